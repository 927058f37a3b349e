"""File discovery, content sniffing, decoding and exclusion."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from io import BytesIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = 8192
#: File types by their first bytes (fixed values).
MAGIC = (
    (b"%PDF", ".pdf"), (b"{\\rtf", ".rtf"), (b"\x89PNG", ".png"), (b"\xff\xd8\xff", ".jpg"), (b"GIF8", ".gif"), (b"II*\x00", ".tiff"),
    (b"MM\x00*", ".tiff"), (b"BM", ".bmp"), (b"\xd0\xcf\x11\xe0", ".xls"),
)
KNOWN = {".txt", ".log", ".csv", ".tsv", ".json", ".jsonl", ".xml", ".html", ".htm", ".eml", ".yaml", ".yml", ".ini", ".sh", ".dat", ".inx", ".md", ".conf"}
DELIMITERS = ",\t;|~#"


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, size_bytes, modified, extension, content): every file below ``root``.

    Listing and reading are distributed; content is read only by what selects it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), extension_of(F.col("path")).alias("extension"), "content"
    )


def extension_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.regexp_extract(path, r"([^/\\]+)$", 1), r"(\.[A-Za-z0-9]{1,8})$", 1))


def excluded(path: Column, names: Sequence[str] = (), suffixes: Sequence[str] = (), roots: Sequence[str] = ()) -> Column:
    """Bare names at any depth, trailing parts of a path, and whole subtrees."""
    p = F.translate(F.lower(path), "\\", "/")
    out = F.lit(False)
    for n in names:
        out = out | F.array_contains(F.split(p, "/"), n.lower())
    for s in suffixes:
        s = s.replace("\\", "/").strip("/").lower()
        out = out | p.endswith("/" + s) | p.contains("/" + s + "/")
    for r in roots:
        r = r.replace("\\", "/").rstrip("/").lower()
        out = out | (p == r) | p.startswith(r + "/")
    return out


def hidden(path: Column) -> Column:
    return F.exists(F.split(path, "/"), lambda x: x.startswith(".") & (F.length(x) > 1))


def binary_like(raw: bytes) -> bool:
    """A NUL in the first 4 KiB, or many control bytes; UTF-16 text is not binary."""
    head = raw[:4096]
    if not head or utf16_of(head):
        return False
    if b"\x00" in head:
        return True
    control = sum(b < 9 or 13 < b < 32 for b in head)
    return control > max(32, len(head) // 10)


def utf16_of(raw: bytes) -> str | None:
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    head = raw[:4096]
    if len(head) >= 8:
        even, odd = head[0::2].count(0) / max(1, len(head[0::2])), head[1::2].count(0) / max(1, len(head[1::2]))
        if odd > 0.25 and even < 0.05:
            return "utf-16-le"
        if even > 0.25 and odd < 0.05:
            return "utf-16-be"
    return None


def decode(raw: bytes) -> str:
    """UTF-16 by mark or by its zero bytes, else UTF-8 without what is not valid."""
    kind = utf16_of(raw)
    if kind:
        return raw.decode(kind, "ignore")
    return raw.decode("utf-8-sig", "ignore")


def decode_table(raw: bytes) -> str:
    """Strict cascade for person tables."""
    for kind in ("utf-8-sig", "cp1252"):
        try:
            return raw.decode(kind)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def sniff_delimiter(text: str) -> str | None:
    """The delimiter that splits the first lines into the same number of two or more fields."""
    rows = [r for r in text.splitlines()[:20] if r.strip()]
    best = None
    for d in DELIMITERS:
        counts = [r.count(d) for r in rows]
        if rows and min(counts) >= 1:
            even = counts.count(counts[0]) / len(counts)
            rank = (even, min(counts))
            if even >= 0.7 and (best is None or rank > best[0]):
                best = (rank, d)
    return best[1] if best else None


def sniff(raw: bytes, extension: str) -> str:
    """The extension a file's content speaks for."""
    head = raw[:HEAD]
    for magic, ext in MAGIC:
        if head.startswith(magic):
            return extension if ext == ".xls" and extension in (".xls", ".doc", ".msg") else ext
    if head.startswith(b"RIFF") and head[8:12] == b"WEBP":
        return ".webp"
    if head.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(BytesIO(raw)).namelist()
        except zipfile.BadZipFile:
            return ".zip"
        for part, ext in (("word/", ".docx"), ("xl/", ".xlsx"), ("ppt/", ".pptx")):
            if any(n.startswith(part) for n in names):
                return ext
        return ".zip"
    text = decode(head).lstrip()
    low = text[:512].lower()
    if low.startswith(("<!doctype html", "<html")):
        return ".html"
    if low.startswith("<?xml"):
        return ".xml"
    if extension in KNOWN:
        return extension
    if binary_like(head):
        return extension or ".bin"
    d = sniff_delimiter(text)
    return ".tsv" if d == "\t" else ".csv" if d else ".txt"


INDEX = "path string, size_bytes long, extension string, detected_extension string, binary boolean, sha256 string, md5 string"


def file_index(files: DataFrame) -> DataFrame:
    """What each file is, by its content, with its digests."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["detected_extension"] = [sniff(c, e) for c, e in zip(b["content"], b["extension"])]
            b["binary"] = [binary_like(c) for c in b["content"]]
            yield b[["path", "size_bytes", "extension", "detected_extension", "binary", "sha256", "md5"]]

    # The directory of a zip is at its end; of others the beginning tells.
    zipped = F.substring("content", 1, 4) == F.lit(b"PK\x03\x04")
    seen = F.when(zipped, F.col("content")).otherwise(F.substring("content", 1, 1 << 20)).alias("content")
    cols = files.select("path", "size_bytes", "extension", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), seen)
    return cols.mapInPandas(look, INDEX)


IMAGES = (".png", ".jpg", ".jpeg", ".gif", ".tiff", ".tif", ".bmp", ".webp", ".heic")
DOCUMENTS = (".pdf", ".doc", ".docx", ".rtf")


def file_signals(files: DataFrame, name: str, extension: str) -> DataFrame:
    """(file_name, evidence_type, confidence): what a name and extension alone say."""
    from traceloom.functions.validators import identity_document_file

    ext = F.concat(F.lit("."), F.regexp_replace(F.lower(F.col(extension)), r"^\.", ""))
    image, document = ext.isin(*IMAGES), ext.isin(*DOCUMENTS)
    signals = F.array_compact(F.array(
        F.when(image, F.struct(F.lit("Pictures").alias("t"), F.lit("high").alias("c"))), F.when(document, F.struct(F.lit("Document Info").alias("t"), F.lit("low").alias("c"))),
        F.when((image | document) & identity_document_file(F.col(name)), F.struct(F.lit("Identity Document File").alias("t"), F.lit("medium").alias("c"))),
    ))
    return files.select(F.col(name).alias("file_name"), F.explode(signals).alias("s")).select("file_name", F.col("s.t").alias("evidence_type"), F.col("s.c").alias("confidence"))
