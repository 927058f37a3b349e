"""Labelled records from delimited, JSON, XML, HTML, mail and Word contents.

Where record boundaries must be inferred from the content, a walker runs over
Arrow batches; its output is the unit every scan reads: an array of (header,
value) pairs.
"""

from __future__ import annotations

import csv
import email
import email.policy
import html
import io
import json
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.operators.rules import resolve_header
from traceloom.sources.files import decode, sniff_delimiter

# A cell of any length is one cell.
csv.field_size_limit((1 << 31) - 1)
UNITS = "key string, row_number string, kind string, fields array<struct<header:string,value:string>>"
#: Most levels and most fields of a record that are read; 0: all of them.
DEPTH, FIELDS = 0, 0
STRONG_LABEL = re.compile(r"(?i)\b(?:name|e-?mail|student|person|passport|dob|birth|nhs|nino|phone)\b|id$")
VALUE_EVIDENCE = re.compile(r"(?i)^[\w.+%-]+@[\w.-]+\.\w{2,}$|^\d{4}-\d{2}-\d{2}$|^[A-Z]{1,2}\d[A-Z\d]? ?\d[A-Z]{2}$")


def clean(value) -> str:
    return " ".join(str(value).split()) if value is not None else ""


def table_records(text: str, delimiter: str | None = None) -> list[list[tuple[str, str]]]:
    """Records of delimited text whose first row is headers; transposed tables are turned.

    A table is transposed if its first column resolves as headers and its first
    row does not. Empty cells give no field; a table without headers gets ``column_N``.
    """
    delimiter = delimiter or sniff_delimiter(text)
    return row_records(list(csv.reader(io.StringIO(text), delimiter=delimiter))) if delimiter else []


def row_records(rows: list[list[str]]) -> list[list[tuple[str, str]]]:
    """The same of rows of cells."""
    rows = [[clean(c) for c in r] for r in rows]
    rows = [r for r in rows if any(r)]
    if len(rows) < 2:
        return []
    known = lambda cells: sum(resolve_header(c) is not None for c in cells)
    first_row, first_col = known(rows[0]), known([r[0] for r in rows])
    if first_col >= 2 and first_col > first_row and first_col >= len(rows) / 2:
        width = max(map(len, rows))
        rows = [[r[i] if i < len(r) else "" for r in rows] for i in range(width)]
        first_row = known(rows[0])
    if first_row == 0 and not all(re.search("[A-Za-z]", c) for c in rows[0] if c):
        headers, body = [f"column_{i + 1}" for i in range(max(map(len, rows)))], rows
    else:
        headers, body = [h or f"column_{i + 1}" for i, h in enumerate(rows[0])], rows[1:]
    out = []
    for r in body:
        fields = [(headers[i] if i < len(headers) else f"column_{i + 1}", v) for i, v in enumerate(r) if v]
        if fields:
            out.append(fields)
    return out


def _score(fields: list[tuple[str, str]]) -> int:
    return sum(3 if STRONG_LABEL.search(h) else 1 if VALUE_EVIDENCE.match(v) else 0 for h, v in fields)


def tree_records(node, max_depth: int = DEPTH, max_fields: int = FIELDS) -> list[list[tuple[str, str]]]:
    """Records inferred from a tree of dicts and lists.

    An object is a record if its scalars score as evidence or it is an item of a
    list; nested objects with own records are records of their own, others fold in.
    With ``max_depth`` or ``max_fields`` above 0 a record ends there.
    """
    deep = max_depth or 1 << 30
    out: list[list[tuple[str, str]]] = []

    def scalars(x, path, depth) -> list[tuple[str, str]]:
        found, todo = [], [(x, path, depth)]
        while todo:
            x, path, depth = todo.pop()
            if depth > deep:
                continue
            if isinstance(x, dict):
                todo += [(v, f"{path}.{k}" if path else str(k), depth + 1) for k, v in reversed(x.items())]
            elif isinstance(x, list):
                todo += [(v, path, depth + 1) for v in reversed(x)]
            elif x is not None and clean(x):
                found.append((path, clean(x)))
        return found

    def walk(x, depth) -> bool:
        """Emit the records below; True if there were any."""
        if depth > deep:
            return False
        if isinstance(x, list):
            return any([walk(v, depth + 1) for v in x])
        if not isinstance(x, dict):
            return False
        own = [(str(k), clean(v)) for k, v in x.items() if not isinstance(v, (dict, list)) and clean(v)]
        nested = {k: v for k, v in x.items() if isinstance(v, (dict, list))}
        inner = {k: walk(v, depth + 1) for k, v in nested.items()}
        fields = own + [f for k, v in nested.items() if not inner[k] for f in scalars(v, str(k), depth + 1)]
        if own and _score(fields) >= 2:
            out.append(list(dict.fromkeys(fields))[:max_fields or None])
            return True
        return any(inner.values())

    if not walk(node, 0):
        rest = scalars(node, "", 0)
        if rest:
            out.append(list(dict.fromkeys(rest))[:max_fields or None])
    return out


def element_tree(e) -> object:
    """An XML element as dicts, lists and text; attributes are ``@name``."""
    node: dict = {f"@{k}": v for k, v in e.attrib.items()}
    for child in e:
        tag, value = child.tag.rsplit("}", 1)[-1], element_tree(child)
        if tag in node:
            node[tag] = node[tag] + [value] if isinstance(node[tag], list) else [node[tag], value]
        else:
            node[tag] = value
    text = clean(e.text)
    if not node:
        return text
    if text:
        node["#text"] = text
    return node


_TAG = re.compile(r"<!\[CDATA\[(?P<cdata>.*?)\]\]>|<!--.*?-->|<\?.*?\?>|<(?P<close>/)?(?P<name>[\w:.-]+)(?P<attrs>[^<>]*?)(?P<empty>/)?>", re.S)
_ATTR = re.compile(r"([\w:.-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def xml_scopes(text: str, max_fields: int = FIELDS) -> list[list[tuple[str, str]]]:
    """Evidence scopes of XML by its tags alone: tolerant of what a parser refuses.

    Every leaf goes to all open elements; an element is a scope when it closes
    with two or more leaves and none of its children was one.
    """
    out, stack, last = [], [], 0
    add = lambda h, v: [f["fields"].append((h, v)) for f in stack if not max_fields or len(f["fields"]) < max_fields]
    for m in _TAG.finditer(text):
        between = clean(html.unescape(text[last:m.start()]))
        last = m.end()
        if stack and between:
            add(stack[-1]["name"], between)
        if m["cdata"] is not None:
            if stack and clean(m["cdata"]):
                add(stack[-1]["name"], clean(m["cdata"]))
            continue
        if m["name"] is None:
            continue
        name = m["name"].rsplit(":", 1)[-1]
        if m["close"]:
            while stack:
                frame = stack.pop()
                leaf = not frame["kids"]
                if not leaf and not frame["emitted"] and len(frame["fields"]) >= 2 and _score(frame["fields"]) >= 2:
                    out.append(list(dict.fromkeys(frame["fields"])))
                    frame["emitted"] = True
                if stack:
                    stack[-1]["emitted"] |= frame["emitted"]
                if frame["name"] == name:
                    break
            continue
        if stack:
            stack[-1]["kids"] += 1
        stack.append({"name": name, "fields": [], "emitted": False, "kids": 0})
        for a, v1, v2 in _ATTR.findall(m["attrs"] or ""):
            if v1 or v2:
                add(a, clean(html.unescape(v1 or v2)))
                stack[-1]["kids"] += 1
        if m["empty"]:
            stack.pop()
    return out


class _Tables(HTMLParser):
    """Rows of all tables and the plain text of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.cell, self.text, self.quiet = [], None, [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("table", "tr", "td", "th"):
            self.end_cell()  # its end tag may be left out
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []
        elif tag in ("script", "style"):
            self.quiet += 1
        elif tag in ("p", "br", "div", "li", "h1", "h2", "h3"):
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.end_cell()
        elif tag in ("script", "style"):
            self.quiet = max(0, self.quiet - 1)

    def end_cell(self):
        if self.cell is not None:
            self.tables[-1][-1].append(clean("".join(self.cell)))
            self.cell = None

    def close(self):
        super().close()
        self.end_cell()

    def handle_data(self, data):
        if self.quiet:
            return
        if self.cell is not None:
            self.cell.append(data)
        else:
            self.text.append(data)


def html_records(text: str) -> list[list[tuple[str, str]]]:
    page = _Tables()
    page.feed(text)
    page.close()
    out = []
    for t in page.tables:
        if len(t) > 1:
            out += [[(h or f"column_{i + 1}", v) for i, (h, v) in enumerate(zip(t[0], r)) if v] for r in t[1:]]
    return [r for r in out if r]


def html_text(text: str) -> str:
    """Text of a page outside its tables, and of tables of one row, which give no records."""
    page = _Tables()
    page.feed(text)
    page.close()
    rows = ["\n" + "\t".join(r) for t in page.tables if len(t) == 1 for r in t]
    return re.sub(r"[ \t]*\n\s*", "\n", "".join([*page.text, *rows])).strip()


def _message(raw: bytes | str) -> email.message.EmailMessage:
    parse = email.message_from_bytes if isinstance(raw, bytes) else email.message_from_string
    return parse(raw, policy=email.policy.default)


def eml_body(raw: bytes | str) -> str:
    """The plain text of a mail; of a mail in markup only, its text."""
    message = _message(raw)
    part = message.get_body(preferencelist=("plain", "html"))
    if part is None:
        return ""
    try:
        body = part.get_content()
    except (LookupError, UnicodeError):  # a character set that does not exist or does not fit
        body = decode(part.get_payload(decode=True) or b"")
    return html_text(body) if part.get_content_type() == "text/html" else body


def eml_records(raw: bytes | str) -> list[list[tuple[str, str]]]:
    """One record of the headers, then labelled lines of the plain body as another."""
    message = _message(raw)
    head = [(h, clean(message[h])) for h in ("Subject", "From", "To", "Cc") if message[h]]
    return [r for r in (head, label_lines(eml_body(raw))) if r]


def label_lines(text: str) -> list[tuple[str, str]]:
    """``label: value`` and ``key = value`` lines of a note or a setting file."""
    out = []
    for line in text.splitlines():
        m = re.match(r"^\s*(?:export\s+)?([A-Za-z][\w .\-/]{0,40}?)\s*[:=]\s*[\"']?(.+?)[\"']?\s*$", line)
        if m:
            out.append((clean(m[1]), clean(m[2])))
    return out


def docx_text(raw: bytes) -> str:
    """Paragraphs, then table rows with tabs, of a Word file."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml")).find(f"{ns}body")
    say = lambda e: "".join(t.text or "" for t in e.iter(f"{ns}t"))
    rows = [say(p) for p in body.findall(f"{ns}p")]
    rows += ["\t".join(say(c) for c in r.findall(f"{ns}tc")) for t in body.findall(f"{ns}tbl") for r in t.findall(f"{ns}tr")]
    return "\n".join(r for r in rows if r.strip())


def xlsx_sheets(raw: bytes) -> list[list[list[str]]]:
    """Rows of cells of every sheet of a workbook, empty cells in their places."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    book = zipfile.ZipFile(io.BytesIO(raw))
    names = set(book.namelist())
    say = lambda e: "".join(t.text or "" for t in e.iter(f"{ns}t"))
    shared = [say(x) for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{ns}si")] if "xl/sharedStrings.xml" in names else []
    sheets = []
    for name in sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n))):
        rows = []
        for row in ElementTree.fromstring(book.read(name)).iter(f"{ns}row"):
            cells: dict[int, str] = {}
            for c in row.findall(f"{ns}c"):
                letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
                at = sum((ord(x) - 64) * 26 ** i for i, x in enumerate(reversed(letters))) - 1 if letters else len(cells)
                value = c.find(f"{ns}v")
                kind = c.get("t")
                if kind == "s" and value is not None:
                    cells[at] = shared[int(value.text)] if int(value.text) < len(shared) else ""
                else:
                    cells[at] = say(c) if kind == "inlineStr" else (value.text or "") if value is not None else ""
            rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
        sheets.append(rows)
    return sheets


_RTF = re.compile(r"\\'([0-9a-fA-F]{2})|\\u(-?\d+) ?\??|\\([a-zA-Z]+)(-?\d+)? ?|\\([^a-zA-Z])|([{}])|([\r\n]+)")
#: Groups of a rich text that hold no text of the document.
_RTF_HIDDEN = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "themedata", "datastore", "generator", "listtable", "listoverridetable", "rsidtbl", "xmlnstbl"}


def rtf_text(raw: bytes) -> str:
    """The text of a rich text file: control words off, paragraphs as lines, hidden groups left out."""
    text = raw.decode("latin-1")
    out, last, hidden = [], 0, [False]
    for m in _RTF.finditer(text):
        if not hidden[-1]:
            out.append(text[last:m.start()])
        last = m.end()
        code, uni, word, _, sign, brace, _ = m.groups()
        if brace == "{":
            hidden.append(hidden[-1])
        elif brace == "}":
            if len(hidden) > 1:
                hidden.pop()
        elif word in _RTF_HIDDEN or sign == "*":
            hidden[-1] = True
        elif hidden[-1]:
            continue
        elif code:
            out.append(bytes([int(code, 16)]).decode("cp1252", "replace"))
        elif uni:
            out.append(chr(int(uni) % 65536))
        elif word in ("par", "line", "row", "sect", "page"):
            out.append("\n")
        elif word in ("tab", "cell"):
            out.append("\t")
        elif sign in ("\\", "{", "}"):
            out.append(sign)
        elif sign == "~":
            out.append(" ")
    return "".join([*out, "" if hidden[-1] else text[last:]])


def plain_text(content: bytes | str, extension: str) -> str:
    """The text of a content that is no record format."""
    if isinstance(content, str):
        return content
    return rtf_text(content) if extension == ".rtf" else decode(content)


def jsonl_records(text: str, max_depth: int = DEPTH, max_fields: int = FIELDS) -> list[list[tuple[str, str]]]:
    """Records of the lines that are JSON; others are skipped."""
    out = []
    for line in text.splitlines():
        try:
            node = json.loads(line)
        except ValueError:
            continue
        out += tree_records(node, max_depth, max_fields)
    return out


def embedded_tables(text: str) -> list[list[tuple[str, str]]]:
    """Records of delimited blocks inside prose: runs of two or more lines of one field count."""
    out, run, count, delimiter = [], [], 0, None
    for line in [*text.splitlines(), ""]:
        d = next((d for d in DELIMITED if line.count(d) >= 2), None) if line.strip() else None
        n = line.count(d) if d else 0
        if d and d == delimiter and n == count:
            run.append(line)
            continue
        if len(run) >= 3:
            out += table_records("\n".join(run), delimiter)
        run, count, delimiter = ([line], n, d) if d else ([], 0, None)
    return out


DELIMITED = "|\t;~#"


def xml_records(text: str, max_depth: int = DEPTH, max_fields: int = FIELDS) -> list[list[tuple[str, str]]]:
    """Records of the tree that a strict parser makes of XML; fields are named by their paths."""
    root = ElementTree.fromstring(text)
    return tree_records({root.tag.rsplit("}", 1)[-1]: element_tree(root)}, max_depth, max_fields)


def records_of(content: bytes | str, extension: str, max_depth: int = DEPTH, max_fields: int = FIELDS, xml_tree: bool = False) -> tuple[str, list[list[tuple[str, str]]]]:
    """(kind, records) of a content by its extension; what fails gives none."""
    text = plain_text(content, extension)
    try:
        if extension == ".xlsx":
            return "TABLE_ROW", [r for rows in xlsx_sheets(content) for r in row_records(rows)]
        if extension == ".json":
            return "JSON_RECORD", tree_records(json.loads(text), max_depth, max_fields)
        if extension == ".jsonl":
            return "JSONL_RECORD", jsonl_records(text, max_depth, max_fields)
        if extension == ".xml" and xml_tree:
            return "XML_RECORD", xml_records(text, max_depth, max_fields)
        if extension == ".xml":
            return "XML_SCOPE", xml_scopes(text, max_fields)
        if extension in (".html", ".htm"):
            return "TABLE_ROW", html_records(text)
        if extension == ".eml":
            return "MAIL", eml_records(content)
        if extension in (".csv", ".tsv"):
            return "TABLE_ROW", table_records(text, "\t" if extension == ".tsv" else None)
        if extension in (".yaml", ".yml"):
            import yaml

            return "YAML_RECORD", tree_records(yaml.safe_load(text), max_depth, max_fields)
    except Exception:
        return "", []
    return "TABLE_ROW", embedded_tables(text)


def rest_text(content: bytes | str, extension: str) -> str:
    """What of a structured content no record holds: all of it if it gives no records.

    Of a page its text, of JSON lines those that are none and of a mail the lines
    without label, in their places; of a
    Word file, which has no records, its text, none if it is damaged.
    """
    if extension == ".docx":
        try:
            return docx_text(content)
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, AttributeError, RuntimeError, NotImplementedError, OSError):
            return ""
    if extension == ".xlsx":
        # Sheets without records, as those of a single row, are text.
        try:
            return "\n".join("\t".join(r) for rows in xlsx_sheets(content) if not row_records(rows) for r in rows)
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError, RuntimeError, NotImplementedError, OSError):
            return ""
    text = plain_text(content, extension)
    if extension in (".html", ".htm"):
        return html_text(text)
    if extension == ".eml":
        body = eml_body(content)
        return "\n".join("" if label_lines(line) else line for line in body.splitlines())
    if extension == ".jsonl":
        return "\n".join("" if jsonl_records(line) else line for line in text.splitlines())
    return "" if records_of(content, extension)[1] else text


def texts(df: DataFrame, key: str, content: str, extension, read) -> DataFrame:
    """(key, text) of contents by ``read`` of content and extension."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, read(c, e or "")) for k, c, e in zip(b["key"], b["content"], b["ext"]) if c is not None]
            yield pd.DataFrame([r for r in rows if r[1]], columns=["key", "text"])

    cols = df.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"), extension.alias("ext"))
    return cols.mapInPandas(walk, "key string, text string")


def record_units(df: DataFrame, key: str, content: str, extension, max_depth: int = DEPTH, max_fields: int = FIELDS, xml_tree: bool = False) -> DataFrame:
    """(key, row_number, kind, fields) of every record in the contents."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, c, e in zip(b["key"], b["content"], b["ext"]):
                if c is None:
                    continue
                kind, records = records_of(c, e or "", max_depth, max_fields, xml_tree)
                label = "xml_scope:" if kind == "XML_SCOPE" else ""
                rows += [(k, f"{label}{i + 1}", kind, [{"header": h, "value": v} for h, v in r]) for i, r in enumerate(records)]
            yield pd.DataFrame(rows, columns=["key", "row_number", "kind", "fields"])

    cols = df.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"), extension.alias("ext"))
    return cols.mapInPandas(walk, UNITS)
