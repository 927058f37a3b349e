"""A full run: from a tree of files to findings, clusters, exposure and reports.

Each stage writes a table in the output folder and the next one reads it, so a run
can be resumed at any stage and a lost executor costs no more than its tasks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.config import EngineConfig
from traceloom.functions.text import context_window, email_type
from traceloom.operators import linking as L
from traceloom.operators import people as P
from traceloom.operators.dedupe import collapse_evidence
from traceloom.operators.ordering import group_places
from traceloom.operators.profiling import column_profile, value_type
from traceloom.operators.rules import RULES, Rule, load_rules, resolve_header, rules_for
from traceloom.operators.scan import AROUND, FINDING, assemble_names, cap_findings, lines, match_text, scan_table, scan_text
from traceloom.operators.summary import entity_summary, file_summary, regex_summary
from traceloom.sources.files import IMAGES, excluded, file_index, file_signals, hidden, list_files
from traceloom.sources.records import plain_text, record_units, rest_text, texts
from traceloom.sources.sinks import html_report, widen_context, write_evidence, write_manifest, write_person_evidence, write_table

STAGES = ("scanning", "clustering", "reidentification", "reporting")
STRUCTURED = (".csv", ".tsv", ".json", ".jsonl", ".xml", ".html", ".htm", ".eml", ".yaml", ".yml")
TEXT = (".txt", ".rtf", ".log", ".ini", ".sh", ".dat", ".inx", ".md", ".conf")
#: Packed files with a reader of their own; as bytes they look binary.
PACKED = (".docx", ".xlsx")


RESOLVED = "header string, rules array<string>, full_name boolean"


def resolved_headers(headers: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(header, rules, full_name): the rules each distinct header leads to, resolved where the headers are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [resolve_header(h) for h in b["header"]]
            yield pd.DataFrame({
                "header": b["header"], "rules": [[r.pattern_name for r in rules_for(h, rules)] for h in b["header"]],
                "full_name": [r is not None and r.canonical == "full name" for r in found],
            })

    return headers.select("header").where("header IS NOT NULL").distinct().mapInPandas(run, RESOLVED)


#: Columns of a finding: where it is, what it is, and what stands around.
FOUND = (
    "unit_key", "row_number", "evidence_type", "pattern_name", "matched_text", "normalized_value", "confidence", "evidence_tier", "start_offset", "end_offset", "context",
)


def scan_units(units: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings in labelled records whose headers are known only at run time.

    Distinct headers are resolved once, in Arrow batches, and joined to the cells; the
    planner sends that table to all tasks if it is small when it is there, and else
    shuffles. Each rule runs on the cells whose header leads to it.
    """
    cell = units.select("key", "row_number", F.explode("fields").alias("f")).select("key", "row_number", "f.*")
    known = cell.join(resolved_headers(cell.select("header"), rules), "header")
    none = F.array().cast(FINDING)
    arrays = [
        F.when(F.array_contains("rules", r.pattern_name), match_text(F.concat_ws(": ", "header", "value"), r, "cell")).otherwise(none) for r in rules
    ]
    arrays.append(F.when(F.col("full_name"), assemble_names({"name": F.col("value")})[0]).otherwise(none))
    found = known.select(F.col("key").alias("unit_key"), "row_number", "header", "value", F.explode(F.concat(*arrays)).alias("f"))
    # Places in a cell; a name that was put together need not stand in it as it is.
    at = F.nullif(F.call_function("locate", F.col("matched_text"), F.col("value")), F.lit(0)) - 1
    cell = F.concat_ws(": ", "header", "value")
    shift = F.length("header") + 2
    found = found.select("unit_key", "row_number", "header", "value", "f.*").drop("source_column").withColumn("start_offset", at.cast("int"))
    end = F.col("start_offset") + F.length("matched_text")
    around = context_window(cell, F.coalesce(F.col("start_offset"), F.lit(0)) + shift, F.coalesce(end, F.length("value")) + shift, AROUND)
    return found.withColumns({"end_offset": end.cast("int"), "context": around}).drop("header", "value").distinct()


def numbered(contents: DataFrame, label: str = "") -> DataFrame:
    """(unit_key, row_number, text): the lines of (key, text)."""
    rows = contents.select(F.col("key").alias("unit_key"), F.posexplode(lines(F.col("text"))).alias("_p", "text"))
    return rows.select("unit_key", F.concat(F.lit(label), (F.col("_p") + 1).cast("string")).alias("row_number"), "text")


class Engine:
    """Runs the stages of a configuration on a session."""

    def __init__(self, spark: SparkSession, config: EngineConfig):
        self.spark, self.config = spark, config
        self.rules = load_rules(config.rules) if config.rules else RULES

    def path(self, name: str) -> str:
        return os.path.join(self.config.output_dir, name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name)

    def discover(self) -> DataFrame:
        """The files to scan with type, digest and duplicate index."""
        c = self.config
        files = list_files(self.spark, c.root)
        keep = ~excluded(F.col("path"), names=[e for e in c.exclude if "/" not in e], suffixes=[e for e in c.exclude if "/" in e and not e.startswith("/")],
                         roots=[e for e in c.exclude if e.startswith("/")])
        if not c.include_hidden:
            keep = keep & ~hidden(F.col("path"))
        index = file_index(files.where(keep))
        digest = F.col("sha256") if c.file_hash == "sha256" else F.col("md5")
        placed = group_places(index.withColumn("digest", F.concat(F.lit(f"{c.file_hash}:"), digest)), "digest", "path", name="duplicate_index")
        return self.save(placed.withColumnRenamed("group_size", "duplicate_count").withColumnRenamed("canonical", "canonical_path"), "file_index")

    def scan(self, index: DataFrame) -> DataFrame:
        """Findings of all canonical files, repeated for duplicates where asked."""
        c = self.config
        wanted = index.where(~F.col("binary") | F.col("detected_extension").isin(*PACKED))
        if c.duplicate_files != "scan":
            wanted = wanted.where("duplicate_index = 1")
        files = list_files(self.spark, c.root).select("path", "content").join(wanted.select("path", "detected_extension"), "path")
        kind = F.col("detected_extension")
        structured, plain = files.where(kind.isin(*STRUCTURED)), files.where(kind.isin(*TEXT))
        # Places of tables in a text, and of text beside records, are named apart from its lines.
        units = record_units(structured, "path", "content", kind, c.structured_max_depth, c.xml_max_fields, c.xml_mode == "structured")
        tables = record_units(plain.where(~kind.isin(*STRUCTURED)), "path", "content", kind)
        units = units.unionByName(tables.withColumn("row_number", F.concat(F.lit("table:"), "row_number")))
        prose = numbered(texts(plain, "path", "content", kind, plain_text))
        rest = numbered(texts(structured.where(~kind.isin(*TEXT)), "path", "content", kind, rest_text), "text:")
        packed = numbered(texts(files.where(kind.isin(*PACKED)), "path", "content", kind, rest_text))
        units = units.unionByName(record_units(files.where(kind == ".xlsx"), "path", "content", kind))
        prose = prose.unionByName(rest).unionByName(packed)
        found = scan_units(units, self.rules).select(*FOUND).unionByName(scan_text(prose, self.rules, places=True).select(*FOUND))
        if c.email_suffixes:
            found = found.withColumn("evidence_type", F.when(F.col("evidence_type") == "Email", email_type(F.col("normalized_value"), c.email_suffixes)).otherwise(F.col("evidence_type")))
        if c.max_findings_per_file:
            found = cap_findings(found, ["unit_key"], ["row_number", "evidence_type", "normalized_value", "matched_text"], c.max_findings_per_file)
        if c.duplicate_files == "collapse":
            copies = index.where("duplicate_index > 1").select("path", F.col("canonical_path").alias("unit_key"))
            found = found.unionByName(found.join(copies, "unit_key").drop("unit_key").withColumnRenamed("path", "unit_key"))
        return self.save(found, "findings")

    def cluster(self, findings: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Linked evidence, one row per unit, and its clusters."""
        linked = L.linked_evidence(findings.where("evidence_tier <> 'metadata'"), ["unit_key", "row_number"])
        linked = self.save(linked.withColumn("row_id", F.xxhash64("unit_key", "row_number")), "linked_evidence")
        if self.config.duplicate_evidence != "scan":
            self.save(collapse_evidence(linked, "row_id"), "evidence_groups")
        clusters = L.cluster_rows(linked, "row_id", self.config.hub_limit)
        members = self.save(clusters, "cluster_members")
        return linked, self.save(L.cluster_summary(linked, members, "row_id", "unit_key"), "clusters")

    def people(self, findings: DataFrame, linked: DataFrame) -> None:
        """Exposure, risk matrix and unknown evidence for the person tables."""
        tables = [self.spark.read.option("header", "true").csv(p) for p in self.config.person_tables]
        if not tables:
            return
        keyed = []
        for df in tables:
            keys = [c for c in df.columns if c in self.config.person_key] or df.columns[:1]
            keyed.append((df.withColumn("__person", P.person_key(df, keys)), df.columns))
        anchors = reduce(DataFrame.unionByName, [P.person_anchors(scan_table(df, "__person", cols, self.rules)) for df, cols in keyed]).distinct()
        people = reduce(DataFrame.unionByName, [df.select(F.col("__person").alias("person")) for df, _ in keyed]).distinct()
        hits = self.save(P.anchored_people(findings, anchors, ["unit_key", "row_number"]), "person_links")
        exposure = self.save(P.known_exposure(hits, ["unit_key", "row_number"]), "known_people")
        types = sorted({r.evidence_type for r in self.rules} | {"Name"})
        self.save(P.risk_matrix(people, exposure, types), "risk_matrix")
        self.save(P.not_in_dataset(people, hits), "not_in_dataset")
        self.save(P.unknown_rows(linked, hits, ["unit_key", "row_number"]), "unknown_evidence")

    def statuses(self, index: DataFrame) -> DataFrame:
        """(path, status, detail) of every listed file; what was not read is listed with its reason.

        Files without any content are not listed: the reader of files passes them over.
        """
        kind = F.col("detected_extension")
        readable = kind.isin(*STRUCTURED, *TEXT, *PACKED)
        collapse = self.config.duplicate_files != "scan"
        image = F.coalesce(kind.isin(*IMAGES), F.lit(False))
        status = F.when(image, "ocr_disabled").when(F.lit(collapse) & (F.col("duplicate_index") > 1), "duplicate").when(
            F.col("binary") & ~kind.isin(*PACKED), "binary").when(~readable, "unsupported").otherwise("scanned")
        # Pictures are known by name and type only (see file_signals); nothing reads their pixels.
        detail = F.when(status == "duplicate", F.col("canonical_path")).when(status.isin("binary", "unsupported", "ocr_disabled"), kind).otherwise("")
        return index.select("path", status.alias("status"), detail.alias("detail"))

    def report(self, findings: DataFrame) -> None:
        index = self.read("file_index")
        statuses = self.save(self.statuses(index), "file_status")
        write_table(statuses.where(~F.col("status").isin("scanned", "duplicate")), self.path("errors"))
        types = sorted({r.evidence_type for r in self.rules} | {"Name"})
        files = index.select(F.col("path").alias("unit_key"), "size_bytes", "detected_extension").join(statuses.select(F.col("path").alias("unit_key"), "status"), "unit_key")
        write_table(file_summary(files, findings, "unit_key", types), self.path("file_summary"))
        write_table(entity_summary(findings, "unit_key"), self.path("entity_summary"))
        write_table(regex_summary(findings, "unit_key"), self.path("regex_summary"))
        # Every finding of a unit carries the longest context any of them has.
        write_evidence(widen_context(findings, ["unit_key", "row_number"]), self.path("evidence"), self.config.output_format)
        names = index.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "extension")
        write_table(file_signals(names, "file_name", "extension"), self.path("file_signals"))
        links = self.path("person_links")
        if self.config.person_evidence and self.config.person_tables:
            write_person_evidence(self.spark.read.parquet(links), self.path("person_evidence"), self.config.output_format)
        if self.config.html_report:
            # One row per rule.
            rows = [r.asDict() for r in regex_summary(findings, "unit_key").orderBy("evidence_type", "pattern_name").collect()]
            html_report(self.path("report.html"), "Findings by rule", rows)
        if self.config.profile:
            for p in self.config.person_tables:
                df = self.spark.read.option("header", "true").csv(p)
                write_table(value_type(column_profile(df)), self.path(f"profile_{os.path.splitext(os.path.basename(p))[0]}"))

    def run(self) -> dict:
        """All stages, or those from ``resume`` on; returns the manifest."""
        start = STAGES.index(self.config.resume) if self.config.resume else 0
        findings = self.scan(self.discover()) if start == 0 else self.read("findings")
        linked = self.cluster(findings)[0] if start <= 1 else self.read("linked_evidence")
        if start <= 2:
            self.people(findings, linked)
        self.report(findings)
        counts = {n: self.read(n).count() for n in ("findings", "linked_evidence", "clusters")}
        return write_manifest(self.path("manifest.json"), counts, self.config.__dict__)
