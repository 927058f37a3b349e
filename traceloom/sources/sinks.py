"""Writing evidence, summaries, and the manifest of a run."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators.rules import RULES


def write_text(path: str, text: str) -> None:
    """A small text under any path the session can write to, also on shared storage."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_evidence(findings: DataFrame, path: str, form: str = "parquet") -> None:
    """Findings partitioned by evidence type and rule; every rule's folder is a partition."""
    findings.write.mode("overwrite").partitionBy("evidence_type", "pattern_name").format(form).save(path)


def write_table(df: DataFrame, path: str, form: str = "csv") -> None:
    """A summary as CSV with header (arrays joined by bars) or another format."""
    flat = df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes if not t.startswith(("array<struct", "map"))])
    flat.write.mode("overwrite").option("header", "true").format(form).save(path)


def widen_context(findings: DataFrame, locator: list[str], context: str = "context") -> DataFrame:
    """Every finding gets the longest context seen at its locator."""
    longest = findings.groupBy(*locator).agg(F.max_by(context, F.length(context)).alias("_c"))
    return findings.join(longest, locator).withColumn(context, F.col("_c")).drop("_c")


def write_manifest(path: str, outputs: dict[str, int], options: dict) -> dict:
    """Rule fingerprints, options and row counts of a run, as JSON."""
    manifest = {
        "written_at": datetime.now(timezone.utc).isoformat(timespec="seconds"), "options": options, "outputs": outputs,
        "rules": {r.pattern_name: r.fingerprint for r in RULES},
    }
    write_text(path, json.dumps(manifest, indent=1, sort_keys=True))
    return manifest


def html_report(path: str, title: str, rows: list[dict]) -> None:
    """A static table of a small summary."""
    from html import escape

    cols = list(rows[0]) if rows else []
    head = "".join(f"<th>{escape(c)}</th>" for c in cols)
    body = "".join("<tr>" + "".join(f"<td>{escape(str(r[c]))}</td>" for c in cols) + "</tr>" for r in rows)
    write_text(path, f"<!doctype html><title>{escape(title)}</title><h1>{escape(title)}</h1><table><tr>{head}</tr>{body}</table>")


def write_person_evidence(links: DataFrame, path: str, form: str = "parquet") -> None:
    """One folder per person, named by a digest so that no name or address is a path."""
    links.withColumn("person_digest", F.md5(F.col("person").cast("string"))).write.mode("overwrite").partitionBy("person_digest").format(form).save(path)


def write_index(index: DataFrame, path: str) -> None:
    """A file or person index as JSON lines, to be trusted by a later run."""
    index.write.mode("overwrite").json(path)


def read_index(spark, path: str, like: DataFrame) -> DataFrame:
    """An index written before, with the columns and types of ``like``."""
    return spark.read.schema(like.schema).json(path)
