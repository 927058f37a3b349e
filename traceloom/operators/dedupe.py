"""Duplicate contents and duplicate evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.operators.ordering import group_places


def content_groups(df: DataFrame, key: str, content: str, algorithm: str = "sha256") -> DataFrame:
    """(key, size, digest, group_size, duplicate_index, canonical, action): rows of equal content.

    The least key of a group is the canonical one. What is sorted and shuffled are
    digests; a group of any size is spread over ranges.
    """
    size = F.octet_length(content)
    sized = df.select(F.col(key).alias("key"), size.alias("size_bytes"), F.col(content).alias("_c"))
    digest = F.sha2("_c", 256) if algorithm == "sha256" else F.md5("_c")
    hashed = sized.select("key", "size_bytes", F.concat(F.lit(f"{algorithm}:"), digest).alias("digest"))
    placed = group_places(hashed, "digest", "key", name="duplicate_index")
    first = (F.col("group_size") == 1) | (F.col("duplicate_index") == 1)
    return placed.select(
        "key", "size_bytes", "digest", "group_size", "duplicate_index", "canonical", F.when(first, "scanned").otherwise("duplicate_collapsed").alias("action")
    )


def evidence_signature(linked: DataFrame) -> DataFrame:
    """Adds ``signature``: a digest of the sorted evidence, anchor and eligibility, not of the place."""
    pairs = F.array_sort(F.transform("evidence", lambda e: F.concat(F.lower(e["t"]), F.lit("="), F.lower(e["v"]))))
    return linked.withColumn("signature", F.sha2(F.concat_ws("\x1f", F.array_join(pairs, "\x1e"), F.lower("anchor_type"), F.lower("anchor_value"), "cluster_eligible"), 256))


def collapse_evidence(linked: DataFrame, row: str) -> DataFrame:
    """One row per signature, with how many there were and where the first was."""
    signed = evidence_signature(linked)
    return signed.groupBy("signature").agg(
        F.count("*").alias("duplicate_count"), F.min(row).alias("first_row"), F.min_by("evidence_values", row).alias("evidence_values"), F.min_by("risk_level", row).alias("risk_level"),
    )
