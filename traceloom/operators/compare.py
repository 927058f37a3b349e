"""Comparing two runs: what evidence, clusters and people they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evidence_terms(findings: DataFrame) -> DataFrame:
    """(evidence_type, term): distinct evidence as digests."""
    return findings.select("evidence_type", F.sha2(F.concat_ws("=", "evidence_type", F.lower("normalized_value")), 256).alias("term")).distinct()


def conservation(left: DataFrame, right: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Shared, left only, right only, shares kept, and the Jaccard index; per group if asked."""
    by = by or []
    sides = left.select(*by, "term", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*by, "term", F.lit(0).alias("l"), F.lit(1).alias("r")))
    flags = sides.groupBy(*by, "term").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counted = flags.groupBy(*by).agg(F.sum(F.col("l") * F.col("r")).alias("shared"), F.sum(F.col("l") * (1 - F.col("r"))).alias("left_only"), F.sum((1 - F.col("l")) * F.col("r")).alias("right_only"))
    pct = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    s, lo, ro = F.col("shared"), F.col("left_only"), F.col("right_only")
    return counted.withColumns({"left_kept": pct(s, s + lo), "right_kept": pct(s, s + ro), "jaccard": pct(s, s + lo + ro)})


def people_two_by_two(universe: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(both, left_only, right_only, neither): people of a list found by two runs."""
    flags = universe.select("person").distinct().join(left.select("person", F.lit(True).alias("l")).distinct(), "person", "left").join(
        right.select("person", F.lit(True).alias("r")).distinct(), "person", "left")
    l, r = F.coalesce("l", F.lit(False)), F.coalesce("r", F.lit(False))
    return flags.agg(F.count_if(l & r).alias("in_both"), F.count_if(l & ~r).alias("left_only"), F.count_if(~l & r).alias("right_only"), F.count_if(~l & ~r).alias("neither"))
