"""Summaries of findings: by type, by rule, by file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import capped_join
from traceloom.operators.linking import IDENTIFIABLE, SENSITIVE, STANDALONE, TIER_ONE, _any


def entity_summary(findings: DataFrame, file: str) -> DataFrame:
    """(evidence_type, findings, files)."""
    return findings.groupBy("evidence_type").agg(F.count("*").alias("findings"), F.count_distinct(file).alias("files"))


def regex_summary(findings: DataFrame, file: str) -> DataFrame:
    """Per rule: findings, distinct values and files, confidences and tiers."""
    return findings.groupBy("evidence_type", "pattern_name").agg(
        F.count("*").alias("findings"), F.count_distinct("normalized_value").alias("distinct_values"), F.count_distinct(file).alias("files"),
        capped_join(F.collect_set("confidence")).alias("confidences"), capped_join(F.collect_set("evidence_tier")).alias("tiers"),
    )


def file_summary(files: DataFrame, findings: DataFrame, file: str, types: Sequence[str]) -> DataFrame:
    """Every file with a count per evidence type, all findings, and its risk."""
    slug = lambda t: "count_" + "".join(c if c.isalnum() else "_" for c in t.lower())
    counts = findings.groupBy(file).agg(
        F.count("*").alias("finding_count"), F.collect_set("evidence_type").alias("_types"),
        *[F.count_if(F.col("evidence_type") == t).alias(slug(t)) for t in types],
    )
    joined = files.join(counts, file, "left")
    types_col = F.coalesce("_types", F.array().cast("array<string>"))
    return joined.select(
        *files.columns, F.coalesce("finding_count", F.lit(0)).alias("finding_count"),
        *[F.coalesce(slug(t), F.lit(0)).alias(slug(t)) for t in types], file_risk(types_col).alias("risk_level"),
    )


def file_risk(types):
    """High and medium as for a unit, but three supporting types alone make medium."""
    email, name, dob = _any(types, ("Email", "Institutional Email", "Personal Email")), _any(types, ("Name",)), _any(types, ("DOB",))
    high = _any(types, STANDALONE) | ((name | email) & dob) | (_any(types, SENSITIVE) & _any(types, IDENTIFIABLE))
    third = F.size(F.filter(types, lambda t: ~t.isin(*TIER_ONE, *SENSITIVE)))
    return F.when(F.size(types) == 0, "none").when(high, "high").when(_any(types, TIER_ONE) | (third >= 3), "medium").otherwise("low")
