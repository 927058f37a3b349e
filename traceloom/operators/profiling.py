"""Column profiles: what a column holds, and what it should be treated as."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import safe_cell
from traceloom.functions.validators import contextual_date, postcode

EMAIL_SHAPE = r"(?i)^[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}$"
NUMBER_SHAPE = r"^[+-]?\d+(?:[.,]\d+)?$"
ENUM_MOST, SAMPLES = 10, 5


def cells(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column_name, value): all cells, one row each."""
    columns = list(columns or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), safe_cell(F.col(f"`{c}`").cast("string")).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("c")).select("c.*")


def value_flags(value: Column) -> dict[str, Column]:
    return {
        "email": value.rlike(EMAIL_SHAPE), "date": contextual_date(value) | value.rlike(r"^\d{4}-\d{2}-\d{2}"), "postcode": postcode(value),
        "numeric": value.rlike(NUMBER_SHAPE),
    }


def column_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Per column: rows, blanks, distinct values, lengths, and shares of shapes.

    Distinct counts are exact: cells are first aggregated by value (in part before
    the shuffle), so what is shuffled is the distinct values, not the cells.
    """
    by_value = cells(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    filled = F.col("value") != ""
    flags = value_flags(F.col("value"))
    share = lambda c: F.round(F.sum(F.when(filled & c, F.col("n")).otherwise(0)) / F.greatest(F.lit(1), F.sum(F.when(filled, F.col("n")).otherwise(0))), 6)
    return by_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(filled, 0).otherwise(F.col("n"))).alias("blank_count"), F.count_if(filled).alias("distinct_count"),
        F.min(F.when(filled, F.length("value"))).alias("min_length"), F.max(F.when(filled, F.length("value"))).alias("max_length"),
        *[share(c).alias(f"{k}_rate") for k, c in flags.items()],
    )


def value_type(profile: DataFrame) -> DataFrame:
    """Adds ``suggested``: identifier, enum, email, date, postcode or text."""
    filled = F.greatest(F.lit(1), F.col("row_count") - F.col("blank_count"))
    unique = F.col("distinct_count") / filled
    quiet = (F.col("date_rate") < 0.5) & (F.col("postcode_rate") < 0.5) & (F.col("email_rate") < 0.5)
    return profile.withColumn(
        "suggested",
        F.when(F.col("email_rate") >= 0.9, "email").when(F.col("postcode_rate") >= 0.9, "postcode").when(F.col("date_rate") >= 0.9, "date")
        .when((F.col("numeric_rate") >= 0.8) & (unique >= 0.8) & (F.col("distinct_count") >= 20) & quiet, "identifier")
        .when(F.col("distinct_count").between(2, ENUM_MOST) & (unique <= 0.2), "enum").otherwise("text"),
    )


def value_samples(df: DataFrame, columns: Iterable[str] | None = None, n: int = SAMPLES) -> DataFrame:
    """Per column the values of the least digests: a sample that any order of rows gives again."""
    distinct = cells(df, columns).where("value <> ''").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.md5("value"), "value"))
    return distinct.withColumn("rank", rank).where(F.col("rank") <= n).select("column_name", "rank", "value", "n")


def schema_signature(profile: DataFrame) -> DataFrame:
    """One digest of the profile of all columns: tables of one make share it."""
    row = F.concat_ws(",", "column_name", *[F.format_string("%.1f", F.col(f"{k}_rate")) for k in ("email", "date", "postcode", "numeric")])
    return profile.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), ";"), 256).alias("signature"), F.count("*").alias("columns"))


def grouped_candidates(candidates: DataFrame, by: str = "candidate_kind") -> DataFrame:
    """Candidates of one kind together: best score, columns, values."""
    return candidates.groupBy(by).agg(F.max("candidate_score").alias("best_score"), F.count("*").alias("columns"), F.sum("distinct_count").alias("values"),
                                      F.array_join(F.array_sort(F.collect_set("column_name")), "|").alias("labels"))


def schema_families(entries: DataFrame, file: list[str], field: str) -> DataFrame:
    """(family, fields, files): files whose set of fields is the same."""
    per = entries.select(*file, F.col(field).alias("_f")).distinct().groupBy(*file).agg(F.array_sort(F.collect_set("_f")).alias("_fs"))
    return per.groupBy(F.array_join("_fs", "|").alias("fields")).agg(F.count("*").alias("files"), F.first(F.size("_fs")).alias("width")).withColumn("family", F.sha2("fields", 256))


def draft_rules(candidates: DataFrame, path: str) -> int:
    """A JSON draft per candidate column, for a person to finish; returns how many."""
    import json
    from pathlib import Path

    Path(path).mkdir(parents=True, exist_ok=True)
    rows = candidates.select("column_name", "candidate_kind").collect()
    for r in rows:
        slug = "".join(c if c.isalnum() else "_" for c in r.column_name.lower())
        draft = {"evidence_type": f"Unknown Identifier: {r.column_name}", "pattern_name": f"profile_candidate_{slug}", "pattern": "", "normal": "compact_upper", "kind": r.candidate_kind}
        (Path(path) / f"{slug}.json").write_text(json.dumps(draft, indent=1), encoding="utf-8")
    return len(rows)
