"""Exact matches of cells with the values of a person table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import safe_cell

#: Shortest key, and values that identify nobody (fixed values).
SHORTEST = 6
STOP = ("NA", "NONE", "NULL", "UNKNOWN", "NOTKNOWN", "MISSING", "TRUE", "FALSE", "YES", "NO", "NOTAPPLICABLE", "NOTSPECIFIED", "PREFERNOTTOSAY")


def exact_key(value: Column) -> Column:
    """Upper case, only what identifiers are made of; null if too short or a stop word."""
    k = F.regexp_replace(F.upper(safe_cell(value)), r"[^A-Z0-9@._%+]", "")
    plain = F.regexp_replace(k, "[^A-Z0-9]", "")
    return F.when((F.length(plain) >= SHORTEST) & ~plain.isin(*STOP), k)


def exact_index(people: DataFrame, person: str, columns: dict[str, str]) -> DataFrame:
    """(exact_key, evidence_type, person): the least person per key and type, and how many share it."""
    parts = [
        F.transform(F.split(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), r"[|;,]"), _typed(t)) for c, t in columns.items()
    ]
    rows = people.select(F.col(f"`{person}`").alias("person"), F.explode(F.concat(*parts)).alias("e")).select("person", "e.*").where("exact_key IS NOT NULL AND person IS NOT NULL")
    return rows.groupBy("exact_key", "evidence_type").agg(F.min("person").alias("person"), F.count_distinct("person").alias("people"))


def _typed(kind: str):
    return lambda p: F.struct(exact_key(p).alias("exact_key"), F.lit(kind).alias("evidence_type"))


def exact_matches(df: DataFrame, key: str, columns: Sequence[str], index: DataFrame) -> DataFrame:
    """(unit_key, column_name, evidence_type, person): cells, or parts of cells, that a person holds.

    Keys that several people share point at nobody and are left out.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("v")) for c in columns])
    parts = df.select(F.col(f"`{key}`").alias("unit_key"), F.explode(cells).alias("c")).select(
        "unit_key", "c.column_name", F.explode(F.array_distinct(F.concat(F.array("c.v"), F.split("c.v", r"[|;,]")))).alias("part")
    )
    keyed = parts.select("unit_key", "column_name", exact_key(F.col("part")).alias("exact_key")).where("exact_key IS NOT NULL").distinct()
    return keyed.join(index.where("people = 1"), "exact_key").select("unit_key", "column_name", "evidence_type", "person").distinct()
