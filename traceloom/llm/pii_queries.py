"""Queries over the free-text fields of problem 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.name_model import NameModel
from traceloom.llm.pii import dated, fit_names, mentions, redacted
from traceloom.session import table

FIELDS = (
    ("exposed_roster_003", "roster_no", "case_note"),
    ("exposed_records_008", "record_no", "case_status"),
    ("address_assembled_table_address", "finding_no", "context"),
)
#: Columns of people's names that the name model learns from.
NAMES = (("exposed_records_008", "full_name"), ("exposed_roster_003", "concat_ws(' ', first_name, last_name)"), ("roster_contacts_a", "full_name"))
#: Columns of birth dates.
DATES = (("exposed_roster_003", "roster_no", "dob"), ("exposed_records_008", "record_no", "dob"))
#: The pseudonym key of the queries; a real run passes its own secret.
DEMO_SECRET = "traceloom-demo"


def name_model(spark: SparkSession, base: str) -> NameModel:
    """The model of the tables' own names and texts."""
    names = [table(spark, base, t).select(F.expr(c).alias("x")) for t, c in NAMES]
    texts = [table(spark, base, t).select(F.col(c).alias("x")) for t, _, c in FIELDS]
    return fit_names(reduce(DataFrame.unionByName, names), reduce(DataFrame.unionByName, texts))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, row_key, pii_type, char_start) of every mention."""
    model = name_model(spark, base)
    return reduce(DataFrame.unionByName, [
        mentions(table(spark, base, name), key, text, model).select(F.lit(name).alias("table_name"), "row_key", "pii_type", "char_start")
        for name, key, text in FIELDS
    ])


def p2_redacted(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, row_key, redacted): every text with typed placeholders; dates are no cases and stay."""
    model = name_model(spark, base)
    return reduce(DataFrame.unionByName, [
        redacted(table(spark, base, name), key, text, DEMO_SECRET, model).select(F.lit(name).alias("table_name"), "row_key", "redacted")
        for name, key, text in FIELDS
    ])


def p2_dates(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, row_key, pseudonym): birth dates permuted within their format."""
    return reduce(DataFrame.unionByName, [
        dated(table(spark, base, name), key, column, DEMO_SECRET).select(F.lit(name).alias("table_name"), "row_key", "pseudonym") for name, key, column in DATES
    ])


QUERIES = {"p2_found": p2_found, "p2_redacted": p2_redacted, "p2_dates": p2_dates}
SQL: dict[str, str] = {}
