"""Known people: anchors of a person table, joins to evidence, exposure, unknowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.operators.linking import EMAIL_TYPES, SENSITIVE, STANDALONE, STRONG, _any
from traceloom.operators.rules import RULES

IDENTITY = tuple(r.evidence_type for r in RULES if r.identifiable) + ("Name", *EMAIL_TYPES)
EMAILS = (*STRONG, *EMAIL_TYPES)
IDS = tuple(r.evidence_type for r in RULES if "id" in r.roles)
#: Kinds of anchors too common to tell one person from another.
WEAK = ("DOB", "Gender/Sex", "IP Address")


def person_key(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first non-empty of the candidate columns."""
    return F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in candidates])


def person_anchors(findings: DataFrame, person: str = "unit_key") -> DataFrame:
    """(evidence_type, value, person): anchors from the scanned cells of a person table."""
    return findings.where(~F.col("evidence_type").isin(*WEAK) & (F.col("normalized_value") != "")).select(
        "evidence_type", F.col("normalized_value").alias("value"), F.col(person).alias("person")
    ).distinct()


def anchored_people(findings: DataFrame, anchors: DataFrame, unit: list[str]) -> DataFrame:
    """(unit..., evidence_type, value, person): findings whose value is a person's anchor."""
    left = findings.select(*unit, "evidence_type", F.col("normalized_value").alias("value")).distinct()
    return left.join(anchors, ["evidence_type", "value"])


def exposure_risk(types: Column) -> Column:
    """none, low, medium or high, by the types matched for a person."""
    email_more = _any(types, EMAILS) & _any(types, ("DOB", *IDS))
    sensitive = _any(types, SENSITIVE) & _any(types, IDENTITY)
    return F.when(F.size(types) == 0, "none").when(_any(types, STANDALONE) | email_more | sensitive, "high").when(_any(types, IDENTITY), "medium").otherwise("low")


def exposure_score(types: Column) -> Column:
    level = exposure_risk(types)
    return F.when(level == "high", 90).when(level == "medium", 60).when(level == "low", 25).otherwise(0)


def known_exposure(hits: DataFrame, unit: list[str]) -> DataFrame:
    """One row per person found: matched types, values and units, with risk and score."""
    types = F.array_sort(F.collect_set("evidence_type"))
    grouped = hits.groupBy("person").agg(
        types.alias("types"), F.count_distinct(*unit).alias("matched_units"), F.count_distinct("evidence_type", "value").alias("matched_values"),
    )
    return grouped.select("person", F.array_join("types", "|").alias("evidence_types"), "matched_units", "matched_values",
                          exposure_risk(F.col("types")).alias("risk_level"), exposure_score(F.col("types")).alias("risk_score"), "types")


def risk_matrix(people: DataFrame, exposure: DataFrame, types: Sequence[str]) -> DataFrame:
    """Every person with yes or no per evidence type; people without any are ``none``."""
    slug = lambda t: "has_" + "".join(c if c.isalnum() else "_" for c in t.lower())
    joined = people.join(exposure.select("person", "types", "risk_level"), "person", "left")
    return joined.select(
        "person", F.coalesce("risk_level", F.lit("none")).alias("risk_level"),
        *[F.when(F.coalesce(F.array_contains("types", t), F.lit(False)), "yes").otherwise("no").alias(slug(t)) for t in types],
    )


def not_in_dataset(people: DataFrame, hits: DataFrame) -> DataFrame:
    """People to whom no evidence was linked."""
    return people.join(hits.select("person").distinct(), "person", "left_anti")


def unknown_rows(linked: DataFrame, hits: DataFrame, unit: list[str]) -> DataFrame:
    """Linked evidence that no listed person explains."""
    return linked.join(hits.select(*unit).distinct(), unit, "left_anti")


def authoritative_names(findings: DataFrame, exact: DataFrame, names: DataFrame, unit: str = "unit_key") -> DataFrame:
    """Names per unit: of the one person an exact match points at, else the ones found.

    exact: (unit_key, person); names: (person, name). A unit that points at several
    people keeps its own names.
    """
    sure = exact.select(F.col("unit_key").alias(unit), "person").distinct().groupBy(unit).agg(F.count("*").alias("n"), F.min("person").alias("person")).where("n = 1")
    own = sure.join(names, "person").select(unit, "name").distinct()
    found = findings.where("evidence_type = 'Name'").select(unit, F.col("normalized_value").alias("name")).distinct()
    return own.withColumn("origin", F.lit("person list")).unionByName(found.join(own.select(unit).distinct(), unit, "left_anti").withColumn("origin", F.lit("found")))


def value_matrix(hits: DataFrame, types: Sequence[str], limit: int = 50) -> DataFrame:
    """Per person found, the matched values of each type, joined with a cap."""
    from traceloom.operators.ordering import capped_values

    out = hits.select("person").distinct()
    for t in types:
        name = "".join(c if c.isalnum() else "_" for c in t.lower()) + "_values"
        out = out.join(capped_values(hits.where(F.col("evidence_type") == t), "person", "value", limit, name), "person", "left")
    return out.fillna("")
