"""From findings to linked evidence, merge keys and person clusters."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import slug
from traceloom.operators.graph import connected_components
from traceloom.operators.ordering import capped_values, number_rows
from traceloom.operators.rules import RULES, TIER_1, TIER_2
from traceloom.session import cut

# Anchors and their order, on which results depend.
STRONG = ("Email",)
EMAIL_TYPES = ("Institutional Email", "Personal Email")
COMPOUND = (
    ("Email", "Name", "Address"), ("Email", "Name", "Passport"), ("Email", "Name", "Driving Licence"), ("Email", "Saturn ID"), ("Email", "Phone"),
    ("Email", "National Insurance Number"), ("Email", "NHS Number"), ("Phone", "Name"), ("Name", "Address"), ("Name", "NHS Number"),
    ("Name", "HUSID"), ("Name", "CAS Number"), ("Name", "Saturn ID"), ("Name", "DOB", "Address"),
)
PRIORITY = ("Email", "Institutional Email", "Personal Email", "Phone", "National Insurance Number", "NHS Number", "Saturn ID", "Passport", "Driving Licence", "Name")
HUB = 200

_TYPES = {r.evidence_type: r for r in RULES}
STANDALONE = tuple(t for t, r in _TYPES.items() if r.standalone_high) + ("Saturn ID",)
IDENTIFIABLE = tuple(t for t, r in _TYPES.items() if r.identifiable) + ("Saturn ID", "Name", *EMAIL_TYPES)
SENSITIVE = tuple(t for t, r in _TYPES.items() if r.tier == TIER_2) + ("Disability", "Ethnicity", "Marital Status", "Citizenship Country", "Religion")
TIER_ONE = tuple(t for t, r in _TYPES.items() if r.tier == TIER_1) + ("Saturn ID", *EMAIL_TYPES)
ID_TYPES = tuple(t for t, r in _TYPES.items() if "id" in r.roles) + ("Saturn ID",)
CAPS = {t: r.cap for t, r in _TYPES.items()} | {"Institutional Email": 3, "Personal Email": 5}


def _any(types: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(types, F.array(*[F.lit(w) for w in wanted]))


def risk_reasons(types: Column) -> Column:
    """Ordered reasons why the evidence types of a unit put a person at risk."""
    email, name, dob = _any(types, STRONG + EMAIL_TYPES), _any(types, ("Name",)), _any(types, ("DOB",))
    phone, address, ident = _any(types, ("Phone",)), _any(types, ("Address",)), _any(types, ID_TYPES)
    ladder = (
        (_any(types, STANDALONE), "validated_or_contextual_strong_identifier"), ((name | email) & dob, "name_or_email_plus_dob"),
        (ident & (name | dob | phone | email), "institutional_id_plus_identifying_detail"),
        (_any(types, SENSITIVE) & _any(types, IDENTIFIABLE), "sensitive_attribute_plus_identifiable_person"),
        (_any(types, ("Payment Card",)), "luhn_valid_payment_card"), ((address & name) | (phone & email), "supporting_contact_details_linked"),
    )
    return F.array_compact(F.array(*[F.when(c, r) for c, r in ladder]))


def risk_level(types: Column) -> Column:
    reasons = risk_reasons(types)
    high = F.exists(reasons, lambda r: r != "supporting_contact_details_linked")
    return F.when(high, "high").when((F.size(reasons) > 0) | _any(types, TIER_ONE), "medium").otherwise("low")


def risk_text(types: Column) -> Column:
    reasons = risk_reasons(types)
    return F.when(F.size(reasons) > 0, F.array_join(reasons, "|")).when(_any(types, TIER_ONE), "strong_identifier_without_linkage").otherwise("weak_supporting_evidence_only")


def linked_evidence(findings: DataFrame, unit: list[str]) -> DataFrame:
    """One row per unit with an anchor: its evidence, risk and whether it may cluster.

    A unit of one type only counts if the type is strong with a single value; a
    unit without any anchor type gives no row.
    """
    values = findings.where("normalized_value <> ''").groupBy(*unit).agg(
        F.array_sort(F.collect_set(F.struct(F.col("evidence_type").alias("t"), F.col("normalized_value").alias("v")))).alias("evidence")
    )
    types = F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["t"])))
    df = values.withColumn("types", types)
    ranked = F.array(*[F.lit(p) for p in PRIORITY])
    first = F.get(F.filter(ranked, lambda p: F.array_contains(F.col("types"), p)), F.lit(0))
    df = df.withColumn("anchor_type", first).where("anchor_type IS NOT NULL")
    single = (F.size("types") > 1) | (F.get("types", F.lit(0)).isin(*STRONG, *EMAIL_TYPES) & (F.size("evidence") == 1))
    df = df.where(single)
    anchor = F.array_min(F.transform(F.filter("evidence", lambda e: e["t"] == F.col("anchor_type")), lambda e: e["v"]))
    def too_many(kind: str, cap: int) -> Column:
        n = F.size(F.filter("evidence", lambda e: e["t"] == kind))
        return F.when(n > cap, F.concat(F.lit("too_many_"), slug(F.lit(kind)), F.lit("_values:"), n.cast("string"), F.lit(f">{cap}")))

    over = F.array_compact(F.array(*[too_many(t, cap) for t, cap in sorted(CAPS.items())]))
    reason = F.array_join(over, "|")
    return df.select(
        *unit, "anchor_type", anchor.alias("anchor_value"), F.array_join("types", "|").alias("evidence_types"),
        F.array_join(F.transform("evidence", lambda e: F.concat_ws("=", e["t"], e["v"])), "|").alias("evidence_values"), "evidence",
        risk_level(F.col("types")).alias("risk_level"), risk_text(F.col("types")).alias("risk_reasons"),
        F.when(reason == "", "yes").otherwise("no").alias("cluster_eligible"), reason.alias("cluster_exclusion_reason"),
    )


def merge_keys(evidence: Column, strong: Sequence[str] = STRONG, compound: Sequence[Sequence[str]] = COMPOUND) -> Column:
    """Strong and compound keys of a unit's evidence; empty if it has none.

    A set that names ``Email`` also stands for the two kinds of mailbox.
    """
    def of(t: str) -> Column:
        vals = F.transform(F.filter(evidence, lambda e: e["t"] == t), lambda e: e["v"])
        if t == "Name":
            full = F.filter(vals, lambda v: v.contains(" "))
            return F.when(F.size(full) > 0, full).otherwise(vals)
        return vals

    out = []
    widen = lambda t: (t, *EMAIL_TYPES) if t == "Email" else (t,)

    def strong_keys(kind: str) -> Column:
        return F.transform(of(kind), lambda v: F.concat(F.lit(f"strong:{kind}:"), v))

    def times(keys: Column, kind: str) -> Column:
        return F.flatten(F.transform(keys, lambda k: F.transform(of(kind), lambda v: F.concat_ws(":", k, v))))

    for t in [x for s in strong for x in widen(s)]:
        out.append(strong_keys(t))
    for anchors in compound:
        for combo in product(*[widen(t) for t in anchors]):
            keys = F.array(F.lit(f"compound:{'+'.join(combo)}"))
            for t in combo:
                keys = times(keys, t)
            out.append(keys)
    return F.array_distinct(F.flatten(F.array(*out)))


def hub_keys(keys: DataFrame, most: int = HUB) -> DataFrame:
    """Keys that more than ``most`` eligible rows hold; they link nothing."""
    return keys.groupBy("merge_key").agg(F.count("*").alias("n")).where(F.col("n") > most)


def cluster_rows(linked: DataFrame, row: str, most: int = HUB) -> DataFrame:
    """(row, cluster, merge_keys, suppressed): clusters of eligible rows over shared keys.

    The cluster is its least row; a row without usable keys is its own cluster.
    """
    eligible = linked.where("cluster_eligible = 'yes'").select(row, merge_keys(F.col("evidence")).alias("_keys"))
    # Keys are costly to make and read several times: written once. They are joined on by
    # 16 bytes each; equal digests mean equal keys.
    eligible = cut(eligible)
    keys = cut(eligible.select(row, F.explode("_keys").alias("merge_key")).select(row, F.unhex(F.md5("merge_key")).alias("k")))
    sizes = cut(keys.groupBy("k").agg(F.count("*").alias("n"), F.min(row).alias("c")).where("n > 1"))
    edges = keys.join(sizes.where(F.col("n") <= most), "k").select(F.col(row).alias("a"), F.col("c").alias("b"))
    found = connected_components(edges)
    hubs = sizes.where(F.col("n") > most).select("k")
    over = eligible.select(row, F.explode("_keys").alias("merge_key")).join(hubs, F.unhex(F.md5("merge_key")) == F.col("k"), "left_semi")
    suppressed = over.groupBy(row).agg(F.array_sort(F.collect_set("merge_key")).alias("suppressed"))
    return (
        eligible.join(found, eligible[row] == found["vertex"], "left").select(eligible[row], F.coalesce("component", eligible[row]).alias("cluster"), F.col("_keys").alias("merge_keys"))
        .join(suppressed, row, "left")
    )


RISK_RANK = {"low": 1, "medium": 2, "high": 3}


def cluster_summary(linked: DataFrame, clusters: DataFrame, row: str, file: str | None = None) -> DataFrame:
    """One row per cluster: counts, joined values, the highest risk, and its number.

    Numbers go by risk, then rows, then the first anchor, then the least row.
    """
    rank = F.when(F.col("risk_level") == "high", 3).when(F.col("risk_level") == "medium", 2).otherwise(1)
    members = cut(clusters.join(linked, row).select("cluster", row, *([file] if file else []), rank.alias("_rank"), "anchor_type", "anchor_value", "merge_keys", "evidence_types", "suppressed"))
    agg = members.groupBy("cluster").agg(
        F.count("*").alias("linked_evidence_count"), F.count_distinct(F.col(file) if file else F.col(row)).alias("file_count"),
        F.max("_rank").alias("_rank"), F.max(F.col("suppressed").isNotNull()).alias("hub_suppressed"), F.min("anchor_value").alias("_first"),
    )
    each = lambda col: members.select("cluster", F.explode(col).alias("v"))
    for name, values, limit in (
        ("cluster_anchor_types", members.select("cluster", F.col("anchor_type").alias("v")), 50), ("cluster_anchor_values", members.select("cluster", F.col("anchor_value").alias("v")), 50),
        ("cluster_merge_keys", each("merge_keys"), 100), ("evidence_types", each(F.split("evidence_types", r"\|")), 50),
    ):
        agg = agg.join(capped_values(values, "cluster", "v", limit, name), "cluster", "left")
    level = F.when(F.col("_rank") == 3, "high").when(F.col("_rank") == 2, "medium").otherwise("low")
    numbered = number_rows(agg.withColumn("risk_level", level), F.desc("_rank"), F.desc("linked_evidence_count"), "_first", "cluster", name="_no")
    return numbered.select(
        F.format_string("person_cluster_%08d", "_no").alias("person_cluster_id"), "cluster", "risk_level", "linked_evidence_count", "file_count",
        "cluster_anchor_types", "cluster_anchor_values", "cluster_merge_keys", "evidence_types", "hub_suppressed",
    )
