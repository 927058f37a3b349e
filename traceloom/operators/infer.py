"""What columns without a telling header hold, and how a scan should treat them.

A column is typed by a vote of its cells: each cell is tested as a whole against
the rules that stand alone, and the type of most cells wins if it is clear. All
columns of a table are counted in one aggregate; only the counts, a row per
column, meet the rules of precedence on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions.text import name_key, safe_cell
from traceloom.functions.validators import person_name, postcode, validate
from traceloom.operators.rules import RULES, Rule, resolve_header, rules_for, slug_of

#: Cells needed for a vote, share of the winner, share of distinct names.
LEAST, WIN, DISTINCT = 3, 0.80, 0.60
#: Which header a type stands for (fixed values).
HEADER_OF = {
    "Email": "email", "Phone": "phone", "Postcode": "postcode", "National Insurance Number": "national insurance number", "NHS Number": "nhs number",
    "Passport": "passport", "CAS Number": "CAS number", "Payment Card": "payment card", "China NID": "national id", "IP Address": "IP Address",
}
CONTEXT = {"email", "phone", "national insurance number", "nhs number", "passport", "CAS number", "postcode", "person id", "student id", "staff id", "DOB"}
GENDERS = ("m", "f", "male", "female", "non-binary", "nonbinary", "other", "prefer not to say")
WEAK = set("id identifier number no ref reference code key value user member employee staff student person applicant record".split()) | {""}


def cell_types(value: Column, rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """Per type whether the whole cell is a value of it; rules that need context take no part."""
    v = safe_cell(value)
    out = {
        r.evidence_type: v.rlike(rf"^\s*(?:{r.pattern})\s*$" if not r.pattern.startswith("(?i)") else rf"(?i)^\s*(?:{r.pattern[4:]})\s*$") & validate(r.validator, v)
        for r in rules if not r.triggers and not r.labelled_only
    }
    return out | {"Postcode": postcode(v)}


def column_votes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, filled, one count per type and shape): votes of all cells, columns as rows.

    Cells are aggregated by value before they are tested, so each distinct value is
    tested once.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), safe_cell(F.col(f"`{c}`").cast("string")).alias("value")) for c in columns])
    by_value = df.select(F.explode(cells).alias("c")).select("c.*").where("value <> ''").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    v = F.col("value")
    low = F.lower(v)
    shapes = {
        "_gender": low.isin(*GENDERS), "_name": person_name(v), "_token": v.rlike(r"^[A-Za-z][A-Za-z'\-]{1,39}$") & ~low.isin("active", "inactive", "pending", "yes", "no", "true", "false", *GENDERS),
        "_address": v.rlike(r"(?i)\b(?:avenue|close|court|crescent|drive|gardens|grove|lane|mews|place|road|square|street|terrace|way|row)\b") | v.rlike(r"\b\d{1,5}\s+[A-Za-z][A-Za-z'.-]{2,}"),
    }
    tests = cell_types(v) | shapes
    return by_value.groupBy("column_name").agg(
        F.sum("n").alias("filled"), F.count("*").alias("distinct_values"), F.count_distinct(F.when(shapes["_name"], name_key(v))).alias("distinct_names"),
        F.count_distinct(F.when(shapes["_gender"], low)).alias("distinct_genders"),
        *[F.sum(F.when(t, F.col("n")).otherwise(0)).alias(slug_of(k) if not k.startswith("_") else k) for k, t in tests.items()],
    )


def infer_headers(df: DataFrame, columns: Sequence[str], trusted: bool = True) -> dict[str, str]:
    """The header of each column: its own if it tells, else what its cells say.

    Without trusted headers, gender and name columns are inferred only where another
    column gives person context; an address column only near a postcode column.
    """
    votes = {r.column_name: r.asDict() for r in column_votes(df, columns).collect()}
    out: dict[str, str] = {}
    for c in columns:
        if trusted and slug_of(c) not in WEAK and resolve_header(c):
            out[c] = c
            continue
        v = votes.get(c)
        if not v or v["filled"] < LEAST:
            continue
        ranked = sorted(((v[slug_of(t)], t) for t in (*HEADER_OF,) if v.get(slug_of(t)) is not None), reverse=True)
        if ranked and ranked[0][0] / v["filled"] >= WIN and (len(ranked) < 2 or ranked[1][0] != ranked[0][0]):
            out[c] = HEADER_OF[ranked[0][1]]
    share = lambda c, k: votes[c][k] / votes[c]["filled"] if c in votes and votes[c]["filled"] >= LEAST else 0.0
    if not trusted and CONTEXT & set(out.values()):
        for c in columns:
            if c not in out and share(c, "_gender") >= 0.9 and 2 <= votes[c]["distinct_genders"] <= 6:
                out[c] = "gender/sex"
        for c in columns:
            if c not in out and share(c, "_name") >= WIN and votes[c]["distinct_names"] / votes[c]["filled"] >= DISTINCT:
                out[c] = "full name"
        for c, d in zip(columns, columns[1:]):
            if c not in out and d not in out and all(share(x, "_token") >= 0.9 and votes[x]["distinct_values"] / votes[x]["filled"] >= DISTINCT for x in (c, d)):
                out[c], out[d] = "first name", "last name"
    codes = [i for i, c in enumerate(columns) if out.get(c) and resolve_header(out[c]) and resolve_header(out[c]).canonical == "postcode"]
    for i, c in enumerate(columns):
        if c not in out and share(c, "_address") >= WIN and any(abs(i - j) <= 3 for j in codes):
            out[c] = "address1"
    return {c: out.get(c, c) for c in columns}


def schema_plan(spark: SparkSession, df: DataFrame, table_name: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_index, raw_header, resolved_header, suggested_type, confidence, scan_action)."""
    guessed = infer_headers(df, columns)
    rows = []
    for i, c in enumerate(columns):
        own = resolve_header(c)
        suggestion = resolve_header(guessed[c]) if guessed[c] != c else None
        if own:
            action = "route_rules_and_emit" if own.emits else "route_rules" if rules_for(c) else "assemble_only"
            rows.append((table_name, i, c, own.canonical, "", "high", action))
        elif suggestion:
            rows.append((table_name, i, c, "", suggestion.canonical, "medium", "route_suggested_and_emit" if suggestion.emits else "route_suggested"))
        else:
            rows.append((table_name, i, c, "", "", "", "raw_fallback"))
    return spark.createDataFrame(rows, "table_name string, column_index int, raw_header string, resolved_header string, suggested_type string, confidence string, scan_action string")


def plan_decisions(plans: DataFrame) -> DataFrame:
    """(raw_header, scan_action): the strongest action any table gives a header."""
    order = ["raw_fallback", "assemble_only", "route_suggested", "route_suggested_and_emit", "route_rules", "route_rules_and_emit"]
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("scan_action"))
    return plans.groupBy("raw_header").agg(F.max_by("scan_action", rank).alias("scan_action"))


def rule_coverage(findings: DataFrame, file: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every rule with files, findings and distinct values; rules that found nothing stay."""
    names = findings.sparkSession.createDataFrame([(r.pattern_name, r.evidence_type) for r in rules], "pattern_name string, evidence_type string")
    seen = findings.groupBy("pattern_name").agg(F.count("*").alias("findings"), F.count_distinct(file).alias("files"), F.count_distinct("normalized_value").alias("distinct_values"))
    status = F.when(F.coalesce("findings", F.lit(0)) == 0, "unseen").when(F.col("files") >= 2, "active").otherwise("rare")
    return names.join(seen, "pattern_name", "left").select(
        "pattern_name", "evidence_type", F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), status.alias("status"),
    )


def value_candidates(profile: DataFrame) -> DataFrame:
    """Columns that may need a rule of their own: identifiers and small sets of values."""
    filled = F.col("row_count") - F.col("blank_count")
    unique = F.col("distinct_count") / F.greatest(F.lit(1), filled)
    ident = (F.col("numeric_rate") >= 0.8) & (unique >= 0.8) & (F.col("distinct_count") >= 20) & (F.col("date_rate") < 0.2) & (F.col("postcode_rate") < 0.2) & (F.col("email_rate") < 0.2)
    enum = F.col("distinct_count").between(2, 10) & (unique <= 0.2)
    kind = F.when(ident, "possible_identifier_family").when(enum, "possible_enum_family")
    score = F.when(ident, 62).otherwise(37)
    return profile.withColumn("candidate_kind", kind).where("candidate_kind IS NOT NULL").select("column_name", "candidate_kind", score.alias("candidate_score"), "distinct_count")
