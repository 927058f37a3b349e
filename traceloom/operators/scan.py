"""Scanning units for evidence: free text, tables and labelled records.

A scan is one projection: every rule becomes an array of matches (empty unless a
trigger word is present), the arrays are concatenated and exploded once. There is
no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.text import address_compact, canonical_postcode, clean_name, context_window, digits_only, lines, name_key, normal_form, safe_cell
from traceloom.functions.validators import person_name, validate
from traceloom.operators.rules import RULES, TIER_2, TIER_3, Rule, guard_allows, names_no_person, resolve_header, rules_for, slug_of

FINDING = (
    "array<struct<evidence_type:string,pattern_name:string,matched_text:string,normalized_value:string,confidence:string,"
    "evidence_tier:string,source_column:string>>"
)


#: The same with places in the text of the unit and what stands around.
PLACED = FINDING.replace("source_column:string", "source_column:string,start_offset:int,end_offset:int,context:string")
#: Characters of context on either side of a finding.
AROUND = 80


def in_order(text: Column, values: Column) -> Column:
    """(v, start) of values that stand in a text in this order: each is sought behind the one before."""
    none = F.array().cast("array<struct<v:string,start:int>>")

    def seek(done: Column, v: Column) -> Column:
        at = F.call_function("locate", v, text, done["at"])
        return F.struct((at + F.length(v)).cast("int").alias("at"), F.concat(done["out"], F.array(F.struct(v.alias("v"), (at - 1).cast("int").alias("start")))).alias("out"))

    return F.aggregate(values, F.struct(F.lit(1).alias("at"), none.alias("out")), seek, lambda done: done["out"])


def match_places(text: Column, rule: Rule) -> Column:
    """Findings of one rule with offsets and context; offsets count characters of the unit's text from 0."""
    found = in_order(text, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)))
    good = F.filter(found, lambda x: (x["v"] != "") & validate(rule.validator, x["v"]))
    placed = F.transform(good, lambda x: F.struct(
        F.lit(rule.evidence_type).alias("evidence_type"), F.lit(rule.pattern_name).alias("pattern_name"), x["v"].alias("matched_text"),
        normal_form(rule.normal, x["v"]).alias("normalized_value"), F.lit(rule.confidence).alias("confidence"), F.lit(rule.tier).alias("evidence_tier"),
        F.lit(None).cast("string").alias("source_column"), x["start"].alias("start_offset"), (x["start"] + F.length(x["v"])).cast("int").alias("end_offset"),
        context_window(text, x["start"], x["start"] + F.length(x["v"]), AROUND).alias("context"),
    ))
    low, hit = F.lower(text), F.lit(not rule.triggers)
    for t in sorted(rule.triggers, key=len, reverse=True):
        hit = hit | low.contains(t)
    return F.when(hit, placed).otherwise(F.array().cast(PLACED))


def _findings(rule: Rule, values: Column, column: str | None) -> Column:
    """Validated matches of a rule as an array of findings."""
    good = F.filter(values, lambda v: (v != "") & validate(rule.validator, v))
    return F.transform(good, lambda v: F.struct(
        F.lit(rule.evidence_type).alias("evidence_type"), F.lit(rule.pattern_name).alias("pattern_name"), v.alias("matched_text"),
        normal_form(rule.normal, v).alias("normalized_value"), F.lit(rule.confidence).alias("confidence"),
        F.lit(rule.tier).alias("evidence_tier"), F.lit(column).cast("string").alias("source_column"),
    ))


def match_text(text: Column, rule: Rule, column: str | None = None) -> Column:
    """Findings of one rule in a text; a trigger word must be there if the rule has any."""
    found = _findings(rule, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), column)
    if not rule.triggers or column is not None:
        return found
    low, hit = F.lower(text), F.lit(False)
    for t in sorted(rule.triggers, key=len, reverse=True):
        hit = hit | low.contains(t)
    return F.when(hit, found).otherwise(F.array().cast(FINDING))


def text_units(df: DataFrame, key: str, text: str) -> DataFrame:
    """(unit_key, row_number, text): one unit per physical line, from 1."""
    return df.select(F.col(key).alias("unit_key"), F.posexplode(lines(F.col(text))).alias("_p", "text")).select(
        "unit_key", (F.col("_p") + 1).cast("long").alias("row_number"), "text"
    )


def scan_text(units: DataFrame, rules: Sequence[Rule] = RULES, places: bool = False) -> DataFrame:
    """Findings of the rules in units of free text (unit_key, row_number, text), with offsets and context if asked."""
    match = match_places if places else match_text
    arrays = [match(F.col("text"), r) for r in rules if not r.labelled_only]
    return units.select("unit_key", "row_number", F.explode(F.concat(*arrays)).alias("f")).select("unit_key", "row_number", "f.*").drop("source_column")


def _cell_emission(header: str, value: Column) -> Column | None:
    """The whole cell as evidence where the header confirms what it holds."""
    rule = resolve_header(header)
    if rule is None or not rule.emits or not guard_allows(rule, header):
        return None
    v = safe_cell(value)
    empty = F.lower(v).isin("", "n/a", "na", "none", "null", "nil", "-", "--", "not known", "unknown", "not applicable")
    good = ~empty & (F.length(v) <= 500) & validate(rule.validator, v)
    return F.when(good, F.array(F.struct(
        F.lit(rule.emits).alias("evidence_type"), F.lit(f"column_{slug_of(rule.canonical)}").alias("pattern_name"), v.alias("matched_text"),
        normal_form(rule.normal, v).alias("normalized_value"), F.lit("high").alias("confidence"), F.lit(rule.tier).alias("evidence_tier"),
        F.lit(header).alias("source_column"),
    ))).otherwise(F.array().cast(FINDING))


def _derived(kind: str, pattern: str, value: Column, normal: Column, ok: Column) -> Column:
    return F.when(ok, F.array(F.struct(
        F.lit(kind).alias("evidence_type"), F.lit(pattern).alias("pattern_name"), value.alias("matched_text"), normal.alias("normalized_value"),
        F.lit("high").alias("confidence"), F.lit(TIER_3).alias("evidence_tier"), F.lit(None).cast("string").alias("source_column"),
    ))).otherwise(F.array().cast(FINDING))


def assemble_names(cells: dict[str, Column]) -> list[Column]:
    """Names of a row: full-name cells, and first and last name cells joined."""
    role = {h: (resolve_header(h).canonical if resolve_header(h) else "") for h in cells}
    out = []
    for h, v in cells.items():
        if role[h] == "full name" and not names_no_person(h):
            out.append(_derived("Name", "assembled_name", clean_name(v), name_key(v), person_name(v)))
    firsts, lasts = ([h for h in cells if role[h] == r] for r in ("first name", "last name"))
    for f, s in zip(firsts, lasts) if len(firsts) == len(lasts) else ():
        whole = F.concat_ws(" ", F.nullif(clean_name(cells[f]), F.lit("")), F.nullif(clean_name(cells[s]), F.lit("")))
        parts = person_name(cells[f], full=False) & person_name(cells[s], full=False)
        out.append(_derived("Name", "assembled_name", whole, name_key(whole), parts & person_name(whole)))
    return out


def assemble_addresses(cells: dict[str, Column]) -> list[Column]:
    """One address per postcode: the address cells since the postcode before it."""
    out, parts = [], []
    for h, v in cells.items():
        rule = resolve_header(h)
        role = rule.canonical if rule else ""
        if role == "address" or slug_of(h).endswith(("town", "city", "county")):
            parts.append(safe_cell(v))
        elif role == "postcode" and parts:
            code = canonical_postcode(v)
            body = F.array_join(F.array_distinct(F.filter(F.array(*parts), lambda p: p != "")), ", ")
            whole = F.concat_ws(", ", body, code)
            searchable = body.rlike(r"\b\d{1,5}\s+[A-Za-z][A-Za-z'.-]{2,}") | (F.size(F.regexp_extract_all(body, F.lit(r"[A-Za-z][A-Za-z'.-]{2,}"), F.lit(0))) >= 2)
            out.append(_derived("Address", "assembled_table_address", whole, address_compact(whole), (code != "") & (body != "") & searchable))
            parts = []
    return out


def assemble_bank_accounts(cells: dict[str, Column]) -> list[Column]:
    """Every sort code cell with every account number cell of the row."""
    sorts, accounts = ([h for h in cells if resolve_header(h) and resolve_header(h).canonical == c] for c in ("sort code", "account number"))
    out = []
    for s in sorts:
        for a in accounts:
            ds, da = digits_only(cells[s]), digits_only(cells[a])
            ok = (F.length(ds) == 6) & (F.length(da) == 8) & ~ds.rlike(r"^(\d)\1*$") & ~da.rlike(r"^(\d)\1*$")
            out.append(_derived("Bank Account", "assembled_table_bank_account", F.concat_ws(" ", safe_cell(cells[s]), safe_cell(cells[a])), F.concat(ds, da), ok))
    return out


def scan_table(df: DataFrame, key: str, headers: Iterable[str] | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings in the cells of a typed table, routed by its headers.

    A cell is searched as ``header: value`` by the rules its header leads to; what
    a header confirms or a row assembles comes first, and a rule's match of the
    same type and value in the same row is dropped.
    """
    headers = [c for c in (headers or df.columns) if c != key]
    cells = {h: F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")) for h in headers}
    first = assemble_names(cells) + assemble_addresses(cells) + assemble_bank_accounts(cells)
    first += [e for h, v in cells.items() if (e := _cell_emission(h, v)) is not None]
    later = [
        F.when(v != "", match_text(F.concat(F.lit(f"{h}: "), v), r, h)).otherwise(F.array().cast(FINDING))
        for h, v in cells.items() for r in rules_for(h, tuple(rules))
    ]
    empty = F.array().cast(FINDING)
    sure = F.concat(*first) if first else empty
    rows = df.select(F.col(f"`{key}`").alias("unit_key"), sure.alias("_sure"), (F.concat(*later) if later else empty).alias("_later"))
    same = lambda x, y: (x["evidence_type"] == y["evidence_type"]) & (x["normalized_value"] == y["normalized_value"])
    fresh = F.filter("_later", lambda x: ~F.exists("_sure", lambda y: same(x, y)))
    return rows.select("unit_key", F.explode(F.concat(F.array_distinct("_sure"), fresh)).alias("f")).select("unit_key", "f.*")


def cap_findings(findings: DataFrame, unit: list[str], order: list[str], most: int) -> DataFrame:
    """At most ``most`` findings per unit in order, and one marker row where some are cut."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(*unit).orderBy(*order))
    ranked = findings.withColumn("_n", n).where(F.col("_n") <= most + 1)
    marker = {
        "evidence_type": "SCAN_LIMIT", "pattern_name": "scan_limit", "matched_text": "", "normalized_value": "", "confidence": "low", "evidence_tier": "metadata",
    }
    over = F.col("_n") == most + 1
    return ranked.select(*[
        F.when(over, marker[c]).otherwise(F.col(c)).alias(c) if c in marker else F.col(c) for c in findings.columns
    ])


SENSITIVE = {r.evidence_type for r in RULES if r.tier == TIER_2} | {"Disability", "Ethnicity", "Marital Status", "Citizenship Country", "Religion"}
