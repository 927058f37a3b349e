"""Queries that scan text and tables, link evidence, and sum it up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators import linking as L
from traceloom.operators import people as P
from traceloom.operators.dedupe import collapse_evidence, content_groups
from traceloom.operators.rules import RULES
from traceloom.operators.scan import cap_findings, scan_table, scan_text, text_units
from traceloom.operators.summary import entity_summary, file_summary, regex_summary
from traceloom.plans.sql_text import NAME_SQL, exposure_sql
from traceloom.session import cut, table

#: Rules that SQL engines without look-around and Unicode word boundaries can express.
PLAIN = tuple(r for r in RULES if r.evidence_type not in ("Email", "Phone", "National Insurance Number", "Payment Card", "China NID", "Identity Document File"))
AROUND = tuple(r for r in RULES if r.evidence_type in ("Email", "Phone", "National Insurance Number", "Payment Card", "China NID"))


def _lines(spark: SparkSession, base: str) -> DataFrame:
    return text_units(table(spark, base, "documents"), "doc_id", "text")


def m_text_findings(spark: SparkSession, base: str) -> DataFrame:
    """Findings of the context rules and network addresses in all documents."""
    return scan_text(_lines(spark, base), PLAIN)


def m_text_findings_around(spark: SparkSession, base: str) -> DataFrame:
    """Findings of the rules that look around or validate what stands alone."""
    return scan_text(_lines(spark, base), AROUND)


def _all_findings(spark: SparkSession, base: str) -> DataFrame:
    return scan_text(_lines(spark, base))


def _records(spark: SparkSession, base: str) -> DataFrame:
    return scan_table(table(spark, base, "exposed_records_008").drop("exported_at", "received_at", "student_id", "case_status"), "record_no")


def _roster(spark: SparkSession, base: str) -> DataFrame:
    return scan_table(table(spark, base, "exposed_roster_003").drop("loaded_at", "id", "case_note"), "roster_no")


def m_table_findings(spark: SparkSession, base: str) -> DataFrame:
    """Findings in the cells of exposed_records_008, routed by header."""
    return _records(spark, base).drop("source_column")


def m_roster_findings(spark: SparkSession, base: str) -> DataFrame:
    """Findings in the cells of exposed_roster_003, names assembled from two columns."""
    return _roster(spark, base).drop("source_column")


def m_unresolved_cells(spark: SparkSession, base: str) -> DataFrame:
    """The restricted fallback rules on cells whose header no rule knows."""
    df = table(spark, base, "exposed_roster_003").select("roster_no", "case_note")
    return scan_table(df, "roster_no").where("evidence_type IN ('Email', 'IP Address')").drop("source_column")


def a_assembled(spark: SparkSession, base: str) -> DataFrame:
    """Addresses and bank accounts assembled from the cells of derived rows."""
    k = F.col("c_custkey")
    df = table(spark, base, "customer").select(
        k, F.concat((k % 240).cast("string"), F.lit(" Heron Way")).alias("address1"), F.lit("Varnley").alias("city"),
        F.concat(F.lit("KM"), (k % 19 + 1).cast("string"), F.lit(" "), (k % 10).cast("string"), F.lit("FE")).alias("postcode"),
        F.lpad((k * 7 % 1000000).cast("string"), 6, "0").alias("sort code"), F.lpad((k * 7919 % 100000000).cast("string"), 8, "0").alias("account number"),
    )
    return scan_table(df, "c_custkey").where("pattern_name LIKE 'assembled%'").select("unit_key", "evidence_type", "matched_text", "normalized_value")


def m_capped(spark: SparkSession, base: str) -> DataFrame:
    """At most three findings per document, with a marker row where some were cut."""
    return cap_findings(m_text_findings(spark, base), ["unit_key"], ["row_number", "evidence_type", "normalized_value", "matched_text"], 3).select(
        "unit_key", "evidence_type", "normalized_value")


def c_linked(spark: SparkSession, base: str) -> DataFrame:
    """Linked evidence of exposed_records_008: one scored row per record with an anchor."""
    return L.linked_evidence(_records(spark, base), ["unit_key"]).drop("evidence")


def c_clusters(spark: SparkSession, base: str) -> DataFrame:
    """(unit_key, cluster): records that share a merge key that is no hub, over any number of steps."""
    linked = cut(L.linked_evidence(_records(spark, base), ["unit_key"]))
    return L.cluster_rows(linked, "unit_key").select("unit_key", "cluster")


def c_cluster_sizes(spark: SparkSession, base: str) -> DataFrame:
    """(members, clusters): how many clusters have how many records."""
    return c_clusters(spark, base).groupBy("cluster").agg(F.count("*").alias("members")).groupBy("members").agg(F.count("*").alias("clusters"))


def c_cluster_summary(spark: SparkSession, base: str) -> DataFrame:
    """Clusters in order of risk and size."""
    linked = cut(L.linked_evidence(_records(spark, base), ["unit_key"]))
    clusters = cut(L.cluster_rows(linked, "unit_key"))
    return L.cluster_summary(linked, clusters, "unit_key").drop("cluster_merge_keys")


def c_hub_keys(spark: SparkSession, base: str) -> DataFrame:
    """Merge keys that too many records hold to link them."""
    linked = L.linked_evidence(_records(spark, base), ["unit_key"]).where("cluster_eligible = 'yes'")
    return L.hub_keys(linked.select("unit_key", F.explode(L.merge_keys(F.col("evidence"))).alias("merge_key")))


def d_contents(spark: SparkSession, base: str) -> DataFrame:
    """Documents of equal text, with index and canonical row."""
    return content_groups(table(spark, base, "documents"), "doc_id", "text")


def d_evidence(spark: SparkSession, base: str) -> DataFrame:
    """Linked evidence collapsed by signature."""
    return collapse_evidence(L.linked_evidence(_records(spark, base), ["unit_key"]), "unit_key").drop("signature")


def g_entities(spark: SparkSession, base: str) -> DataFrame:
    """Findings and documents per evidence type."""
    return entity_summary(m_text_findings(spark, base), "unit_key")


def g_rules(spark: SparkSession, base: str) -> DataFrame:
    """Findings, values and documents per rule."""
    return regex_summary(m_text_findings(spark, base), "unit_key")


FILE_TYPES = ("DOB", "Passport", "NHS Number", "IP Address", "CAS Number")


def g_files(spark: SparkSession, base: str) -> DataFrame:
    """Every document with counts per type and its risk."""
    docs = table(spark, base, "documents").select(F.col("doc_id").alias("unit_key"), "n_chars")
    return file_summary(docs, m_text_findings(spark, base), "unit_key", FILE_TYPES)


def _people(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    contacts = table(spark, base, "synthetic_slim_contacts").where("id IS NOT NULL")
    anchors = P.person_anchors(scan_table(contacts.select("id", "uon_email", "first_name", "last_name", F.col("other_emails").alias("other_email")), "id"))
    return contacts.select(F.col("id").alias("person")).distinct(), anchors


def g_all_rules(spark: SparkSession, base: str) -> DataFrame:
    """Findings, values and documents per rule, of every rule."""
    return regex_summary(_all_findings(spark, base), "unit_key")


def i_links(spark: SparkSession, base: str) -> DataFrame:
    """(unit_key, evidence_type, value, person): records that hold an anchor of a listed person."""
    return P.anchored_people(_records(spark, base), _people(spark, base)[1], ["unit_key"])


def i_exposure(spark: SparkSession, base: str) -> DataFrame:
    """Exposure of every listed person found in the records."""
    return P.known_exposure(i_links(spark, base), ["unit_key"]).drop("types")


def i_risk_matrix(spark: SparkSession, base: str) -> DataFrame:
    """Every listed person with yes or no per evidence type."""
    people, _ = _people(spark, base)
    return P.risk_matrix(people, P.known_exposure(i_links(spark, base), ["unit_key"]), ("Email", "Name"))


def i_not_found(spark: SparkSession, base: str) -> DataFrame:
    """Listed people without any link."""
    return P.not_in_dataset(_people(spark, base)[0], i_links(spark, base))


def i_unknown(spark: SparkSession, base: str) -> DataFrame:
    """Linked evidence that no listed person explains."""
    linked = L.linked_evidence(_records(spark, base), ["unit_key"]).select("unit_key", "anchor_type", "anchor_value")
    return P.unknown_rows(linked, i_links(spark, base), ["unit_key"])


# --- SQL ---------------------------------------------------------------------
_LINES = r"""lines0 AS (SELECT doc_id AS unit_key, regexp_split_to_array(coalesce(text, ''), '\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]') AS parts FROM documents),
lines AS (SELECT unit_key, CAST(unnest(generate_series(1, len(parts))) AS BIGINT) AS row_number, unnest(parts) AS text FROM
  (SELECT unit_key, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS parts FROM lines0) WHERE len(parts) > 0)"""
_VALID = {
    None: "true",
    "contextual_date": r"""coalesce(CASE WHEN regexp_full_match(v, '\d{4}-\d{2}-\d{2}') THEN try_cast(v AS DATE)
      WHEN regexp_full_match(v, '\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4}') THEN try_cast(regexp_replace(v, '(\d{1,2})[/-](\d{1,2})[/-](\d{4})', '\3-\2-\1') AS DATE)
      WHEN regexp_full_match(v, '\d{1,2}/\d{1,2}/\d{2}|\d{1,2}-\d{1,2}-\d{2}') THEN try_cast(CASE WHEN CAST(right(v, 2) AS INT) >= 69 THEN '19' ELSE '20' END || right(v, 2)
        || regexp_replace(v, '(\d{1,2})[/-](\d{1,2})[/-](\d{2})', '-\2-\1') AS DATE) END BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false)""",
    "nhs_number": r"""(NOT regexp_full_match(regexp_replace(v, '\D', '', 'g'), '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+') AND NOT regexp_matches(v, '^\s*0\d{1,3}\s+0?\d')
      AND (11 - list_sum(list_transform(generate_series(1, 9), lambda i: CAST(regexp_replace(v, '\D', '', 'g')[i] AS INT) * (11 - i))) % 11) % 11 = CAST(right(v, 1) AS INT))""",
    "passport_like": r"""(upper(v) NOT IN ('APPROVED', 'PENDING', 'UPLOADED', 'REJECTED', 'EXPIRED', 'REQUIRED') AND regexp_matches(v, '\d'))""",
    "cas_number": r"(regexp_matches(v, '[A-Z]') AND regexp_matches(v, '\d'))",
    "husid": "(CAST(v[1:2] AS INT) + 1900 BETWEEN 1926 AND 2026 OR CAST(v[1:2] AS INT) + 2000 BETWEEN 1926 AND 2026)",
    "ucas_id": "true",
    "driving_licence": r"""(CAST(v[7:8] AS INT) % 50 BETWEEN 1 AND 12 AND CAST(v[7:8] AS INT) < 63 AND len(list_filter(['19', '20'], lambda c:
      coalesce(try_cast(c || v[6] || v[11] || '-' || lpad(CAST(CAST(v[7:8] AS INT) % 50 AS VARCHAR), 2, '0') || '-' || v[9:10] AS DATE) BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false))) > 0)""",
}
_NORMAL = {"lower": "lower(trim(v))", "compact_upper": r"upper(regexp_replace(v, '[\s-]+', '', 'g'))", "none": "trim(v)"}


def _rule_sql(r) -> str:
    quoted = r.pattern.replace("'", "''")
    triggers = " OR ".join(f"contains(lower(text), '{t}')" for t in r.triggers) or "true"
    return (
        f"SELECT unit_key, row_number, '{r.evidence_type}' AS evidence_type, '{r.pattern_name}' AS pattern_name, v AS matched_text, {_NORMAL[r.normal]} AS normalized_value, "
        f"'{r.confidence}' AS confidence, '{r.tier}' AS evidence_tier FROM (SELECT unit_key, row_number, unnest(regexp_extract_all(text, '{quoted}', {r.group})) AS v "
        f"FROM lines WHERE {triggers}) WHERE v <> '' AND {_VALID[r.validator]}"
    )


_TEXT = f"WITH {_LINES}, findings AS ({' UNION ALL '.join(_rule_sql(r) for r in PLAIN)}) "
def _clean_sql(source: str, expr: str, key: str) -> str:
    return rf"""SELECT {key}, trim(regexp_replace(CASE WHEN length(v) - length(replace(v, ',', '')) = 1 AND trim(split_part(v, ',', 1)) <> '' AND trim(split_part(v, ',', 2)) <> ''
  THEN trim(split_part(v, ',', 2)) || ' ' || trim(split_part(v, ',', 1)) ELSE v END, '\s+', ' ', 'g')) AS c
FROM (SELECT {key}, regexp_replace(regexp_replace(trim(regexp_replace(coalesce({expr}, ''), '\s+', ' ', 'g')), '^[ ,;|/]+|[ ,;|/]+$', '', 'g'),
  '(?i)^(?:(?:mr|mrs|ms|miss|mx|dr|prof|professor|sir|dame|lord|lady)\.?\s+)+', '') AS v FROM {source})"""


_FOLD = "lower(translate(c, '’‘', ''''''))"
_WORDS = r"len(list_filter(string_split(c, ' '), lambda w: regexp_matches(w, '\p{L}')))"
_EMAIL_RE = RULES[0].pattern


def _cell_sql(key: str, source: str, column: str, rule, validator: str, normal: str, pattern: str, group: int) -> str:
    quoted = pattern.replace("'", "''")
    return (
        f"SELECT {key} AS unit_key, '{rule[0]}' AS evidence_type, '{rule[1]}' AS pattern_name, v AS matched_text, {normal} AS normalized_value, '{rule[2]}' AS confidence, '{rule[3]}' AS evidence_tier "
        f"FROM (SELECT {key}, unnest(regexp_extract_all('{column}: ' || {column}, '{quoted}', {group})) AS v FROM {source} WHERE {column} <> '') WHERE v <> '' AND {validator}"
    )


_BY = {r.evidence_type: r for r in RULES}
_PHONE_OK = r"""(length(regexp_replace(regexp_replace(v, '\D', '', 'g'), '^44', '0')) IN (10, 11) AND regexp_replace(regexp_replace(v, '\D', '', 'g'), '^44', '0') LIKE '0%'
  AND NOT regexp_full_match(regexp_replace(regexp_replace(v, '\D', '', 'g'), '^44', '0'), '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+'))"""
_PHONE_RE = r"^phone:.*?\D((?:\+44\s?\(?0?\)?\s?|0)(?:7\d{3}|1\d{3}|2\d{3}|3\d{2})[\s.\-]?\d{3}[\s.\-]?\d{3,4})(?:\D|$)"


def _table_sql(key: str, source: str, emails: tuple[str, ...], name_sql: str) -> str:
    rule = lambda t: (_BY[t].evidence_type, _BY[t].pattern_name, _BY[t].confidence, _BY[t].tier)
    dob = (f"SELECT {key} AS unit_key, 'DOB' AS evidence_type, 'column_dob' AS pattern_name, v AS matched_text, v AS normalized_value, 'high' AS confidence, '{_BY['DOB'].tier}' AS evidence_tier "
           f"FROM (SELECT {key}, trim(regexp_replace(coalesce(dob, ''), '\\s+', ' ', 'g')) AS v FROM {source}) WHERE v <> '' AND {_VALID['contextual_date']}")
    parts = [name_sql, dob]
    parts += [_cell_sql(key, source, e, rule("Email"), "true", _NORMAL["lower"], _EMAIL_RE, 0) for e in emails]
    parts.append(_cell_sql(key, source, "phone", rule("Phone"), _PHONE_OK, _NORMAL["compact_upper"], _PHONE_RE, 1))
    parts.append(_cell_sql(key, source, "passport_number", rule("Passport"), _VALID["passport_like"], _NORMAL["compact_upper"], _BY["Passport"].pattern, 1))
    return " UNION ALL ".join(parts)


def _name_row(key: str, inner: str, where: str) -> str:
    return (f"SELECT {key} AS unit_key, 'Name' AS evidence_type, 'assembled_name' AS pattern_name, c AS matched_text, {_FOLD} AS normalized_value, 'high' AS confidence, "
            f"'tier_3_supporting_evidence' AS evidence_tier FROM ({inner}) WHERE {where}")


_RECORDS = _table_sql("record_no", "exposed_records_008", ("email",), _name_row("record_no", _clean_sql("exposed_records_008", "full_name", "record_no"), f"{NAME_SQL} AND {_WORDS} >= 2"))
_ROSTER_NAME = (
    f"SELECT f.roster_no, trim(f.c || ' ' || s.c) AS c FROM (SELECT * FROM ({_clean_sql('exposed_roster_003', 'first_name', 'roster_no')}) WHERE {NAME_SQL} AND {_WORDS} >= 1) f "
    f"JOIN (SELECT * FROM ({_clean_sql('exposed_roster_003', 'last_name', 'roster_no')}) WHERE {NAME_SQL} AND {_WORDS} >= 1) s ON f.roster_no = s.roster_no"
)
_ROSTER = _table_sql("roster_no", "exposed_roster_003", ("uon_email", "other_email"), _name_row("roster_no", _ROSTER_NAME, NAME_SQL))
_CELL_FALLBACK = " UNION ALL ".join(
    _cell_sql("roster_no", "exposed_roster_003", "case_note", (r.evidence_type, r.pattern_name, r.confidence, r.tier), "true", _NORMAL[r.normal], r.pattern, 0)
    for r in RULES if r.evidence_type in ("Email", "IP Address"))

_LINKED = f"""WITH findings AS ({_RECORDS}), ev AS (SELECT DISTINCT unit_key, evidence_type AS t, normalized_value AS v FROM findings WHERE normalized_value <> ''),
types AS (SELECT unit_key, list_sort(list(DISTINCT t)) AS types, count(*) AS n, list_sort(list(t || '=' || v)) AS vals FROM ev GROUP BY 1),
anchored AS (SELECT *, CASE WHEN list_contains(types, 'Email') THEN 'Email' WHEN list_contains(types, 'Phone') THEN 'Phone' WHEN list_contains(types, 'Passport') THEN 'Passport'
  WHEN list_contains(types, 'Name') THEN 'Name' END AS anchor_type FROM types),
kept AS (SELECT * FROM anchored WHERE anchor_type IS NOT NULL AND (len(types) > 1 OR (types[1] = 'Email' AND n = 1))),
flags AS (SELECT *, list_contains(types, 'Email') AS e, list_contains(types, 'Name') AS nm, list_contains(types, 'DOB') AS d, list_contains(types, 'Phone') AS p, list_contains(types, 'Passport') AS pp FROM kept),
reasons AS (SELECT *, list_filter([CASE WHEN pp THEN 'validated_or_contextual_strong_identifier' END, CASE WHEN (nm OR e) AND d THEN 'name_or_email_plus_dob' END,
  CASE WHEN d AND (e OR nm OR p OR pp) THEN 'sensitive_attribute_plus_identifiable_person' END, CASE WHEN p AND e THEN 'supporting_contact_details_linked' END], lambda x: x IS NOT NULL) AS r FROM flags)
"""
def _merge_keys_sql(linked: str, name: str = "keys") -> str:
    """Merge keys (unit_key, k) of the evidence ``ev`` of kept units: those of the types these tables hold."""
    parts = ["SELECT unit_key, 'strong:Email:' || v AS k FROM ev WHERE t = 'Email'"]
    for combo in (c for c in L.COMPOUND if set(c) <= {"Email", "Name", "Phone", "DOB", "Passport"}):
        values = " || ':' || ".join(f"e{i}.v" for i in range(len(combo)))
        tables = " JOIN ".join(f"ev e{i}" + ("" if i == 0 else f" ON e0.unit_key = e{i}.unit_key") for i in range(len(combo)))
        kinds = " AND ".join(f"e{i}.t = '{t}'" for i, t in enumerate(combo))
        parts.append(f"SELECT e0.unit_key, 'compound:{'+'.join(combo)}:' || {values} FROM {tables} WHERE {kinds}")
    return f"{linked}, {name} AS (SELECT * FROM ({' UNION '.join(parts)}) WHERE unit_key IN (SELECT unit_key FROM kept))"


_CONTACT_ANCHORS = rf"""contacts AS (SELECT * FROM synthetic_slim_contacts WHERE id IS NOT NULL),
anchors AS (SELECT DISTINCT 'Email' AS evidence_type, lower(v) AS value, id AS person FROM (
    SELECT id, unnest(regexp_extract_all(uon_email, '{_EMAIL_RE}', 0)) AS v FROM contacts UNION ALL SELECT id, unnest(regexp_extract_all('other_email: ' || other_emails, '{_EMAIL_RE}', 0)) FROM contacts)
  UNION SELECT DISTINCT 'Name', lower(translate(trim(f.c || ' ' || s.c), '’‘', '''''')), f.id FROM
    (SELECT * FROM ({_clean_sql('contacts', 'first_name', 'contact_no, id')}) WHERE {NAME_SQL} AND {_WORDS} >= 1) f JOIN
    (SELECT * FROM ({_clean_sql('contacts', 'last_name', 'contact_no, id')}) WHERE {NAME_SQL} AND {_WORDS} >= 1) s ON f.contact_no = s.contact_no)"""
_LINKS = f"WITH findings AS ({_RECORDS}), {_CONTACT_ANCHORS}, links AS (SELECT DISTINCT unit_key, a.evidence_type, a.value, person FROM findings f JOIN anchors a ON f.evidence_type = a.evidence_type AND f.normalized_value = a.value)"
_EXPOSED = f"""{_LINKS}, exposed AS (SELECT person, list_sort(list(DISTINCT evidence_type)) AS types, count(DISTINCT unit_key) AS matched_units, count(DISTINCT evidence_type || '=' || value) AS matched_values FROM links GROUP BY 1)"""

_KEYS = _merge_keys_sql(_LINKED)
_CLUSTERS = _KEYS.replace("WITH ", "WITH RECURSIVE ", 1) + f""", usable AS (SELECT unit_key, k, min(unit_key) OVER (PARTITION BY k) AS c, count(*) OVER (PARTITION BY k) AS n FROM keys),
edges AS (SELECT unit_key AS x, c AS y FROM usable WHERE n <= {L.HUB} AND unit_key <> c UNION SELECT c, unit_key FROM usable WHERE n <= {L.HUB} AND unit_key <> c),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
clusters AS (SELECT k.unit_key, least(k.unit_key, coalesce(min(y), k.unit_key)) AS cluster FROM kept k LEFT JOIN reach r ON k.unit_key = r.x GROUP BY k.unit_key)"""
SQL = {
    "c_hub_keys": _KEYS + f" SELECT k AS merge_key, count(*) AS n FROM keys GROUP BY 1 HAVING count(*) > {L.HUB}",
    "c_clusters": _CLUSTERS + " SELECT * FROM clusters",
    "c_cluster_sizes": _CLUSTERS + " SELECT members, count(*) AS clusters FROM (SELECT cluster, count(*) AS members FROM clusters GROUP BY 1) GROUP BY 1",
    "m_text_findings": _TEXT + "SELECT * FROM findings",
    "m_table_findings": _RECORDS,
    "m_roster_findings": _ROSTER,
    "m_unresolved_cells": _CELL_FALLBACK,
    "a_assembled": r"""
WITH x AS (SELECT c_custkey, CAST(c_custkey % 240 AS VARCHAR) || ' Heron Way' AS a, 'KM' || (c_custkey % 19 + 1) || ' ' || (c_custkey % 10) || 'FE' AS p,
  lpad(CAST(c_custkey * 7 % 1000000 AS VARCHAR), 6, '0') AS s, lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS n FROM customer)
SELECT c_custkey AS unit_key, 'Address' AS evidence_type, a || ', Varnley, ' || p AS matched_text, upper(regexp_replace(a || ', Varnley, ' || p, '[^A-Za-z0-9]+', '', 'g')) AS normalized_value FROM x
UNION ALL SELECT c_custkey, 'Bank Account', s || ' ' || n, s || n FROM x
WHERE NOT regexp_full_match(s, '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+') AND NOT regexp_full_match(n, '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+')""",
    "m_capped": _TEXT + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY unit_key ORDER BY row_number, evidence_type, normalized_value, matched_text) AS n FROM findings)
SELECT unit_key, CASE WHEN n = 4 THEN 'SCAN_LIMIT' ELSE evidence_type END AS evidence_type, CASE WHEN n = 4 THEN '' ELSE normalized_value END AS normalized_value FROM ranked WHERE n <= 4""",
    "c_linked": _LINKED + """SELECT unit_key, anchor_type, (SELECT min(v) FROM ev WHERE ev.unit_key = reasons.unit_key AND ev.t = reasons.anchor_type) AS anchor_value, array_to_string(types, '|') AS evidence_types,
  array_to_string(vals, '|') AS evidence_values, CASE WHEN len(list_filter(r, lambda x: x <> 'supporting_contact_details_linked')) > 0 THEN 'high' WHEN len(r) > 0 OR e OR pp THEN 'medium' ELSE 'low' END AS risk_level,
  CASE WHEN len(r) > 0 THEN array_to_string(r, '|') WHEN e OR pp THEN 'strong_identifier_without_linkage' ELSE 'weak_supporting_evidence_only' END AS risk_reasons,
  'yes' AS cluster_eligible, '' AS cluster_exclusion_reason FROM reasons""",
    "d_contents": """WITH x AS (SELECT doc_id AS key, CAST(octet_length(encode(text)) AS INT) AS size_bytes, 'sha256:' || sha256(text) AS digest FROM documents)
SELECT key, size_bytes, digest, count(*) OVER w AS group_size, CAST(row_number() OVER (PARTITION BY digest ORDER BY key) AS INT) AS duplicate_index, min(key) OVER w AS canonical,
  CASE WHEN row_number() OVER (PARTITION BY digest ORDER BY key) = 1 THEN 'scanned' ELSE 'duplicate_collapsed' END AS action FROM x WINDOW w AS (PARTITION BY digest)""",
    "g_entities": _TEXT + "SELECT evidence_type, count(*) AS findings, count(DISTINCT unit_key) AS files FROM findings GROUP BY 1",
    "g_rules": _TEXT + """SELECT evidence_type, pattern_name, count(*) AS findings, count(DISTINCT normalized_value) AS distinct_values, count(DISTINCT unit_key) AS files,
  min(confidence) AS confidences, min(evidence_tier) AS tiers FROM findings GROUP BY 1, 2""",
    "g_files": _TEXT + """, per AS (SELECT unit_key, count(*) AS n, list(DISTINCT evidence_type) AS types, """ + ", ".join(
        f"count(*) FILTER (evidence_type = '{t}') AS c{i}" for i, t in enumerate(FILE_TYPES)) + """ FROM findings GROUP BY 1),
j AS (SELECT d.doc_id AS unit_key, d.n_chars, coalesce(n, 0) AS finding_count, coalesce(types, []) AS types, """ + ", ".join(f"coalesce(c{i}, 0) AS c{i}" for i in range(len(FILE_TYPES))) + """ FROM documents d LEFT JOIN per ON d.doc_id = per.unit_key)
SELECT unit_key, n_chars, finding_count, """ + ", ".join(f"c{i} AS count_{''.join(ch if ch.isalnum() else '_' for ch in t.lower())}" for i, t in enumerate(FILE_TYPES)) + f""",
  CASE WHEN len(types) = 0 THEN 'none' WHEN list_has_any(types, {list(L.STANDALONE)}) OR (list_contains(types, 'Email') AND list_contains(types, 'DOB'))
    OR (list_has_any(types, {list(L.SENSITIVE)}) AND list_has_any(types, {list(L.IDENTIFIABLE)})) THEN 'high'
    WHEN list_has_any(types, {list(L.TIER_ONE)}) OR len(list_filter(types, lambda t: NOT list_contains({list(L.TIER_ONE) + list(L.SENSITIVE)}, t))) >= 3 THEN 'medium' ELSE 'low' END AS risk_level FROM j""",
    "i_links": _LINKS + " SELECT * FROM links",
    "i_exposure": _EXPOSED + """ SELECT person, array_to_string(types, '|') AS evidence_types, matched_units, matched_values, risk AS risk_level, CASE risk WHEN 'high' THEN 90 WHEN 'medium' THEN 60 WHEN 'low' THEN 25 ELSE 0 END AS risk_score
  FROM (SELECT *, """ + exposure_sql() + """ AS risk FROM exposed)""",
    "i_risk_matrix": _EXPOSED + """ SELECT p.person, CASE WHEN e.person IS NULL THEN 'none' ELSE """ + exposure_sql() + """ END AS risk_level, CASE WHEN list_contains(types, 'Email') THEN 'yes' ELSE 'no' END AS has_email,
  CASE WHEN list_contains(types, 'Name') THEN 'yes' ELSE 'no' END AS has_name FROM (SELECT DISTINCT id AS person FROM contacts) p LEFT JOIN exposed e ON p.person = e.person""",
    "i_unknown": _LINKED + f""", {_CONTACT_ANCHORS}, links AS (SELECT DISTINCT unit_key FROM findings f JOIN anchors a ON f.evidence_type = a.evidence_type AND f.normalized_value = a.value)
SELECT unit_key, anchor_type, (SELECT min(v) FROM ev WHERE ev.unit_key = reasons.unit_key AND ev.t = reasons.anchor_type) AS anchor_value FROM reasons WHERE unit_key NOT IN (SELECT unit_key FROM links)""",
    "d_evidence": _LINKED + """, rows AS (SELECT unit_key, array_to_string(vals, '|') AS e, lower(array_to_string(list_sort(list_transform(vals, lambda x: lower(x))), '|')) AS sig, anchor_type,
  (SELECT min(v) FROM ev WHERE ev.unit_key = reasons.unit_key AND ev.t = reasons.anchor_type) AS av,
  CASE WHEN len(list_filter(r, lambda x: x <> 'supporting_contact_details_linked')) > 0 THEN 'high' WHEN len(r) > 0 OR e OR pp THEN 'medium' ELSE 'low' END AS risk FROM reasons)
SELECT count(*) AS duplicate_count, min(unit_key) AS first_row, arg_min(e, unit_key) AS evidence_values, arg_min(risk, unit_key) AS risk_level FROM rows GROUP BY sig, anchor_type, lower(av)""",
    "i_not_found": _LINKS + " SELECT DISTINCT id AS person FROM contacts WHERE id NOT IN (SELECT person FROM links)",
}
QUERIES = {f.__name__: f for f in (
    m_text_findings, m_text_findings_around, m_table_findings, m_roster_findings, m_unresolved_cells, a_assembled, m_capped, c_linked, c_clusters, c_cluster_sizes, c_cluster_summary, c_hub_keys,
    d_contents, d_evidence, g_entities, g_rules, g_all_rules, g_files, i_links, i_exposure, i_risk_matrix, i_not_found, i_unknown)}
