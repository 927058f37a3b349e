"""Queries over column inference, schema plans, exact matches and run comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators import compare as C
from traceloom.operators.exact import exact_index, exact_matches
from traceloom.operators.infer import DISTINCT, WIN, column_votes, infer_headers, plan_decisions, rule_coverage, schema_plan, value_candidates
from traceloom.operators.profiling import column_profile
from traceloom.plans import report_queries as R
from traceloom.plans import scan_queries as S
from traceloom.plans.sql_text import NAME_SQL
from traceloom.session import table

HEADERLESS = ("full_name", "user_contact", "born_when", "category_flag", "reference_code", "postcode")


def _headerless(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "roster_contacts_b").select(*[F.col(c).cast("string").alias(f"column_{i + 1}") for i, c in enumerate(HEADERLESS)])


def u_votes(spark: SparkSession, base: str) -> DataFrame:
    """Votes of the cells of a table without headers."""
    return column_votes(_headerless(spark, base), [f"column_{i + 1}" for i in range(6)]).select("column_name", "filled", "distinct_values", "postcode", "ip_address")


def u_inferred(spark: SparkSession, base: str) -> DataFrame:
    """(column_name, header): what the columns of a table without headers are taken for."""
    cols = [f"column_{i + 1}" for i in range(6)]
    got = infer_headers(_headerless(spark, base), cols, trusted=False)
    return spark.createDataFrame(list(got.items()), "column_name string, header string")


TABLES = {
    "exposed_records_008": ("student_id", "full_name", "email", "dob", "phone", "passport_number", "case_status"),
    "roster_contacts_a": ("full_name", "mailbox", "birth_when", "status_flag", "external_ref", "postcode"),
    "roster_contacts_b": HEADERLESS,
}


def f_schema_plan(spark: SparkSession, base: str) -> DataFrame:
    """How each column of three tables is scanned."""
    return reduce(DataFrame.unionByName, [schema_plan(spark, table(spark, base, t), t, list(c)) for t, c in TABLES.items()])


def f_decisions(spark: SparkSession, base: str) -> DataFrame:
    """The strongest decision per header over the three tables."""
    return plan_decisions(f_schema_plan(spark, base))


def f_rule_coverage(spark: SparkSession, base: str) -> DataFrame:
    """Every context rule with what it found in all documents."""
    return rule_coverage(S.m_text_findings(spark, base), "unit_key", S.PLAIN)


def f_candidates(spark: SparkSession, base: str) -> DataFrame:
    """Columns of roster_contacts_a that may need a rule of their own."""
    return value_candidates(column_profile(table(spark, base, "roster_contacts_a"), R.A_COLUMNS))


def i_exact(spark: SparkSession, base: str) -> DataFrame:
    """Cells of the records that hold exactly what one listed contact holds."""
    index = exact_index(table(spark, base, "synthetic_slim_contacts"), "id", {"uon_email": "Email", "other_emails": "Email"})
    return exact_matches(table(spark, base, "exposed_records_008"), "record_no", ["email"], index)


def o_conservation(spark: SparkSession, base: str) -> DataFrame:
    """Evidence that records and roster share, per type."""
    return C.conservation(C.evidence_terms(S._records(spark, base)), C.evidence_terms(S._roster(spark, base)), ["evidence_type"])


def o_people(spark: SparkSession, base: str) -> DataFrame:
    """Listed people found through mailboxes against those found through names."""
    people, _ = S._people(spark, base)
    links = S.i_links(spark, base)
    return C.people_two_by_two(people, links.where("evidence_type = 'Email'"), links.where("evidence_type = 'Name'"))


_EV = lambda q: f"SELECT DISTINCT evidence_type, lower(normalized_value) AS term FROM ({q})"
SQL = {
    "u_votes": f"""WITH c AS ({' UNION ALL '.join(f"SELECT 'column_{i + 1}' AS column_name, trim(regexp_replace(CAST({c} AS VARCHAR), '\\s+', ' ', 'g')) AS v FROM roster_contacts_b" for i, c in enumerate(HEADERLESS))})
SELECT column_name, count(*) AS filled, count(DISTINCT v) AS distinct_values,
  count(*) FILTER (regexp_full_match(upper(regexp_replace(v, '\\s+', '', 'g')), '(?:GIR0AA|[A-PR-UWYZ][A-HK-Y]?\\d[A-HJKPSTUW\\d]?\\d[ABD-HJLNP-UW-Z]{{2}})')) AS postcode,
  count(*) FILTER (regexp_full_match(v, '(?:(?:25[0-5]|2[0-4]\\d|1?\\d?\\d)\\.){{3}}(?:25[0-5]|2[0-4]\\d|1?\\d?\\d)')) AS ip_address
FROM c WHERE v <> '' GROUP BY 1""",
    "u_inferred": f"""WITH c AS ({' UNION ALL '.join(f"SELECT 'column_{i + 1}' AS column_name, trim(regexp_replace(CAST({c} AS VARCHAR), '\\s+', ' ', 'g')) AS v FROM roster_contacts_b" for i, c in enumerate(HEADERLESS))}),
filled AS (SELECT * FROM c WHERE v <> ''), n AS ({S._clean_sql('filled', 'v', 'column_name')}),
names AS (SELECT column_name, count(*) AS names, count(DISTINCT {S._FOLD}) AS distinct_names FROM n WHERE {NAME_SQL} AND {S._WORDS} >= 2 GROUP BY 1),
votes AS (SELECT column_name, count(*) AS filled, count(*) FILTER (regexp_full_match(v, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}')) AS mails,
  count(*) FILTER (regexp_full_match(upper(regexp_replace(v, '\\s+', '', 'g')), '(?:GIR0AA|[A-PR-UWYZ][A-HK-Y]?\\d[A-HJKPSTUW\\d]?\\d[ABD-HJLNP-UW-Z]{{2}})')) AS codes FROM filled GROUP BY 1),
typed AS (SELECT v.*, names, distinct_names, CASE WHEN mails >= {WIN} * filled THEN 'email' WHEN codes >= {WIN} * filled THEN 'postcode' END AS kind FROM votes v LEFT JOIN names n ON v.column_name = n.column_name)
SELECT column_name, CASE WHEN kind IS NOT NULL THEN kind WHEN (SELECT count(kind) FROM typed) > 0 AND names >= {WIN} * filled AND distinct_names >= {DISTINCT} * filled THEN 'full name' ELSE column_name END AS header FROM typed""",
    "f_rule_coverage": S._TEXT + f""", seen AS (SELECT pattern_name, count(*) AS n, count(DISTINCT unit_key) AS f, count(DISTINCT normalized_value) AS d FROM findings GROUP BY 1),
names AS (SELECT * FROM (VALUES {', '.join(f"('{r.pattern_name}', '{r.evidence_type}')" for r in S.PLAIN)}) t(pattern_name, evidence_type))
SELECT names.pattern_name, evidence_type, coalesce(n, 0) AS findings, coalesce(f, 0) AS files, coalesce(d, 0) AS distinct_values,
  CASE WHEN coalesce(n, 0) = 0 THEN 'unseen' WHEN f >= 2 THEN 'active' ELSE 'rare' END AS status FROM names LEFT JOIN seen ON names.pattern_name = seen.pattern_name""",
    "f_candidates": R._P_A + """SELECT column_name, CASE WHEN numeric_rate >= 0.8 AND distinct_count / greatest(1, row_count - blank_count) >= 0.8 AND distinct_count >= 20 AND date_rate < 0.2 AND postcode_rate < 0.2 AND email_rate < 0.2
  THEN 'possible_identifier_family' ELSE 'possible_enum_family' END AS candidate_kind, CASE WHEN numeric_rate >= 0.8 AND distinct_count >= 20 THEN 62 ELSE 37 END AS candidate_score, distinct_count FROM profile
WHERE (numeric_rate >= 0.8 AND distinct_count / greatest(1, row_count - blank_count) >= 0.8 AND distinct_count >= 20 AND date_rate < 0.2 AND postcode_rate < 0.2 AND email_rate < 0.2)
  OR (distinct_count BETWEEN 2 AND 10 AND distinct_count / greatest(1, row_count - blank_count) <= 0.2)""",
    "i_exact": r"""WITH k AS (SELECT id, regexp_replace(upper(trim(unnest(string_split_regex(coalesce(v, ''), '[|;,]')))), '[^A-Z0-9@._%+]', '', 'g') AS k FROM
  (SELECT id, uon_email AS v FROM synthetic_slim_contacts UNION ALL SELECT id, other_emails FROM synthetic_slim_contacts) WHERE id IS NOT NULL),
idx AS (SELECT k, min(id) AS person FROM k WHERE length(regexp_replace(k, '[^A-Z0-9]', '', 'g')) >= 6 GROUP BY k HAVING count(DISTINCT id) = 1),
cells AS (SELECT record_no, regexp_replace(upper(trim(unnest(list_concat([coalesce(email, '')], string_split_regex(coalesce(email, ''), '[|;,]'))))), '[^A-Z0-9@._%+]', '', 'g') AS k FROM exposed_records_008)
SELECT DISTINCT record_no AS unit_key, 'email' AS column_name, 'Email' AS evidence_type, person FROM cells JOIN idx ON cells.k = idx.k""",
    "o_conservation": f"""WITH l AS ({_EV(S._RECORDS)}), r AS ({_EV(S._ROSTER)}), j AS (SELECT coalesce(l.evidence_type, r.evidence_type) AS evidence_type, l.term IS NOT NULL AS a, r.term IS NOT NULL AS b
  FROM l FULL JOIN r ON l.evidence_type = r.evidence_type AND l.term = r.term),
c AS (SELECT evidence_type, count(*) FILTER (a AND b) AS shared, count(*) FILTER (a AND NOT b) AS left_only, count(*) FILTER (NOT a AND b) AS right_only FROM j GROUP BY 1)
SELECT *, round(coalesce(shared / nullif(shared + left_only, 0), 0), 6) AS left_kept, round(coalesce(shared / nullif(shared + right_only, 0), 0), 6) AS right_kept,
  round(coalesce(shared / nullif(shared + left_only + right_only, 0), 0), 6) AS jaccard FROM c""",
    "o_people": S._LINKS + """, p AS (SELECT DISTINCT id AS person FROM contacts), f AS (SELECT p.person, bool_or(evidence_type = 'Email') AS l, bool_or(evidence_type = 'Name') AS r FROM p LEFT JOIN links ON p.person = links.person GROUP BY 1)
SELECT count(*) FILTER (l AND r) AS in_both, count(*) FILTER (l AND NOT coalesce(r, false)) AS left_only, count(*) FILTER (NOT coalesce(l, false) AND r) AS right_only,
  count(*) FILTER (NOT coalesce(l, false) AND NOT coalesce(r, false)) AS neither FROM f""",
}
QUERIES = {f.__name__: f for f in (u_votes, u_inferred, f_schema_plan, f_decisions, f_rule_coverage, f_candidates, i_exact, o_conservation, o_people)}
