"""Queries over text functions and validators, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions import text as T
from traceloom.functions import validators as V
from traceloom.operators.ordering import capped_values
from traceloom.plans.sql_text import NAME_SQL
from traceloom.session import table


def v_numbers(spark: SparkSession, base: str) -> DataFrame:
    """Number checks on values derived from customer keys."""
    k = F.col("c_custkey")
    pad = lambda mul, mod, n: F.lpad((k * F.lit(mul) % F.lit(mod)).cast("string"), n, "0")
    df = table(spark, base, "customer").select(
        "c_custkey", pad(7919919191, 10**16, 16).alias("card"), pad(104729 * 31, 10**10, 10).alias("ten"), pad(7907, 10**8, 8).alias("eight"), pad(15485863 * 97, 10**13, 13).alias("thirteen")
    )
    return df.select(
        "c_custkey", V.luhn(F.col("card")).alias("luhn"), V.nhs_number(F.col("ten")).alias("nhs"), V.ucas_id(F.col("ten")).alias("ucas"),
        V.saturn_id(F.col("eight")).alias("saturn"), V.bare_id(F.col("eight")).alias("bare"), V.husid(F.col("thirteen")).alias("husid"),
    )


def v_record_fields(spark: SparkSession, base: str) -> DataFrame:
    """Date, telephone and passport checks on exposed_records_008."""
    return table(spark, base, "exposed_records_008").select(
        "record_no", V.contextual_date(F.col("dob")).alias("dob_ok"), V.uk_phone(F.col("phone")).alias("phone_ok"), V.passport_like(F.col("passport_number")).alias("passport_ok"),
        V.person_name(F.col("full_name")).alias("name_ok"),
    )


def v_contact_fields(spark: SparkSession, base: str) -> DataFrame:
    """Postcode, status and count checks on roster_contacts_a."""
    return table(spark, base, "roster_contacts_a").select(
        "roster_a_no", V.postcode(F.col("postcode")).alias("postcode_ok"), T.canonical_postcode(F.col("postcode")).alias("postcode"),
        V.positive_indicator(F.col("status_flag")).alias("indicator"), V.positive_count(F.col("external_ref").cast("string")).alias("counted"),
        V.positive_amount(F.concat(F.lit("£"), F.col("external_ref").cast("string"), F.lit(".50"))).alias("amount"),
    )


def v_words(spark: SparkSession, base: str) -> DataFrame:
    """Closed vocabularies on nation names and market segments."""
    n = table(spark, base, "nation").select(F.col("n_name").alias("value"))
    r = table(spark, base, "region").select(F.col("r_name").alias("value"))
    c = table(spark, base, "customer").select(F.col("c_mktsegment").alias("value")).distinct()
    v = F.col("value")
    return n.unionByName(r).unionByName(c).select(
        "value", V.citizenship(v).alias("citizenship"), V.ethnicity(v).alias("ethnicity"), V.religion(v).alias("religion"), V.disability(v).alias("disability"), V.marital_status(v).alias("marital"),
    )


def p_normal_forms(spark: SparkSession, base: str) -> DataFrame:
    """Normal forms of the fields of exposed_records_008."""
    return table(spark, base, "exposed_records_008").select(
        "record_no", T.safe_cell(F.col("full_name")).alias("cell"), T.slug(F.col("case_status")).alias("slug"), T.normal_form("lower", F.col("email")).alias("email"),
        T.compact_upper(F.col("phone")).alias("phone"), T.digits_only(F.col("phone")).alias("digits"), T.address_compact(F.col("full_name")).alias("compact"),
    )


def p_names(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned names and their keys."""
    return table(spark, base, "exposed_records_008").select("record_no", T.clean_name(F.col("full_name")).alias("clean"), T.name_key(F.col("full_name")).alias("name_key"))


SUFFIXES = ("northmere.example", "example.*")


def p_email_types(spark: SparkSession, base: str) -> DataFrame:
    """(domain, kind, n): mailboxes by domain, institutional by suffix rules."""
    mail = F.col("email")
    return table(spark, base, "exposed_records_008").where("email LIKE '%@%'").groupBy(
        T.email_domain(mail).alias("domain"), T.email_type(mail, SUFFIXES).alias("kind")).agg(F.count("*").alias("n"))


def p_lines(spark: SparkSession, base: str) -> DataFrame:
    """(doc_id, line_count, longest): physical lines of every document."""
    parts = T.lines(F.col("text"))
    return table(spark, base, "documents").select("doc_id", F.size(parts).alias("line_count"), F.array_max(F.transform(parts, F.length)).alias("longest"))


def p_capped_join(spark: SparkSession, base: str) -> DataFrame:
    """Distinct e-mail values per student, joined with a cap."""
    rows = table(spark, base, "exposed_records_008").where("student_id IS NOT NULL")
    return rows.select("student_id").distinct().join(capped_values(rows, "student_id", "email", 2, "emails"), "student_id", "left").select("student_id", F.coalesce("emails", F.lit("")).alias("emails"))


_CELL = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"
_VARIED = lambda d: f"NOT regexp_full_match({d}, '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+')"
_CLEAN = r"""
SELECT record_no, CASE WHEN length(v) - length(replace(v, ',', '')) = 1 AND trim(split_part(v, ',', 1)) <> '' AND trim(split_part(v, ',', 2)) <> ''
  THEN trim(split_part(v, ',', 2)) || ' ' || trim(split_part(v, ',', 1)) ELSE v END AS c
FROM (SELECT record_no, regexp_replace(regexp_replace(trim(regexp_replace(coalesce(full_name, ''), '\s+', ' ', 'g')), '^[ ,;|/]+|[ ,;|/]+$', '', 'g'),
  '(?i)^(?:(?:mr|mrs|ms|miss|mx|dr|prof|professor|sir|dame|lord|lady)\.?\s+)+', '') AS v FROM exposed_records_008)
"""
_CLEANED = f"SELECT record_no, trim(regexp_replace(c, '\\s+', ' ', 'g')) AS c FROM ({_CLEAN})"
_DAY = r"""CASE WHEN regexp_full_match(d, '\d{4}-\d{1,2}-\d{1,2}') THEN try_cast(d AS DATE)
  WHEN regexp_full_match(d, '\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4}') THEN try_cast(regexp_replace(d, '(\d{1,2})[/-](\d{1,2})[/-](\d{4})', '\3-\2-\1') AS DATE) END"""

SQL = {
    "v_numbers": f"""
WITH x AS (SELECT c_custkey, lpad(CAST(CAST(c_custkey AS HUGEINT) * 7919919191 % 10000000000000000 AS VARCHAR), 16, '0') AS card,
  lpad(CAST(c_custkey * {104729 * 31} % 10000000000 AS VARCHAR), 10, '0') AS ten, lpad(CAST(c_custkey * 7907 % 100000000 AS VARCHAR), 8, '0') AS eight,
  lpad(CAST(c_custkey * {15485863 * 97} % 10000000000000 AS VARCHAR), 13, '0') AS thirteen FROM customer),
plain AS (SELECT *, NOT regexp_matches(ten, '^0\\d{{1,3}}\\s+0?\\d') AS ok FROM x)
SELECT c_custkey,
  {_VARIED('card')} AND list_sum(list_transform(generate_series(1, 16), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(card[i] AS INT) * 2 - CASE WHEN CAST(card[i] AS INT) > 4 THEN 9 ELSE 0 END ELSE CAST(card[i] AS INT) END)) % 10 = 0 AS luhn,
  {_VARIED('ten')} AND (11 - list_sum(list_transform(generate_series(1, 9), lambda i: CAST(ten[i] AS INT) * (11 - i))) % 11) % 11 = CAST(ten[10] AS INT) AS nhs,
  true AS ucas, {_VARIED('eight')} AS saturn,
  {_VARIED('eight')} AND eight NOT IN ('12345678', '87654321') AND NOT regexp_matches(eight, '^(19|20)\\d\\d(0[1-9]|1[0-2])(0[1-9]|[12]\\d|3[01])$')
    AND NOT regexp_matches(eight, '^(0[1-9]|[12]\\d|3[01])(0[1-9]|1[0-2])(19|20)\\d\\d$') AS bare,
  (CAST(thirteen[1:2] AS INT) + 1900 BETWEEN 1926 AND 2026) OR (CAST(thirteen[1:2] AS INT) + 2000 BETWEEN 1926 AND 2026) AS husid
FROM plain""",
    "v_record_fields": f"""
WITH x AS (SELECT record_no, trim(coalesce(dob, '')) AS d, regexp_replace(regexp_replace(coalesce(phone, ''), '\\D', '', 'g'), '^44', '0') AS p,
  upper(regexp_replace(coalesce(passport_number, ''), '[^A-Za-z0-9]', '', 'g')) AS s FROM exposed_records_008)
SELECT x.record_no, coalesce({_DAY} BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false) AS dob_ok,
  length(p) IN (10, 11) AND {_VARIED('p')} AND p LIKE '0%' AS phone_ok,
  length(s) BETWEEN 6 AND 12 AND s NOT IN ('APPROVED', 'PENDING', 'UPLOADED', 'REJECTED', 'EXPIRED', 'REQUIRED') AND regexp_matches(s, '\\d') AS passport_ok,
  {NAME_SQL}
    AND len(list_filter(string_split(c, ' '), lambda w: regexp_matches(w, '\\p{{L}}'))) >= 2 AS name_ok
FROM x JOIN ({_CLEANED}) n ON x.record_no = n.record_no""",
    "v_contact_fields": f"""
WITH x AS (SELECT roster_a_no, upper(regexp_replace(coalesce(postcode, ''), '\\s+', '', 'g')) AS p, {_CELL('status_flag')} AS f, external_ref FROM roster_contacts_a),
y AS (SELECT *, regexp_full_match(p, '{T.POSTCODE}') AS ok FROM x)
SELECT roster_a_no, ok AS postcode_ok, CASE WHEN ok THEN p[1:-4] || ' ' || right(p, 3) ELSE '' END AS postcode,
  lower(f) IN ('y', 'yes', 'true', '1', 'approved', 'declared', 'eligible', 'received', 'awarded') AS indicator, coalesce(external_ref > 0, false) AS counted, external_ref IS NOT NULL AS amount
FROM y""",
    "p_normal_forms": f"""
SELECT record_no, {_CELL('full_name')} AS cell, regexp_replace(regexp_replace(lower(coalesce(case_status, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
  lower(trim(email)) AS email, upper(regexp_replace(coalesce(phone, ''), '[\\s-]+', '', 'g')) AS phone, regexp_replace(coalesce(phone, ''), '\\D', '', 'g') AS digits,
  upper(regexp_replace(coalesce(full_name, ''), '[^A-Za-z0-9]+', '', 'g')) AS compact
FROM exposed_records_008""",
    "p_names": f"SELECT record_no, c AS clean, lower(translate(c, '’‘', '''''')) AS name_key FROM ({_CLEANED})",
    "p_email_types": r"""
WITH x AS (SELECT regexp_replace(split_part(lower(trim(email)), '@', -1), '^\.+|\.+$', '', 'g') AS domain FROM exposed_records_008 WHERE email LIKE '%@%')
SELECT domain, CASE WHEN regexp_full_match(domain, '(.+\.)?northmere\.example|(.+\.)?example\..+') THEN 'Institutional Email' ELSE 'Personal Email' END AS kind, count(*) AS n
FROM x GROUP BY 1, 2""",
    "p_lines": """
WITH x AS (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]') AS parts FROM documents),
y AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS parts FROM x)
SELECT doc_id, CAST(len(parts) AS INT) AS line_count, CAST(list_max(list_transform(parts, lambda p: length(p))) AS INT) AS longest FROM y""",
    "p_capped_join": """
WITH x AS (SELECT student_id, list_sort(list(DISTINCT email) FILTER (email <> '')) AS v FROM exposed_records_008 WHERE student_id IS NOT NULL GROUP BY 1)
SELECT student_id, CASE WHEN len(v) > 2 THEN array_to_string(v[1:2], '|') || '|...(+' || (len(v) - 2) || ' more)' ELSE coalesce(array_to_string(v, '|'), '') END AS emails FROM x""",
    "v_words": r"""
WITH x AS (SELECT n_name AS value FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT DISTINCT c_mktsegment FROM customer),
y AS (SELECT value, lower(trim(value)) AS low, regexp_matches(lower(value), 'address|appointment|assessment|bank|building|campus|cas|city|comment|course|department|email|evidence|faculty|fee|finance|module|note|passport|payment|phone|postcode|programme|program|record|reference|school|staff|student|support plan|telephone|visa') AS topic FROM x)
SELECT value, NOT topic AND low NOT IN ('europe', 'european', 'england', 'wales', 'scotland') AND regexp_full_match(value, '[A-Za-z][A-Za-z .,''()-]{1,59}') AS citizenship,
  NOT topic AND regexp_full_match(value, '[A-Za-z][A-Za-z ''&,/()-]{1,79}') AS ethnicity, false AS religion, false AS disability, false AS marital FROM y""",
}
QUERIES = {f.__name__: f for f in (v_numbers, v_record_fields, v_contact_fields, v_words, p_normal_forms, p_names, p_email_types, p_lines, p_capped_join)}
