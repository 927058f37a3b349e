"""Queries over profiles, overlaps, and contents read as records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators import overlap as O
from traceloom.operators.profiling import column_profile, schema_signature, value_samples, value_type
from traceloom.session import table
from traceloom.sources.records import record_units

A_COLUMNS = ("full_name", "mailbox", "birth_when", "status_flag", "external_ref", "postcode")
PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def f_profile(spark: SparkSession, base: str) -> DataFrame:
    """Profile of every column of roster_contacts_a."""
    return column_profile(table(spark, base, "roster_contacts_a"), A_COLUMNS)


def f_profile_part(spark: SparkSession, base: str) -> DataFrame:
    """Profile of the columns of part, with the suggested kind of value."""
    return value_type(column_profile(table(spark, base, "part"), PART_COLUMNS)).select("column_name", "row_count", "distinct_count", "numeric_rate", "suggested")


def f_suggested(spark: SparkSession, base: str) -> DataFrame:
    """Kind of value of every column of roster_contacts_a."""
    return value_type(f_profile(spark, base)).select("column_name", "suggested")


def f_samples(spark: SparkSession, base: str) -> DataFrame:
    """Five reproducible sample values per column."""
    return value_samples(table(spark, base, "roster_contacts_a"), A_COLUMNS)


def f_signature(spark: SparkSession, base: str) -> DataFrame:
    """Schema signatures of the two roster tables, of copies of them, and of one of them without a column."""
    a, b = table(spark, base, "roster_contacts_a"), table(spark, base, "roster_contacts_b").drop("roster_b_no")
    kinds = (("a", a, A_COLUMNS), ("copy of a", a.unionByName(a), A_COLUMNS), ("a without postcode", a, A_COLUMNS[:-1]), ("b", b, b.columns))
    signs = [schema_signature(column_profile(df, columns)).withColumn("table_name", F.lit(n)) for n, df, columns in kinds]
    every = reduce(DataFrame.unionByName, signs)
    # A copy has the signature of its original, any other table its own.
    same = every.groupBy("signature").agg(F.array_join(F.array_sort(F.collect_list("table_name")), "|").alias("tables"), F.min("columns").alias("columns"))
    return same.select("tables", "columns")


def _mail_tokens(spark: SparkSession, base: str) -> DataFrame:
    parts = (("exposed_records_008", "email"), ("exposed_roster_003", "uon_email"), ("exposed_roster_003", "other_email"), ("roster_contacts_a", "mailbox"), ("roster_contacts_b", "user_contact"))
    return reduce(DataFrame.unionByName, [O.tokens(table(spark, base, t), t, "Email", F.col(c)) for t, c in parts])


def o_membership(spark: SparkSession, base: str) -> DataFrame:
    """Mailboxes of exposed_records_008 and exposed_roster_003: both, left, right."""
    return O.membership(_mail_tokens(spark, base), "exposed_records_008", "exposed_roster_003")


def o_frequency(spark: SparkSession, base: str) -> DataFrame:
    """How many mailboxes occur in how many sources."""
    return O.source_frequency(_mail_tokens(spark, base))


def o_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows of both tables with equal name and birth date, counting repeats."""
    sign = lambda t, d: O.tokens(table(spark, base, t), t, "row", F.concat_ws("|", "full_name", F.col(d).cast("string"))).drop("source")
    return O.multiset_overlap(sign("roster_contacts_a", "birth_when"), sign("roster_contacts_b", "born_when"))


#: How the contents of documents are read, by their source.
EXTENSIONS = {"record_xml": ".xml", "page_markup": ".html", "visa_case_mail": ".eml", "refund_extract": ".csv"}


def _units(spark: SparkSession, base: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for p in EXTENSIONS.items() for x in p])
    # All other sources, and documents of none, are texts that may hold tables.
    kind = F.coalesce(F.try_element_at(names, F.col("source")), F.lit(".txt"))
    return record_units(table(spark, base, "documents"), "doc_id", "text", kind)


def s_units(spark: SparkSession, base: str) -> DataFrame:
    """Labelled records found in markup, mail and delimited contents: records and fields per kind."""
    return _units(spark, base).groupBy("kind").agg(F.count("*").alias("records"), F.sum(F.size("fields")).alias("fields"))


def s_headers(spark: SparkSession, base: str) -> DataFrame:
    """How often each header occurs in the records of a kind."""
    return _units(spark, base).select("kind", F.explode("fields").alias("f")).groupBy("kind", F.col("f.header").alias("header")).agg(F.count("*").alias("n"))


def s_drop_records(spark: SparkSession, base: str) -> DataFrame:
    """Records of JSON lines: the number of fields of every line of roster_drops."""
    drops = table(spark, base, "roster_drops")
    units = record_units(drops, "drop_line_no", "record_text", F.lit(".jsonl"))
    return units.select(F.col("key").cast("long").alias("drop_line_no"), F.size("fields").alias("fields"))


def s_events(spark: SparkSession, base: str) -> DataFrame:
    """Events per day and type, the batch form of the windowed stream."""
    return table(spark, base, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


_PROFILE = r"""
WITH cells AS ({cells}), v AS (SELECT column_name, trim(regexp_replace(coalesce(value, ''), '\s+', ' ', 'g')) AS value FROM cells),
f AS (SELECT *, value <> '' AS filled, regexp_full_match(value, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}') AS e,
  regexp_matches(value, '^\d{{4}}-\d{{2}}-\d{{2}}') OR coalesce(CASE WHEN regexp_full_match(value, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN try_cast(value AS DATE)
    WHEN regexp_full_match(value, '\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}}-\d{{1,2}}-\d{{4}}') THEN try_cast(regexp_replace(value, '(\d{{1,2}})[/-](\d{{1,2}})[/-](\d{{4}})', '\3-\2-\1') AS DATE) END
    BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false) AS d,
  regexp_full_match(upper(regexp_replace(value, '\s+', '', 'g')), '(?:GIR0AA|[A-PR-UWYZ][A-HK-Y]?\d[A-HJKPSTUW\d]?\d[ABD-HJLNP-UW-Z]{{2}})') AS p,
  regexp_full_match(value, '[+-]?\d+(?:[.,]\d+)?') AS n FROM v),
profile AS (SELECT column_name, count(*) AS row_count, count(*) FILTER (NOT filled) AS blank_count, count(DISTINCT value) FILTER (filled) AS distinct_count,
  min(length(value)) FILTER (filled) AS min_length, max(length(value)) FILTER (filled) AS max_length,
  round(count(*) FILTER (filled AND e) / greatest(1, count(*) FILTER (filled)), 6) AS email_rate, round(count(*) FILTER (filled AND d) / greatest(1, count(*) FILTER (filled)), 6) AS date_rate,
  round(count(*) FILTER (filled AND p) / greatest(1, count(*) FILTER (filled)), 6) AS postcode_rate, round(count(*) FILTER (filled AND n) / greatest(1, count(*) FILTER (filled)), 6) AS numeric_rate
  FROM f GROUP BY 1)
"""
_SUGGEST = """CASE WHEN email_rate >= 0.9 THEN 'email' WHEN postcode_rate >= 0.9 THEN 'postcode' WHEN date_rate >= 0.9 THEN 'date'
  WHEN numeric_rate >= 0.8 AND distinct_count / greatest(1, row_count - blank_count) >= 0.8 AND distinct_count >= 20 AND date_rate < 0.5 AND postcode_rate < 0.5 AND email_rate < 0.5 THEN 'identifier'
  WHEN distinct_count BETWEEN 2 AND 10 AND distinct_count / greatest(1, row_count - blank_count) <= 0.2 THEN 'enum' ELSE 'text' END AS suggested"""


def _cells(source: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns)


_P_A, _P_PART = _PROFILE.format(cells=_cells("roster_contacts_a", A_COLUMNS)), _PROFILE.format(cells=_cells("part", PART_COLUMNS))
_MAILS = " UNION ALL ".join(
    f"SELECT '{t}' AS source, lower(trim({c})) AS v FROM {t} WHERE trim({c}) <> ''" for t, c in
    (("exposed_records_008", "email"), ("exposed_roster_003", "uon_email"), ("exposed_roster_003", "other_email"), ("roster_contacts_a", "mailbox"), ("roster_contacts_b", "user_contact")))

SQL = {
    "f_profile": _P_A + "SELECT * FROM profile",
    "f_profile_part": _P_PART + f"SELECT column_name, row_count, distinct_count, numeric_rate, {_SUGGEST} FROM profile",
    "f_suggested": _P_A + f"SELECT column_name, {_SUGGEST} FROM profile",
    "f_samples": f"""WITH v AS (SELECT column_name, trim(regexp_replace(value, '\\s+', ' ', 'g')) AS value FROM ({_cells('roster_contacts_a', A_COLUMNS)}) WHERE value IS NOT NULL),
g AS (SELECT column_name, value, count(*) AS n FROM v WHERE value <> '' GROUP BY 1, 2)
SELECT * FROM (SELECT column_name, CAST(row_number() OVER (PARTITION BY column_name ORDER BY md5(value), value) AS INT) AS rank, value, n FROM g) WHERE rank <= 5""",
    "f_signature": """SELECT 'a|copy of a' AS tables, count(*) FILTER (table_name = 'roster_contacts_a') - 1 AS columns FROM information_schema.columns WHERE table_name LIKE 'roster_contacts__'
UNION ALL SELECT 'a without postcode', count(*) FILTER (table_name = 'roster_contacts_a' AND column_name <> 'postcode') - 1 FROM information_schema.columns WHERE table_name LIKE 'roster_contacts__'
UNION ALL SELECT 'b', count(*) FILTER (table_name = 'roster_contacts_b') - 1 FROM information_schema.columns WHERE table_name LIKE 'roster_contacts__'""",
    "o_membership": f"""WITH f AS (SELECT v, bool_or(source = 'exposed_records_008') AS l, bool_or(source = 'exposed_roster_003') AS r FROM ({_MAILS}) GROUP BY v),
c AS (SELECT count(*) FILTER (l AND r) AS "both", count(*) FILTER (l AND NOT r) AS left_only, count(*) FILTER (NOT l AND r) AS right_only FROM f)
SELECT *, round("both" / greatest(1, "both" + left_only + right_only), 6) AS jaccard FROM c""",
    "o_frequency": f"SELECT sources, count(*) AS tokens FROM (SELECT v, count(DISTINCT source) AS sources FROM ({_MAILS}) GROUP BY v) GROUP BY 1",
    "o_rows": """WITH a AS (SELECT lower(trim(concat_ws('|', full_name, birth_when))) AS v, count(*) AS n FROM roster_contacts_a GROUP BY 1),
b AS (SELECT lower(trim(concat_ws('|', full_name, CAST(born_when AS VARCHAR)))) AS v, count(*) AS m FROM roster_contacts_b GROUP BY 1)
SELECT coalesce(sum(least(n, m)), 0) AS shared_rows, count(*) AS shared_tokens FROM a JOIN b ON a.v = b.v WHERE a.v <> ''""",
    "s_drop_records": "SELECT drop_line_no, CAST(len(list_filter(json_keys(record_text), lambda k: coalesce(trim(json_extract_string(record_text, '$.\"' || k || '\"')), '') <> '')) AS INT) AS fields FROM roster_drops",
    "s_events": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
QUERIES = {f.__name__: f for f in (f_profile, f_profile_part, f_suggested, f_samples, f_signature, o_membership, o_frequency, o_rows, s_units, s_headers, s_drop_records, s_events)}
