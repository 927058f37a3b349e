"""Queries over aliases, file names, selected rules, person lists and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions.text import alias_rules, country_name, email_aliases, name_key
from traceloom.functions.validators import DOCUMENT_CUE, DOCUMENT_WORDS, RELATIVES, identity_document_file
from traceloom.operators import linking as L
from traceloom.operators import overlap as O
from traceloom.operators import people as P
from traceloom.operators.profiling import grouped_candidates, schema_families
from traceloom.operators.rules import RULES
from traceloom.operators.scan import scan_text
from traceloom.plans import report_queries as R
from traceloom.plans import scan_queries as S
from traceloom.plans import schema_queries as Q
from traceloom.session import table
from traceloom.sources.files import file_signals

ALIASES = "northmere.example == mail.northmere.example; example.org == example.net"
#: Other names of countries (fixed values), by the name they stand for.
COUNTRIES = {"UNITED KINGDOM": ("UK", "GB", "GREAT BRITAIN", "BRITISH"), "UNITED STATES": ("US", "USA", "AMERICAN"), "CHINA": ("PRC", "CHINESE"), "FRANCE": ("FR", "FRENCH")}


def p_email_aliases(spark: SparkSession, base: str) -> DataFrame:
    """(record_no, address): each mailbox and those it equals by a domain rule."""
    return table(spark, base, "exposed_records_008").where("email LIKE '%@%'").select("record_no", F.explode(email_aliases(F.col("email"), alias_rules(ALIASES))).alias("address"))


def p_countries(spark: SparkSession, base: str) -> DataFrame:
    """Nation names and short forms brought to one name."""
    n = table(spark, base, "nation").select(F.upper(F.trim("n_name")).alias("value"))
    short = spark.createDataFrame([(a,) for names in COUNTRIES.values() for a in names], "value string")
    return n.unionByName(short).select("value", country_name(F.col("value"), COUNTRIES).alias("country"))


def v_file_names(spark: SparkSession, base: str) -> DataFrame:
    """Which file names look like somebody's identity document."""
    return table(spark, base, "address_assembled_table_address").select("finding_no", identity_document_file(F.col("file_name")).alias("names_owner"))


def s_file_signals(spark: SparkSession, base: str) -> DataFrame:
    """Evidence from file names and extensions alone."""
    return file_signals(table(spark, base, "address_assembled_table_address"), "file_name", "file_extension").groupBy("evidence_type", "confidence").agg(F.count("*").alias("n"))


def m_selected(spark: SparkSession, base: str) -> DataFrame:
    """One rule run again by itself over all documents."""
    return scan_text(S._lines(spark, base), [r for r in RULES if r.pattern_name == "technical_ipv4"]).select("unit_key", "row_number", "matched_text")


def a_authoritative(spark: SparkSession, base: str) -> DataFrame:
    """Names of records: the listed person's own where a mailbox points at one."""
    contacts = table(spark, base, "synthetic_slim_contacts").where("id IS NOT NULL")
    names = contacts.select(F.col("id").alias("person"), name_key(F.concat_ws(" ", "first_name", "last_name")).alias("name")).where("name <> ''").distinct()
    return P.authoritative_names(S._records(spark, base), Q.i_exact(spark, base), names).groupBy("origin").agg(F.count("*").alias("names"), F.count_distinct("unit_key").alias("units"))


def i_values(spark: SparkSession, base: str) -> DataFrame:
    """Matched values of every listed person found."""
    return P.value_matrix(S.i_links(spark, base), ("Email", "Name"))


def f_grouped(spark: SparkSession, base: str) -> DataFrame:
    """Candidate columns grouped by kind."""
    return grouped_candidates(Q.f_candidates(spark, base))


def f_families(spark: SparkSession, base: str) -> DataFrame:
    """Files of roster_drops whose records have the same fields."""
    drops = table(spark, base, "roster_drops").select("series", "file_name", F.explode(F.json_object_keys("record_text")).alias("field"))
    return schema_families(drops, ["series", "file_name"], "field").select("fields", "files", "width")


def _emails(spark: SparkSession, base: str) -> DataFrame:
    parts = (("exposed_records_008", "email"), ("exposed_roster_003", "uon_email"), ("exposed_roster_003", "other_email"), ("roster_contacts_a", "mailbox"), ("roster_contacts_b", "user_contact"))
    return reduce(DataFrame.unionByName, [table(spark, base, t).select(F.lit(t).alias("source"), F.lower(F.trim(c)).alias("email")) for t, c in parts])


def o_email_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Distinct addresses shared by each pair of tables."""
    return O.email_overlap(_emails(spark, base))


def o_not_in_list(spark: SparkSession, base: str) -> DataFrame:
    """Addresses of the records that roster_contacts_a does not list."""
    rows = table(spark, base, "exposed_records_008").select("record_no", F.lower(F.trim("email")).alias("email"))
    return O.not_in_list(rows, table(spark, base, "roster_contacts_a").select(F.lower(F.trim("mailbox")).alias("email")), "record_no")


def o_person_tokens(spark: SparkSession, base: str) -> DataFrame:
    """Identity keys that records and roster share."""
    tokens = [O.person_tokens(L.linked_evidence(f(spark, base), ["unit_key"]), n, L.merge_keys(F.col("evidence"))) for f, n in ((S._records, "records"), (S._roster, "roster"))]
    return O.membership(tokens[0].unionByName(tokens[1]), "records", "roster")


_MAILS = R._MAILS
_COUNTRY = ", ".join(f"('{a}', '{c}')" for c, names in COUNTRIES.items() for a in names)
_OWNER = r"""len(list_filter(regexp_extract_all(regexp_replace(regexp_replace(f, '\.[A-Za-z0-9]{1,5}$', ''), '([a-z])([A-Z])', '\1 \2', 'g'), '[A-Za-z][A-Za-z''-]{1,}'), lambda w: lower(w) NOT IN (""" + ", ".join(f"'{w}'" for w in DOCUMENT_WORDS + RELATIVES) + "))) >= 2"
SQL = {
    "p_email_aliases": r"""WITH x AS (SELECT record_no, lower(trim(email)) AS v FROM exposed_records_008 WHERE email LIKE '%@%'), y AS (SELECT record_no, v, split_part(v, '@', 1) AS l, split_part(v, '@', -1) AS d FROM x)
SELECT record_no, v AS address FROM y
UNION SELECT record_no, l || '@mail.' || d FROM y WHERE d = 'northmere.example' OR d LIKE 'northmere.example.%'
UNION SELECT record_no, l || '@' || d[6:] FROM y WHERE d = 'mail.northmere.example' OR d LIKE 'mail.northmere.example.%'
UNION SELECT record_no, l || '@example.net' || d[12:] FROM y WHERE d = 'example.org' OR d LIKE 'example.org.%'
UNION SELECT record_no, l || '@example.org' || d[12:] FROM y WHERE d = 'example.net' OR d LIKE 'example.net.%'""",
    "p_countries": f"WITH a AS (SELECT * FROM (VALUES {_COUNTRY}) t(alias, canonical)), n AS (SELECT upper(trim(n_name)) AS value FROM nation UNION ALL SELECT alias FROM a) SELECT value, coalesce(canonical, value) AS country FROM n LEFT JOIN a ON value = alias",
    "v_file_names": f"SELECT finding_no, coalesce({_OWNER} AND regexp_matches(f, '{DOCUMENT_CUE}') AND NOT contains(f, '@'), false) AS names_owner FROM (SELECT finding_no, trim(regexp_replace(file_name, '\\s+', ' ', 'g')) AS f FROM address_assembled_table_address)",
    "s_file_signals": f"""WITH x AS (SELECT trim(regexp_replace(file_name, '\\s+', ' ', 'g')) AS f, lower(file_extension) AS e FROM address_assembled_table_address)
SELECT 'Document Info' AS evidence_type, 'low' AS confidence, count(*) AS n FROM x WHERE e IN ('pdf', 'doc', 'docx', 'rtf') HAVING count(*) > 0
UNION ALL SELECT 'Pictures', 'high', count(*) FROM x WHERE e IN ('png', 'jpg', 'jpeg', 'gif', 'tiff', 'tif', 'bmp', 'webp', 'heic') HAVING count(*) > 0
UNION ALL SELECT 'Identity Document File', 'medium', count(*) FROM x WHERE e IN ('pdf', 'doc', 'docx', 'rtf', 'png', 'jpg', 'jpeg', 'gif', 'tiff', 'tif', 'bmp', 'webp', 'heic') AND regexp_matches(f, '(?i)passport|visa') AND {_OWNER} HAVING count(*) > 0""",
    "m_selected": S._TEXT + "SELECT unit_key, row_number, matched_text FROM findings WHERE pattern_name = 'technical_ipv4'",
    "i_values": S._LINKS + """ SELECT person, coalesce(array_to_string(list_sort(list(DISTINCT value) FILTER (evidence_type = 'Email')), '|'), '') AS email_values,
  coalesce(array_to_string(list_sort(list(DISTINCT value) FILTER (evidence_type = 'Name')), '|'), '') AS name_values FROM links GROUP BY 1""",
    "f_grouped": f"""SELECT candidate_kind, max(candidate_score) AS best_score, count(*) AS columns, CAST(sum(distinct_count) AS BIGINT) AS values, array_to_string(list_sort(list(DISTINCT column_name)), '|') AS labels FROM ({Q.SQL['f_candidates']}) GROUP BY 1""",
    "f_families": """WITH k AS (SELECT DISTINCT series, file_name, unnest(json_keys(record_text)) AS f FROM roster_drops), s AS (SELECT series, file_name, list_sort(list(f)) AS fs FROM k GROUP BY 1, 2)
SELECT array_to_string(fs, '|') AS fields, count(*) AS files, CAST(len(fs) AS INT) AS width FROM s GROUP BY fs""",
    "o_email_pairs": f"WITH m AS (SELECT DISTINCT source, v FROM ({_MAILS})) SELECT a.source AS left_source, b.source AS right_source, count(*) AS shared FROM m a JOIN m b ON a.v = b.v AND a.source < b.source GROUP BY 1, 2",
    "o_not_in_list": """SELECT lower(trim(email)) AS email, count(DISTINCT record_no) AS rows FROM exposed_records_008 WHERE trim(email) <> ''
  AND lower(trim(email)) NOT IN (SELECT lower(trim(mailbox)) FROM roster_contacts_a WHERE mailbox IS NOT NULL) GROUP BY 1""",
}
_KEYS_OF = {n: f"SELECT DISTINCT k FROM ({S._KEYS.replace(S._RECORDS, findings)} SELECT * FROM keys)" for n, findings in (("l", S._RECORDS), ("r", S._ROSTER))}
SQL |= {
    "o_person_tokens": f"""WITH l AS ({_KEYS_OF['l']}), r AS ({_KEYS_OF['r']}), j AS (SELECT l.k AS a, r.k AS b FROM l FULL JOIN r ON l.k = r.k),
c AS (SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS "both", count(*) FILTER (b IS NULL) AS left_only, count(*) FILTER (a IS NULL) AS right_only FROM j)
SELECT *, round("both" / greatest(1, "both" + left_only + right_only), 6) AS jaccard FROM c""",
    "a_authoritative": f"""WITH findings AS ({S._RECORDS}), exact AS ({Q.SQL['i_exact']}), contacts AS (SELECT * FROM synthetic_slim_contacts WHERE id IS NOT NULL),
names AS (SELECT DISTINCT id, {S._FOLD} AS name FROM ({S._clean_sql('contacts', "concat_ws(' ', first_name, last_name)", 'contact_no, id')}) WHERE c <> ''),
sure AS (SELECT unit_key, min(person) AS person FROM exact GROUP BY 1 HAVING count(DISTINCT person) = 1),
own AS (SELECT DISTINCT unit_key, name FROM sure JOIN names ON person = id),
found AS (SELECT DISTINCT unit_key, normalized_value AS name FROM findings WHERE evidence_type = 'Name' AND unit_key NOT IN (SELECT unit_key FROM own))
SELECT 'person list' AS origin, count(*) AS names, count(DISTINCT unit_key) AS units FROM own HAVING count(*) > 0 UNION ALL SELECT 'found', count(*), count(DISTINCT unit_key) FROM found HAVING count(*) > 0""",
}
QUERIES = {f.__name__: f for f in (p_email_aliases, p_countries, v_file_names, s_file_signals, m_selected, a_authoritative, i_values, f_grouped, f_families, o_email_pairs, o_not_in_list, o_person_tokens)}
