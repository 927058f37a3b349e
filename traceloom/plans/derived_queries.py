"""Queries over values derived from customer keys, so that every rule and check fires and fails.

The tables hold no tax references, student numbers or religions. Here the number of a
customer makes such values, the same in Spark and in SQL: numbers with and without a
valid check, words in and out of a vocabulary. Each rule has rows it must find and rows
it must leave.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions import validators as V
from traceloom.operators import linking as L
from traceloom.operators.linking import risk_level, risk_text
from traceloom.operators.people import exposure_risk, exposure_score
from traceloom.operators.rules import HEADER_RULES, NO_PERSON, RULES, resolve_header
from traceloom.operators.scan import scan_text
from traceloom.plans.scan_queries import _clean_sql, _rule_sql
from traceloom.plans.sql_text import NAME_SQL, any_sql, exposure_sql, sql_list
from traceloom.session import table

#: Lines of text by rule; ``{n}`` stands for digits of the customer's number, of that many places.
LINES = (
    "Date of birth: 19{2}-0{1}-1{1}", "dob = 3{1}/0{1}/19{2}", "Gender: female", "Sex - m", "gender role {2}", "sort code 20-{2}-{2} account number {8}", "bank sort {6}, {8}",
    "UTR: {10}", "unique taxpayer reference {10}", "NHS number: {10}", "NHS no {3} {3} {4}", "driving licence number: SMITH{6}AB1CD", "driver license JONES80{1}1{1}5MA9XY",
    "passport number: P{8}", "passport approved {1}", "Passport no: REQUIRED", "CAS number: AB{8}CDEF", "cas no: {14}", "HUSID: {13}", "SLC id: SLC{6}", "SSN: {3}-{2}-{4}", "student ssn {9}",
    "UCAS personal id: 1{2}-{3}-{4}", "UCASPERID 2{2}{3}{4}", "from 10.{2}.{1}.{3}", "seen at 1{2}.2{2}.{2}.7", "nothing to see in {4}",
)
PLAIN = tuple(r for r in RULES if r.evidence_type not in ("Email", "Phone", "National Insurance Number", "Payment Card", "China NID", "Identity Document File"))


def _factor(no: int, i: int) -> int:
    """What the customer's number is multiplied with for the digits of a line's i-th blank."""
    return 7919 * (no + 3) ** 3 + 104729 * (i + 1) ** 5


def _parts(line: str) -> list[tuple[str, int]]:
    """(text, places of the digits behind it; 0 at the end)."""
    out, rest = [], line
    while "{" in rest:
        before, _, tail = rest.partition("{")
        places, _, rest = tail.partition("}")
        out.append((before, int(places)))
    return [*out, (rest, 0)]


def _line(line: str, no: int, key: Column) -> Column:
    bits = []
    for i, (text, places) in enumerate(_parts(line)):
        bits.append(F.lit(text))
        if places:
            bits.append(F.lpad((key * F.lit(_factor(no, i)) % F.lit(10 ** places)).cast("string"), places, "0"))
    return F.concat(*bits)


def _line_sql(line: str, no: int) -> str:
    bits = []
    for i, (text, places) in enumerate(_parts(line)):
        bits.append("'" + text + "'")
        if places:
            bits.append(f"lpad(CAST(CAST(c_custkey AS BIGINT) * {_factor(no, i)} % {10 ** places} AS VARCHAR), {places}, '0')")
    return " || ".join(bits)


def _lines(spark: SparkSession, base: str) -> DataFrame:
    key = F.col("c_custkey")
    lines = F.array(*[_line(x, i, key) for i, x in enumerate(LINES)])
    return table(spark, base, "customer").select(key.alias("unit_key"), F.posexplode(lines).alias("_p", "text")).select(
        "unit_key", (F.col("_p") + 1).cast("long").alias("row_number"), "text")


def r_findings(spark: SparkSession, base: str) -> DataFrame:
    """Findings of the context rules in the derived lines."""
    return scan_text(_lines(spark, base), PLAIN)


def r_counts(spark: SparkSession, base: str) -> DataFrame:
    """(pattern_name, findings): how often each of those rules fires."""
    return r_findings(spark, base).groupBy("pattern_name").agg(F.count("*").alias("findings"))


#: Answers as people give them, with some that a vocabulary must refuse.
ANSWERS = (
    "Yes", "N/A", "Declared", "approved", "0", "12", "£1,250.50", "Hindu", "no religion", "Jedi", "Sikh student", "Dyslexia", "Mental health condition", "No known disability",
    "hearing impairment, wheelchair", "Dyslexia support plan", "adhd and autism and asperger and dyslexia and dyspraxia of long standing", "Married", "Widowed", "Single parent", "civil partnership",
    "Nigerian", "UK - International", "home fee", "White British", "Mixed / multiple", "Irish 2024", "Prefer not to say", "Heron Way", "Ada Lark", "Flat Lark", "School of Law", "O'Neill, Bram", "x", "", "  ",
)
CHECKS = {
    "religion": V.religion, "ethnicity": V.ethnicity, "citizenship": V.citizenship, "disability": V.disability, "marital": V.marital_status, "indicator": V.positive_indicator,
    "amount": V.positive_amount, "counted": V.positive_count, "person": V.person_name,
}


def v_answers(spark: SparkSession, base: str) -> DataFrame:
    """Checks of free answers, each customer with one."""
    value = F.element_at(F.array(*[F.lit(a) for a in ANSWERS]), (F.col("c_custkey") % len(ANSWERS) + 1).cast("int"))
    return table(spark, base, "customer").select("c_custkey", value.alias("value")).select("c_custkey", *[f(F.col("value")).alias(n) for n, f in CHECKS.items()])


def v_documents(spark: SparkSession, base: str) -> DataFrame:
    """Checks of identity numbers with letters, on values derived from customer keys."""
    k = F.col("c_custkey")
    digits = lambda mul, n: F.lpad((k * F.lit(mul) % F.lit(10 ** n)).cast("string"), n, "0")
    letter = lambda mul: F.substring(F.lit("ABCDEFGHJKLMNPRSTUVWXYZ"), (k * F.lit(mul) % 23 + 1).cast("int"), F.lit(1))
    df = table(spark, base, "customer").select(
        k, F.concat(letter(7), letter(11), digits(7919, 6), letter(3)).alias("ni"), F.concat(digits(104729, 15), F.when(k % 10 == 0, "X").otherwise((k % 10).cast("string"))).alias("orcid"),
        F.concat(F.lit("11010"), F.lit("5"), (F.lit(1930) + k % 90).cast("string"), F.lpad((k % 14).cast("string"), 2, "0"), F.lpad((k % 33).cast("string"), 2, "0"), digits(31, 3),
                 F.substring(F.lit("10X98765432"), (k % 11 + 1).cast("int"), F.lit(1))).alias("china"),
        F.concat(F.lit("SMITH"), (k % 10).cast("string"), F.lpad((k % 70).cast("string"), 2, "0"), F.lpad((k % 35).cast("string"), 2, "0"), (k * 3 % 10).cast("string"), F.lit("AB1CD")).alias("licence"),
        F.concat(F.lit("AB"), digits(7919, 6), F.when(k % 3 == 0, "ABCDEF").otherwise("abcdef")).alias("cas"),
        F.concat(letter(5), digits(17, 1), F.lit(" "), digits(13, 1), letter(2), letter(9)).alias("postcode"),
    )
    return df.select("c_custkey", V.ni_number(F.col("ni")).alias("ni_ok"), V.orcid(F.col("orcid")).alias("orcid_ok"), V.china_id(F.col("china")).alias("china_ok"),
                     V.driving_licence(F.col("licence")).alias("licence_ok"), V.cas_number(F.col("cas")).alias("cas_ok"), V.postcode(F.col("postcode")).alias("postcode_ok"))


#: Labels as files have them: one or more for every header rule, and some that no rule may take.
LABELS = (
    "Address line 1", "home address", "street", "postal_address", "E-mail", "uon_email", "primary email", "user email type", "IP address", "ipv4", "Telephone", "mobile phone number", "contact no", "phone status",
    "Post Code", "home postcode", "user name", "loginName", "disability", "Reasonable Adjustment", "DOB", "DateOfBirth", "birth date", "ethnicity", "race", "gender", "Sex", "marital status", "nationality",
    "Country of Domicile", "passport country of birth", "religion", "faith", "document type", "account number", "bank account", "IBAN", "card number", "credit card", "direct debit", "sort code", "BRP",
    "driving licence", "national identity", "NI number", "nino", "NHS no", "passport", "passport_number", "id", "applicant number", "EmplId", "UTR", "visa", "currency", "amount", "forename", "first_name",
    "name", "Full Name", "student name", "surname", "last name", "middle names", "CAS number", "husid", "saturn id", "slc", "staff id", "member no", "student_id", "ssn", "UCAS personal id", "care leaver",
    "dependants adg indicator", "dependants ccg indicator", "household income", "maintenance grant", "number of sponsors", "principal earner income", "special support element", "special support grant",
    "course name", "school name", "column_3", "case_status", "loaded at", "colour",
)


def h_labels(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, label, canonical): what labels, and the columns of all tables, resolve to."""
    names = ("customer", "supplier", "part", "orders", "lineitem", "events", "exposed_records_008", "exposed_roster_003", "synthetic_slim_contacts", "roster_contacts_a", "roster_contacts_b")
    rows = [("", x) for x in LABELS] + [(n, c) for n in names for c in table(spark, base, n).columns]
    found = [(n, x, r.canonical if (r := resolve_header(x)) else "") for n, x in rows]
    return spark.createDataFrame(found, "table_name string, label string, canonical string")


TYPES = ("Email", "Phone", "DOB", "Name", "Address", "Passport", "NHS Number", "Payment Card", "UCAS Personal ID", "Gender/Sex", "Religion", "IP Address")


def i_ladders(spark: SparkSession, base: str) -> DataFrame:
    """Risk of a unit, its reasons, and exposure of a person, for sets of evidence types by the bits of customer keys."""
    sets = F.array_compact(F.array(*[F.when(F.shiftright(F.col("c_custkey") * 2654435761 % 4096, i).bitwiseAND(1) == 1, t) for i, t in enumerate(TYPES)]))
    df = table(spark, base, "customer").select("c_custkey", F.array_sort(sets).alias("types"))
    t = F.col("types")
    return df.select("c_custkey", F.array_join("types", "|").alias("types"), risk_level(t).alias("risk"), risk_text(t).alias("reasons"), exposure_risk(t).alias("exposure"), exposure_score(t).alias("score"))


# --- SQL ---------------------------------------------------------------------
_DERIVED = "lines AS (" + " UNION ALL ".join(f"SELECT c_custkey AS unit_key, CAST({i + 1} AS BIGINT) AS row_number, {_line_sql(x, i)} AS text FROM customer" for i, x in enumerate(LINES)) + ")"
_FOUND = f"WITH {_DERIVED}, findings AS ({' UNION ALL '.join(_rule_sql(r) for r in PLAIN)}) "
_CELL = "trim(regexp_replace(value, '\\s+', ' ', 'g'))"


def _odd(most: int, words: int) -> str:
    foreign = "|".join([r"[@{}\[\]<>]", "https?://", r"www\.", *V.OFF_TOPIC, r"\d\D*\d\D*\d"])
    return f"(length(v) NOT BETWEEN 1 AND {most} OR regexp_matches(v, '(?i){foreign}') OR len(regexp_extract_all(v, '[A-Za-z]+')) > {words})"


_IN = lambda words: f"low IN ({', '.join(repr(w) for w in words)})"
_ANSWERS = f"""WITH a AS (SELECT c_custkey, {sql_list(ANSWERS)}[c_custkey % {len(ANSWERS)} + 1] AS value FROM customer),
b AS (SELECT c_custkey, value, {_CELL} AS v, lower({_CELL}) AS low FROM a),
p AS (SELECT c_custkey, c FROM ({_clean_sql('a', 'value', 'c_custkey')}))
SELECT b.c_custkey, {_IN(V.RELIGIONS)} AND NOT {_odd(60, 6)} AS religion,
  NOT {_IN(V.FALSE_WORDS + V.TRUE_WORDS)} AND NOT {_odd(80, 10)} AND regexp_full_match(v, '[A-Za-z][A-Za-z ''&,/()-]{{1,79}}') AS ethnicity,
  NOT {_IN(V.FALSE_WORDS + V.TRUE_WORDS + V.REGIONS)} AND NOT regexp_matches(low, '\\b(?:home|international|enrolment|enrollment|fee|fees|tuition|class)\\b') AND NOT contains(v, '|')
    AND NOT {_odd(60, 5)} AND regexp_full_match(v, '[A-Za-z][A-Za-z .,''()-]{{1,59}}') AS citizenship,
  NOT {_IN(V.FALSE_WORDS)} AND ({_IN(V.TRUE_WORDS)} OR (regexp_matches(low, '{"|".join(V.DISABILITY_PARTS)}') AND NOT {_odd(80, 8)} AND regexp_full_match(v, '[A-Za-z][A-Za-z ''&,/()-]{{1,79}}'))) AS disability,
  low IN ('single', 'never married', 'not married', 'unmarried', 'married', 'civil partnership', 'civil partner', 'in a civil partnership', 'separated', 'married but separated', 'divorced', 'widowed',
    'surviving civil partner', 'cohabiting', 'living with partner', 'partnered', 'living as married') AS marital,
  {_IN(V.SUPPORT)} AS indicator,
  NOT {_IN(V.NO_SUPPORT)} AND ({_IN(V.SUPPORT)} OR coalesce(try_cast(regexp_extract(regexp_replace(low, '[£$,\\s]', '', 'g'), '^\\d+(\\.\\d+)?$') AS DOUBLE) > 0, false)) AS amount,
  NOT {_IN(V.NO_SUPPORT)} AND coalesce(try_cast(regexp_extract(low, '^\\d+$') AS DOUBLE) > 0, false) AS counted,
  {NAME_SQL} AND len(list_filter(string_split(c, ' '), lambda w: regexp_matches(w, '\\p{{L}}'))) >= 2 AS person
FROM b JOIN p ON b.c_custkey = p.c_custkey"""
_DOCUMENTS = r"""
WITH x AS (SELECT c_custkey, CAST(c_custkey AS BIGINT) AS k FROM customer),
y AS (SELECT c_custkey, k, 'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 7 % 23 + 1] || 'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 11 % 23 + 1] || lpad(CAST(k * 7919 % 1000000 AS VARCHAR), 6, '0') || 'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 3 % 23 + 1] AS ni,
  lpad(CAST(k * 104729 % 1000000000000000 AS VARCHAR), 15, '0') || CASE WHEN k % 10 = 0 THEN 'X' ELSE CAST(k % 10 AS VARCHAR) END AS orcid,
  '110105' || (1930 + k % 90) || lpad(CAST(k % 14 AS VARCHAR), 2, '0') || lpad(CAST(k % 33 AS VARCHAR), 2, '0') || lpad(CAST(k * 31 % 1000 AS VARCHAR), 3, '0') || '10X98765432'[k % 11 + 1] AS china,
  k % 10 AS decade, k % 70 AS month, k % 35 AS day, k * 3 % 10 AS unit,
  'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 5 % 23 + 1] || (k * 17 % 10) || (k * 13 % 10) || 'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 2 % 23 + 1] || 'ABCDEFGHJKLMNPRSTUVWXYZ'[k * 9 % 23 + 1] AS postcode FROM x)
SELECT c_custkey, regexp_full_match(ni, '[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z]\d{6}[A-D]') AND ni[1:2] NOT IN ('BG', 'GB', 'KN', 'NK', 'NT', 'TN', 'ZZ')
    AND NOT regexp_full_match(ni[3:8], '0+|1+|2+|3+|4+|5+|6+|7+|8+|9+') AS ni_ok,
  (12 - list_sum(list_transform(generate_series(1, 15), lambda i: CAST(orcid[i] AS INT) * ([1, 2, 4, 8, 5, 10, 9, 7, 3, 6][CAST((15 - i + 1) % 10 + 1 AS BIGINT)]))) % 11) % 11 = CASE WHEN orcid[16] = 'X' THEN 10 ELSE CAST(orcid[16] AS INT) END AS orcid_ok,
  coalesce(k % 14 BETWEEN 1 AND 12 AND k % 33 BETWEEN 1 AND 31 AND try_cast(china[7:10] || '-' || china[11:12] || '-' || china[13:14] AS DATE) BETWEEN DATE '1926-12-31' AND DATE '2026-12-31'
    AND '10X98765432'[CAST(list_sum(list_transform(generate_series(1, 17), lambda i: CAST(china[i] AS INT) * ([1, 2, 4, 8, 5, 10, 9, 7, 3, 6][CAST((18 - i) % 10 + 1 AS BIGINT)]))) % 11 + 1 AS BIGINT)] = china[18], false) AS china_ok,
  coalesce((CASE WHEN month BETWEEN 51 AND 62 THEN month - 50 ELSE month END) BETWEEN 1 AND 12 AND (
    coalesce(try_cast('19' || decade || unit || '-' || lpad(CAST(CASE WHEN month > 50 THEN month - 50 ELSE month END AS VARCHAR), 2, '0') || '-' || lpad(CAST(day AS VARCHAR), 2, '0') AS DATE) BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false)
    OR coalesce(try_cast('20' || decade || unit || '-' || lpad(CAST(CASE WHEN month > 50 THEN month - 50 ELSE month END AS VARCHAR), 2, '0') || '-' || lpad(CAST(day AS VARCHAR), 2, '0') AS DATE) BETWEEN DATE '1926-12-31' AND DATE '2026-12-31', false)), false) AS licence_ok,
  k % 3 = 0 AS cas_ok, regexp_full_match(postcode, '(?:GIR0AA|[A-PR-UWYZ][A-HK-Y]?\d[A-HJKPSTUW\d]?\d[ABD-HJLNP-UW-Z]{2})') AS postcode_ok FROM y"""
_Q = lambda text: "'" + text.replace("'", "''") + "'"
_HEADER_VALUES = ", ".join(
    f"({i}, {_Q(r.canonical)}, {_Q(p)}, {sql_list(r.required) if r.required else '[]::VARCHAR[]'}, {sql_list(r.forbidden) if r.forbidden else '[]::VARCHAR[]'})" for i, r in enumerate(HEADER_RULES) for p in r.patterns)
_LABEL_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events", "exposed_records_008", "exposed_roster_003", "synthetic_slim_contacts", "roster_contacts_a", "roster_contacts_b")
_LABELS = rf"""
WITH rules(ord, canonical, pattern, required, forbidden) AS (VALUES {_HEADER_VALUES}),
labels AS (SELECT '' AS table_name, unnest({sql_list(LABELS)}) AS label UNION ALL
  SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ({', '.join(_Q(t) for t in _LABEL_TABLES)})),
forms AS (SELECT *, trim(regexp_replace(label, '[_~#|-]+', ' ', 'g')) AS spaced, lower(trim(regexp_replace(regexp_replace(regexp_replace(label, '[._-]', ' ', 'g'), '([a-z0-9])([A-Z])', '\1 \2', 'g'), '\s+', ' ', 'g'))) AS words FROM labels),
toks AS (SELECT *, string_split(regexp_replace(words, '[^a-z0-9]+', '_', 'g'), '_') AS t0, string_split(regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g'), '_') AS s0 FROM forms),
tok AS (SELECT *, CASE WHEN list_contains(t0, 'dob') THEN list_concat(t0, ['date', 'birth']) ELSE t0 END AS tokens FROM toks),
variants AS (SELECT table_name, label, words, tokens, s0, unnest([0, 1, 2]) AS v, unnest([label, spaced, regexp_replace(spaced, '([a-z0-9])([A-Z])', '\1 \2', 'g')]) AS form FROM tok WHERE NOT regexp_full_match(lower(label), 'column_\d+')),
hits AS (SELECT table_name, label, canonical, v, ord, regexp_extract(form, '(?i)' || pattern) AS m, form FROM variants, rules WHERE regexp_matches(form, '(?i)' || pattern)
  AND (len(required) = 0 OR list_has_any(tokens, required)) AND len(list_filter(forbidden, lambda f: CASE WHEN contains(f, ' ') THEN contains(words, f) ELSE list_contains(tokens, f) END)) = 0
  AND NOT (canonical IN ('first name', 'last name', 'full name') AND list_has_any(s0, ['name', 'fullname']) AND list_has_any(s0, {sql_list(NO_PERSON)}))),
best AS (SELECT table_name, label, arg_min(canonical, [v, strpos(form, m), -length(m), ord]) AS canonical FROM hits GROUP BY 1, 2)
SELECT l.table_name, l.label, coalesce(canonical, '') AS canonical FROM labels l LEFT JOIN best b ON l.table_name = b.table_name AND l.label = b.label"""
_LADDERS = f"""
WITH x AS (SELECT c_custkey, CAST(c_custkey AS BIGINT) * 2654435761 % 4096 AS b FROM customer),
y AS (SELECT c_custkey, list_sort(list_filter([{', '.join(f"CASE WHEN (b >> {i}) & 1 = 1 THEN '{t}' END" for i, t in enumerate(TYPES))}], lambda t: t IS NOT NULL)) AS types FROM x),
z AS (SELECT *, list_filter([
  CASE WHEN {any_sql(L.STANDALONE)} THEN 'validated_or_contextual_strong_identifier' END,
  CASE WHEN ({any_sql(('Name',))} OR {any_sql(L.STRONG + L.EMAIL_TYPES)}) AND {any_sql(('DOB',))} THEN 'name_or_email_plus_dob' END,
  CASE WHEN {any_sql(L.ID_TYPES)} AND {any_sql(('Name', 'DOB', 'Phone') + L.STRONG + L.EMAIL_TYPES)} THEN 'institutional_id_plus_identifying_detail' END,
  CASE WHEN {any_sql(L.SENSITIVE)} AND {any_sql(L.IDENTIFIABLE)} THEN 'sensitive_attribute_plus_identifiable_person' END,
  CASE WHEN {any_sql(('Payment Card',))} THEN 'luhn_valid_payment_card' END,
  CASE WHEN ({any_sql(('Address',))} AND {any_sql(('Name',))}) OR ({any_sql(('Phone',))} AND {any_sql(L.STRONG + L.EMAIL_TYPES)}) THEN 'supporting_contact_details_linked' END], lambda r: r IS NOT NULL) AS r,
  {exposure_sql()} AS exposure FROM y)
SELECT c_custkey, array_to_string(types, '|') AS types, CASE WHEN len(list_filter(r, lambda x: x <> 'supporting_contact_details_linked')) > 0 THEN 'high' WHEN len(r) > 0 OR {any_sql(L.TIER_ONE)} THEN 'medium' ELSE 'low' END AS risk,
  CASE WHEN len(r) > 0 THEN array_to_string(r, '|') WHEN {any_sql(L.TIER_ONE)} THEN 'strong_identifier_without_linkage' ELSE 'weak_supporting_evidence_only' END AS reasons,
  exposure, CASE exposure WHEN 'high' THEN 90 WHEN 'medium' THEN 60 WHEN 'low' THEN 25 ELSE 0 END AS score FROM z"""
SQL = {
    "r_findings": _FOUND + "SELECT * FROM findings", "r_counts": _FOUND + "SELECT pattern_name, count(*) AS findings FROM findings GROUP BY 1", "v_answers": _ANSWERS, "v_documents": _DOCUMENTS,
    "h_labels": _LABELS, "i_ladders": _LADDERS,
}
QUERIES = {f.__name__: f for f in (r_findings, r_counts, v_answers, v_documents, h_labels, i_ladders)}
