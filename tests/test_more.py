"""Ordering, inference, exact matches, comparison, people, reports and file signals."""

import json

from pyspark.sql import functions as F

from traceloom.functions.text import alias_rules, email_aliases
from traceloom.operators import compare as C
from traceloom.operators import overlap as O
from traceloom.operators import people as P
from traceloom.operators import profiling as G
from traceloom.operators.exact import exact_index, exact_matches
from traceloom.operators.infer import infer_headers, plan_decisions, rule_coverage, schema_plan
from traceloom.operators.ordering import capped_values, group_places, number_rows
from traceloom.operators.summary import entity_summary, file_summary
from traceloom.sources import sinks
from traceloom.sources.files import file_signals


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("k")).repartition(5)
    got = [(r.g, r.k) for r in number_rows(df, "g", "k").orderBy("row_no").collect()]
    assert got == sorted(got) and number_rows(df, "g", "k").agg(F.min("row_no"), F.max("row_no"), F.count_distinct("row_no")).first() == (1, 1000, 1000)
    assert number_rows(df.limit(0), "g", "k").count() == 0


def test_places_in_a_hot_group(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.col("id").alias("k"))
    got = {r.k: (r.group_size, r.place, r.canonical) for r in group_places(df, "g", "k").collect()}
    assert got[0] == (400, 1, 0) and got[399] == (400, 400, 0) and got[450] == (1, 1, 450)


def test_capped_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("a", "y"), ("a", "x"), ("b", ""), ("b", None), ("c", "q")], "g string, v string")
    assert dict(capped_values(df, "g", "v", 2).collect()) == {"a": "x|y|...(+1 more)", "c": "q"}


def test_inferred_headers(spark):
    rows = [(f"u{i}@x.org", f"Ann{'abcdefghij'[i]} Lark{'abcdefghij'[i]}", "male" if i % 2 else "female", f"{i} High Street", "SW1A 1AA", "1990-01-01") for i in range(10)]
    cols = [f"column_{i}" for i in range(1, 7)]
    df = spark.createDataFrame(rows, cols)
    assert infer_headers(df, cols, trusted=False) == dict(zip(cols, ["email", "full name", "gender/sex", "address1", "postcode", "column_6"]))
    own = df.toDF("contact", "full name", "x", "y", "z", "dob")
    assert infer_headers(own, own.columns)["contact"] == "email" and infer_headers(own, own.columns)["x"] == "x"
    plan = {r.raw_header: r.scan_action for r in schema_plan(spark, own, "t", own.columns).collect()}
    assert plan == {"contact": "route_suggested", "full name": "assemble_only", "x": "raw_fallback", "y": "route_suggested", "z": "route_suggested", "dob": "route_rules_and_emit"}
    assert plan_decisions(schema_plan(spark, own, "t", own.columns)).count() == 6
    assert infer_headers(df.limit(0), cols, trusted=False) == dict(zip(cols, cols))


def test_exact_matches_point_at_one(spark):
    people = spark.createDataFrame([("P1", "AB-123456"), ("P2", "XY 999999; shared1"), ("P3", "shared1"), (None, "zz123456"), ("P4", "unknown")], "id string, code string")
    index = exact_index(people, "id", {"code": "Code"})
    rows = spark.createDataFrame([(1, "ab123456"), (2, "foo|xy999999"), (3, "SHARED1"), (4, None), (5, "unknown")], "k long, c string")
    assert {(r.unit_key, r.person) for r in exact_matches(rows, "k", ["c"], index).collect()} == {(1, "P1"), (2, "P2")}


def test_comparison(spark):
    a = spark.createDataFrame([("Email", "x"), ("Email", "y"), ("Phone", "1")], "evidence_type string, normalized_value string")
    b = spark.createDataFrame([("Email", "X"), ("Phone", "2")], "evidence_type string, normalized_value string")
    got = {r.evidence_type: (r.shared, r.left_only, r.right_only) for r in C.conservation(C.evidence_terms(a), C.evidence_terms(b), ["evidence_type"]).collect()}
    assert got == {"Email": (1, 1, 0), "Phone": (0, 1, 1)}
    p = lambda *x: spark.createDataFrame([(v,) for v in x], "person string")
    assert tuple(C.people_two_by_two(p("a", "b", "c", "d"), p("a", "b"), p("b", "c")).first()) == (1, 1, 1, 1)


def test_overlaps(spark):
    t = lambda s, *v: O.tokens(spark.createDataFrame([(x,) for x in v], "v string"), s, "Email", F.col("v"))
    both = t("l", "a", "A ", "b", None).unionByName(t("r", "a", "c"))
    assert tuple(O.membership(both, "l", "r").first())[:3] == (1, 1, 1)
    assert tuple(O.multiset_overlap(t("l", "a", "a", "b"), t("r", "a", "a", "a")).first()) == (2, 1)
    mails = spark.createDataFrame([("s1", "a"), ("s2", "a"), ("s3", "a"), ("s1", "b"), ("s1", "b")], "source string, email string")
    assert O.email_overlap(mails).count() == 3
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k long, email string")
    assert [tuple(r) for r in O.not_in_list(rows, spark.createDataFrame([("a",)], "email string"), "k").collect()] == [("b", 2)]


def test_people(spark):
    hits = spark.createDataFrame([(1, "Email", "a@x", "P1"), (2, "Name", "ann lark", "P1"), (2, "DOB", "1990-01-01", "P1"), (3, "Name", "b c", "P2")], "unit long, evidence_type string, value string, person string")
    got = {r.person: (r.risk_level, r.risk_score, r.matched_units) for r in P.known_exposure(hits, ["unit"]).collect()}
    assert got == {"P1": ("high", 90, 2), "P2": ("medium", 60, 1)}
    assert {r.person: r.email_values for r in P.value_matrix(hits, ("Email",)).collect()} == {"P1": "a@x", "P2": ""}
    found = spark.createDataFrame([(1, "Name", "other"), (3, "Name", "found one")], "unit_key long, evidence_type string, normalized_value string")
    exact = spark.createDataFrame([(1, "P1"), (3, "P1"), (3, "P2")], "unit_key long, person string")
    names = spark.createDataFrame([("P1", "ann lark")], "person string, name string")
    assert {(r.unit_key, r.name) for r in P.authoritative_names(found, exact, names).collect()} == {(1, "ann lark"), (3, "found one")}


def test_profiles_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(i, str(1000 + i), "a" if i % 2 else "b", None) for i in range(40)], "k long, code string, kind string, none string")
    profile = G.value_type(G.column_profile(df, ["code", "kind", "none"]))
    assert {r.column_name: r.suggested for r in profile.collect()} == {"code": "identifier", "kind": "enum", "none": "text"}
    from traceloom.operators.infer import value_candidates

    assert G.draft_rules(value_candidates(profile), str(tmp_path / "drafts")) == 2
    assert json.loads((tmp_path / "drafts" / "code.json").read_text())["kind"] == "possible_identifier_family"
    f = spark.createDataFrame([(1, "Email", "contact_location_email", "a"), (1, "DOB", "column_dob", "1990-01-01"), (2, "Email", "contact_location_email", "b")], "file long, evidence_type string, pattern_name string, normalized_value string")
    assert {r.evidence_type: (r.findings, r.files) for r in entity_summary(f, "file").collect()} == {"Email": (2, 2), "DOB": (1, 1)}
    files = spark.createDataFrame([(1,), (2,), (3,)], "file long")
    assert {r.file: (r.count_email, r.risk_level) for r in file_summary(files, f, "file", ("Email",)).collect()} == {1: (1, "high"), 2: (1, "medium"), 3: (0, "none")}
    assert {r.pattern_name: r.status for r in rule_coverage(f, "file").collect()}["contact_location_email"] == "active"


def test_sinks(spark, tmp_path):
    f = spark.createDataFrame([(1, "Email", "p", "aa"), (1, "Email", "p", "long context")], "file long, evidence_type string, pattern_name string, context string")
    sinks.write_evidence(f, str(tmp_path / "e"), "csv")
    assert spark.read.option("header", "false").csv(str(tmp_path / "e")).count() == 2
    assert {r.context for r in sinks.widen_context(f, ["file"]).collect()} == {"long context"}
    sinks.write_index(f, str(tmp_path / "i"))
    assert sinks.read_index(spark, str(tmp_path / "i"), f).count() == 2
    sinks.write_person_evidence(f.withColumn("person", F.lit("P")), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    sinks.html_report(str(tmp_path / "r.html"), "A<b", [{"x": 1}])
    assert "A&lt;b" in (tmp_path / "r.html").read_text()


def test_aliases_and_signals(spark):
    rules = alias_rules("@a.org == mail.a.org; bad; x == x")
    assert rules == [("a.org", "mail.a.org")]
    df = spark.createDataFrame([("U@a.org",), ("u@mail.a.org.uk",), ("u@b.org",), (None,)], "e string")
    assert [r[0] for r in df.select(email_aliases(F.col("e"), rules)).collect()] == [["u@a.org", "u@mail.a.org"], ["u@a.org.uk", "u@mail.a.org.uk"], ["u@b.org"], []]
    files = spark.createDataFrame([("passport Ann Lark.pdf", "pdf"), ("passport.jpg", "jpg"), ("a.txt", "txt")], "n string, x string")
    assert {(r.file_name, r.evidence_type) for r in file_signals(files, "n", "x").collect()} == {
        ("passport Ann Lark.pdf", "Document Info"), ("passport Ann Lark.pdf", "Identity Document File"), ("passport.jpg", "Pictures")}
