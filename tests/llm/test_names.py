"""Names, metric partitioning and variant links."""

import functools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from traceloom.llm.metric_join import radius_pairs
from traceloom.llm import metric_join, name_variants
from traceloom.llm.name_variants import keyed_rows, names_agree, people_of, variant_links
from traceloom.llm.people import birth_date, birth_parts, mailbox, name_tokens, people_rows, phone


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("cell,radius", [(1000, 2), (16, 2), (16, 1)])
def test_radius_pairs_are_all_pairs(spark, cell, radius):
    rng = random.Random(9)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(3, 8))) for _ in range(260)}
    rows = [("b", w) for w in words] + [("c", "abcabc"), ("c", "abcabd"), ("c", "abcabd"), ("c", None), (None, "abcabc")]
    got = {(r.a, r.b, r.d) for r in radius_pairs(spark.createDataFrame(rows, "k string, x string"), "k", "x", radius, cell=cell, fan=4).collect() if r.block == "b"}
    ws = sorted(words)
    want = {(a, b, lev(a, b)) for i, a in enumerate(ws) for b in ws[i + 1:] if lev(a, b) <= radius}
    assert got == want
    assert radius_pairs(spark.createDataFrame([], "k string, x string"), "k", "x", 2).count() == 0


def test_large_block_of_few_strings_keeps_its_pairs(spark):
    rows = [("b", "jones" if i % 2 else "johns", i) for i in range(300)] + [("c", "only", i) for i in range(300)]
    got = radius_pairs(spark.createDataFrame(rows, "k string, x string, id int"), "k", "x", 2, keep=("id",), apart="id")
    # Rows of one string pair too, as they differ in id.
    assert {r.block: r["count"] for r in got.groupBy("block").count().collect()} == {"b": 300 * 299 // 2, "c": 300 * 299 // 2}


def test_name_tokens(spark):
    cases = {"Dr Maddy O'Lark": ["madeleine", "olark"], "LARK, José": ["jose", "lark"], "Ann van der Lark": ["ann", "lark"],
             "Ann vanderWenquist": ["ann", "wenquist"], "O1umide Skels0n": ["olumide", "skelson"], "Ma McLark": ["ma", "mclark"], "": [], "?": []}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {r.n: r.t for r in df.select("n", name_tokens(df.n).alias("t")).collect()} == cases


def test_agreement(spark):
    cases = [("Ann Lark", "Lark A", True), ("Ann Lark", "Anne Q. Lark", True), ("Ann Lark", "Bob Lark", False), ("Bella Lark", "Arabella Lark", True),
             ("Ann Lark", "Ann", False), ("Rose Lark", "Rsoe Lark", True), ("A Lark", "A Bark", True), ("Ann Lark", "Ann Wenquist", False)]
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    for r in df.select("*", names_agree(name_tokens(F.col("a")), name_tokens(F.col("b"))).alias("got")).collect():
        assert r.got == r.want, r


def test_fields(spark):
    df = spark.createDataFrame([("4 May 1990", " A.B+tag@X.org", "+44 7700 900123")], "d string, m string, p string")
    assert tuple(df.select(birth_date(df.d), mailbox(df.m), phone(df.p)).first()) == ("19900504", "a.b", "700900123")
    odd = spark.createDataFrame([(x,) for x in ("1900-01-01", "unknown", "", None)], "d string")
    assert all(r[0] is None for r in odd.select(birth_date(odd.d)).collect())
    part = spark.createDataFrame([("1990-05",), ("May 1990",), ("1990",)], "d string")
    assert [tuple(r) for r in part.select(*birth_parts(part.d)).collect()] == [("1990", "05", None), ("1990", "05", None), ("1990", None, None)]


def test_links_and_people(spark):
    rows = [
        ("K1", ["ann", "lark"], "19900101", ["ann1"], "700900001"), ("K2", ["a", "lark"], "19900101", [], None), ("K2", ["a", "lark"], "19900101", [], None),
        ("K3", ["ann", "larrk"], None, ["ann1"], None), ("K4", ["ann", "lark"], "19800202", ["other"], "700900001"),
        ("K5", ["bob", "stone"], "19900101", ["ann1"], None), ("K6", ["lark"], "19900101", ["ann1"], None), ("K7", [], None, [], None),
    ]
    df = spark.createDataFrame(rows, "key string, tokens array<string>, dob string, mails array<string>, tel string")
    people = people_of(variant_links(df), df).collect()
    by = {}
    for r in people:
        by.setdefault(r.person, set()).add(r.key)
    assert list(by.values()) == [{"K1", "K2", "K3"}]
    empty = df.limit(0)
    assert people_of(variant_links(empty), empty).count() == 0


def test_crowded_evidence_links_as_a_small_one(spark):
    # The block of a compared token has more rows than a cell, but two strings.
    rows = [(f"K{i}", ["an", "jones" if i % 2 else "johns"], "19900102", []) for i in range(2)]
    many = rows + [(f"M{i}", ["a" + "bcdefghijklmnopqrst"[i % 19] + "bcdefghijklmnopqrst"[i // 19] + "xyzuvw", "jones" if i % 2 else "johns"], "19900102", []) for i in range(300)]
    schema = "key string, tokens array<string>, dob string, mails array<string>"
    ids = {r.h: r.key for r in spark.createDataFrame(rows, schema).select("key", F.xxhash64("key").alias("h")).collect()}
    got = [{frozenset((ids.get(r.a), ids.get(r.b))) for r in variant_links(spark.createDataFrame(x, schema)).collect()} for x in (rows, many)]
    assert frozenset(("K0", "K1")) in got[0] and frozenset(("K0", "K1")) in got[1]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="needs the test tables")
def test_small_cells_give_the_same_links(spark, monkeypatch):
    rows = keyed_rows(spark, "/root/testdata/sf0.001")
    whole = {tuple(r) for r in variant_links(rows).collect()}
    monkeypatch.setattr(name_variants, "radius_pairs", functools.partial(radius_pairs, cell=3, fan=2))
    assert {tuple(r) for r in variant_links(rows).collect()} == whole != set()


def test_every_mailbox_is_a_proof_and_cells_are_reported(spark):
    rows = [("K1", ["ada", "jones"], None, ["aaaa", "bbbb", "shared"]), ("K2", ["ada", "jonse"], None, ["cccc", "dddd", "eeee", "shared"])]
    rows += [(f"M{i}", ["a" + "bcdefghijklmnopqrst"[i % 19] + "xyzuvw", "jones"], "19900102", []) for i in range(60)]
    report = []
    df = spark.createDataFrame(rows, "key string, tokens array<string>, dob string, mails array<string>")
    ids = {r.h: r.key for r in df.select("key", F.xxhash64("key").alias("h")).collect()}
    got = {frozenset((ids[r.a], ids[r.b])) for r in variant_links(df, report=report).collect()}
    assert frozenset(("K1", "K2")) in got
    assert [r["level"] for r in report] == list(range(len(report))) and len(report) > 1 and report[1]["cells"] > 1


def test_evidence_parses_a_name_once_and_is_shuffled_once(spark):
    df = spark.createDataFrame([("K1", "Ann Lark", "1990-01-02", "ann.lark@a.org"), ("K2", "Ann Lark", "1990-01-02", None), ("K3", "Ann", "1990-01-02", "ann.lark@a.org")], "id string, name string, born string, mail string")
    known = name_variants.held_evidence(people_rows(df, "id", ["name"], "born", ["mail"]))
    plan = known._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("split(regexp_replace") == 1
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1
    # One holder for both keys of the date, another proof for the mailbox; a single token is no name.
    rows = known.collect()
    assert len(rows) == 3 and len({r.key for r in rows}) == 2
    assert sum(r.key != r.holder for r in rows) == 1 and len({(r.proof, r.name, r.holder) for r in rows}) == 2


def test_dates_and_agreement_read_their_values_once(spark):
    df = spark.createDataFrame([("x", "ann lark", "ann larrk")], "d string, a string, b string")
    plan = lambda c: df.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan(birth_date(df.d)).count("RLIKE") == 3
    assert plan(names_agree(F.split("a", " "), F.split("b", " "))).count("split(") == 2
    cases = {
        "1990-05-04": "19900504", "19900504": "19900504", " 1990-05-04T10:00": "19900504", "1900-12-31": None, "1901-01-01": "19010101", "04/05/1990": "19900504",
        "4.5.1990": "19900504", "1/1/1900": None, "4 May 1990": "19900504", "14 SEPT 1990": "19900914", "4 Foo 1990": None, "4 May 1900": None, "May 1990": None, "1990": None, None: None,
    }
    dates = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r.d: r.t for r in dates.select("d", birth_date(dates.d).alias("t")).collect()} == cases


def test_proof_of_few_names_is_one_cell(spark):
    """Names of a proof that few share are compared as they are: one cell, where their objects made many."""
    schema = "key string, tokens array<string>, dob string, mails array<string>"
    rows = [("K1", ["ann", "lark"], None, ["shared"]), ("K2", ["ann", "larrk"], None, ["shared"]), ("K3", ["bob", "stone"], None, ["shared"]), ("K4", ["ann", "lark"], None, ["other"])]
    report = []
    df = spark.createDataFrame(rows, schema)
    ids = {r.h: r.key for r in df.select("key", F.xxhash64("key").alias("h")).collect()}
    assert [{ids[r.a], ids[r.b]} for r in variant_links(df, report=report).collect()] == [{"K1", "K2"}]
    assert [tuple(r.values()) for r in report] == [(0, 2, 4, 3)]


def test_few_names_link_as_their_objects_do(spark, monkeypatch):
    rng = random.Random(5)
    given = ["ann", "anne", "a", "bella", "arabella", "trixie", "beatrix", "rose", "rsoe", "jo", "ed", "edward", "ted", "liz", "betty"]
    family = ["lark", "larrk", "lerk", "stone", "st", "bark", "al", "wenquist", "wenqiust", "l", "s"]
    rows = []
    for i in range(240):
        tokens = sorted({rng.choice(given), rng.choice(family)} | ({rng.choice(given + family)} if rng.random() < 0.3 else set()))
        rows.append((f"K{rng.randrange(200)}", tokens, None if i % 3 else f"1990{i // 6:04d}", [f"mail{i // 6}"]))
    df = spark.createDataFrame(rows, "key string, tokens array<string>, dob string, mails array<string>")
    direct = {tuple(r) for r in variant_links(df).collect()}
    monkeypatch.setattr(metric_join, "SENT", 0)
    assert {tuple(r) for r in variant_links(df).collect()} == direct
    # As many crowded proofs as there are, so that all names are compared by their objects.
    monkeypatch.setattr(name_variants, "CELL", 0)
    assert {tuple(r) for r in variant_links(df).collect()} == direct and len(direct) > 20


def test_capitals_and_tags(spark):
    names = {"annLark": ["ann", "lark"], "McLark": ["mclark"], "MacLark": ["maclark"], "AnnMcLark": ["ann", "lark", "mc"], "lMcLark": ["l", "lark", "mc"], "ANN": ["ann"], "aB": ["a", "b"]}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r.n: r.t for r in df.select("n", name_tokens(df.n).alias("t")).collect()} == names
    mails = {"+x@y": None, "@y": None, "a+b+c@x": "a", "A@x@y": "a", "a": None, "a+b": None, "a+b\nc@x": "a+b\nc", None: None}
    df = spark.createDataFrame([(k,) for k in mails], "m string")
    assert {r.m: r.t for r in df.select("m", mailbox(df.m).alias("t")).collect()} == mails
