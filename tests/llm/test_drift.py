"""Tree edit scripts and drift between files."""

import itertools
import json
from pathlib import Path

import pytest

from traceloom.llm.drift import (
    TYPED_TABLES, canonical, changes, column_families, edit_scripts, families, first_names, json_records, leaves, p6_unified, slug, typed_records, unify,
)
from traceloom.llm.schema_tree import assignment, script


def test_assignment_is_least():
    cost = [[4, 1, 3, 9], [2, 0, 5, 8], [3, 2, 2, 7], [1, 6, 4, 3]]
    got = sum(cost[i][j] for i, j in enumerate(assignment(cost)))
    assert got == min(sum(cost[i][p[i]] for i in range(4)) for p in itertools.permutations(range(4)))


def test_scripts():
    shares = {("a", "b"): 1.0, ("b", "a"): 1.0, ("a", "a"): 0.0, ("b", "b"): 0.0, ("o\x1fx", "p\x1fx"): 1.0}
    look = lambda x, y: shares.get((x, y))
    assert sorted(script(["a", "b"], ["a", "b"], look)) == [("renamed", "a", "b"), ("renamed", "b", "a")]
    assert ("moved", "o\x1fx", "p\x1fx") in script(["o\x1fx", "o\x1fk"], ["o\x1fk", "p\x1fx", "p\x1fz"], look)
    assert script([], ["n"], look) == [("added", "", "n")]
    assert script(["n"], [], look) == [("removed", "n", "")]


def records(rows, seq):
    return [("s", seq, f"f{seq}", i, json.dumps(r)) for i, r in enumerate(rows)]


def test_changes(spark):
    people = [{"name": f"Person {i:03d}", "mail": f"p{i}@x.org", "dob": f"19{60 + i}-01-02", "ok": "active"} for i in range(20)]
    second = [{"Name": p["name"], "mail": p["mail"], "born": f"02/01/{p['dob'][:4]}", "ok": True, "more": {"room": i}} for i, p in enumerate(people)]
    rows = records(people + people[:2], 1) + records(second, 3) + [("s", 3, "f3", 99, "broken"), (None, 1, "x", 1, "{}"), ("one", 1, "g", 1, None)]
    df = spark.createDataFrame(rows, "series string, file_seq int, file_name string, line_no int, record_text string")
    got = {tuple(r) for r in changes(edit_scripts(json_records(df))).collect()}
    assert got == {("s", "f3", "renamed", "name", "Name"), ("s", "f3", "renamed", "dob", "born"),
                   ("s", "f3", "retyped", "ok", "ok"), ("s", "f3", "added", "", "more.room")}
    assert changes(edit_scripts(json_records(df.limit(0)))).count() == 0


def test_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (2, None, 2.5)], "k long, field string, val double")
    first, second = typed_records(df, "s", 1, "f", "k").orderBy("line_no").collect()
    assert list(zip(first.f, first.kind, first.raw)) == [("field", "string", "x"), ("val", "number", "2.5")] and second.kind == [None, "number"]


def test_canonical():
    assert {canonical(c) for c in ("1985-05-26", "26/05/1985", "26.05.1985", "26 May 1985", "19850526", "1985-05-26T10:00", " 1985-05-26 ")} == {"19850526"}
    assert canonical("Yes") == canonical("ACTIVE") == "true" and canonical(" ") is None and canonical("") is None and canonical(None) is None


def test_leaves():
    deep = {"email": "x", "a": {"b": {"c": {"d": {"e": {"f": 1.50}}}}}}
    assert leaves(json.dumps(deep))[-1] == ("a\x1fb\x1fc\x1fd\x1fe\x1ff", "number", "1.5")
    assert leaves('{"a": 1, "a": "2", "b": [1], "c": {}, "d": null, "e": true}') == [
        ("a", "string", "2"), ("b", "array", "[\"1\"]"), ("c", "object", "{}"), ("d", None, None), ("e", "boolean", "true")]
    assert leaves("[1]") == leaves("no json") == leaves(None) == leaves("") == []
    assert leaves("[" * 100000) == []


def test_copies_of_a_line_count_once(spark):
    odd = [{"a": "text", "who": "one@x.org"}] * 5 + [{"a": i, "who": f"{i}@x.org"} for i in range(3)]
    rows = records(odd, 1) + records([{"a": i, "who": f"{i}@x.org"} for i in range(3)], 2)
    df = spark.createDataFrame(rows, "series string, file_seq int, file_name string, line_no int, record_text string")
    assert changes(edit_scripts(json_records(df))).count() == 0


def test_families():
    renames = {("dob", "born"): 3, ("born", "birth_when"): 2, ("kind", "status"): 1, ("kind", "born"): 1}
    got = column_families(renames, {("dob", "kind")}, ["birth_when"])
    assert got["dob"] == got["born"] == got["birth_when"] == "birth_when" and got["kind"] == got["status"] != "birth_when"
    assert slug("MailAddr") == "mail_addr" and slug("a\x1fb c") == "a_b_c"


DATA = "/root/testdata/sf0.01"


def one_table(spark, rows):
    scripts = edit_scripts(rows)
    origins = first_names(scripts)
    return unify(rows, origins, families(scripts, origins, ["name", "mail", "ident"]), ["name", "mail", "ident"])


def test_colliding_fields_and_records_without_series(spark):
    people = [{"name": f"Person {i:03d}", "mail": f"p{i:03d}@x.org", "ident": f"REF{i:04d}"} for i in range(20)]
    later = [{"name": p["name"], "post": p["mail"], "ident": p["ident"], "extra": 1} for p in people]
    both = [{"Email": "a@x.org", "email": "b@x.org", "name": "Ada", "Extra": "1", "extra": "2"}]
    rows = records(people, 1) + records(later, 2) + [("t", 1, "g1", 0, json.dumps(both[0])), (None, None, "h", 7, '{"post": "z@x.org"}'), ("t", 2, "g2", 1, "broken")]
    df = spark.createDataFrame(rows, "series string, file_seq int, file_name string, line_no int, record_text string")
    out = {(r.file_name, r.line_no): r for r in one_table(spark, json_records(df)).collect()}
    assert len(out) == len(rows)
    assert all(out["f2", i].mail == p["mail"] == out["f1", i].mail and out["f2", i].ident == p["ident"] for i, p in enumerate(people))
    assert json.loads(out["f2", 3].more) == {"extra": "1"} and out["h", 7].mail == "z@x.org" and out["g2", 1].name is None
    clash = out["g1", 0]
    assert json.loads(clash.more) == {"email": "a@x.org", "extra": "1"} and set(clash.conflicts.split("|")) == {"email=b@x.org", "extra=2"}
    assert one_table(spark, json_records(df.limit(0))).count() == 0


@pytest.mark.skipif(not Path(DATA).exists(), reason="needs the test tables")
def test_unified_table_holds_the_records_of_all_three_tables(spark):
    out = p6_unified(spark, DATA).cache()
    tables = {x: spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("roster_drops", *[n for n, _ in TYPED_TABLES])}
    assert out.count() == sum(t.count() for t in tables.values())
    filled = out.selectExpr("avg(int(full_name IS NOT NULL)) AS n", "avg(int(external_ref IS NOT NULL)) AS r", "avg(int(mailbox IS NOT NULL)) AS m").first()
    assert filled.n > 0.99 and filled.r > 0.99 and filled.m > 0.9
    # What the script between the two typed tables renames stands under the names of the first.
    b = tables["roster_contacts_b"].selectExpr(
        "roster_b_no AS line_no", "full_name", "user_contact AS mailbox", "CAST(born_when AS string) AS birth_when", "reference_code AS external_ref", "category_flag")
    assert b.exceptAll(out.where("file_name = 'roster_contacts_b'").select(*b.columns)).count() == 0
    a = tables["roster_contacts_a"].selectExpr("roster_a_no AS line_no", "full_name", "mailbox", "birth_when", "CAST(external_ref AS string) AS external_ref")
    assert a.exceptAll(out.where("file_name = 'roster_contacts_a'").select(*a.columns)).count() == 0
    out.unpersist()
