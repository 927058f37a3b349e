"""Rules, scans, linking, graph, sources and a whole run on small inputs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from traceloom.cli import parse_args
from traceloom.engine import Engine
from traceloom.functions import text as T
from traceloom.functions import validators as V
from traceloom.operators import linking as L
from traceloom.operators.dedupe import content_groups
from traceloom.operators.graph import connected_components
from traceloom.operators.rules import RULES, load_rules, resolve_header
from traceloom.operators.scan import cap_findings, scan_table, scan_text, text_units
from traceloom.sources import files as S
from traceloom.sources import records as R


def check(spark, function, cases):
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.ok for r in df.select("v", function(F.col("v")).alias("ok")).collect()}
    assert got == cases


def test_validators(spark):
    check(spark, V.luhn, {"4111 1111 1111 1111": True, "4111111111111112": False, "0000000000000000": False, "4111.1111": False, None: False})
    check(spark, V.nhs_number, {"943 476 5919": True, "9434765918": False, "1111111111": False, "": False})
    check(spark, V.contextual_date, {"1990-02-30": False, "29/02/2004": True, "1-1-99": True, "2199-01-01": False, None: False})
    check(spark, V.driving_licence, {"MORGA657054SM9IJ": True, "MORGA657994SM9IJ": False, "x": False})
    check(spark, V.china_id, {"11010519491231002X": True, "110105194912310021": False})
    check(spark, V.ni_number, {"AB 12 34 56 C": True, "BG123456A": False, "AB111111A": False})
    check(spark, V.orcid, {"0000-0002-1825-0097": True, "0000-0002-1825-0098": False})
    check(spark, V.postcode, {"sw1a 1aa": True, "ZZ": False})
    check(spark, V.person_name, {"Dr Ann Lark": True, "Lark": False, "School of Maths": False, "A1 Lark": False})
    check(spark, V.positive_amount, {"£1,200.50": True, "0": False, "no|3": True, "": False})
    check(spark, V.disability, {"Dyslexia": True, "none": False, "yes": True})
    check(spark, V.bare_id, {"19900101": False, "12345678": False, "90817263": True})


def test_text_functions(spark):
    df = spark.createDataFrame([(" a  b\t", "Lark, Mr Ann", "x@Mail.Uni.AC.uk", "a\r\nb\n\n")], "c string, n string, e string, l string")
    r = df.select(T.safe_cell(F.col("c")), T.clean_name(F.col("n")), T.email_type(F.col("e"), ["uni.*"]), T.lines(F.col("l"))).first()
    assert tuple(r) == ("a b", "Mr Ann Lark", "Institutional Email", ["a", "b", ""])
    with pytest.raises(KeyError):
        T.normal_form("odd", F.col("c"))


@pytest.mark.parametrize("header,want", [("UoN email", "email"), ("email type", None), ("student-number", "student id"), ("DateOfBirth", "DOB"),
                                         ("Root.Person.Contact.EMAIL_ADDR", "email"), ("course name", None), ("column_2", None), ("", None)])
def test_headers(header, want):
    found = resolve_header(header)
    assert (found.canonical if found else None) == want


def test_text_scan_needs_triggers(spark):
    docs = spark.createDataFrame([(1, "NHS number: 943 476 5919\nring 07700 900123 or a@x.org\npassport P1234567 from 10.0.0.1"), (2, None), (3, "")], "doc long, text string")
    got = {(r.row_number, r.evidence_type, r.normalized_value) for r in scan_text(text_units(docs, "doc", "text")).collect()}
    assert got == {(1, "NHS Number", "9434765919"), (2, "Phone", "07700900123"), (2, "Email", "a@x.org"), (3, "Passport", "P1234567"), (3, "IP Address", "10.0.0.1")}


def test_table_scan_routes_by_header(spark):
    rows = [(1, "Ann", "Lark", "a@x.org", "07700 900123", "call 07700 900123", "1990-05-06", "12-34-56", "12345678")]
    df = spark.createDataFrame(rows, "`id` long, `first name` string, `last name` string, email string, `email type` string, notes string, dob string, `sort code` string, `account number` string")
    got = {(r.evidence_type, r.normalized_value, r.pattern_name) for r in scan_table(df, "id").collect()}
    assert ("Name", "ann lark", "assembled_name") in got and ("DOB", "1990-05-06", "column_dob") in got
    assert ("Bank Account", "12345612345678", "assembled_table_bank_account") in got
    assert sum(t == "DOB" for t, _, _ in got) == 1 and sum(t == "Email" for t, _, _ in got) == 1


def test_cap(spark):
    docs = spark.createDataFrame([(1, "\n".join(f"u{i}@x.org" for i in range(9)))], "doc long, text string")
    out = cap_findings(scan_text(text_units(docs, "doc", "text")), ["unit_key"], ["row_number"], 4).collect()
    assert len(out) == 5 and sum(r.evidence_type == "SCAN_LIMIT" for r in out) == 1


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(30)] + [(rng.randrange(100, 220), rng.randrange(100, 220)) for _ in range(90)] + [(1, 1), (None, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = dict(connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def linked_of(spark, rows):
    f = spark.createDataFrame(rows, "unit long, evidence_type string, normalized_value string")
    return L.linked_evidence(f, ["unit"])


def test_linking_and_clusters(spark):
    rows = [(1, "Email", "a@x.org"), (1, "DOB", "1990-01-01"), (2, "Email", "a@x.org"), (3, "Phone", "077"), (3, "Name", "ann lark"), (4, "Phone", "077"), (4, "Name", "ann lark"),
            (5, "Phone", "078"), (6, "IP Address", "1.1.1.1"), (6, "DOB", "1990-01-01"), (7, "Email", "b@x.org"), (7, "Email", "c@x.org")]
    linked = linked_of(spark, rows)
    by = {r.unit: r for r in linked.collect()}
    assert set(by) == {1, 2, 3, 4} and by[1].risk_level == "high" and by[2].risk_level == "medium" and by[3].risk_level == "low"
    clusters = dict(L.cluster_rows(linked, "unit").select("unit", "cluster").collect())
    assert clusters == {1: 1, 2: 1, 3: 3, 4: 3}
    hubs = dict(L.cluster_rows(linked, "unit", most=1).select("unit", "cluster").collect())
    assert hubs == {1: 1, 2: 2, 3: 3, 4: 4}
    summary = L.cluster_summary(linked, L.cluster_rows(linked, "unit"), "unit").collect()
    assert {r.person_cluster_id for r in summary} == {"person_cluster_00000001", "person_cluster_00000002"}


def test_too_many_values_are_not_clustered(spark):
    rows = [(1, "Email", f"u{i}@x.org") for i in range(6)] + [(1, "Phone", "077")]
    assert linked_of(spark, rows).first().cluster_exclusion_reason == "too_many_email_values:6>5"


def test_contents(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None)], "k long, c string")
    got = {r.key: (r.duplicate_index, r.canonical) for r in content_groups(df, "k", "c").collect()}
    assert got[1] == (1, 1) and got[3] == (2, 1) and got[2] == (1, 2)


def test_sniff_and_decode():
    assert S.sniff(b"%PDF-1.4", ".txt") == ".pdf" and S.sniff(b"a,b\n1,2\n3,4\n", ".unknown") == ".csv" and S.sniff(b"<?xml version='1.0'?><a/>", "") == ".xml"
    assert S.decode("héllo".encode("utf-16")) == "héllo" and S.decode(b"\xef\xbb\xbfhi\xff") == "hi" and S.binary_like(b"\x00\x01\x02" * 50)
    assert S.decode_table("é".encode("cp1252")) == "é" and not S.binary_like("text".encode("utf-16"))


def test_record_readers():
    assert R.table_records("name|email\nAnn|a@x.org\n|b@x.org\n")[1] == [("email", "b@x.org")]
    assert R.table_records("email,a@x.org,b@x.org\nfull name,Ann,Bob\ndob,1990-01-01,1991-01-01\n")[0] == [("email", "a@x.org"), ("full name", "Ann"), ("dob", "1990-01-01")]
    tree = {"people": [{"name": "Ann", "email": "a@x.org", "home": {"postcode": "SW1A 1AA"}}, {"name": "Bob", "email": "b@x.org"}]}
    assert [dict(r)["name"] for r in R.tree_records(tree)] == ["Ann", "Bob"]
    xml = "<r><rec id='1'><name>Ann</name><email>a@x.org</email></rec><rec><name>B&amp;o</name><note><![CDATA[x]]></note></rec><broken>"
    assert [dict(r)["name"] for r in R.xml_scopes(xml)] == ["Ann", "B&o"]
    assert R.html_records("<table><tr><th>Email</th></tr><tr><td>a@x.org</td></tr></table>") == [[("Email", "a@x.org")]]
    mail = "Subject: Hi\nFrom: a@x.org\n\nFull name: Ann Lark\n"
    assert R.eml_records(mail) == [[("Subject", "Hi"), ("From", "a@x.org")], [("Full name", "Ann Lark")]]
    assert R.jsonl_records('{"name": "A", "id": 1}\nbroken\n') == [[("name", "A"), ("id", "1")]]
    assert R.records_of("{broken", ".json") == ("", [])


def test_rule_files(tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"evidence_type": "X", "pattern_name": "x", "pattern": r"\bX\d+\b", "group": 0, "triggers": ["x"]}]))
    rule = load_rules(path)[0]
    assert rule.triggers == ("x",) and len(rule.fingerprint) == 64 and rule.fingerprint != RULES[0].fingerprint
    path.write_text(json.dumps([{"evidence_type": "X", "pattern_name": "x", "pattern": "(", "group": 0}]))
    with pytest.raises(Exception):
        load_rules(path)


def test_excludes(spark):
    df = spark.createDataFrame([("/a/b/c.txt",), ("/a/skip/c.txt",), ("/a/.git/c",), ("/z/c",)], "p string")
    got = [tuple(r) for r in df.select(S.excluded(F.col("p"), names=["skip"], roots=["/z"]), S.hidden(F.col("p"))).collect()]
    assert got == [(False, False), (True, False), (False, True), (True, False)]


def test_whole_run(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.csv").write_text("full name,email,dob\nAnn Lark,a@x.org,1990-05-06\nBob Wen,b@x.org,1991-05-06\n")
    (root / "sub" / "copy.csv").write_text((root / "a.csv").read_text())
    (root / "note.txt").write_text("ring 07700 900123\nmail a@x.org dob: 06/05/1990\n")
    (root / "r.jsonl").write_text('{"full_name": "Ann Lark", "email": "a@x.org", "phone": "07700 900123"}\n')
    (root / "raw.bin").write_bytes(b"\x00\x01\x02" * 500)
    people = tmp_path / "people.csv"
    people.write_text("ID,Full Name,Email\nP1,Ann Lark,a@x.org\nP2,Cy Stone,c@x.org\n")
    config = parse_args(["--root", str(root), "--output-dir", str(tmp_path / "out"), "--person-tables", str(people), "--profile"])
    manifest = Engine(spark, config).run()
    out = Engine(spark, config)
    assert manifest["outputs"]["findings"] > 0 and len(manifest["rules"]) == len(RULES)
    assert {r.person for r in out.read("known_people").collect()} == {"P1"}
    assert [r.person for r in out.read("not_in_dataset").collect()] == ["P2"]
    found = out.read("findings")
    assert found.where("unit_key LIKE '%copy.csv'").count() == found.where("unit_key LIKE '%/a.csv'").count() > 0
    config.resume = "reporting"
    assert Engine(spark, config).run()["outputs"] == manifest["outputs"]


def test_stream_equals_batch(spark, tmp_path):
    from traceloom.streaming.scan import stream_documents, stream_findings, write_findings

    df = spark.createDataFrame([(1, "a@x.org"), (2, "ring 07700 900123")], "doc long, text string")
    df.write.parquet(str(tmp_path / "in"))
    q = write_findings(stream_findings(stream_documents(spark, str(tmp_path / "in"), df.schema), "doc", "text"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == scan_text(text_units(df, "doc", "text")).count() == 2
