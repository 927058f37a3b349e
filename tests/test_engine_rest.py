"""Contents that record readers do not hold are scanned as text."""

import os
import zipfile

from traceloom.cli import parse_args
from traceloom.engine import Engine
from traceloom.sources.records import eml_records, records_of, rest_text, rtf_text, tree_records, xlsx_sheets, xml_scopes


def emails(spark, root, out):
    engine = Engine(spark, parse_args(["--root", str(root), "--output-dir", str(out)]))
    found = engine.scan(engine.discover()).where("evidence_type = 'Email'").collect()
    return {(r.unit_key.rsplit("/", 1)[1], r.normalized_value) for r in found}


def test_contents_without_records_are_text(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    files = {
        "page.html": "<html><p>write to para@x.org</p><table><tr><th>Email</th></tr><tr><td>cell@x.org</td></tr></table><table><tr><td>row@x.org</table></html>",
        "bad.json": "{'mail': broken@x.org", "bad.yaml": "a: [yaml@x.org", "one.csv": "first@x.org,b", "none.csv": "only one column\nnone@x.org",
        "some.jsonl": '{"email": "line@x.org"}\nnot json jsonl@x.org\n', "flat.xml": "<?xml version='1.0'?><a>flat@x.org</a>",
    }
    for name, text in files.items():
        (root / name).write_text(text)
    (root / "wide.txt").write_bytes("seen by wide@x.org".encode("utf-16"))
    (root / "table.txt").write_text("People\nnote|Email|x\n1|tab@x.org|2\n3|tabs@x.org|4\n")
    got = emails(spark, root, tmp_path / "out")
    assert got == {("page.html", "para@x.org"), ("page.html", "cell@x.org"), ("page.html", "row@x.org"), ("bad.json", "broken@x.org"), ("bad.yaml", "yaml@x.org"),
                   ("one.csv", "first@x.org"), ("none.csv", "none@x.org"), ("some.jsonl", "line@x.org"), ("some.jsonl", "jsonl@x.org"), ("flat.xml", "flat@x.org"),
                   ("wide.txt", "wide@x.org"), ("table.txt", "tab@x.org"), ("table.txt", "tabs@x.org")}
    found = spark.read.parquet(str(tmp_path / "out" / "findings"))
    assert found.where("row_number LIKE 'table:%' AND unit_key LIKE '%table.txt'").count() > 0


def test_word_files_are_read_whatever_their_size(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "<w:p><w:r><w:t>write to {0}.par@x.org</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>{0}.cell@x.org</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    for name, more in (("small", 0), ("large", 2 << 20)):
        with zipfile.ZipFile(root / f"{name}.docx", "w") as z:
            z.writestr("word/media/image.bin", os.urandom(more))
            z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body.format(name)}</w:body></w:document>')
    (root / "broken.docx").write_bytes(b"PK\x03\x04" + bytes(100))
    assert emails(spark, root, tmp_path / "out") == {(f"{n}.docx", f"{n}.{x}@x.org") for n in ("small", "large") for x in ("par", "cell")}


def test_records_have_no_hidden_caps():
    deep = {"email": "a@b.org", "l1": {"l2": {"l3": {"l4": {"l5": {"l6": "deepest"}}}}}}
    for _ in range(300):
        deep = {"x": deep}
    assert any(v == "deepest" for r in tree_records(deep) for _, v in r)
    wide = {f"field {i}": f"v{i}" for i in range(1000)} | {"email": "a@b.org"}
    assert max(len(r) for r in tree_records(wide)) == 1001
    xml = "<r>" + "".join(f"<f{i}>v{i}</f{i}>" for i in range(1000)) + "<email>a@b.org</email><name>Ada</name></r>"
    assert max(len(r) for r in xml_scopes(xml)) == 1002
    assert max(len(r) for r in tree_records(wide, max_fields=10)) == 10


def test_mails_are_read_once():
    raw = b"From: Ada <ada@x.org>\nTo: b@y.org\nSubject: hello\nContent-Type: text/plain; charset=nonsense\n\nDear all,\nPhone: 07700 900571\n"
    records = eml_records(raw)
    assert dict(records[1])["Phone"] == "07700 900571" and "Dear all," in rest_text(raw, ".eml") and "07700" not in rest_text(raw, ".eml")


def workbook(path, rows, shared=()):
    cell = lambda r, c, v: f'<c r="{"ABCDEF"[c]}{r}" t="s"><v>{shared.index(v)}</v></c>' if v in shared else f'<c r="{"ABCDEF"[c]}{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v) + "</row>" for r, row in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks_and_rich_text(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    workbook(root / "people.xlsx", [["name", "", "Email"], ["Ada Lark", "", "ada@x.org"], ["", "1", "bob@x.org"]], ("name", "Email"))
    workbook(root / "one.xlsx", [["write to one@x.org", "now"]])
    (root / "note.rtf").write_bytes(rb"{\rtf1{\fonttbl{\f0 Arial hidden@x.org;}}\f0 write to rich@x.org\par caf\'e9 \u8364? end}")
    (root / "broken.xlsx").write_bytes(b"PK\x03\x04" + bytes(50))
    assert xlsx_sheets((root / "people.xlsx").read_bytes()) == [[["name", "", "Email"], ["Ada Lark", "", "ada@x.org"], ["", "1", "bob@x.org"]]]
    assert rtf_text((root / "note.rtf").read_bytes()) == "write to rich@x.org\ncaf\u00e9 \u20ac end"
    assert emails(spark, root, tmp_path / "out") == {("people.xlsx", "ada@x.org"), ("people.xlsx", "bob@x.org"), ("one.xlsx", "one@x.org"), ("note.rtf", "rich@x.org")}


def test_findings_have_places_and_files_a_status(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    root.mkdir()
    (root / "a.txt").write_text("nothing\nfirst a@x.org, then b@x.org and a@x.org again\n")
    (root / "b.csv").write_text("Email,Note\nc@x.org,hello\n")
    (root / "c.txt").write_text((root / "a.txt").read_text())
    (root / "bin.dat").write_bytes(bytes(range(256)) * 20)
    (root / "odd.xyz").write_bytes(b"%PDF-1.4 something")
    (root / "scan.png").write_bytes(b"\x89PNG and more")
    engine = Engine(spark, parse_args(["--root", str(root), "--output-dir", str(out), "--html-report"]))
    engine.run()
    assert "contact_location_email" in (out / "report.html").read_text() and (out / "manifest.json").exists()
    found = spark.read.parquet(f"{out}/findings").where("evidence_type = 'Email'").collect()
    line = "first a@x.org, then b@x.org and a@x.org again"
    placed = sorted((r.start_offset, r.end_offset) for r in found if r.unit_key.endswith("a.txt"))
    assert [line[a:b] for a, b in placed] == ["a@x.org", "b@x.org", "a@x.org"] and all(r.context == line for r in found if r.unit_key.endswith("a.txt"))
    cell = [r for r in found if r.unit_key.endswith("b.csv")]
    assert [(r.start_offset, r.end_offset, r.context) for r in cell] == [(0, 7, "Email: c@x.org")]
    status = {r.path.rsplit("/", 1)[1]: r.status for r in spark.read.parquet(f"{out}/file_status").collect()}
    assert status == {"a.txt": "scanned", "b.csv": "scanned", "c.txt": "duplicate", "bin.dat": "binary", "odd.xyz": "unsupported", "scan.png": "ocr_disabled"}
    summary = {r.unit_key.rsplit("/", 1)[1]: int(r.finding_count) for r in spark.read.option("header", "true").csv(f"{out}/file_summary").collect()}
    assert summary["a.txt"] == 3 and summary["odd.xyz"] == 0 and len(summary) == 6


def test_structured_xml_and_cells_of_any_length():
    kind, records = records_of("<r><p id='1'><name>Ada</name><email>a@x.org</email></p><p id='2'><name>Bob</name><email>b@x.org</email></p></r>", ".xml", xml_tree=True)
    assert kind == "XML_RECORD" and [dict(r)["email"] for r in records] == ["a@x.org", "b@x.org"] and dict(records[0])["@id"] == "1"
    assert records_of("<r><p>", ".xml", xml_tree=True) == ("", [])
    long = "x" * 300_000
    assert dict(records_of(f"name,note,email\nAda,{long},a@x.org\n", ".csv")[1][0])["note"] == long
