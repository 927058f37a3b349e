"""Packed cells: quoting, delimiters, positions, dirty input."""

from pyspark.sql import functions as F

from traceloom.operators.packed import EVIDENCE_TYPES, FILE_PATHS, MAILBOXES, PackedField, packed_values, split_packed


def values(spark, cells, field):
    df = spark.createDataFrame([(i, c, "x") for i, c in enumerate(cells)], "k long, cell string, item string")
    got = {}
    for r in sorted(split_packed(df, "k", "cell", field).collect()):
        got.setdefault(r.row_key, []).append((r.item_pos, r.item))
    for v in got.values():
        assert [p for p, _ in v] == list(range(1, len(v) + 1))
    return [[x for _, x in got.get(i, [])] for i in range(len(cells))]


def test_types(spark):
    cells = ['A|B', '"Fee Status, Region";C', 'A | Fee Status, Region | B', '["A", "Case \\"Note\\" Text"]',
             '"Case ""Note"" Text", A||B', 'Fee Status\\, Region,A', ' | ;', None, '', 'A|A', 'A|...(+7 more)', '"open']
    assert values(spark, cells, EVIDENCE_TYPES) == [
        ['A', 'B'], ['Fee Status, Region', 'C'], ['A', 'Fee Status, Region', 'B'], ['A', 'Case "Note" Text'],
        ['Case "Note" Text', 'A', 'B'], ['Fee Status, Region', 'A'], [], [], [], ['A', 'A'], ['A'], ['"open']]


def test_paths(spark):
    cells = ['/a/fees, 2026, v1.csv|D:\\x\\e 1.csv', '"/a/b|c.csv"; /a/m; d.txt', '/a/the "final" list.csv | /b.csv',
             '["D:\\\\x\\\\e.csv", "...(+25 more)"]']
    assert values(spark, cells, FILE_PATHS) == [
        ['/a/fees, 2026, v1.csv', 'D:\\x\\e 1.csv'], ['/a/b|c.csv', '/a/m; d.txt'],
        ['/a/the "final" list.csv', '/b.csv'], ['D:\\x\\e.csv']]


def test_mailboxes(spark):
    cells = ['"Doe, A" <a@x.org>; mailto:b@y.org', 'a@x.org b+c@y.org / d@z.org and E@Z.ORG', '["a@x.org"]', 'none']
    assert values(spark, cells, MAILBOXES) == [['a@x.org', 'b@y.org'], ['a@x.org', 'b+c@y.org', 'd@z.org', 'E@Z.ORG'], ['a@x.org'], []]


def test_long_and_empty_table(spark):
    long = "|".join(f"v{i}" for i in range(20000))
    assert len(values(spark, [long], PackedField())[0]) == 20000
    assert split_packed(spark.createDataFrame([], "k long, cell string"), "k", "cell", PackedField()).count() == 0


def test_cells_of_a_megabyte(spark):
    n = 1_000_000
    cells = [
        '["' + '","'.join(["a@b.org"] * (n // 10)) + '"]', ";" * n, "a" + " " * n + "b", "\n" * n + "x", '"' * n, "a;" * (n // 2), "[" * n, '["' + "a" * n + '"]',
    ]
    df = spark.createDataFrame(list(enumerate(cells)), "k long, v string")
    counts = {}
    for field in (EVIDENCE_TYPES, FILE_PATHS, MAILBOXES):
        rows = df.select("k", F.size(packed_values(F.col("v"), field)).alias("n")).collect()
        counts[field] = {r.k: r.n for r in rows}
    assert counts[EVIDENCE_TYPES][0] == counts[MAILBOXES][0] == n // 10
    assert counts[EVIDENCE_TYPES][1] == 0 and counts[EVIDENCE_TYPES][2] == counts[EVIDENCE_TYPES][3] == 1 and counts[EVIDENCE_TYPES][5] == n // 2
