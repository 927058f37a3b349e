"""Schemas that drift between the files of a series (problem 6).

A record is one row: its fields, their types, and digests of their canonical values.
Two files that follow each other are aligned on people (records that share at least two
values found once in either file); the values of aligned people are then compared row by
row, which gives each pair of fields the share of people whose value of the one stands
under the other. The tree edit distance between the two schemas turns those shares into
a script of least cost. Scripts compile into one projection per file: along a series
every field keeps the name it had first, and names that any script renames into each
other are one column, so all files come into one table.

Only the schemas and shares of two files, a handful of rows however many records
they hold, meet in one Python task, and the scripts of a series in one: as many rows
as its files have fields. Records are joined by digests that are spread evenly, so a
large file or series is in no task as a whole.

Defined results: a file without fields gives no changes but those to its
neighbours; records that are no JSON object give no fields; fields that are null
throughout have no type; repeated lines count once; nested objects of any depth give
one field per leaf, named by its path; of a name that stands twice in an object the
last value counts; a field that moved counts as renamed.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.llm.schema_tree import script
from traceloom.session import cut, table

#: Aligned people needed before a share counts, and values two records must have in common.
PEOPLE, VOTES = 2, 2
#: Steps up to which their table goes to all tasks.
FILES = 200_000
#: Characters from which a value may tell people apart.
TELLING = 4
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "y", "active", "on"), ("false", "no", "n", "inactive", "off")
MONTHS = {m: f"{i:02d}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
_WORDS = {w: "true" for w in TRUE_WORDS} | {w: "false" for w in FALSE_WORDS}
_ISO = re.compile(r"(\d{4})-(\d{2})-(\d{2})(?:[t ].*)?$")
_DAY_FIRST = re.compile(r"(\d{1,2})[/.](\d{1,2})[/.](\d{4})$")
_NAMED = re.compile(r"(\d{1,2}) ([a-z]{3})[a-z]* (\d{4})$")


def canonical(value: str | None) -> str | None:
    """A value without its way of writing: date forms, case, blanks, booleans; blank is no value."""
    if value is None:
        return None
    v = " ".join(value.lower().split())
    if v in _WORDS:
        return _WORDS[v]
    if v[:1].isdigit() and len(v) >= 8:
        if m := _ISO.match(v):
            return m[1] + m[2] + m[3]
        if m := _DAY_FIRST.match(v):
            return m[3] + m[2].zfill(2) + m[1].zfill(2)
        if m := _NAMED.match(v):
            return m[3] + MONTHS.get(m[2], "00") + m[1].zfill(2)
    return v or None


class _Number(str):
    """A JSON number as it was written."""


def leaves(text: str | None) -> list[tuple[str, str | None, str | None]]:
    """(path, type, value as text) of every leaf of a JSON object; of anything else none."""
    try:
        node = json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    except (ValueError, TypeError, RecursionError):
        return []
    if not isinstance(node, dict):
        return []
    out, todo = [], [(k, v) for k, v in reversed(node.items())]
    while todo:
        path, x = todo.pop()
        if isinstance(x, dict) and x:
            todo += [(f"{path}\x1f{k}", v) for k, v in reversed(x.items())]
        elif isinstance(x, bool):
            out.append((path, "boolean", "true" if x else "false"))
        elif isinstance(x, _Number):
            out.append((path, "number", str(x)))
        elif isinstance(x, str):
            out.append((path, "string", x))
        elif x is None:
            out.append((path, None, None))
        else:
            out.append((path, "array" if isinstance(x, list) else "object", json.dumps(x, ensure_ascii=False)))
    return out


RECORDS = "series string, seq long, file_name string, line_no long, rec long, f array<string>, kind array<string>, raw array<string>"
DIGESTS = "series string, seq long, file_name string, rec long, f array<string>, kind array<string>, val array<int>, tell array<long>"


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    """A column of lists, built flat: far cheaper than one object per list."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for r in rows for x in r], kind))


def line_texts(drops: DataFrame) -> DataFrame:
    """(series, seq, file_name, line_no, rec, record_text): ``rec`` is the same for repeated lines of a file."""
    return drops.select(
        "series", F.col("file_seq").cast("long").alias("seq"), "file_name", F.col("line_no").cast("long").alias("line_no"),
        F.xxhash64("series", "file_seq", "record_text").alias("rec"), "record_text",
    )


def json_records(drops: DataFrame) -> DataFrame:
    """(series, seq, file_name, line_no, rec, f, kind, raw): records held as JSON text, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [leaves(t) for t in b.column("record_text").to_pylist()]
            lists = [_lists([[x[i] for x in p] for p in parsed], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *lists], names=[c.split()[0] for c in RECORDS.split(", ")])

    return line_texts(drops).mapInArrow(run, RECORDS)


def typed_records(df: DataFrame, series: str, seq: int, file_name: str, key: str) -> DataFrame:
    """The same for a typed table; its row key is the line number and no field, its column types count."""
    kinds = {"bigint": "number", "int": "number", "double": "number", "float": "number", "smallint": "number"}
    columns = [(c, kinds.get(t, t)) for c, t in df.dtypes if c != key]
    text = [F.col(f"`{c}`").cast("string") for c, _ in columns]
    return df.select(
        F.lit(series).alias("series"), F.lit(seq).cast("long").alias("seq"), F.lit(file_name).alias("file_name"), F.col(f"`{key}`").cast("long").alias("line_no"),
        F.xxhash64(F.lit(series), F.lit(seq), *text).alias("rec"), F.array(*[F.lit(c) for c, _ in columns]).alias("f"),
        F.array(*[F.when(t.isNotNull(), F.lit(k)) for t, (_, k) in zip(text, columns)]).alias("kind"), F.array(*text).alias("raw"),
    )


def digested(records: DataFrame) -> DataFrame:
    """(series, seq, file_name, rec, f, kind, val, tell) of records or of their texts.

    Values are 32-bit digests, compared for one person only; those that tell people apart
    are 64-bit ones beside them.
    """
    held = ["record_text"] if "record_text" in records.columns else ["f", "kind", "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(held) == 1:
                parsed = [leaves(t) for t in b.column(4).to_pylist()]
                names, kinds, raws = ([[x[i] for x in p] for p in parsed] for i in range(3))
            else:
                names, kinds, raws = (b.column(4 + i).to_pylist() for i in range(3))
            vals, tells = [], []
            for raw in raws:
                known = [(x.encode("utf-8", "replace"), len(x)) if x else None for x in map(canonical, raw)]
                vals.append([None if x is None else zlib.crc32(x[0]) - (1 << 31) for x in known])
                tells.append([xxhash.xxh64_intdigest(x) - (1 << 63) for x in {x[0] for x in known if x is not None and x[1] >= TELLING}])
            lists = [_lists(names, pa.string()), _lists(kinds, pa.string()), _lists(vals, pa.int32()), _lists(tells, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *lists], names=[c.split()[0] for c in DIGESTS.split(", ")])

    rows = records.where("series IS NOT NULL AND seq IS NOT NULL").select("series", "seq", "file_name", "rec", *held)
    return rows.mapInArrow(run, DIGESTS)


def _steps(records: DataFrame) -> DataFrame:
    """(series, seq, seq2, file_name): each file's predecessor in its series; files without fields are left out."""
    files = records.where(F.size("f") > 0).groupBy("series", "seq").agg(F.min("file_name").alias("file_name"))
    w = Window.partitionBy("series").orderBy("seq")
    return files.select("series", F.lag("seq").over(w).alias("seq"), F.col("seq").alias("seq2"), "file_name").where("seq IS NOT NULL")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, sent to all tasks if it is known to have no more than FILES rows, else joined by shuffle."""
    return F.broadcast(df) if rows <= FILES else df


def aligned_people(records: DataFrame, steps: DataFrame, n_steps: int) -> DataFrame:
    """(step, rec, rec2): records of one person before and after a step.

    Every telling value is one row for the step after its file and one for the step
    before; a value that stands in one record on either side is a vote for the two.
    """
    step = F.xxhash64("series", "seq2").alias("step")
    # As many rows as there are files: each file's steps as its records see them.
    sides = steps.select("series", F.col("seq").alias("at"), step, F.lit(False).alias("later")).unionByName(
        steps.select("series", F.col("seq2").alias("at"), step, F.lit(True).alias("later")))
    sides = sides.groupBy("series", F.col("at").alias("seq")).agg(F.collect_list(F.struct("step", "later")).alias("sides"))
    seen = records.select("series", "seq", "rec", "tell").join(_small(sides, n_steps), ["series", "seq"]).select("rec", "tell", F.explode("sides").alias("s"))
    seen = seen.select("s.step", "s.later", "rec", F.explode("tell").alias("v")).select("step", F.xxhash64("step", "v").alias("k"), "later", "rec")
    before, after = F.when(~F.col("later"), F.col("rec")), F.when(F.col("later"), F.col("rec"))
    votes = seen.groupBy("k", "step").agg(
        F.min(before).alias("rec"), F.max(before).alias("last"), F.min(after).alias("rec2"), F.max(after).alias("last2")).where("rec = last AND rec2 = last2")
    return votes.groupBy("step", "rec", "rec2").agg(F.count("*").alias("votes")).where(F.col("votes") >= VOTES).select("step", "rec", "rec2")


def field_shares(records: DataFrame, steps: DataFrame, n_steps: int) -> DataFrame:
    """(step, f, g, share): people whose value of f stands under g next."""
    people = aligned_people(records, steps, n_steps)
    # Copies of a line are one record; each side of a person meets its record once.
    distinct = records.select("rec", "f", "val").groupBy("rec").agg(F.first(F.struct("f", "val")).alias("r"))
    left = people.join(distinct.select("rec", F.col("r").alias("a")), "rec")
    both = left.join(distinct.select(F.col("rec").alias("rec2"), F.col("r").alias("b")), "rec2").select("step", "a", "b")
    filled = lambda side: F.filter(F.arrays_zip(F.col(f"{side}.f"), F.col(f"{side}.val")), lambda e: e["val"].isNotNull())
    both = both.select("step", filled("a").alias("a"), filled("b").alias("b"))
    none = F.lit(None).cast("string")
    name = lambda e, side: F.struct((e["f"] if side == "a" else none).alias("f"), (e["f"] if side == "b" else none).alias("g"))
    equal = F.flatten(F.transform("a", lambda x: F.transform(F.filter("b", lambda y: y["val"] == x["val"]), lambda y: F.struct(x["f"].alias("f"), y["f"].alias("g")))))
    counted = both.select("step", F.explode(F.concat(
        equal, F.transform("a", lambda x: name(x, "a")), F.transform("b", lambda y: name(y, "b")))).alias("e")).groupBy("step", "e.f", "e.g").agg(F.count("*").alias("n"))
    counted = cut(counted)
    n_f = counted.where("g IS NULL").select("step", "f", F.col("n").alias("n_f"))
    n_g = counted.where("f IS NULL").select("step", "g", F.col("n").alias("n_g"))
    pairs = n_f.join(n_g, "step").where(F.least("n_f", "n_g") >= PEOPLE)
    return pairs.join(counted.where("f IS NOT NULL AND g IS NOT NULL"), ["step", "f", "g"], "left").select(
        "step", "f", "g", (F.coalesce("n", F.lit(0)) / F.least("n_f", "n_g")).alias("share"))


SCRIPT_SCHEMA = "series string, file_name string, seq long, seq2 long, kind string, field_before string, field_after string, type_before string, type_after string"


#: Steps between two files that one Python task takes at once.
STEPS_AT_ONCE = 400


def _scripts_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """Edit scripts of some steps; rows are either fields or shares of a step."""
    held: dict[tuple, tuple[dict, dict, dict]] = {}
    for series, file, seq, seq2, side, f, kind, g, share in zip(*(pdf[c] for c in ("series", "file_name", "seq", "seq2", "side", "f", "kind", "g", "share"))):
        before, after, shares = held.setdefault((series, file, seq, seq2), ({}, {}, {}))
        if side == "share":
            shares[f, g] = share
        else:
            (before if side == "before" else after)[f] = kind
    rows = [
        (*step, kind, x, y, before.get(x), after.get(y))
        for step, (before, after, shares) in held.items() for kind, x, y in script(list(before), list(after), lambda x, y, s=shares: s.get((x, y)))
    ]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCRIPT_SCHEMA.split(", ")])


def field_kinds(records: DataFrame) -> DataFrame:
    """(series, seq, field, kind): the type of most of a field's values, copies of a line counted once."""
    # Counted over all lines first, in each task, then what copies add is taken away.
    copies = records.groupBy("rec").agg(F.count("*").alias("copies")).where("copies > 1")
    again = records.join(copies, "rec").groupBy("rec").agg(
        F.first(F.struct("series", "seq", "f", "kind")).alias("r"), F.first("copies").alias("copies")).select("r.*", (1 - F.col("copies")).alias("w"))
    every = records.select("series", "seq", "f", "kind", F.lit(1).cast("long").alias("w")).unionByName(again)
    entry = every.select("series", "seq", "w", F.explode(F.arrays_zip("f", "kind")).alias("e"))
    kinds = entry.groupBy("series", "seq", F.col("e.f").alias("field"), F.col("e.kind").alias("kind")).agg(F.sum("w").alias("n"))
    return kinds.groupBy("series", "seq", "field").agg(
        F.max_by("kind", F.when(F.col("kind").isNotNull(), F.struct(F.col("n"), F.col("kind")))).alias("kind"))


def edit_scripts(records: DataFrame) -> DataFrame:
    """The script from each file to the next, kept fields included, of records, their texts, or digests."""
    records = cut(records if "tell" in records.columns else digested(records))
    fields = cut(field_kinds(records))
    steps = cut(_steps(records))
    n_steps = steps.count()
    none = F.lit(None).cast("string")
    share = field_shares(records, steps, n_steps).join(steps.select(F.xxhash64("series", "seq2").alias("step"), "series", "seq", "seq2", "file_name"), "step")
    tall = (
        steps.join(fields, ["series", "seq"]).select("series", "seq", "seq2", "file_name", F.lit("before").alias("side"), F.col("field").alias("f"), "kind", none.alias("g"), F.lit(0.0).alias("share"))
        .unionByName(steps.join(fields.withColumnRenamed("seq", "seq2"), ["series", "seq2"]).select("series", "seq", "seq2", "file_name", F.lit("after").alias("side"), F.col("field").alias("f"), "kind", none.alias("g"), F.lit(0.0).alias("share")))
        .unionByName(share.select("series", "seq", "seq2", "file_name", F.lit("share").alias("side"), "f", none.alias("kind"), "g", "share"))
    )
    buckets = max(1, -(-n_steps // STEPS_AT_ONCE))
    return tall.groupBy(F.pmod(F.xxhash64("series", "seq2"), F.lit(buckets)).alias("bucket")).applyInPandas(_scripts_of, SCRIPT_SCHEMA)


def changes(scripts: DataFrame) -> DataFrame:
    """(series, file_name, change_kind, field_before, field_after)."""
    show = lambda c: F.replace(F.col(c), F.lit("\x1f"), F.lit(".")).alias(c)
    moved = scripts.where("kind <> 'kept'").select(
        "series", "file_name", F.when(F.col("kind") == "moved", "renamed").otherwise(F.col("kind")).alias("change_kind"), show("field_before"), show("field_after")
    )
    retyped = scripts.where("kind IN ('kept', 'renamed', 'moved') AND type_before <> type_after").select(
        "series", "file_name", F.lit("retyped").alias("change_kind"), show("field_before"), show("field_after")
    )
    return moved.unionByName(retyped)


#: The typed tables of one series, in their order, each with its row key.
TYPED, TYPED_TABLES = "roster_contacts", (("roster_contacts_a", "roster_a_no"), ("roster_contacts_b", "roster_b_no"))


def _typed(spark: SparkSession, base: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [typed_records(table(spark, base, name), TYPED, seq, name, key) for seq, (name, key) in enumerate(TYPED_TABLES, 1)])


def _scripts(spark: SparkSession, base: str) -> DataFrame:
    return edit_scripts(digested(line_texts(table(spark, base, "roster_drops"))).unionByName(digested(_typed(spark, base))))


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    """Every change from a file of a series to the next."""
    return changes(_scripts(spark, base))


ORIGIN_SCHEMA = "series string, seq long, field string, origin string"


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """(series, seq, field, origin): the name that each field of a file had first in its series."""
    out, origin, series = [], None, pdf.series.iloc[0]
    for (seq2, seq), step in sorted(pdf.groupby(["seq2", "seq"]), key=lambda x: x[0]):
        if origin is None:
            origin = {x: x for x in step.field_before if x}
            out += [(series, int(seq), x, y) for x, y in origin.items()]
        origin = {y: origin.get(x, x) if x else y for x, y in zip(step.field_before, step.field_after) if y}
        out += [(series, int(seq2), x, y) for x, y in origin.items()]
    return pd.DataFrame(out, columns=["series", "seq", "field", "origin"])


def first_names(scripts: DataFrame) -> DataFrame:
    """(series, seq, field, origin) of every field that a script knows."""
    return scripts.groupBy("series").applyInPandas(_compose, ORIGIN_SCHEMA)


_CAMEL = "(?<=[a-z0-9])(?=[A-Z])"


def slug(name: str) -> str:
    """A field's path as a column name."""
    return re.sub(r"[^a-z0-9]+", "_", re.sub(_CAMEL, "_", name).lower()).strip("_")


def _slug(name: Column) -> Column:
    low = F.lower(F.regexp_replace(name, _CAMEL, "_"))
    return F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def column_families(renames: dict[tuple[str, str], int], together: set[tuple[str, str]], first: list[str]) -> dict[str, str]:
    """Column of every name that some script renames: names renamed into each other are one column.

    ``renames`` counts the steps that rename one name into the other. Pairs count in order
    of that number; one that would bring two names into a column that stand ``together``
    in some file is left out. A column is named after one of ``first`` if it holds such,
    else after its commonest name.
    """
    group: dict[str, set[str]] = {}
    weight: dict[str, int] = {}
    for (a, b), n in sorted(renames.items(), key=lambda r: (-r[1], r[0])):
        for x in (a, b):
            group.setdefault(x, {x})
            weight[x] = weight.get(x, 0) + n
        ga, gb = group[a], group[b]
        if ga is gb or any((min(x, y), max(x, y)) in together for x in ga for y in gb):
            continue
        ga |= gb
        group.update((x, ga) for x in gb)
    return {x: next((f for f in first if f in g), None) or min(g, key=lambda m: (-weight[m], m)) for x, g in group.items()}


def families(scripts: DataFrame, origins: DataFrame, first: list[str]) -> dict[str, str]:
    """Column of every renamed name over all series.

    What reaches the driver are distinct pairs of field names: bounded by the vocabulary
    of the schemas, whatever the number of files and records.
    """
    renames: dict[tuple[str, str], int] = {}
    for r in scripts.where("kind IN ('renamed', 'moved')").groupBy("field_before", "field_after").agg(F.count("*").alias("n")).collect():
        a, b = sorted((slug(r.field_before), slug(r.field_after)))
        if a != b:
            renames[a, b] = renames.get((a, b), 0) + r.n
    names = sorted({x for p in renames for x in p})
    held = origins.select("series", "seq", _slug(F.col("field")).alias("x")).where(F.col("x").isin(names)).distinct()
    met = held.join(held.withColumnRenamed("x", "y"), ["series", "seq"]).where("x < y").select("x", "y").distinct().collect()
    return column_families(renames, {(r.x, r.y) for r in met}, first)


def unify(records: DataFrame, origins: DataFrame, family: dict[str, str], columns: list[str]) -> DataFrame:
    """Records (series, seq, file_name, line_no, f, raw) in one table of ``columns``, each row kept.

    A field takes the name it had first in its series, and that name the column of all
    names it is ever renamed to. Fields of no column stay in ``more``, a JSON object; if
    two fields of a record meet in one column, the first value that is not null stands
    there and other values stand in ``conflicts`` as ``column=value``.
    """
    maps = origins.groupBy("series", "seq").agg(F.map_from_entries(F.collect_list(F.struct("field", "origin"))).alias("_m"))
    known = F.create_map(*[F.lit(x) for p in sorted(family.items()) for x in p]) if family else None
    rows = records.join(maps, ["series", "seq"], "left")
    # Null series or numbers have no script; their fields go by their own names.
    entries = F.transform(F.arrays_zip("f", "raw"), lambda e: F.struct(F.coalesce(F.try_element_at("_m", e["f"]), e["f"]).alias("f"), e["raw"].alias("v")))
    column = lambda x: F.coalesce(F.try_element_at(known, _slug(x)), _slug(x)) if family else _slug(x)
    rows = rows.withColumn("_e", F.transform(entries, lambda e: F.struct(column(e["f"]).alias("c"), e["v"].alias("v"))))
    values = lambda c: F.array_distinct(F.transform(F.filter("_e", lambda e: (e["c"] == c) & e["v"].isNotNull()), lambda e: e["v"]))
    rows = rows.withColumn("_n", F.array_distinct(F.transform("_e", lambda e: e["c"])))
    others = F.filter("_n", lambda c: ~c.isin(*columns))
    spare = F.flatten(F.transform("_n", lambda c: F.transform(F.slice(values(c), 2, 1 << 20), lambda v: F.concat(c, F.lit("="), v))))
    return rows.select(
        "series", "file_name", "line_no", *[F.get(values(F.lit(c)), F.lit(0)).alias(c) for c in columns],
        F.to_json(F.map_from_arrays(others, F.transform(others, lambda c: F.get(values(c), F.lit(0))))).alias("more"),
        F.array_join(spare, "|").alias("conflicts"),
    )


def p6_unified(spark: SparkSession, base: str) -> DataFrame:
    """All roster records, of the files and of both typed tables, in one table."""
    scripts = cut(_scripts(spark, base))
    origins = cut(first_names(scripts))
    first, second = ([slug(c) for c in table(spark, base, n).columns if c != key] for n, key in TYPED_TABLES)
    family = families(scripts, origins, first)
    columns = list(dict.fromkeys(family.get(c, c) for c in first + second))
    return unify(json_records(table(spark, base, "roster_drops")).unionByName(_typed(spark, base)), origins, family, columns)


QUERIES = {"p6_found": p6_found, "p6_unified": p6_unified}
SQL: dict[str, str] = {}
