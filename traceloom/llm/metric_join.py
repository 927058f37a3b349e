"""Exact radius joins of strings under the edit distance, by metric partitioning.

A block is a cell. A cell of more than a few strings gets pivots, in proportion to its
strings, and each string goes home to the nearest. By the triangle inequality, a
string within ``radius`` of one whose home is pivot q is at most ``2 * radius`` farther
from q than from its own pivot, so replicating just those strings to q loses no pair.
The cells of the pivots are parted in the same way, as long as that makes them smaller.
Inside a cell, home strings are compared with all strings of the cell.

Defined results: nulls take no part; equal strings of a block are one string and
pair with nothing, unless what is kept beside them differs; each pair comes once,
the lesser side first. The result does not depend on the size of cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.session import cut

#: Strings up to which a block is not parted, and times as many up to which a cell of pivots is
#: not; pivots of a cell at most; levels at most; share of its parent's strings above which a
#: cell is left as it is.
CELL, AGAIN, FAN, LEVELS, SMALLER = 8, 4, 32, 4, 0.75
#: Large blocks up to which their list goes to all tasks.
SENT = 200_000


def _parted(cells: DataFrame, radius: int, cell: int, fan: int, keep: tuple[str, ...]) -> DataFrame:
    """Cells (block, cell, n, x, *keep) parted by pivots: the same columns, ``n`` that of the parent, and ``home``."""
    # Pivots are distinct strings of least hash: a bounded number for each cell, one at
    # least, however few strings its rows hold.
    part = F.pmod(F.xxhash64("x"), F.lit(1 << 30)) / float(1 << 30)
    strings = cells.select("cell", "x", part.alias("part")).distinct()
    counts = strings.groupBy("cell").agg(F.count("*").alias("strings"), F.min("part").alias("first"))
    few = F.least(F.lit(fan), F.ceil(F.col("strings") / cell)).cast("int")
    counts = counts.select("cell", "first", few.alias("k"), (F.greatest(F.lit(4.0) * few, F.lit(64.0)) / F.col("strings")).alias("upto"))
    near = strings.join(counts, "cell").where((F.col("part") < F.col("upto")) | (F.col("part") == F.col("first")))
    chosen = near.groupBy("cell", "k").agg(F.sort_array(F.collect_set(F.struct("part", "x"))).alias("p"))
    chosen = chosen.select("cell", F.transform(F.slice("p", 1, F.greatest("k", F.lit(1))), lambda s: s["x"]).alias("p"))
    far = cells.join(chosen, "cell").withColumn("d", F.transform("p", lambda p: F.levenshtein(F.col("x"), p)))
    far = far.withColumn("least", F.array_min("d")).withColumn("own", F.array_position("d", F.col("least")).cast("int") - 1)
    spread = far.select("block", "cell", "n", "x", *keep, "least", "own", F.posexplode("d").alias("q", "dq")).where(F.col("dq") <= F.col("least") + 2 * radius)
    return spread.select("block", F.xxhash64("cell", "q").alias("cell"), "n", "x", *keep, (F.col("q") == F.col("own")).alias("home"))


def listed_apart(rows: DataFrame, listed: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(``listed`` for a join, the rows whose ``on`` it does not have, placed by ``on``).

    A short list goes to all tasks, so that its rows are left out before the exchange; a long one is shuffled.
    """
    if listed.count() <= SENT:
        known = F.broadcast(listed)
        return known, rows.join(known, on, "left_anti").repartition(on)
    return listed, rows.join(listed, on, "left_anti")


def cell_sizes(rows: DataFrame, cell: str) -> dict[str, int]:
    """How many cells there are, how many rows stand in them, and in the largest."""
    seen = rows.groupBy(cell).agg(F.count("*").alias("m")).agg(F.count("*").alias("cells"), F.sum("m").alias("places"), F.max("m").alias("largest")).first()
    return {"cells": seen.cells, "places": seen.places or 0, "largest": seen.largest or 0}


def radius_pairs(
    objects: DataFrame, block: str, text: Column | str, radius: int, keep: tuple[str, ...] = (), apart: str | None = None,
    check: Column | None = None, cell: int = CELL, fan: int = FAN, report: list[dict] | None = None,
) -> DataFrame:
    """(block, a, b, d, *keep_a, *keep_b): strings of one block within ``radius``.

    ``keep`` names columns carried along with each side. With ``apart``, one of
    them, rows are compared that differ in it, equal strings too, and the side of
    the lesser value comes first. ``check`` is a further condition on both sides'
    kept columns, evaluated for pairs within the radius only. ``text`` may be an expression over the columns
    that travel, so that a long string need not be shuffled beside what it is
    derived from. The small blocks are read from one exchange, the others are not in it. Repeated
    rows give repeated pairs where ``apart`` is given, and one pair otherwise.
    ``report`` receives cells, strings and places of strings at each level.
    """
    x = F.col(text) if isinstance(text, str) else text
    source = [F.col(c) for c in objects.columns if c not in (block, *keep)]
    raw = objects.select(F.col(block).alias("block"), *source, *keep).where("block IS NOT NULL")
    # An upper bound of the blocks' sizes, aggregated before it is shuffled.
    large = raw.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > cell)

    def side(df: DataFrame, name: str, *on: str) -> DataFrame:
        return df.select(*on, F.col("x").alias(name), F.length("x").alias(f"len_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in keep])

    def compared(pairs: DataFrame) -> DataFrame:
        first = F.col(f"{apart}_a") < F.col(f"{apart}_b") if apart else F.col("a") < F.col("b")
        # r edits change the length by r at most. The nested conditions keep the order of
        # cost, which a conjunction would leave to the optimizer.
        near = F.levenshtein("a", "b", radius) >= 0
        close = F.when(F.abs(F.col("len_a") - F.col("len_b")) <= radius, near if check is None else F.when(near, check).otherwise(False)).otherwise(False)
        held = [f"{c}_{s}" for c in keep for s in "ab"]
        return pairs.where(F.when(first, close).otherwise(False)).select("block", "a", "b", *held, F.levenshtein("a", "b", radius).alias("d"))

    def note(level: int, cells: DataFrame) -> None:
        if report is not None:
            report.append({"level": level} | cell_sizes(cells, "cell"))

    large = cut(large)
    known, placed = listed_apart(raw, large, "block")
    # Blocks of a few strings are cells without a second pivot: all are at home.
    small = (placed if apart else placed.distinct()).select("block", x.alias("x"), *keep).where("x IS NOT NULL")
    note(0, small.withColumnRenamed("block", "cell"))
    within = compared(side(small, "a", "block").join(side(small, "b", "block"), "block"))
    across: list[DataFrame] = []
    crowded = raw.select("block", x.alias("x"), *keep).where("x IS NOT NULL").join(known, "block").select("block", "n", "x", *keep)
    cells = cut((crowded if apart else crowded.distinct()).withColumn("cell", F.col("block")))
    for level in range(1, LEVELS + 1):
        parted = cut(_parted(cells, radius, cell, fan, keep))
        if parted.isEmpty():
            break
        note(level, parted)
        sizes = parted.groupBy("cell").agg(F.count("*").alias("m"), F.first("n").alias("_n"))
        # Cells of pivots are parted again once they are some times as large.
        again = cut(sizes.where((F.col("m") > AGAIN * cell) & (F.col("m") <= SMALLER * F.col("_n"))).select("cell", F.col("m").alias("n"))) if level < LEVELS else None
        again = None if again is None or again.isEmpty() else again
        done = parted if again is None else parted.join(again.select("cell"), "cell", "left_anti")
        # One side is at home in the cell, whichever it is; a pair whose homes differ meets twice.
        home = done.where("home")
        met = [side(p, "a", "block", "cell").join(side(g, "b", "cell"), "cell").drop("cell") for p, g in ((home, done), (done, home))]
        across += [compared(m) for m in met]
        if again is None:
            break
        cells = parted.drop("n", "home").join(again, "cell")
    return within.unionByName(reduce(DataFrame.unionByName, across).distinct()) if across else within
