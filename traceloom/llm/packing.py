"""Filling fixed-capacity containers: best-fit decreasing with a segment tree.

Sizes are token counts. An item above the capacity is cut into full containers
and a rest; all else stays whole. Items are spread over shards of bounded size;
in a shard, the largest item goes first, into the open container that it fills
most tightly. That container is found by descending a segment tree over the
remaining capacities. What a shard leaves in containers that are not full enough
is packed again together with the leftovers of other shards.

Defined results: every item is placed exactly once (or its pieces are); items of
size null or 0 take a place without room; ties go to the smaller key; the same
key in two rows is two items; an empty table gives no containers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.chunking import read_jobs
from traceloom.llm.tokens import with_token_counts
from traceloom.session import cut, table

#: Items a shard holds on average; containers filled less than this are opened again.
SHARD, FULL = 100_000, 0.98


class OpenBins:
    """Open containers by remaining capacity; the tightest that fits in log time."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.capacity = capacity

    def add(self, bin_no: int, room: int) -> None:
        self.stacks[room].append(bin_no)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (bin, room) with the least room of at least ``size``."""
        count, at = self.count, size + self.leaves
        if not count[at]:
            while True:
                if at == 1:
                    return None
                if at % 2 == 0 and count[at + 1]:
                    at += 1
                    break
                at >>= 1
            while at < self.leaves:
                at *= 2
                if not count[at]:
                    at += 1
        room = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return self.stacks[room].pop(), room


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, place) of each item; sizes come in decreasing order."""
    bins, out, opened = OpenBins(capacity), [], 0
    places: list[int] = []
    for size in sizes:
        got = bins.take(size)
        if got is None:
            got = (opened, capacity)
            places.append(0)
            opened += 1
        no, room = got
        out.append((no, places[no]))
        places[no] += 1
        bins.add(no, room - size)
    return out


PLACED = "job string, capacity long, shard long, doc_id long, piece_no long, token_start long, n_tokens long, container_id string, place long"


def _pack(items: DataFrame, tag: str) -> DataFrame:
    """Pack each (job, shard) of the items; containers are named after both."""
    names = [c.split()[0] for c in PLACED.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable")
        head = pdf.iloc[0]
        placed = best_fit_decreasing(pdf["n_tokens"].tolist(), int(head.capacity))
        stem = f"{head.job}/{tag}{head.shard}/"
        pdf = pdf.assign(container_id=[f"{stem}{b}" for b, _ in placed], place=[p + 1 for _, p in placed])
        return pdf[names]

    return items.groupBy("job", "shard").applyInPandas(run, PLACED)


def pack(sizes: DataFrame, jobs: list[tuple[str, int]], shard_items: int = SHARD) -> DataFrame:
    """Place items (key, n_tokens) into containers of each job (name, capacity).

    Two rounds: the first packs shards of ``shard_items`` items, the second opens
    containers below FULL and packs their items again in shards of the same size. Every
    input goes through both, whatever its size.
    """
    n = F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("long")
    job_rows = F.explode(F.array(*[F.struct(F.lit(j).alias("job"), F.lit(c).cast("long").alias("capacity")) for j, c in jobs]))
    items = sizes.select(F.col("key").alias("doc_id"), n.alias("size"), job_rows.alias("j")).select("doc_id", "size", "j.job", "j.capacity")
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("size") / F.col("capacity")) - 1)))
    items = items.select("job", "capacity", "doc_id", "size", piece.alias("p")).select(
        "job", "capacity", "doc_id", (F.col("p") + 1).alias("piece_no"), (F.col("p") * F.col("capacity")).alias("token_start"),
        F.least("capacity", F.col("size") - F.col("p") * F.col("capacity")).alias("n_tokens"),
    )
    total = sizes.count()
    shards = max(1, -(-total // shard_items))
    spread = F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(shards))
    # The one or two jobs and shards of a small input still make separate tasks.
    first = cut(_pack(items.withColumn("shard", spread), "a"))
    fill = first.groupBy("job", "container_id").agg((F.sum("n_tokens") / F.first("capacity")).alias("fill"))
    marked = first.join(fill, ["job", "container_id"])
    keep = marked.where(F.col("fill") >= FULL).drop("fill")
    loose = marked.where(F.col("fill") < FULL).drop("fill", "container_id", "place")
    left = loose.count()
    again = _pack(loose.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(1)), F.lit(max(1, -(-left // shard_items))))), "b")
    return keep.unionByName(again).drop("shard")


def p7_packed(spark: SparkSession, base: str) -> DataFrame:
    """Container and place of each document or piece, for the jobs pack_*."""
    sizes = cut(with_token_counts(table(spark, base, "documents"), "doc_id", "text"))
    return pack(sizes, [(j, c) for j, c, _ in read_jobs(spark, base, "pack_")])


def p7_fill(spark: SparkSession, base: str) -> DataFrame:
    """Per job: containers, the least number possible by volume, share of room used."""
    return p7_packed(spark, base).groupBy("job", "capacity").agg(
        F.count_distinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"), F.count_distinct("doc_id").alias("docs")
    ).withColumn("least", F.ceil(F.col("tokens") / F.col("capacity"))).withColumn(
        "used", F.col("tokens") / (F.col("containers") * F.col("capacity"))
    )


QUERIES = {"p7_packed": p7_packed, "p7_fill": p7_fill}
SQL: dict[str, str] = {}
