"""Connected components by alternating large-star and small-star steps.

Edges are rewired until every component is a star around its least vertex. A vertex of
very many edges has them spread over copies: the least neighbour is aggregated before it
is shuffled, and the join that hands it back runs on (vertex, copy), so that no task
holds all edges of one vertex, not even in the last rounds, when large components are
stars. Whether a round changed anything is told by the job that makes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from traceloom.session import cut

#: Rounds after which something must be wrong; edges of a vertex that one task holds in a join,
#: and most vertices that have so many.
ROUNDS, HELD, HOT_MOST = 50, 100_000, 10_000


def _hot(ends: DataFrame, vertex: str, limit: int) -> DataFrame | None:
    """(vertex, copies) of vertices with more than ``limit`` rows, none if there are none."""
    degree = ends.groupBy(vertex).agg(F.count("*").alias("d"))
    if (degree.agg(F.max("d")).first()[0] or 0) <= limit:
        return None
    return cut(degree.where(F.col("d") > limit).select(vertex, F.ceil(F.col("d") / limit).cast("int").alias("copies")))


def _with_least(ends: DataFrame, vertex: str, other: str, least: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Each row of ``ends`` with its vertex's row of ``least``."""
    if hot is None:
        return ends.join(least, vertex)
    # No more than HOT_MOST rows, by the choice of the limit.
    copies = F.broadcast(hot)
    spread = ends.join(copies, vertex, "left").withColumn("_s", F.coalesce(F.pmod(F.xxhash64(other), "copies").cast("int"), F.lit(0))).drop("copies")
    repeated = least.join(copies, vertex, "left").withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    return spread.join(repeated, [vertex, "_s"]).drop("_s")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Link every larger neighbour of a vertex to the least of the vertex and its neighbours."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(near.where("v > u"), "u", "v", least, hot).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a vertex, and the vertex, to the least of them.

    After a large step a vertex has few smaller neighbours, at most one per neighbour
    it had, so no copies are needed here.
    """
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", held: int = HELD) -> DataFrame:
    """(vertex, component): the component is its least vertex; isolated vertices have no row."""
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()

    def settle(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        marks = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
        done = cut(df.observe(seen, *marks))
        return done, (seen.get["n"], seen.get["h"])

    now, before = settle(now)
    for _ in range(ROUNDS):
        hot = _hot(_both(now), "u", max(held, -(-2 * before[0] // HOT_MOST))) if before[0] > held else None
        now, mark = settle(_small_star(_large_star(now, hot)))
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots)
