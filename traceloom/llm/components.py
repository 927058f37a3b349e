"""Consolidating pairwise matches into groups: low-diameter decomposition.

Each round draws an exponential shift per vertex. A vertex joins the cluster whose
start (the negative shift of its centre) plus distance is least. Starts travel along
edges until none changes: in each step only vertices whose start has just changed tell
their neighbours, so what moves is the rim of the growing clusters. A path from a
centre is no longer than the largest shift, about ln(n) / BETA steps, and an edge is
cut with a chance of BETA at most. Clusters contract to super-vertices, the edges
between clusters make the next, smaller graph, and the assignments of all rounds
compose. The recursion ends where a round left no more than ``LAST`` edges, a bounded
number, which one task joins. Every step is an equi-join or an aggregate over edges; nothing is sent to the
driver but counts.

Contracted vertices may have any number of edges. Those above a limit, no more than
``HOT_MOST`` by its choice, have their edges spread over salted copies in every join.

Defined results: self loops and repeated edges count once; null ends are no
edges; an empty edge table gives an empty result; vertices without an edge to
another vertex get no row. A key shared by any number of rows is linked through
salted stars of bounded degree, so no task holds a whole hot group.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from traceloom.session import cut

#: Rate of the exponential shifts: an edge is cut with this chance at most.
BETA = 0.25
#: Edges between clusters from which the recursion ends: so few are joined in one task.
LAST = 20_000
#: Steps of growth in one job.
STEPS_AT_ONCE = 4
#: Rounds after which something must be wrong.
ROUNDS = 60
#: Members of a key that one star holds.
STAR = 512
#: Edges of a vertex from which its edges are spread, unless more than HOT_MOST vertices had so many.
HOT_LEAST, HOT_MOST = 20_000, 10_000


def star_edges(members: DataFrame, key: str, vertex: str, star: int = STAR) -> DataFrame:
    """(a, b) edges that link all vertices of each key.

    Members are spread over sub-stars by hash; the least vertex of a sub-star is
    its centre, the centres of a key are linked through further levels until one
    is left. No vertex gets more than ``star`` or so edges by one key.
    """
    # Written once: what the members are read from may be costly, and they are read three times.
    level = cut(members.where(F.col(key).isNotNull() & F.col(vertex).isNotNull()).select(
        F.col(key).alias("_k"), F.col(vertex).cast("long").alias("_v")
    ).distinct())
    sizes = level.groupBy("_k").agg(F.count("*").alias("_n")).where("_n > 1")
    most = sizes.agg(F.max("_n")).first()[0] or 0
    if most <= star:
        centres = level.groupBy("_k").agg(F.min("_v").alias("_c"))
        return level.join(centres, "_k").where("_v <> _c").select(F.col("_v").alias("a"), F.col("_c").alias("b"))
    level = level.join(sizes, "_k")
    edges, fan = None, 1
    while True:
        # A salt of 0 everywhere would be one star; the number of stars follows the group.
        stars = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(star * fan))).cast("long")
        level = level.withColumn("_s", F.pmod(F.xxhash64("_v", F.lit(fan)), stars))
        centres = level.groupBy("_k", "_s", "_n").agg(F.min("_v").alias("_c"))
        own = level.join(centres.drop("_n"), ["_k", "_s"]).where("_v <> _c").select(F.col("_v").alias("a"), F.col("_c").alias("b"))
        edges = own if edges is None else edges.unionByName(own)
        if most <= star * fan:
            return edges
        level = centres.select("_k", "_n", F.col("_c").alias("_v"))
        fan *= star


def _shift(vertex: Column, round_no: int, beta: float) -> Column:
    """Exponential variate of a vertex, the same whenever it is computed again."""
    u = (F.pmod(F.xxhash64(vertex, F.lit(round_no)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
    return -F.log(u) / F.lit(beta)


def _hot_vertices(edges: DataFrame, n_edges: int, least: int) -> DataFrame | None:
    """(v, n): vertices with so many of the directed ``edges`` that they are spread over n copies, none if there are none."""
    limit = max(least, -(-n_edges // HOT_MOST))
    degrees = edges.groupBy(F.col("a").alias("v")).agg(F.count("*").alias("d"))
    if degrees.agg(F.max("d")).first()[0] <= limit:
        return None
    return cut(degrees.where(F.col("d") > limit).select("v", F.ceil(F.col("d") / limit).cast("int").alias("n")))


def _spread(edges: DataFrame, end: str, other: str, hot: DataFrame | None) -> DataFrame:
    """Adds to each edge the copy ``s`` of its ``end`` that it belongs to."""
    if hot is None:
        return edges.withColumn("s", F.lit(0))
    # HOT_MOST rows at most, since there are no more than n_edges / limit such vertices.
    known = F.broadcast(hot.select(F.col("v").alias(end), "n"))
    return edges.join(known, end, "left").withColumn("s", F.coalesce(F.pmod(F.xxhash64(other), F.col("n")).cast("int"), F.lit(0))).drop("n")


def _copies(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows of vertices (v, ...), one for every copy ``s``."""
    if hot is None:
        return rows.withColumn("s", F.lit(0))
    return rows.join(F.broadcast(hot), "v", "left").withColumn("s", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n"), F.lit(1)) - 1))).drop("n")


def _grow(edges: DataFrame, hot: DataFrame | None, round_no: int, beta: float) -> tuple[DataFrame, int]:
    """((v, c): the cluster each vertex of the symmetric ``edges`` joins, steps until none changed)."""
    vertices = edges.select(F.col("a").alias("v")).distinct()
    state = vertices.select("v", (-_shift(F.col("v"), round_no, beta)).alias("t"), F.col("v").alias("c"), F.lit(True).alias("fresh"))
    ends = _spread(edges, "a", "b", hot)
    steps = 0
    while True:
        # Some steps at a time, so that fewer jobs ask whether anything changed.
        for _ in range(STEPS_AT_ONCE):
            rim = state.where("fresh").select("v", "t", "c")
            told = ends.join(rim, ends.a == rim.v) if hot is None else ends.join(_copies(rim, hot).withColumnRenamed("s", "_s"), (ends.a == F.col("v")) & (ends.s == F.col("_s")))
            told = told.select(F.col("b").alias("v"), (F.col("t") + 1.0).alias("t2"), F.col("c").alias("c2"))
            # Only what is told is shuffled; the state stays where its vertices are. Times of
            # different clusters do not tie: they hold 52 random bits each.
            told = told.groupBy("v").agg(F.min_by("c2", "t2").alias("c2"), F.min("t2").alias("t2"))
            first = F.coalesce(F.col("t2") < F.col("t"), F.lit(False))
            state = state.drop("fresh").join(told, "v", "left").select(
                "v", F.when(first, F.col("t2")).otherwise(F.col("t")).alias("t"), F.when(first, F.col("c2")).otherwise(F.col("c")).alias("c"), first.alias("fresh"))
            steps += 1
        state, changed = _cut_counting(state, F.count_if("fresh"))
        if not changed:
            return state.select("v", "c"), steps


def _cut_counting(df: DataFrame, what: Column) -> tuple[DataFrame, int]:
    """``df`` materialised, and an aggregate over it taken in the same job."""
    seen = Observation()
    done = cut(df.observe(seen, what.alias("n")))
    return done, seen.get["n"]


def _contracted(edges: DataFrame, homes: DataFrame, hot: DataFrame | None) -> DataFrame:
    """(a, b): the edges between different clusters, by the cluster of each vertex in ``homes`` (v, c)."""
    for end, other in (("a", "b"), ("b", "a")):
        ends, own = _spread(edges, end, other, hot), _copies(homes, hot).select(F.col("v").alias(end), "s", F.col("c").alias(f"c{end}"))
        edges = ends.join(own, [end, "s"]).drop("s")
    return edges.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """(v, c): each end of a few edges with the least end it is connected to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return pd.DataFrame([(x, find(x)) for x in list(parent)], columns=["v", "c"])


def components(
    edges: DataFrame, beta: float = BETA, hot_least: int = HOT_LEAST, report: list[dict] | None = None, last: int = LAST,
) -> DataFrame:
    """(vertex, root): connected components of the edge table (a, b).

    ``root`` is some vertex of the component, the same for all its vertices. ``report``
    receives, per round, its edges, the edges between its clusters, and its steps.
    """
    rest = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    rest, left = _cut_counting(rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), F.count("*"))
    rounds: list[DataFrame] = []
    while left:
        if len(rounds) == ROUNDS:
            raise RuntimeError("components did not settle")
        if rounds and left <= 2 * last:
            rounds.append(cut(rest.groupBy(F.lit(0).alias("_one")).applyInPandas(_joined, "v long, c long")))
            break
        hot = _hot_vertices(rest, left, hot_least)
        grown, steps = _grow(rest, hot, len(rounds), beta)
        rounds.append(grown)
        between = _contracted(rest, grown, hot)
        cuts = 0
        if report is not None:
            between, cuts = _cut_counting(between, F.count("*"))
            report.append({"round_no": len(rounds), "edges": left // 2, "cut_edges": cuts // 2, "steps": steps})
        rest, left = _cut_counting(between.distinct(), F.count("*"))
    if not rounds:
        return rest.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    # Later rounds are smaller, so their assignments are composed first.
    final = rounds.pop()
    while rounds:
        step = rounds.pop()
        final = step.join(final.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left").select("v", F.coalesce("to", "c").alias("c"))
    return final.select(F.col("v").alias("vertex"), F.col("c").alias("root"))


def hooked_components(edges: DataFrame, hot_least: int = HOT_LEAST) -> DataFrame:
    """(vertex, root): as ``components``, after every vertex went to the least of its neighbours and itself.

    Each edge then links the homes of its ends, so what is connected stays so. Where most
    groups are pairs or stars, as those of spellings are, few edges are left to decompose.
    """
    rest = cut(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b"))
    both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
    homes = both.groupBy(F.col("a").alias("v")).agg(F.least("a", F.min("b")).alias("c"), F.count("*").alias("d"))
    homes, seen = _cut_counting(homes, F.struct(F.sum("d").alias("ends"), F.max("d").alias("most")))
    hot, limit = None, max(hot_least, -(-(seen["ends"] or 0) // HOT_MOST))
    if (seen["most"] or 0) > limit:
        hot = cut(homes.where(F.col("d") > limit).select("v", F.ceil(F.col("d") / limit).cast("int").alias("n")))
    homes = homes.select("v", "c")
    found = components(_contracted(rest, homes, hot), hot_least=hot_least).withColumnRenamed("vertex", "c")
    return homes.join(found, "c", "left").select(F.col("v").alias("vertex"), F.coalesce("root", "c").alias("root"))


def groups(edges: DataFrame) -> DataFrame:
    """(vertex, group): the group number is the least vertex of the component."""
    assigned = components(edges)
    least = assigned.groupBy("root").agg(F.min("vertex").alias("group"))
    return assigned.join(least, "root").select("vertex", "group")
