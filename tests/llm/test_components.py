"""Components against union-find; salted stars; dirty cluster rows."""

import math
import random

from traceloom.llm import components as module
from traceloom.llm.cluster_links import cluster_tokens
from traceloom.llm.components import BETA, STEPS_AT_ONCE, components, groups, hooked_components, star_edges


def brute(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def test_random_graphs_and_paths(spark):
    rng = random.Random(7)
    pairs = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    pairs += [(5, 5), (None, 3), (100, 101), (100, 101)]
    got = dict(groups(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == brute(pairs)


def test_long_chain_and_cut_edges(spark):
    """Growth is not cut short: few edges lie between clusters, and steps are bounded by the largest shift."""
    n, report = 3000, []
    chain = spark.range(n).selectExpr("id AS a", "id + 1 AS b")
    assert components(chain, report=report, last=0).select("root").distinct().count() == 1
    first = report[0]
    assert first["edges"] == n and first["cut_edges"] / n <= BETA + 0.03
    assert all(r["steps"] <= STEPS_AT_ONCE + math.log(2 * n) / BETA * 1.5 for r in report)


def test_vertices_of_any_degree(spark):
    """A star and a graph of stars, with hardly any and with many vertices counted as hot."""
    rng = random.Random(3)
    pairs = [(0, i) for i in range(1, 600)] + [(1000 + rng.randrange(5), 2000 + rng.randrange(400)) for _ in range(700)]
    want = brute(pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    for least, last in ((1, 0), (50, 20_000), (10**6, 0)):
        roots = {r.vertex: r.root for r in components(df, hot_least=least, last=last).collect()}
        assert set(roots) == set(want) and len({(roots[v], want[v]) for v in want}) == len(set(want.values())) == len(set(roots.values()))


def test_hooked_first(spark, monkeypatch):
    """Pairs and stars end before the decomposition, which gets the rest; any degree, dirty edges."""
    rng = random.Random(11)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(900, i) for i in range(901, 1100)] + [(2000 + rng.randrange(300), 2000 + rng.randrange(300)) for _ in range(200)]
    dirty = pairs + [(7, 7), (None, 3), (1, 0), (0, 1), (5000, 5000)]
    want = {v: r for v, r in brute(dirty).items() if v != 5000}
    for least in (1, 10**6):
        roots = {r.vertex: r.root for r in hooked_components(spark.createDataFrame(dirty, "a long, b long"), hot_least=least).collect()}
        assert {v for v in want if sum(want[v] == x for x in want.values()) > 1} == set(roots)
        assert len({(roots[v], want[v]) for v in roots}) == len({want[v] for v in roots}) == len(set(roots.values()))
    left, whole = [], module.components
    monkeypatch.setattr(module, "components", lambda edges, **k: left.append(edges.count()) or whole(edges, **k))
    stars = [(0, i) for i in range(1, 50)] + [(100 + 2 * i, 101 + 2 * i) for i in range(50)]
    assert hooked_components(spark.createDataFrame(stars, "a long, b long")).count() == 150 and left == [0]
    assert hooked_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(spark):
    assert groups(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_key_has_bounded_degree(spark):
    members = spark.createDataFrame([("hot", i) for i in range(3000)] + [("x", 1), ("x", 1), (None, 2)], "k string, v long")
    edges = star_edges(members, "k", "v", star=32)
    degrees = edges.groupBy("b").count().agg({"count": "max"}).first()[0]
    assert degrees < 200
    assert set(dict(groups(edges).collect()).values()) == {0}


def test_tokens(spark):
    rows = [
        (1, " Person_1 ", "strong:Email: A@X.org ; compound:DOB+Passport Number: 1990-01-01:P1|singleton:1:2", "DOB=1990-01-01|Name=a b"),
        (2, None, None, "Personal Email=a@x.ORG | Passport Number=p9"),
        (3, "", "compound:dob+passport number:1990-01-01:p1|...(+3 more)", None),
    ]
    df = spark.createDataFrame(rows, "cluster_no long, person_cluster_id string, cluster_merge_keys string, cluster_anchor_values string")
    by = {}
    for r in cluster_tokens(df).collect():
        by.setdefault(bytes(r.token), set()).add(r.cluster_no)
    assert sorted(map(sorted, by.values())) == [[1], [1, 2], [1, 3], [2]]
