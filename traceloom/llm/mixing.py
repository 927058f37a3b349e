"""Mixing sources to target weights with soft membership.

A classifier trained on labelled rows gives every document a posterior over the
sources. A document's own label is evidence, not the answer: it multiplies the
posterior as a prior in which a label is wrong with a small chance, so a document that
reads like another source counts partly for that one. Rates (expected repeats) are
fitted by projected gradient descent on the squared distance between the expected
tokens of each source and its target: each step aggregates tokens per source over all
documents and clips every rate to [0, most repeats]. Only one number per source reaches
the driver per step. If a total turns out not to be within reach, a slightly smaller one
is fitted; what does not settle at all is an error. Rates become whole repeats by a
threshold on a hash, set per source from a histogram of tokens over the hash, so the
shares hold to a fraction of a percent.

Defined results: sources without a target get rate 0; a document of null source
belongs to the source its posterior favours (with its cap of repeats), any other to its
own; null and empty texts have no tokens and are left out; the same document in two rows
is two documents; the total is the largest that lets every source reach its share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.llm.tokens import TOKENIZER, encode
from traceloom.session import cut, table

#: The classifier is fitted on at most this many labelled rows per source, over hashed token counts.
SAMPLE_PER_SOURCE, FEATURES = 200, 2048
#: Distinct sources up to which their counts go to all tasks.
SOURCES = 10_000
#: Chance that a label is wrong.
MISLABELLED = 0.005
#: Gradient steps for one total, distance of every source's share at which they have settled, factor
#: and number of smaller totals to try, bins of the rounding histogram.
STEPS, SETTLED, LESS, TRIES, BINS = 20, 2e-4, 0.99, 10, 4096


def _features(ids: list[int]) -> np.ndarray:
    """Log counts of hashed tokens, of length 1."""
    ids = np.array(ids, dtype=np.int64)
    x = np.log1p(np.bincount((ids * 2654435761 % (1 << 32)) % FEATURES, minlength=FEATURES)).astype(np.float32)
    return x / max(1e-9, float(np.sqrt((x * x).sum())))


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 300, rate: float = 8.0, decay: float = 1e-4):
    """Weights (features + 1, classes) of a multinomial logistic regression."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w, goal = np.zeros((x.shape[1], classes), dtype=np.float32), np.eye(classes, dtype=np.float32)[y]
    weight = (1.0 / np.maximum(1, goal.sum(0)))[y][:, None].astype(np.float32)
    weight /= weight.sum()
    for _ in range(steps):
        w -= rate * (x.T @ (weight * (softmax(x @ w) - goal)) + decay * w)
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, path: str = TOKENIZER) -> tuple[list[str], np.ndarray]:
    """(sources, weights) fitted on a sample of labelled rows, at most SAMPLE_PER_SOURCE of each."""
    labelled = docs.where("source IS NOT NULL AND length(text) > 0")
    counts = cut(labelled.groupBy("source").agg(F.count("*").alias("n")))
    # One row per source, sent to all tasks if there are no more than SOURCES.
    near = labelled.join(F.broadcast(counts) if counts.count() <= SOURCES else counts, "source").withColumn("u", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40))
    # Twice the expected share first, so that no source is ranked as a whole.
    near = near.where(F.col("u") < F.lit(2.0 * SAMPLE_PER_SOURCE) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("u", "doc_id"))
    sample = near.select("source", "text", rank.alias("r")).where(F.col("r") <= SAMPLE_PER_SOURCE).drop("r")

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"source": b["source"], "x": [_features(encode(t, path)) for t in b["text"]]})

    got = sample.mapInPandas(featurize, "source string, x array<float>").toPandas()
    sources = sorted(got["source"].unique())
    if not sources:
        return [], np.zeros((FEATURES + 1, 0), dtype=np.float32)
    y = got["source"].map({s: i for i, s in enumerate(sources)}).to_numpy()
    return sources, fit_softmax(np.stack(got["x"].to_numpy()), y, len(sources))


def memberships(docs: DataFrame, sources: list[str], weights: np.ndarray, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens, posterior) of every document; each text is tokenized once."""
    place = {s: i for i, s in enumerate(sources)}
    k = len(sources)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes, rows = [], []
            for source, text in zip(b["source"], b["text"]):
                ids = encode(text, path) if isinstance(text, str) else []
                sizes.append(len(ids))
                at = place.get(source)
                if not ids or (at is None and source is not None):
                    rows.append(np.zeros(k))
                    continue
                p = softmax((np.append(_features(ids), np.float32(1.0)) @ weights)[None])[0].astype(float) if k else np.zeros(0)
                if at is not None:
                    prior = np.full(k, MISLABELLED / max(1, k - 1))
                    prior[at] = 1.0 - MISLABELLED
                    p = p * prior / (p * prior).sum()
                rows.append(p)
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": sizes, "posterior": rows})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").mapInPandas(
        run, "doc_id long, source string, n_tokens long, posterior array<double>"
    )


def homes(members: DataFrame, sources: list[str]) -> DataFrame:
    """Adds ``home``, the number of a document's own source, of the likeliest where it has none, or -1."""
    best = F.array_max("posterior")
    likeliest = F.when(best > 0, F.array_position("posterior", best) - 1).otherwise(-1)
    own = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source")) - 1
    return members.withColumn("home", F.when(F.col("source").isNull(), likeliest).otherwise(own).cast("int"))


def fit_rates(members: DataFrame, targets: list[float], caps: list[int]) -> tuple[DataFrame, list[float]]:
    """(members with rate, expected tokens per source) by projected gradient steps.

    members: (doc_id, n_tokens, posterior, home), home = index of the likeliest
    source or -1. The gradient of the squared distance is scaled by the tokens
    that can still move (a diagonal preconditioner).
    """
    k = len(targets)
    cap = F.get(F.array(*[F.lit(float(c)) for c in caps]), F.col("home"))
    base = members.where("home >= 0 AND n_tokens > 0").withColumn("cap", cap)
    base = base.where("cap > 0")
    soft = lambda i: F.get("posterior", F.lit(i)) * F.col("n_tokens")
    mass = base.agg(*[F.sum(soft(i) * F.col("cap")).alias(f"m{i}") for i in range(k)]).first()
    most = [float(m or 0.0) for m in mass]
    total = min((m / t for m, t in zip(most, targets) if t > 0), default=0.0)
    if total <= 0:
        return base.withColumn("rate", F.lit(0.0)), [0.0] * k

    def rates(history: list[list[float]]):
        """Rates after all steps so far, from the residuals of each."""
        if not history:
            return F.lit(0.0)
        steps = F.array(*[F.array(*[F.lit(x) for x in h]) for h in history])
        return F.aggregate(
            steps, F.lit(0.0),
            lambda acc, h: F.least(F.col("cap"), F.greatest(F.lit(0.0), acc + F.col("cap") * F.aggregate(
                F.zip_with(h, F.col("posterior"), lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y))),
        )

    for _ in range(TRIES):
        goal = [total * t for t in targets]
        history: list[list[float]] = []
        expected = [0.0] * k
        for _ in range(STEPS):
            history.append([(g - e) / max(m, 1e-9) for g, e, m in zip(goal, expected, most)])
            row = base.withColumn("rate", rates(history)).agg(*[F.sum(soft(i) * F.col("rate")).alias(f"e{i}") for i in range(k)]).first()
            expected = [float(e or 0.0) for e in row]
            if max(abs(g - e) / total for g, e in zip(goal, expected)) < SETTLED:
                return base.withColumn("rate", rates(history)), expected
        total *= LESS
    raise RuntimeError("the shares did not settle: some source is too small for its target")


def whole_repeats(rated: DataFrame) -> DataFrame:
    """(doc_id, home, n_tokens, repeats): rates as whole numbers, tokens per source kept."""
    u = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    parts = rated.withColumn("u", u).withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate"))
    # Documents whose part is 0 need no rounding; the others of a source share one order by u / part.
    parts = parts.withColumn("v", F.when(F.col("part") > 1e-9, F.col("u") / F.col("part")))
    bins = parts.where("v IS NOT NULL").groupBy("home", F.least(F.lit(4 * BINS), F.floor(F.col("v") * BINS)).cast("long").alias("bin")).agg(
        F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("part")).alias("want")
    )
    order = Window.partitionBy("home").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("t").over(order)).withColumn("goal", F.sum("want").over(Window.partitionBy("home")))
    # Whole bins up to the goal, then the one document that comes nearest to what is missing.
    edges = cut(bins.groupBy("home").agg(
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("goal"), F.col("bin"))), F.lit(-1)).alias("edge"),
        (F.first("goal") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("goal"), F.col("upto"))), F.lit(0))).alias("gap"),
    ))
    # One row per source: as many as there are rows in mix_targets.
    joined = parts.join(F.broadcast(edges), "home", "left")
    up = F.col("v").isNotNull() & (F.least(F.lit(4 * BINS), F.floor(F.col("v") * BINS)) <= F.col("edge"))
    joined = joined.withColumn("up", F.coalesce(up, F.lit(False)))
    off = F.abs(F.col("n_tokens") - F.col("gap"))
    extra = joined.where(F.col("v").isNotNull() & ~F.col("up") & (off < F.col("gap"))).groupBy("home").agg(F.min_by("doc_id", off).alias("extra"))
    joined = joined.join(F.broadcast(extra), "home", "left")
    more = F.col("up") | (F.col("v").isNotNull() & F.coalesce(F.col("doc_id") == F.col("extra"), F.lit(False)))
    return joined.select("doc_id", "home", "n_tokens", (F.col("whole") + F.when(more, 1).otherwise(0)).cast("int").alias("repeats"))


def _mix(spark: SparkSession, base: str):
    docs = table(spark, base, "documents")
    targets = {r.source: (r.target_share, r.max_repeats) for r in table(spark, base, "mix_targets").collect()}
    sources, weights = train(docs)
    sources = sources or sorted(targets)
    members = memberships(docs, sources, weights)
    members = cut(homes(members, sources))
    shares = [float(targets[s][0]) if s in targets else 0.0 for s in sources]
    caps = [int(targets[s][1]) if s in targets else 0 for s in sources]
    rated, _ = fit_rates(members, shares, caps)
    return whole_repeats(rated), sources, shares, caps, members


def p8_mix(spark: SparkSession, base: str) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of every chosen document."""
    chosen, sources, *_ = _mix(spark, base)
    names = F.array(*[F.lit(s) for s in sources])
    return chosen.where("repeats > 0").select("doc_id", F.get(names, F.col("home")).alias("source"), "n_tokens", "repeats")


def p8_shares(spark: SparkSession, base: str) -> DataFrame:
    """Target and actual share of every source of mix_targets, by the documents' sources and by their posteriors."""
    chosen, sources, _, _, members = _mix(spark, base)
    chosen = cut(chosen)
    names = F.array(*[F.lit(s) for s in sources])
    soft = chosen.where("repeats > 0").join(members.select("doc_id", "posterior", "n_tokens", "home"), ["doc_id", "n_tokens", "home"])
    soft = soft.select((F.col("n_tokens") * F.col("repeats")).alias("t"), F.posexplode("posterior").alias("i", "p")).groupBy("i").agg(F.sum(F.col("t") * F.col("p")).alias("soft"))
    soft = soft.select(F.get(names, F.col("i")).alias("source"), "soft")
    got = chosen.where("repeats > 0").groupBy(F.get(names, F.col("home")).alias("source")).agg(
        F.count("*").alias("documents"), F.sum("repeats").alias("copies"), F.max("repeats").alias("most_repeats"),
        F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"),
    )
    total = F.sum("tokens").over(Window.partitionBy())
    all_soft = F.sum("soft").over(Window.partitionBy())
    return table(spark, base, "mix_targets").join(got, "source", "left").join(soft, "source", "left").select(
        "source", "target_share", (F.coalesce("tokens", F.lit(0)) / total).alias("actual_share"),
        (F.coalesce("soft", F.lit(0.0)) / all_soft).alias("posterior_share"), "max_repeats",
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
    )


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares}
SQL: dict[str, str] = {}
