"""Cutting, packing and mixing: round trips, limits, brute force."""

import random

import numpy as np
import pytest

from traceloom.llm import mixing
from traceloom.llm.chunking import cut_documents, cut_text
from traceloom.llm.packing import best_fit_decreasing, pack
from traceloom.llm.tokens import TOKENIZER, encode, with_token_counts


def text_of(rng, n):
    words = ["alpha", "beta", "gamma", "x9", "naïve", "東京", "long-word"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "\n", "\n\n"]) for _ in range(n))


@pytest.mark.parametrize("limit,overlap", [(64, 8), (256, 32), (50, 0)])
def test_pieces_rebuild_the_text(limit, overlap):
    rng = random.Random(limit)
    for text in [text_of(rng, 700), "x" * 3000, "é" * 900, "東" * 700, "😀" * 400, " " * 3000, "a b" * 1000]:
        pieces = cut_text(text, limit, overlap)
        assert "".join(text[o:e] for _, o, e, _, _ in pieces) == text
        for i, (a, o, e, size, _) in enumerate(pieces):
            assert a <= o < e and size <= limit and size == len(encode(text[a:e]))
            assert i == 0 or o == pieces[i - 1][2]
            if i and overlap:
                assert overlap <= len(encode(text[a:o])) <= overlap + 8


def test_edit_moves_only_near_cuts():
    rng = random.Random(3)
    text = text_of(rng, 6000)
    edited = text[:200] + "An inserted sentence. " + text[200:]
    shift = len(edited) - len(text)
    a = {e + shift for _, _, e, _, _ in cut_text(text, 256, 32)}
    b = {e for _, _, e, _, _ in cut_text(edited, 256, 32)}
    assert len(a & b) > 0.8 * len(a)


def test_small_and_dirty_texts(spark):
    rows = [(1, None, "p"), (2, "", "p"), (3, "short", "p"), (4, "word " * 300, "p"), (4, "word " * 300, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    got = cut_documents(df, "doc_id", "text", [("j", 100, 10)]).collect()
    assert {r.doc_id for r in got} == {4} and len(got) % 2 == 0
    assert cut_documents(df.limit(0), "doc_id", "text", [("j", 100, 10)]).count() == 0
    assert dict(with_token_counts(df, "doc_id", "text").collect())[1] == 0


def test_best_fit_decreasing_is_best_fit():
    rng = random.Random(5)
    sizes = sorted((rng.randrange(0, 101) for _ in range(400)), reverse=True)
    rooms, want = [], []
    for s in sizes:
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms[rooms.index(min(fits))] -= s
        else:
            rooms.append(100 - s)
        want.append(len(rooms))
    got = best_fit_decreasing(sizes, 100)
    assert max(b for b, _ in got) + 1 == len(rooms)
    fill = {}
    for (b, place), s in zip(got, sizes):
        fill.setdefault(b, []).append(s)
        assert place == len(fill[b]) - 1
    assert max(map(sum, fill.values())) <= 100


@pytest.mark.parametrize("shard", [10_000, 50])
def test_pack_places_everything_once(spark, shard):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 5, 60, 99, 100, 250, 333])) for i in range(300)] + [(7, 5), (900, None)]
    out = pack(spark.createDataFrame(rows, "key long, n_tokens long"), [("j", 100)], shard).toPandas()
    assert out.groupby("container_id").n_tokens.sum().max() <= 100
    assert out.n_tokens.sum() == sum(s or 0 for _, s in rows)
    assert set(out.doc_id) == {k for k, _ in rows}
    assert not out.duplicated(["container_id", "place"]).any()
    pieces = out[out.doc_id == next(k for k, s in rows if s == 333)].sort_values("piece_no")
    assert pieces.n_tokens.tolist() == [100, 100, 100, 33] and pieces.token_start.tolist() == [0, 100, 200, 300]
    assert pack(spark.createDataFrame([], "key long, n_tokens long"), [("j", 100)], shard).count() == 0


def test_classifier_and_rates(spark):
    rng = random.Random(2)
    kinds = {"log": "GET /index 200 from host ", "mail": "Dear student, kindly confirm your address. ", "code": "key = value; export PATH "}
    text = lambda k: kinds[k] * rng.randrange(1, 12)
    rows = [(i, text(k), k) for i, k in enumerate(["log"] * 150 + ["mail"] * 90 + ["code"] * 40)]
    rows += [(1000 + i, text(k), None) for i, k in enumerate(["log", "mail", "code"] * 20)] + [(2000, None, None), (2001, "", "log")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sources, weights = mixing.train(df)
    members = mixing.memberships(df, sources, weights, TOKENIZER).toPandas().set_index("doc_id")
    hits = [sources[int(np.argmax(members.posterior[1000 + i]))] == ["log", "mail", "code"][i % 3] for i in range(60)]
    assert np.mean(hits) >= 0.95
    base = mixing.homes(mixing.memberships(df, sources, weights, TOKENIZER), sources)
    shares, caps = [{"log": 0.2, "mail": 0.5, "code": 0.3}[s] for s in sources], [{"log": 1, "mail": 2, "code": 4}[s] for s in sources]
    rated, expected = mixing.fit_rates(base, shares, caps)
    assert np.allclose(np.array(expected) / sum(expected), shares, atol=0.01)
    chosen = mixing.whole_repeats(rated).toPandas()
    assert (chosen.repeats <= chosen.home.map(dict(enumerate(caps)))).all()
    got = (chosen.n_tokens * chosen.repeats).groupby(chosen.home).sum() / (chosen.n_tokens * chosen.repeats).sum()
    assert np.allclose(got.reindex(range(3)), shares, atol=0.04)
    # A label is evidence: a document that reads like another source keeps its home, but belongs to both.
    odd = spark.createDataFrame([(1, kinds["mail"] * 8, "log"), (2, kinds["log"] * 8, "log"), (3, "x", "unheard of")], "doc_id long, text string, source string")
    got = mixing.homes(mixing.memberships(odd, sources, weights, TOKENIZER), sources).toPandas().set_index("doc_id")
    log, mail = sources.index("log"), sources.index("mail")
    assert got.home.tolist() == [log, log, -1] and got.posterior[2][log] > 0.999
    assert abs(sum(got.posterior[1]) - 1) < 1e-6 and got.posterior[1][mail] > got.posterior[2][mail] * 10


def test_a_mix_that_cannot_settle_is_an_error(spark):
    # Both sources share all their documents' posteriors, so no rates give one of them four fifths.
    rows = [(i, 100, [0.5, 0.5], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>, home int")
    with pytest.raises(RuntimeError):
        mixing.fit_rates(df, [0.8, 0.2], [1, 1])
    assert mixing.fit_rates(df.limit(0), [0.8, 0.2], [1, 1])[1] == [0.0, 0.0]
