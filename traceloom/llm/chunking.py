"""Splitting oversized texts at natural boundaries: content-defined chunking.

A rolling hash over the last tokens marks landmarks that depend on nothing but
the text around them. A piece ends at the first landmark between its least and
its greatest size, snapped to the nearest natural boundary (paragraph, then line
or sentence, then word) near it, so an edit moves the cuts next to it only.
Consecutive pieces share ``overlap`` tokens, a few more where characters or merges
would make the shared text come out shorter when it is tokenized by itself.

Defined results: a text within the limit, an empty or a null text gives no
pieces; a text without boundaries is cut between characters; every piece has at
most ``max_tokens`` tokens, also when it is tokenized by itself; the parts from
``own_start`` to ``char_end`` put together are the text; repeated rows are cut
each by themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.tokens import TOKENIZER, encoder
from traceloom.session import table

#: Tokens under the rolling hash; least size of a piece and reach of a snap as shares of the greatest.
WINDOW, LEAST, REACH = 16, 0.25, 0.25
PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)+")
SENTENCE = re.compile(r"[.!?][\"')\]]*\s+|[。！？]|\r\n|[\r\n]|</\w+>")


def _landmarks(ids: np.ndarray, spacing: int) -> np.ndarray:
    """Token positions after which the hash of the last tokens marks a landmark."""
    mixed = ids.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
        rolling = mixed.copy()
        for k in range(1, min(WINDOW, len(ids))):
            rolling[k:] += mixed[:-k] << np.uint64(k)
        rolling ^= rolling >> np.uint64(32)
    mask = np.uint64((1 << max(1, int(spacing).bit_length() - 1)) - 1)
    return np.flatnonzero((rolling & mask) == 0) + 1


def _own_size(enc, clean: str, char_of: np.ndarray, safe: np.ndarray, a: int, b: int) -> int:
    """Tokens of the piece from token a to b when it is tokenized by itself.

    A token of a blank and a word is always split off from what stands before it,
    so only the stretches outside the first and the last such token can differ
    from the text's own tokens; those are tokenized again.
    """
    i = safe.searchsorted(a)
    j = safe.searchsorted(b) - 1
    if i >= len(safe) or j <= i:
        return len(enc.encode_ordinary(clean[char_of[a]:char_of[b]]))
    first, last = int(safe[i]), int(safe[j])
    head = len(enc.encode_ordinary(clean[char_of[a]:char_of[first]])) if first > a else 0
    return head + (last - first) + len(enc.encode_ordinary(clean[char_of[last]:char_of[b]]))


def _boundary_tokens(text: str, ids: np.ndarray, starts: np.ndarray, char_of: np.ndarray, safe: np.ndarray, closes: np.ndarray) -> list[np.ndarray]:
    """Token positions of the natural boundaries, by class, strongest first.

    A position counts if a token begins there, or if only blanks lie between.
    Words begin at tokens with a blank in front and end after a separator.
    """
    out = []
    for pattern in (PARAGRAPH, SENTENCE):
        ends = np.array([m.end() for m in pattern.finditer(text)], dtype=np.int64)
        at = char_of.searchsorted(ends, side="left")
        # Blanks before a word belong to its token: then the cut is one token earlier.
        at = np.where(char_of[np.minimum(at, len(char_of) - 1)] != ends, at - 1, at)
        out.append(at[(at > 0) & (at < len(char_of))])
    ends = np.zeros(len(ids), dtype=bool)
    ends[safe] = True
    ends[1:] |= closes[ids[:-1]]
    ends[0] = False
    out.append(np.flatnonzero(ends))
    return [b[starts[b]] for b in out]


def cut_text(text: str, max_tokens: int, overlap: int, path: str = TOKENIZER) -> list[tuple]:
    """Pieces (char_start, own_start, char_end, n_tokens, boundary) of a text above the limit."""
    return cut_text_for(text, [(max_tokens, overlap)], path)[0]


def cut_text_for(text: str, limits: list[tuple[int, int]], path: str = TOKENIZER) -> list[list[tuple]]:
    """The pieces for each (max_tokens, overlap); the text is tokenized once for all."""
    enc, lengths, worded, closes = encoder(path)
    clean = text.encode("utf-8", "replace").decode("utf-8")
    ids = np.array(enc.encode_ordinary(clean), dtype=np.int64)
    n = len(ids)
    if any(not 0 <= overlap < most for most, overlap in limits):
        raise ValueError("the overlap must be less than the limit")
    if all(n <= most for most, _ in limits):
        return [[] for _ in limits]
    byte_of = np.concatenate([[0], np.cumsum(lengths[ids])])
    raw = np.frombuffer(clean.encode("utf-8"), dtype=np.uint8)
    begins = np.append((raw & 0xC0) != 0x80, True)
    char_at = np.concatenate([[0], np.cumsum(begins[:-1])])
    whole = begins[byte_of]  # tokens that begin with a character, not within one
    char_of = char_at[byte_of]
    safe = np.flatnonzero(worded[ids])
    classes = _boundary_tokens(clean, ids, whole, char_of, safe, closes)
    return [
        _pieces(enc, clean, ids, whole, char_of, classes, safe, worded, most, overlap) if n > most else [] for most, overlap in limits
    ]


def _pieces(enc, clean, ids, whole, char_of, classes, safe, worded, max_tokens: int, overlap: int) -> list[tuple]:
    n, most = len(ids), max_tokens - overlap
    least, reach = max(1, int(most * LEAST)), max(1, int(most * REACH))
    marks = _landmarks(ids, max(2, (most - least) // 4))
    pieces, own = [], 0
    while own < n:
        back = own - overlap if own else 0
        # The shared text alone must have the stated tokens too, not only within the text.
        settled = not own or not overlap or (worded[ids[own]] and worded[ids[back]])
        while back > 0 and (not whole[back] or (not settled and _own_size(enc, clean, char_of, safe, back, own) < overlap)):
            back -= 1
        top = min(n, back + max_tokens)
        if top == n and n - back <= max_tokens:
            end, kind = n, "end"
        else:
            end, kind = _choose(own + least, top, reach, marks, classes, whole)
        # Tokenized by itself a piece may come out longer by a token or two.
        while True:
            size = _own_size(enc, clean, char_of, safe, back, end)
            if size <= max_tokens or end <= own + 1:
                break
            end, kind = _choose(min(own + least, end - 1), end - (size - max_tokens), reach, marks[:0], classes, whole)
            if end <= own:
                end, kind = own + 1, "hard"
                while end < n and not whole[end]:
                    end += 1
        pieces.append((int(char_of[back]), int(char_of[own]), int(char_of[end]), size, kind))
        own = end
    return pieces


def _choose(low: int, high: int, reach: int, marks: np.ndarray, classes: list[np.ndarray], whole: np.ndarray) -> tuple[int, str]:
    """Where a piece that may end from low to high ends, and at what."""
    i = marks.searchsorted(low)
    goal = int(marks[i]) if i < len(marks) and marks[i] <= high else high
    a, b = max(low, goal - reach), min(high, goal + reach)
    for kind, at in zip(("paragraph", "sentence", "word"), classes):
        near = at[at.searchsorted(a):at.searchsorted(b, side="right")]
        if len(near):
            return int(near[np.argmin(np.abs(near - goal))]), kind
    while goal > low and not whole[goal]:
        goal -= 1
    while goal < len(whole) - 1 and not whole[goal]:
        goal += 1
    return goal, "hard"


PIECES = (
    "job string, doc_id long, piece_no long, char_start long, own_start long, char_end long, "
    "n_tokens long, boundary string, piece string"
)


def cut_documents(docs: DataFrame, key: str, text: str, jobs: list[tuple[str, int, int]], path: str = TOKENIZER) -> DataFrame:
    """The pieces of every text above a job's limit, for jobs (name, max_tokens, overlap)."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    smallest = min((limit for _, limit, _ in jobs), default=0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 200):
                rows = []
                for doc, t in zip(batch["key"].iloc[lo:lo + 200], batch["text"].iloc[lo:lo + 200]):
                    if not isinstance(t, str) or not t:
                        continue
                    # A token has one byte at least, so a text of so few bytes is within the limit.
                    if 4 * len(t) <= smallest or len(t) <= smallest and len(t.encode("utf-8", "replace")) <= smallest:
                        continue
                    for (job, _, _), pieces in zip(jobs, cut_text_for(t, [(m, o) for _, m, o in jobs], path)):
                        rows += [(job, doc, i + 1, a, o, e, size, kind, t[a:e]) for i, (a, o, e, size, kind) in enumerate(pieces)]
                yield pd.DataFrame(rows, columns=names)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(run, PIECES)


def read_jobs(spark: SparkSession, base: str, prefix: str) -> list[tuple[str, int, int]]:
    """Jobs (name, max_tokens, overlap_tokens) of the fixed table token_limits."""
    limits = table(spark, base, "token_limits").where(F.col("job").startswith(prefix)).orderBy("job")
    return [(r.job, r.max_tokens, r.overlap_tokens) for r in limits.collect()]


def p9_pieces(spark: SparkSession, base: str) -> DataFrame:
    """The pieces of all texts above the limits cut_*, in order."""
    return cut_documents(table(spark, base, "documents"), "doc_id", "text", read_jobs(spark, base, "cut_"))


def p9_report(spark: SparkSession, base: str) -> DataFrame:
    """Per job and kind of boundary: pieces, documents, mean size."""
    return p9_pieces(spark, base).groupBy("job", "boundary").agg(
        F.count("*").alias("pieces"), F.count_distinct("doc_id").alias("docs"), F.avg("n_tokens").alias("mean_tokens"), F.max("n_tokens").alias("most_tokens")
    )


QUERIES = {"p9_pieces": p9_pieces, "p9_report": p9_report}
SQL: dict[str, str] = {}
