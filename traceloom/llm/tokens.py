"""Token counts by a public tokenizer, the same one throughout.

The vocabulary is byte_bpe_50k (byte-level BPE, 50,256 ids) read from
``TOKENIZER``; the path is a parameter and the file stays where it is. Strings
of special tokens are ordinary text. Null text has no tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's authors split text before merging (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str = TOKENIZER):
    """The tokenizer of this process; of each token its byte length, whether it is a
    blank and a word, and whether it ends with a blank or a separator."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    worded, closes = np.zeros(len(lengths), dtype=bool), np.zeros(len(lengths), dtype=bool)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
        worded[rank] = token[:1] == b" " and token[1:2].isalpha()
        closes[rank] = token[-1:] in b" \t\r\n,;|>"
    return tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths, worded, closes


def encode(text: str, path: str = TOKENIZER) -> list[int]:
    """Token ids of a text; unpaired surrogates count as replacement characters."""
    return encoder(path)[0].encode_ordinary(text.encode("utf-8", "replace").decode("utf-8"))


def with_token_counts(df: DataFrame, key: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """(key, n_tokens) of every row, over the whole text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "n_tokens": [len(encode(t, path)) for t in texts]})

    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(count, "key long, n_tokens long")
