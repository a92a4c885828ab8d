"""Sizes of texts in tokens of a public byte-level BPE tokenizer.

The pieces that the tokenizer cuts a text into are encoded one by one, so the size of a text is the sum of the sizes of
its pieces; pieces come back often, and each task keeps the sizes of those it has seen. The vocabulary file is read
where the task runs; its path is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pattern by which byte-level BPE cuts text into pieces.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Counter:
    """Counts tokens; pieces of up to 40 characters are remembered."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN) -> None:
        import regex

        self.find = regex.compile(pattern).findall
        self.encoding, self.known = _encoding(path, pattern), {}

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for piece in self.find(text):
            n = known.get(piece)
            if n is None:
                n = len(self.encoding.encode_ordinary(piece))
                if len(piece) <= 40:
                    if len(known) > 500_000:
                        known.clear()
                    known[piece] = n
            total += n
        return total


def with_tokens(df: DataFrame, text: str, keep: list[str], path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The kept columns and ``tokens``; NULL and empty texts have none."""
    types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Counter(path, pattern)
        for pdf in batches:
            out = pdf[keep].copy()
            out["tokens"] = pd.Series([count(t) for t in pdf[text]], index=out.index, dtype="int64")
            yield out

    return df.select(*dict.fromkeys([*keep, text])).mapInPandas(run, f"{types}, tokens long")
