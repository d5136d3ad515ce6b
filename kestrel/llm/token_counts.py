"""Token counts by heap-and-linked-list byte-pair merging; no ids are made.

A word is a linked list of its byte symbols.  A heap holds every adjacent pair
that the vocabulary merges, keyed by (rank, position).  The lowest is popped
again and again: if both its ends still stand, they are joined, and the two new
neighbour pairs are pushed.  Each merge shortens the list by one, so the count is
initial symbols minus merges.  Words met before come from a bounded cache.

Edge cases: null counts as the empty text (0 tokens).  Special strings inside a
text count as one token each, as the public library does by default.  A very long
text is counted whole, in runs of words, and is held with its batch in the task; repeated rows each get
their count, and an empty table gives no rows.  An output
column that already exists is replaced.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.byte_pieces import PieceCache, byte_alphabet, check_byte_level
from kestrel.llm.common import release_memory, runs_of
from kestrel.session import ship_package


def merged_length(word: str, rank: dict[tuple[str, str], int]) -> int:
    """Symbols left of ``word`` when no adjacent pair can be merged any more."""
    n = len(word)
    if n < 2:
        return n
    sym = list(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, p) for i in range(n - 1) if (r := rank.get(p := (sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or sym[i] != pair[0] or sym[j] != pair[1]:
            continue  # one end went into an earlier merge
        merges += 1
        sym[i], sym[j] = pair[0] + pair[1], ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            p = (sym[i], sym[k])
            r = rank.get(p)
            if r is not None:
                heapq.heappush(heap, (r, i, p))
        h = before[i]
        if h >= 0:
            p = (sym[h], sym[i])
            r = rank.get(p)
            if r is not None:
                heapq.heappush(heap, (r, h, p))
    return n - merges


def _counter(js: bytes) -> PieceCache:
    spec = json.loads(js)
    rank = {tuple(m.split(" ", 1) if isinstance(m, str) else m): k for k, m in enumerate(spec["model"]["merges"])}
    return PieceCache(js, spec, word=lambda w: merged_length(w, rank), join=sum, special=lambda i: 1)


def token_counts(df: DataFrame, tokenizer: str, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with ``out long``: tokens of ``text_col`` under the byte-level BPE file
    ``tokenizer`` (read on the driver and broadcast; a fixed vocabulary)."""
    ship_package(df.sparkSession)
    with open(tokenizer, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    check_byte_level(spec)
    if not set(byte_alphabet().values()) <= set(spec["model"]["vocab"]):
        raise ValueError("the vocabulary lacks byte symbols")
    js = df.sparkSession.sparkContext.broadcast(raw)

    def count(batches):
        import numpy as np
        import pandas as pd

        def totals(values, index, ends):
            n = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.array(values, np.int64)[index])])
            return (n[ends[1:]] - n[ends[:-1]]).tolist()

        cache = _counter(js.value)
        try:
            for texts in batches:
                yield pd.Series([n for run in runs_of(texts.tolist()) for n in cache.many(run, totals)], dtype="int64")
        finally:
            del cache
            release_memory()

    count.__annotations__ = _iterator_of_series()
    return df.withColumn(out, F.pandas_udf(count, "long")(F.coalesce(F.col(text_col), F.lit(""))))


def _iterator_of_series() -> dict:
    """Type hints that make a function an iterator-to-iterator pandas UDF."""
    from collections.abc import Iterator

    import pandas as pd

    return {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
