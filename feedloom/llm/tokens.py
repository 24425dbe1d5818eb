"""Token counts by byte-pair merging with a heap and a linked list.

The count of a word is its number of initial symbols minus its number of merges; no identifiers
are made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.pieces import Splitter

#: Words kept with their counts per Python worker, and the longest word that is kept.
CACHED_WORDS, CACHED_LENGTH = 500_000, 64


class MergeCounter:
    """Counts tokens of texts for one vocabulary file with a merge list and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.word_end = model["end_of_word_suffix"] or ""
        self.splitter = Splitter(path)
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols left of one piece, given in byte symbols, once no adjacent pair has a rank."""
        symbols = list(piece)
        symbols[-1] += self.word_end
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        heap = [
            (ranks[pair], i, pair) for i, pair in enumerate(zip(symbols, symbols[1:]))
            if pair in ranks
        ]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            # An entry is stale if either symbol has changed or gone since it was pushed.
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            merges += 1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (pair := (symbols[a], symbols[b])) in ranks:
                    heapq.heappush(heap, (ranks[pair], a, pair))
        return n - merges

    def chunk(self, chunk: str) -> int:
        """Tokens of a run without white space."""
        return sum(map(self.merged, self.splitter.pieces(chunk)))

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for chunk in self.splitter.runs(text):
            count = known.get(chunk)
            if count is None:
                count = self.chunk(chunk)
                if len(chunk) <= CACHED_LENGTH:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[chunk] = count
            total += count
        return total

    def count(self, text: str | None) -> int:
        parts = self.splitter.parts(text)
        return len(parts) // 2 + sum(map(self.plain, parts[::2]))


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` with the vocabulary file ``path``, which every executor can read.

    Special strings in a text are one token each, no begin or end token is added. Null and empty
    texts have 0. A worker keeps at most CACHED_WORDS counts of words.
    """
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count_one = counter(path).count
        for batch in batches:
            yield pd.Series([count_one(text) for text in batch], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    One row out per row in, whatever the ids; columns of these names are replaced. An empty table
    gives an empty one.
    """
    counted = docs.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"),
        "n_tokens": token_count(F.col(text), path),
    })
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
