"""Byte-pair encoding by an index of pair occurrences, and decoding.

The distinct pieces of a batch lie end to end in one list of symbols. An index maps each pair that
has a rank to all its positions; active ranks are applied in ascending order, each to all its
positions at once, and the lists of the pairs that this makes or ends are brought up to date.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import hidden, restored
from feedloom.llm.pieces import Splitter

#: Runs, and pieces, kept with their tokens per Python worker, and the longest that is kept.
CACHED_RUNS, CACHED_LENGTH = 400_000, 64


class PairIndexEncoder:
    """Encodes and decodes texts with one vocabulary file of a merge list and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.splitter = Splitter(path)
        self.ids: dict[str, int] = model["vocab"]
        self.word_end = model["end_of_word_suffix"] or ""
        self.width = max(self.ids.values()) + 1
        self.rank: dict[int, int] = {}
        self.merge: list[tuple[int, int, int]] = []
        for left, right in model["merges"]:
            a, b = self.ids[left], self.ids[right]
            self.rank.setdefault(a * self.width + b, len(self.merge))
            self.merge.append((a, b, self.ids[left + right]))
        names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.splitter.specials.items()}
        # The last one stands for ids that are none.
        self.names = np.array([*(names.get(i) for i in range(max(names) + 1)), None], dtype=object)
        self.named = np.array([name is not None for name in self.names])
        # The ids of byte symbols inside a piece and at its end; -1 for none.
        self.inner, self.final = (
            np.array([self.ids.get(chr(c) + end, -1) for c in range(1024)], dtype=np.int64)
            for end in ("", self.word_end))
        self.index_ranks()
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_pieces: dict[str, tuple[int, ...]] = {}

    def index_ranks(self) -> None:
        """Pairs in ascending order with their ranks, for whole arrays of pairs."""
        self.pairs, self.ranks = (np.array(x, dtype=np.int64) for x in zip(*sorted(self.rank.items())))

    def start(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all pieces before any merge, end to end, and where each piece ends. Those
        that the vocabulary lacks are left out."""
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)
        codes = np.minimum(codes, len(self.inner) - 1)
        ends = np.cumsum([len(piece) for piece in pieces], dtype=np.int64)
        symbols = self.inner[codes]
        symbols[ends - 1] = self.final[codes[ends - 1]]
        known = symbols >= 0
        return symbols[known], np.append(0, np.cumsum(known))[ends]

    def merged(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """The tokens of each piece; none is empty."""
        if not pieces:
            return []
        start, ends = self.start(pieces)
        symbols = start.tolist()
        self.apply(symbols, start, ends)
        out, begin = [], 0
        for end in ends.tolist():
            out.append(tuple([s for s in symbols[begin:end] if s >= 0]))
            begin = end
        return out

    def occurrences(self, symbols: np.ndarray, ends: np.ndarray) -> dict[int, list[int]]:
        """The index: all positions, ascending, of each pair that has a rank, by rank."""
        pairs = symbols[:-1] * self.width + symbols[1:]
        place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        has_rank = self.pairs[place] == pairs
        # Of the ends, only those with a piece after them are followed by a symbol.
        has_rank[ends[(ends > 0) & (ends < len(symbols))] - 1] = False
        at = np.flatnonzero(has_rank)
        ranks = self.ranks[place[at]]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        first = np.flatnonzero(np.diff(ranks, prepend=-1))
        return {int(ranks[i]): at[i:j].tolist() for i, j in zip(first, np.append(first[1:], len(at)))}

    def apply(self, symbols: list[int], start: np.ndarray, ends: np.ndarray) -> None:
        """Merge ``symbols``, a list of ``start``, in place; a symbol that went into the one before it
        becomes -1.

        A piece always takes its lowest rank next, leftmost first. If a merge makes a pair of a
        rank below the one in hand, that piece's further positions wait until the lower rank is
        done; other pieces don't depend on it.
        """
        rank, merge, width, n = self.rank, self.merge, self.width, len(symbols)
        ends = ends[np.diff(ends, prepend=0) > 0]
        begins = np.append(0, ends[:-1])[:len(ends)]
        follow, prior = np.arange(1, n + 1), np.arange(-1, n - 1)
        follow[ends - 1], prior[begins] = -1, -1
        after, before = follow.tolist(), prior.tolist()
        piece = np.repeat(np.arange(len(ends)), ends - begins)
        index = self.occurrences(start, ends)
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right, new = merge[r]
            waiting: set[int] = set()
            later: list[int] = []
            for i in sorted(index.pop(r)):
                j = after[i]
                # A position is stale if either symbol has changed or gone since it was listed.
                if symbols[i] != left or j < 0 or symbols[j] != right:
                    continue
                if waiting and int(piece[i]) in waiting:
                    later.append(i)
                    continue
                symbols[i], symbols[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                for a, b in ((before[i], i), (i, k)):
                    if a < 0 or b < 0:
                        continue
                    s = rank.get(symbols[a] * width + symbols[b])
                    if s is None:
                        continue
                    if s in index:
                        index[s].append(a)
                    else:
                        index[s] = [a]
                        heapq.heappush(active, s)
                    if s < r:
                        waiting.add(int(piece[i]))
            if later:
                index[r] = later
                heapq.heappush(active, r)

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """The tokens of each text. Special strings are one token each; nothing is added."""
        splitter, known = self.splitter, self.known
        for cache in (known, self.known_pieces):
            if len(cache) > CACHED_RUNS:
                cache.clear()
        split = [[part if k % 2 else splitter.runs(part) for k, part in enumerate(splitter.parts(t))]
                 for t in texts]
        new = set().union(*[runs for parts in split for runs in parts[::2]]).difference(known)
        pieces_of = {run: splitter.pieces(run) for run in new}
        tokens = self.known_pieces
        distinct = list(set(chain.from_iterable(pieces_of.values())).difference(tokens))
        tokens.update(zip(distinct, self.merged(distinct)))
        for run, pieces in pieces_of.items():
            known[run] = tokens[pieces[0]] if len(pieces) == 1 else tuple(
                chain.from_iterable(map(tokens.__getitem__, pieces)))
        out = []
        for parts in split:
            ids: list[int] = []
            for k, part in enumerate(parts):
                if k % 2:
                    ids.append(splitter.specials[part])
                else:
                    ids += chain.from_iterable(map(known.__getitem__, part))
            out.append(ids)
        for cache, added in ((known, new), (tokens, distinct)):
            for long in [x for x in added if len(x) > CACHED_LENGTH]:
                del cache[long]
        return out

    def decode_batch(self, ids: np.ndarray, offsets: list[int]) -> list[str]:
        """The tokens as the vocabulary writes them, joined by blanks, as its file names no other
        decoder; ids beyond the vocabulary are left out. Texts lie end to end in ``ids``."""
        ids = np.where((ids >= 0) & (ids < len(self.names)), ids, len(self.names) - 1)
        known = self.named[ids]
        if not known.all():
            offsets, ids = np.append(0, np.cumsum(known))[offsets].tolist(), ids[known]
        names = self.names[ids].tolist()
        return [" ".join(names[a:b]) for a, b in zip(offsets, offsets[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder(path)


#: Texts that are encoded together, by their bytes: bounds the index, not a text.
TOGETHER = 3_000_000


def groups(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, so many together as reach TOGETHER bytes."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    group = (np.cumsum(sizes) - sizes) // TOGETHER
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], len(texts))):
        yield texts.slice(start, end - start)


def coded_groups(texts: pa.Array, path: str) -> Iterator[tuple[pa.ListArray, pa.Array]]:
    """The ids of the texts and what these decode to, some texts at a time."""
    one = encoder(path)
    for group in groups(texts):
        found = one.encode_batch(group.to_pylist())
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        ends = np.cumsum([0, *map(len, found)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        yield ids, pa.array(one.decode_batch(flat, ends.tolist()), pa.string())


def coded(text: Column, path: str) -> Column:
    """``ids``, array<int>, of ``text``, and ``decoded``, the text they stand for, as a structure. Null and
    empty texts have no ids and decode to the empty text. One Python worker does both."""
    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for found in coded_groups(batch, path):
                yield pa.StructArray.from_arrays(found, ["ids", "decoded"])

    return both(text)


def encode(text: Column, path: str) -> Column:
    """``text`` as array<int> of token ids; null and empty texts have none."""
    return coded(text, path)["ids"]


def decode(ids: Column, path: str) -> Column:
    """The text of an array<int> of token ids; null for null, empty for none."""
    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode_batch = encoder(path).decode_batch
        for batch in batches:
            # Null rows have no ids in the flat list; their texts are null too.
            sizes = np.nan_to_num(pc.list_value_length(batch).to_numpy(zero_copy_only=False)).astype(np.int64)
            found = decode_batch(batch.flatten().to_numpy(zero_copy_only=False), [0, *np.cumsum(sizes).tolist()])
            yield pa.array(found, pa.string(), mask=batch.is_null().to_numpy(zero_copy_only=False))

    return text(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>), ``n_tokens`` and ``decoded``, the text the ids stand for.

    ``path`` is a vocabulary file that every executor can read. One row out per row in, whatever the
    ids of the rows; columns of these names are replaced. Null and empty texts have no tokens and
    decode to the empty text. An empty table gives an empty one.
    """
    docs, at, names = hidden(docs, "ids", "n_tokens", "decoded")
    rows = docs.withColumn("_coded", coded(F.col(at[text]), path))
    return restored(
        rows, names, F.col("_coded.ids").alias("ids"), F.size("_coded.ids").cast("bigint").alias("n_tokens"),
        F.col("_coded.decoded").alias("decoded"))
