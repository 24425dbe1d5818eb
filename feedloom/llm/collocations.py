"""Phrases whose words occur together more often than apart, by direct-address tiles of pair counts.

Words are numbered by frequency, so frequent pairs lie near the origin of the square of all pairs.
The square is cut into tiles. A tile with many pairs is one dense numpy array addressed by the pair
and filled by bincount; a tile with few is a sorted list of coordinates and counts. Pairs that are
frequent are numbered by frequency in their turn: a phrase of k + 1 words is a pair of the two
phrases of k words that overlap in it, so the same counting serves all lengths.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import partitions, placed, stored

#: Bits of a number inside its tile, and the share of a tile's cells above which it is counted
#: densely, if it is one of the NEAR x NEAR tiles at the origin; others have few pairs.
BITS, DENSE, NEAR = 9, 1 / 16, 16
CELLS = 1 << 2 * BITS
#: Bits of the second tile number in a code, numbers being below 2^31.
TILE_BITS = 31 - BITS
#: What a task holds before it passes it on: distinct pairs, distinct words.
PAIRS_HELD, WORDS_HELD = 2_000_000, 500_000
#: Pairs in a row between tasks.
CHUNK = 512
#: Bytes of the most frequent words or pairs that every task gets; the others are joined.
BROADCAST_BYTES = 16 << 20

#: Ends a piece; no byte of UTF-8 text.
BREAK = b"\xff"
LETTERS = bytes(range(65, 91))
STOPS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(LETTERS + STOPS + b"\t", LETTERS.lower() + BREAK * len(STOPS) + b" ")
SPACED = b" " + BREAK + b" "

#: Ascending codes of pairs with counts, by the group of tiles they belong to; ``least`` is the first code.
TILE_ROWS = "lang string, part int, salt int, least bigint, codes array<bigint>, counts array<bigint>"


def tokens(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, and BREAK between pieces."""
    return text.translate(TABLE).replace(BREAK, SPACED).split()


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, word, n); a null word counts all words of the language."""
    held: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            counter.pop(BREAK, None)
            words = [None, *counter]
            yield pa.record_batch({
                "lang": pa.array([lang] * len(words), pa.string()),
                "word": pa.array(words, pa.binary()).cast(pa.string()),
                "n": pa.array([sum(counter.values()), *counter.values()], pa.int64())})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            held.setdefault(lang, Counter()).update(tokens(text))
        if sum(map(len, held.values())) > WORDS_HELD:
            yield from flush()
    yield from flush()


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def compacted(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of -1 as one. A text's ids end with -1, so that texts end to end make no new pair."""
    known = ids >= 0
    keep = known.copy()
    keep[1:] |= known[:-1]
    ends = np.concatenate([[0], np.cumsum(keep)])
    return ids[keep], ends[offsets]


def sequence_rows(row: pa.Array, lang: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    ids, offsets = compacted(ids, offsets)
    return pa.record_batch({"row": row, "lang": lang, "ids": lists(offsets, pa.array(ids, pa.int32()))})


def word_ids(words: dict[str, dict[bytes, int]], others: bool) -> Callable:
    """Texts as numbers of words, -1 for breaks and words that have none. With ``others`` the words
    without a number are in ``rest`` with their places, and the ids keep these."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets, places, rest, rest_offsets = [], [0], [], [], [0]
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                known = words.get(lang, {})
                found = tokens(text)
                own = [known.get(word, -1) for word in found]
                if others:
                    new = [i for i, x in enumerate(own) if x < 0 and found[i] != BREAK]
                    places += new
                    rest += [found[i] for i in new]
                    rest_offsets.append(len(rest))
                own.append(-1)
                ids.append(np.array(own, dtype=np.int32))
                offsets.append(offsets[-1] + len(own))
            flat = np.concatenate(ids) if ids else np.array([], dtype=np.int32)
            if not others:
                yield sequence_rows(batch["row"], batch["lang"], flat, np.array(offsets))
                continue
            entries = pa.StructArray.from_arrays(
                [pa.array(places, pa.int32()), pa.array(rest, pa.binary()).cast(pa.string())], ["at", "key"])
            yield pa.record_batch({
                "row": batch["row"], "lang": batch["lang"],
                "ids": lists(np.array(offsets), pa.array(flat, pa.int32())),
                "rest": lists(np.array(rest_offsets), entries)})

    return number


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each language of a batch."""
    coded = batch["lang"].dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for code, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, batch.take(pa.array(np.flatnonzero(codes == code)))


def pair_keys(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a pair begins, and the pairs there as one number."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return at, ids[at].astype(np.int64) << 32 | ids[at + 1]


def pair_ids(pairs: dict[str, tuple[np.ndarray, np.ndarray]], others: bool) -> Callable:
    """Sequences as numbers of the pair that begins at each place; ``others`` as for words."""
    nothing = np.array([], dtype=np.int64), np.array([], dtype=np.int32)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lang, batch in by_language(whole):
                keys, numbers = pairs.get(lang, nothing)
                ids, offsets = flat_lists(batch["ids"])
                at, key = pair_keys(ids)
                out = np.full(len(ids), -1, dtype=np.int32)
                if len(keys):
                    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    out[at] = np.where(keys[place] == key, numbers[place], -1)
                if not others:
                    yield sequence_rows(batch["row"], batch["lang"], out, offsets)
                    continue
                new = out[at] < 0
                at, key = at[new], key[new]
                begin = np.searchsorted(at, offsets)
                within = at - offsets[np.searchsorted(offsets, at, side="right") - 1]
                entries = pa.StructArray.from_arrays(
                    [pa.array(within, pa.int32()), pa.array(key, pa.int64())], ["at", "key"])
                yield pa.record_batch({
                    "row": batch["row"], "lang": batch["lang"],
                    "ids": lists(offsets, pa.array(out, pa.int32())), "rest": lists(begin, entries)})

    return number


def patched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the numbers that a join has ``found`` in their places."""
    for batch in batches:
        ids, offsets = flat_lists(batch["ids"])
        found = batch["found"]
        entries = found.flatten()
        begin = np.repeat(offsets[:-1], np.diff(found.offsets.to_numpy()))
        ids = ids.copy()
        ids[begin + entries.field("at").to_numpy()] = entries.field("place").to_numpy()
        yield sequence_rows(batch["row"], batch["lang"], ids, offsets)


def tiled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs as codes that sort by tile and then by cell."""
    low = (1 << BITS) - 1
    left, right = left.astype(np.int64), right.astype(np.int64)
    return ((left >> BITS) << TILE_BITS + 2 * BITS | (right >> BITS) << 2 * BITS
            | (left & low) << BITS | right & low)


@dataclass(frozen=True)
class Spread:
    """How pairs are dealt to tasks: salts of the tile at the origin, groups of the far tiles, and the
    number of the task that counted."""

    salts: int
    groups: int
    task: int


def untiled(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, tile = (1 << BITS) - 1, (1 << TILE_BITS) - 1
    left = (codes >> TILE_BITS + 2 * BITS) << BITS | codes >> BITS & low
    return left, (codes >> 2 * BITS & tile) << BITS | codes & low


def summed(cells: np.ndarray, counts: np.ndarray | None) -> np.ndarray:
    """The counts of all cells of a tile. Weights are summed as floats, exact in two halves."""
    if counts is None:
        return np.bincount(cells, minlength=CELLS)
    low = np.bincount(cells, counts & 0xFFFFFFFF, CELLS).astype(np.int64)
    return low + (np.bincount(cells, counts >> 32, CELLS).astype(np.int64) << 32)


def counted(codes: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and their counts; without ``counts`` each is one occurrence."""
    left, right = codes >> TILE_BITS + 2 * BITS, codes >> 2 * BITS & (1 << TILE_BITS) - 1
    near = np.flatnonzero((left < NEAR) & (right < NEAR))
    tile = (left[near] * NEAR + right[near]).astype(np.int16)
    dense = np.bincount(tile, minlength=NEAR * NEAR) > CELLS * DENSE
    near, tile = near[dense[tile]], tile[dense[tile]]
    order = np.argsort(tile, kind="stable")
    near, tile = near[order], tile[order]
    found = []
    for at in np.split(near, np.flatnonzero(np.diff(tile)) + 1) if len(near) else []:
        total = summed(codes[at] & CELLS - 1, None if counts is None else counts[at])
        cells = np.flatnonzero(total)
        found.append((codes[at[0]] & ~(CELLS - 1) | cells, total[cells]))
    few = np.ones(len(codes), dtype=bool)
    few[near] = False
    rest = codes[few]
    order = np.argsort(rest, kind="stable")
    rest = rest[order]
    starts = np.flatnonzero(np.diff(rest, prepend=-1))
    if counts is None:
        sums = np.diff(starts, append=len(rest))
    else:
        sums = np.add.reduceat(counts[few][order], starts) if len(starts) else np.array([], dtype=np.int64)
    found.append((rest[starts], sums))
    codes, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(codes, kind="stable")
    return codes[order], counts[order]


def tile_rows(lang: str, codes: np.ndarray, counts: np.ndarray, spread: Spread) -> pa.RecordBatch:
    """Ascending codes as rows of at most CHUNK pairs of one group of tiles. A tile near the origin is a
    group and gets one of some salts, the fewer the farther it is; the others, of few pairs each, go
    into groups by hash."""
    tile = codes >> 2 * BITS
    left, right = tile >> TILE_BITS, tile & (1 << TILE_BITS) - 1
    near = (left < NEAR) & (right < NEAR)
    mixed = (tile.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
    part = np.where(near, left * NEAR + right, NEAR * NEAR + mixed % spread.groups)
    salt = np.where(near, spread.task % np.maximum(spread.salts // (1 + left + right), 1), 0)
    order = np.argsort(part, kind="stable")
    codes, counts, part, salt = codes[order], counts[order], part[order], salt[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    within = np.arange(len(codes)) - np.repeat(first, np.diff(first, append=len(codes)))
    starts = np.flatnonzero(within % CHUNK == 0)
    offsets = np.append(starts, len(codes))
    return pa.record_batch({
        "lang": pa.array([lang] * len(starts), pa.string()),
        "part": pa.array(part[starts], pa.int32()), "salt": pa.array(salt[starts], pa.int32()),
        "least": pa.array(codes[starts], pa.int64()),
        "codes": lists(offsets, pa.array(codes, pa.int64())),
        "counts": lists(offsets, pa.array(counts, pa.int64()))})


def pair_counts(salts: int, groups: int) -> Callable:
    """Counts of the neighbours in sequences, a task's own put together as far as it holds them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        spread = Spread(salts, groups, context.partitionId() if context else 0)
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for whole in batches:
            for lang, batch in by_language(whole):
                ids, _ = flat_lists(batch["ids"])
                at, _ = pair_keys(ids)
                new = counted(tiled(ids[at], ids[at + 1]), None)
                if lang in held:
                    new = counted(*(np.concatenate(x) for x in zip(held[lang], new)))
                held[lang] = new
            if sum(len(codes) for codes, _ in held.values()) > PAIRS_HELD:
                yield from (tile_rows(lang, *pairs, spread) for lang, pairs in held.items())
                held.clear()
        yield from (tile_rows(lang, *pairs, spread) for lang, pairs in held.items())

    return count


def merged_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The whole count of every pair, from rows that are sorted by language and first code. Codes
    below the first one of a batch's last row are in no later row; the others are held, each once."""
    held: tuple[str, np.ndarray, np.ndarray] | None = None
    for whole in batches:
        for lang, batch in by_language(whole):
            codes, counts = flat_lists(batch["codes"])[0], flat_lists(batch["counts"])[0]
            if held and held[0] != lang:
                yield held
            elif held:
                codes, counts = np.concatenate([held[1], codes]), np.concatenate([held[2], counts])
            codes, counts = counted(codes, counts)
            done = np.searchsorted(codes, batch["least"][-1].as_py())
            yield lang, codes[:done], counts[:done]
            held = lang, codes[done:], counts[done:]
    if held:
        yield held


def merge_salts(groups: int) -> Callable:
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, counts in merged_tiles(batches):
            yield tile_rows(lang, codes, counts, Spread(1, groups, 0))

    return merge


def frequent(least: int) -> Callable:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, counts in merged_tiles(batches):
            often = counts >= least
            left, right = untiled(codes[often])
            yield pa.record_batch({
                "lang": pa.array([lang] * len(left), pa.string()), "a": pa.array(left, pa.int64()),
                "b": pa.array(right, pa.int64()), "f": pa.array(counts[often], pa.int64())})

    return keep


def frequent_pairs(sequences: DataFrame, least: int) -> DataFrame:
    """The pairs (lang, a, b, f) that occur at least ``least`` times. Partial counts of a tile meet
    under several salts first, so that no task takes in those of all others."""
    parts = partitions(sequences)
    partial = sequences.select("lang", "ids").mapInArrow(pair_counts(math.isqrt(parts), parts), TILE_ROWS)
    salted = partial.repartition(parts, "lang", "part", "salt").sortWithinPartitions("lang", "least").mapInArrow(
        merge_salts(parts), TILE_ROWS)
    return salted.repartition(parts, "lang", "part").sortWithinPartitions("lang", "least").mapInArrow(
        frequent(least), "lang string, a bigint, b bigint, f bigint")


def light_part(table: DataFrame, weight: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the lowest places that weigh at most BROADCAST_BYTES in sum, and the others, None
    if there are none. Places are cut at powers of two, so the driver sees a few dozen sums."""
    step = F.floor(F.log2(F.col("place") + 1))
    sums = dict(table.groupBy(step.alias("step")).agg(F.expr(f"sum({weight})").alias("w")).collect())
    most, total = 0, 0
    while most in sums and total + sums[most] <= BROADCAST_BYTES:
        total += sums[most]
        most += 1
    return table.where(step < most), table.where(step >= most) if most in sums else None


SEQUENCE = "row bigint, lang string, ids array<int>"


def joined(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Sequences with the numbers of ``others`` (lang, key, place) put in by a join of ``rest``. Frequent
    keys went another way, so no key of the join has a large share of the rows."""
    rows = stored(rows)
    found = (rows.select("row", "lang", F.inline("rest")).join(others, ["lang", "key"])
             .groupBy("row").agg(F.collect_list(F.struct("at", F.col("place").cast("int").alias("place"))).alias("found")))
    nothing = F.array().cast("array<struct<at:int,place:int>>")
    return rows.drop("rest").join(found, "row", "left").withColumn(
        "found", F.coalesce("found", nothing)).mapInArrow(patched, SEQUENCE)


def word_sequences(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(row, lang, text) as sequences of the places of ``words`` (lang, key, place)."""
    light, others = light_part(words, "octet_length(key) + 16")
    known: dict[str, dict[bytes, int]] = {}
    for lang, key, place in light.select("lang", "key", "place").toPandas().itertuples(index=False):
        known.setdefault(lang, {})[key.encode()] = place
    return numbered(texts, word_ids, known, others, "string")


def pair_sequences(sequences: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sequences of the places of ``pairs`` (lang, key, place) that begin at each place."""
    light, others = light_part(pairs, "16")
    known = {}
    for lang, rows in light.select("lang", "key", "place").orderBy("lang", "key").toPandas().groupby("lang"):
        known[lang] = rows["key"].to_numpy(), rows["place"].to_numpy().astype(np.int32)
    return numbered(sequences, pair_ids, known, others, "bigint")


def numbered(rows: DataFrame, function: Callable, known: dict, others: DataFrame | None, key: str) -> DataFrame:
    value = rows.sparkSession.sparkContext.broadcast(known)
    more = f", rest array<struct<at:int,key:{key}>>" if others is not None else ""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(value.value, others_too)(batches)

    others_too = others is not None
    found = rows.mapInArrow(number, SEQUENCE + more)
    return stored(joined(found, others.select("lang", "key", "place")) if others_too else found)


def mine(docs: DataFrame, least: int = 30, longest: int = 4, covered: int = 80, top: int = 2000,
         text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases per language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; A-Z is lower-cased. A phrase of 2
    to ``longest`` words that occurs ``a`` >= ``least`` times is cut after each word into parts that occur
    ``l`` and ``r`` times and scores floor(2,000,000 a / (l + r)) at its lowest cut, the first of equal
    ones. Phrases inside a longer one with at least ``covered`` percent of their count go. ``n`` counts
    the words of the language. Equal scores go by ``a``, then by the phrase.

    A null language is ``und``. Null, empty and blank texts have no words, a repeated row counts again,
    other columns aren't read. An empty table gives an empty result.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    counts = stored(
        texts.select("lang", "text").mapInArrow(word_counts, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | F.col("word").isNull()))
    totals = counts.where("word is null").select("lang", F.col("f").alias("n"))
    words = stored(placed(
        counts.where("word is not null").select("lang", F.col("word").alias("key"), "f"), "lang", F.desc("f"), "key"
    ).select("lang", "key", "f", "place"))
    sequences = word_sequences(texts, words)
    level = words.select("lang", "place", "f", F.array("key").alias("words"),
                         F.array("f").alias("first"), F.array("f").alias("last"))
    levels = [level]
    for k in range(2, longest + 1):
        pairs = stored(frequent_pairs(sequences, least))
        key = F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("key")
        pairs = stored(placed(pairs.select("lang", "a", "b", "f", key), "lang", F.desc("f"), "key").select(
            "lang", "a", "b", "f", "key", "place"))
        if k < longest:
            sequences = pair_sequences(sequences, pairs)
        left = level.select("lang", F.col("place").alias("a"), "words", "first")
        right = level.select("lang", F.col("place").alias("b"), F.element_at("words", -1).alias("word"), "last")
        level = stored(pairs.join(left, ["lang", "a"]).join(right, ["lang", "b"]).select(
            "lang", "place", "a", "b", "f", F.array_append("words", F.col("word")).alias("words"),
            F.array_append("first", F.col("f")).alias("first"), F.array_append("last", F.col("f")).alias("last")))
        levels.append(level)
    found = None
    for k, level in enumerate(levels[1:], 2):
        if k < longest:
            # What a phrase of any length covers, the phrases of one word more inside it cover too.
            longer = levels[k].select("lang", F.inline(F.array(
                *[F.struct(F.col(side).alias("place"), F.col("f").alias("cover")) for side in ("a", "b")])))
            longer = longer.groupBy("lang", "place").agg(F.max("cover").alias("cover"))
            level = level.join(longer, ["lang", "place"], "left").where(
                "cover is null or cast(cover as decimal(20, 0)) * 100 < cast(f as decimal(20, 0)) * "
                f"{int(covered)}")
        cut = F.expr(
            f"""array_min(transform(sequence(1, {k - 1}), m -> named_struct(
              'score', cast(f as decimal(20, 0)) * 2000000 div
                (cast(first[m - 1] as decimal(20, 0)) + cast(last[{k - 1} - m] as decimal(20, 0))),
              'm', m, 'l', first[m - 1], 'r', last[{k - 1} - m])))""")
        level = level.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), cut.alias("cut"))
        found = level if found is None else found.unionAll(level)
    found = found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs))).alias("part")
    best = found.select("*", part)
    for window in (Window.partitionBy("lang", "part"), Window.partitionBy("lang")):
        best = best.withColumn("rank", F.row_number().over(window.orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
