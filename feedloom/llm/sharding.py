"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in source buckets. How many rows go from each bucket to each shard is drawn first, exactly
as a uniform permutation of all rows would send them; then each bucket permutes its rows locally
and deals them out by these counts, and each shard permutes what it got.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import hidden, partitions, restored, with_row_key

#: Standard deviations around the mode within which a count is drawn; less than 1e-30 lies beyond.
REACH = 12
#: Sections of shards per partition of the exchange.
SECTIONS = 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good items among ``drawn`` ones out of ``good`` + ``bad``, by inversion around the mode. The
    cost follows the standard deviation, and there is no limit on the numbers."""
    least, most = max(0, drawn - bad), min(drawn, good)
    if least == most:
        return least
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), least), most)
    spread = np.sqrt(drawn / total * good * (bad / total) * ((total - drawn) / max(1, total - 1)))
    width = int(REACH * spread) + 40
    lo, hi = max(least, mode - width), min(most, mode + width)
    k = np.arange(lo, hi, dtype=np.float64)
    ratio = (good - k) / (k + 1) * ((drawn - k) / (bad - drawn + k + 1))  # of k + 1 to k
    log = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    weight = np.cumsum(np.exp(log - log.max()))
    return lo + min(int(np.searchsorted(weight, rng.random() * weight[-1], "right")), hi - lo)


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows from each bucket to each shard, with ``counts`` as row sums and ``sizes`` as column
    sums, as a uniform permutation distributes them."""
    rng = np.random.default_rng(seed)
    left = list(sizes)
    matrix = np.zeros((len(counts), len(sizes)), np.int64)
    for i, drawn in enumerate(counts):
        rest = sum(left)
        for j, size in enumerate(left):
            rest -= size
            matrix[i, j] = got = hypergeometric(rng, size, rest, drawn)
            drawn -= got
            left[j] -= got
    return matrix


def even_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def permuted(at: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of ``at`` (0 to ``size`` - 1) in a permutation of that many places, which ``key``
    selects: a Feistel network over the next power of four, walked until it is inside."""
    out, todo = at.astype(np.uint64), np.arange(len(at))
    size = size.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(int) + 1) // 2 + 1)
    half, key = half.astype(np.uint64), key.astype(np.uint64)
    while len(todo):
        shift, chosen = half[todo], key[todo]
        mask = (np.uint64(1) << shift) - np.uint64(1)
        left, right = out[todo] >> shift, out[todo] & mask
        for turn in range(6):
            left, right = right, left ^ (mixed(right, chosen + np.uint64(turn)) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def mixed(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A 64-bit hash by multiplication and shifts."""
    z = x * np.uint64(0x9E3779B97F4A7C15) + (key + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return z ^ (z >> np.uint64(31))


def slot_in_shard(shard: Column, arrival: Column, size: Column, seed: int) -> Column:
    """Where a shard's second permutation puts the row that arrives as number ``arrival``."""
    @F.pandas_udf("bigint")
    def compute(shard: pd.Series, arrival: pd.Series, size: pd.Series) -> pd.Series:
        key = mixed(shard.to_numpy(np.uint64), np.full(len(shard), seed % (1 << 64), np.uint64))
        return pd.Series(permuted(arrival.to_numpy(), size.to_numpy(), key))

    return compute(shard, arrival, size)


def shuffle_into_shards(
    docs: DataFrame, shards: int, seed: int = 0, buckets: int | None = None
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard),
    the rows exchanged by shard and sorted by slot inside a partition.

    The numbers of rows in two shards differ by one at most. All columns are kept; columns of these
    two names are replaced. A row's place depends on its content, the seed and the numbers of
    buckets and shards alone, so a recomputed task deals the same rows the same way; rows that are
    equal in all columns are interchangeable. Nulls and empty texts are content like any other, and
    an empty table gives an empty one. The driver handles one number per bucket and shard. A bucket
    or section is one group of rows chosen by hash, so copies with ids of their own spread evenly.
    ``buckets`` is the number of partitions by default. Rows travel twice.
    """
    n = buckets or max(shards, partitions(docs))
    docs, _, names = hidden(docs, "shard", "slot")
    dealt = with_row_key(docs, "_key", f"{seed}:").withColumn(
        "_bucket", F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(n)).cast("int"))
    counts = {r[0]: r[1] for r in dealt.groupBy("_bucket").count().collect()}
    known = sorted(counts)
    sizes = even_sizes(sum(counts.values()), shards)
    matrix = communication_matrix([counts[b] for b in known], sizes, seed)
    ends, arrived = matrix.cumsum(axis=1), matrix.cumsum(axis=0) - matrix
    plan = docs.sparkSession.createDataFrame(
        # What to add to a row's rank in its bucket to get its number of arrival in the shard.
        [(b, e.tolist(), (a - e + m - 1).tolist()) for b, e, a, m in zip(known, ends, arrived, matrix)],
        "_bucket int, _ends array<bigint>, _shift array<bigint>")
    local = Window.partitionBy("_bucket").orderBy("_key")
    shard = F.aggregate("_ends", F.lit(0), lambda s, end: s + (end < F.col("_rank")).cast("int"))
    size = F.get(F.array(*[F.lit(s).cast("bigint") for s in sizes]), F.col("shard"))
    sent = (
        dealt.withColumn("_rank", F.row_number().over(local))
        .join(F.broadcast(plan), "_bucket")
        .withColumn("shard", shard)
        .withColumns({"_size": size, "_arrival": F.col("_rank") + F.get("_shift", F.col("shard"))})
        .withColumn("slot", slot_in_shard(F.col("shard"), F.col("_arrival"), F.col("_size"), seed))
    )
    # Sections of a shard, so that a partition holds runs of slots and no whole shard; several per
    # partition, as they meet there by hash.
    section = F.floor(F.col("slot") * F.lit(max(1, SECTIONS * n // shards)) / F.col("_size"))
    sent = sent.withColumn("_section", section).repartition(n, "shard", "_section")
    return restored(sent.sortWithinPartitions("shard", "slot"), names, "shard", "slot")
