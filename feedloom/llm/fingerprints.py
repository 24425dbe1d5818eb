"""Document fingerprints: threshold-scaled sketches of word shingles, as columns.

A sketch keeps every shingle hash below a threshold, a fixed fraction of the hash space. Two
sketches hold all their hashes below the lower of their thresholds, so containment can be
estimated between texts of very unequal length, and the sketch of a union is the union of sketches.
A text with few hashes below the fixed threshold has a higher one of its own, so that it keeps
KEPT hashes, or all it has: two short texts are compared exactly.

A short text against one of more than about SCALE * KEPT shingles is compared by its hashes below
the fixed threshold alone, about one in SCALE of n shingles. None is there with the chance
(1 - 1 / SCALE) ** n, 26 % at 10 shingles and 1.4 % at 32, and then nothing is known of the pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import (
    LEAST,
    or_empty,
    partitions,
    range_of,
    range_starts,
    shingle_hashes,
    word_array,
)

#: Share of the hash space that is always kept, as its divisor, and the hashes kept at least.
SCALE, KEPT = 8, 32
THRESHOLD, ALL = LEAST + (1 << 64) // SCALE, (1 << 63) - 1


def with_sketch(df: DataFrame, text: Column, name: str, words: int = 5) -> DataFrame:
    """``df`` with the sketch struct (``threshold``, sorted ``hashes``) of ``text`` as ``name``.

    Case does not count. A text of fewer words is one shingle; null and blank texts have an empty
    sketch with the highest threshold. The steps are columns of their own, so none is computed
    again for each shingle.
    """
    w, h, t = f"_{name}_words", f"_{name}_hashes", f"_{name}_threshold"
    df = df.withColumn(w, word_array(F.lower(text)))
    df = df.withColumn(h, F.sort_array(F.array_distinct(shingle_hashes(w, words)))).drop(w)
    own = F.when(F.size(h) <= KEPT, F.lit(ALL)).otherwise(
        F.greatest(F.lit(THRESHOLD), F.get(h, F.lit(KEPT - 1))))
    df = df.withColumn(t, own)
    hashes = F.filter(h, lambda x: x <= F.col(t))
    return df.withColumn(name, F.struct(F.col(t).alias("threshold"), hashes.alias("hashes"))).drop(h, t)


def below(sketch: Column, threshold: Column) -> Column:
    return F.filter(sketch["hashes"], lambda x: x <= threshold)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of a's text that b's text has; 1 for equal sketches, else 0
    where a has no hash below the common threshold. So a short text that is wholly contained in a
    long one can get 0: with n shingles at a chance of (1 - 1 / SCALE) ** n, and the estimate of
    others rests on about n / SCALE hashes."""
    common = F.least(a["threshold"], b["threshold"])
    mine = below(a, common)
    share = F.size(F.array_intersect(mine, below(b, common))) / F.size(mine)
    return F.when(a == b, F.lit(1.0)).when(F.size(mine) == 0, F.lit(0.0)).otherwise(share)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of the two texts' shingles; 1 for equal sketches."""
    common = F.least(a["threshold"], b["threshold"])
    mine, other = below(a, common), below(b, common)
    share = F.size(F.array_intersect(mine, other)) / F.size(F.array_union(mine, other))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    common = F.least(a["threshold"], b["threshold"])
    return F.struct(common.alias("threshold"),
                    F.sort_array(F.array_union(below(a, common), below(b, common))).alias("hashes"))


def merged_by(df: DataFrame, by: list[str], sketch: str) -> DataFrame:
    """One sketch per group: the hashes of all below the group's lowest threshold."""
    lowest = df.groupBy(*by).agg(F.min(f"{sketch}.threshold").alias("_lowest"))
    hashes = df.select(*by, F.explode_outer(f"{sketch}.hashes").alias("_hash")).distinct()
    same = [hashes[c].eqNullSafe(lowest[c]) for c in by]
    kept = hashes.join(lowest, same).drop(*[lowest[c] for c in by]).withColumn(
        "_hash", F.when(F.col("_hash") <= F.col("_lowest"), F.col("_hash")))
    return kept.groupBy(*by, "_lowest").agg(F.sort_array(F.collect_list("_hash")).alias("hashes")).select(
        *by, F.struct(F.col("_lowest").alias("threshold"), "hashes").alias(sketch))


def as_text(sketch: Column) -> Column:
    """The sketch as hexadecimal numbers: the threshold, a colon, the hashes."""
    def number(x: Column) -> Column:
        return F.lower(F.lpad(F.hex(x), 16, "0"))

    return F.concat(number(sketch["threshold"]), F.lit(":"),
                    F.concat_ws("", F.transform(sketch["hashes"], number)))


def with_next(docs: DataFrame, order: str, ties: list[str], columns: list[str]) -> DataFrame:
    """``docs`` with ``next_`` and the name for each of ``columns``, taken from the next row by the
    bigint column ``order`` (null first) and ``ties``; after the last row comes the first.

    Rows go to ranges of ids; the first rows of each range also visit the range before, at its end.
    So each range is a window of its own and no task sees the whole order. Rows that are equal in
    all these columns are neighbours in any order. A single row is its own next one; an empty table
    gives an empty one.
    """
    key = "_order"
    keyed = docs.withColumn(key, F.coalesce(order, F.lit(LEAST).cast("bigint")))
    # Null ids share the least number; a flag keeps them before a real id of that value.
    starts = range_starts(keyed.select(key), key, 4 * partitions(docs)) or [LEAST]
    n = len(starts)
    own = range_of(F.col(key), starts)
    is_start = F.get(F.array(*[F.lit(s).cast("bigint") for s in starts]), own) == F.col(key)
    visits = F.when(is_start, F.array(
        F.struct(own.alias("range"), F.lit(0).alias("late")),
        F.struct(F.pmod(own - 1, F.lit(n)).alias("range"), F.lit(1).alias("late")),
    )).otherwise(F.array(F.struct(own.alias("range"), F.lit(0).alias("late"))))
    spread = keyed.withColumn("_visit", F.explode(visits)).select(
        "*", "_visit.range", "_visit.late").drop("_visit")
    line = Window.partitionBy("range").orderBy(
        "late", key, F.col(order).isNotNull(), *ties)
    following = {f"next_{c}": F.lead(c).over(line) for c in columns}
    return spread.withColumns(following).where("late = 0").drop(key, "range", "late")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter replaced by as many code points from the front of
    ``following``, or by all of it."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter),
                    F.substring(following, F.lit(1), quarter))


def fingerprint_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_chars``, ``sketch`` of the text, ``edited`` text and its
    sketch, and the sketch of the next document.

    The next document is the next by ``doc_id`` (null first, equal ids by text); the last one's is
    the first. Null texts count as empty. Other columns are not looked at. A text travels once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), or_empty(F.col(text)).alias("text"))
    rows = with_sketch(rows, F.col("text"), "sketch", words)
    rows = with_next(rows, "doc_id", ["text"], ["text", "sketch"])
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = with_sketch(rows, F.col("edited"), "edited_sketch", words)
    return rows.select(
        F.col("doc_id").alias(doc_id), F.length("text").cast("bigint").alias("n_chars"), "sketch",
        "edited", "edited_sketch", "next_sketch")
