"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Documents are partitioned by their number of shingles (powers of two). A MinHash signature has one
bin per prefix of the hash, and the least hash of a bin stands for it. Containment t of an item of q
shingles in a document of up to u means a Jaccard likeness of at least t q / (u + (1 - t) q), and
each partition takes as many bins for an item as find that likeness with the wanted certainty. An
item of few shingles can meet only in those, and each may be hidden by a smaller hash of its bin, so
it takes as many bins as that calls for. Bins
are nested, so one pass over a document's sorted hashes gives the signatures of all sizes: a hash
stands for its bin of b bits if it differs from the hash before it within the first b bits.

A shingle of many items would pair each document that holds it with all of them. An item that has
enough other shingles does without such hot ones: a document with containment t lacks few of its
shingles, so it holds some of any larger set of them. How many bins a document and an item must share
follows from that, and is counted before any text is read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import broadcast_if_light, hidden, pinned, restored, shingle_hashes, stored, word_array
from feedloom.operators.skew import broadcast_if_small

#: A shingle of more items than this is hot.
HOT_ITEMS = 8
#: Rows of hashes or candidates that may be broadcast; beyond that they are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Shingles of all items that may be broadcast as text, each item counting for 40 at least.
BROADCAST_SHINGLES = 400_000


def signature_rows(df: DataFrame, text: Column, words: int, keep: list[str]) -> DataFrame:
    """``keep``, ``total`` distinct shingles and, per shingle, its ``hash`` and ``bits``: the
    least number of bits at which it stands for its bin."""
    df = df.select(*keep, word_array(F.lower(text)).alias("_w"))
    df = df.select(*keep, F.sort_array(F.array_distinct(shingle_hashes("_w", words))).alias("_h"))
    all_but_last = F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 1, F.lit(0)))
    before = F.concat(F.array(F.lit(None).cast("bigint")), all_but_last)
    df = df.select(*keep, F.size("_h").alias("total"), F.inline_outer(F.arrays_zip(
        F.col("_h").alias("hash"), before.alias("before"))))
    differ = F.col("hash").bitwiseXOR(F.col("before"))
    bits = F.when(differ.isNull(), 0).when(differ < 0, 1).otherwise(65 - F.length(F.bin(differ)))
    return df.where("hash is not null").select(*keep, "total", "hash", bits.alias("bits"))


def fewest(total: Column, least: float) -> Column:
    """Shingles that a document with containment ``least`` shares with an item of ``total``."""
    return F.ceil(total * least - 1e-9)


def load(shared: Column, miss: float) -> Column:
    """Hashes per bin at which all of ``shared`` common shingles are hidden with the chance ``miss``.

    At a load of x a shared shingle is hidden by a smaller hash of its bin with the chance
    1 - (1 - exp(-x)) / x. Both first guesses lie below the root, and each step goes nearer to it from
    there.
    """
    hidden_ = F.pow(F.lit(miss), 1 / shared)
    low = F.greatest(2 * hidden_, hidden_ / (1 - hidden_))
    return F.when(hidden_ < 0.1, low).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.lit(12)), low, lambda x, _: (1 - F.exp(-x)) / (1 - hidden_)))


def upper(total: Column) -> Column:
    """Documents of ``total`` shingles are taken as large as their partition gets."""
    return F.pow(F.lit(2.0), F.floor(F.log2(total.cast("double"))) + 1)


def union(total: Column, item_total: Column, least: float) -> Column:
    """Shingles of a document and an item that it contains, at most."""
    return upper(total) + item_total * (1 - least)


def bins(union: Column, shared: Column, item_load: Column, miss: float) -> Column:
    """Bits of the signature at a ``union`` of so many shingles: as many as both bounds ask for, that
    of the likeness and that of the few shingles that are ``shared``. From 64 bits on the signature is
    all hashes."""
    return F.ceil(F.log2(F.greatest(union / shared * -math.log(miss), union / item_load)))


def needed(union: Column, shared: Column, bits: Column, miss: float) -> Column:
    """Bins that are common at least, but for a chance of ``miss``. A shared shingle is hidden with the
    chance x / 2 at most, x being the load, so k of ``shared`` ones are with (shared x / 2)^k at most."""
    chance = shared * union / F.pow(F.lit(2.0), bits) / 2
    lost = F.when(chance < 1, F.ceil(F.lit(math.log(miss)) / F.log(chance))).otherwise(shared)
    return F.greatest(shared - F.when(bits < 64, lost).otherwise(0), F.lit(1))


def shingle_texts(words: str, length: int) -> Column:
    last = F.greatest(F.size(words) - length, F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(
        " ", *[F.get(F.col(words), i + j) for j in range(length)]))
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(
        F.array().cast("array<string>"))


def find_contained(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
    text: str = "text", words: int = 5, least: float = 0.8, miss: float = 1e-6,
) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` with ``shared`` and ``item_shingles`` (distinct shingles) and
    ``containment`` >= ``least``, one per matching pair of rows.

    Case does not count. Null and blank texts contain nothing and are contained in nothing; an item
    of fewer words than a shingle is one shingle as a whole. A pair at exactly ``least`` is missed
    with a chance of about ``miss`` at most. Candidates are found per distinct text, so copies cost
    nothing extra, and the exact check runs on the texts of candidates only. Ids may be null or
    repeated, other columns are not looked at, and an empty side gives an empty table.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.md5(text).alias("_key"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("item"),
                         F.md5(text).alias("_item_key")).where("item is not null")
    found = candidates(docs, items, words, least, miss)
    pairs = docs.join(broadcast_if_small(found, BROADCAST_ROWS)[0], "_key")
    named = pinned(items, _words=word_array(F.lower("item"))).select(
        "item_id", "_item_key", shingle_texts("_words", words).alias("wanted"))
    pairs = pairs.join(broadcast_if_light(named, "40 + size(wanted)", BROADCAST_SHINGLES), "_item_key")
    pairs = pinned(pairs, _words=word_array(F.lower("text")))
    pairs = pinned(pairs, shared=F.size(F.array_intersect(
        shingle_texts("_words", words), "wanted")).cast("bigint"))
    total = F.size("wanted").cast("bigint")
    pairs = pairs.where(F.col("shared") / total >= least)
    return pairs.select(
        F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), "shared",
        total.alias("item_shingles"), (F.col("shared") / total).alias("containment"))


def wanted_hashes(items: DataFrame, words: int, least: float, miss: float) -> DataFrame:
    """Per distinct item text (``_item_key``) the hashes that documents are searched for, with their bits,
    ``item_total``, ``shared`` (of these hashes, those that a document with the wanted containment holds
    at least) and ``item_load``.

    All hashes that are not hot, and of the hot ones, the least frequent first, as many as make
    ``shared`` at least 1. An item's rows are as many as its shingles.
    """
    rows = stored(signature_rows(items.dropDuplicates(["_item_key"]), F.col("item"), words, ["_item_key"]))
    common = rows.groupBy("hash").agg(F.count("*").alias("items"))
    rows = rows.join(common, "hash")
    place = F.row_number().over(Window.partitionBy("_item_key").orderBy("items", "hash"))
    cold = F.count_if(F.col("items") <= HOT_ITEMS).over(Window.partitionBy("_item_key"))
    lacking = F.col("total") - fewest(F.col("total"), least)
    return stored(
        rows.withColumns({"place": place, "taken": F.greatest(cold, lacking + 1)}).where("place <= taken")
        .select("_item_key", "hash", F.col("bits").alias("item_bits"), F.col("total").alias("item_total"),
                (F.col("taken") - lacking).alias("shared"))
        .withColumn("item_load", load(F.col("shared"), miss)))


def candidates(
    docs: DataFrame, items: DataFrame, words: int, least: float, miss: float
) -> DataFrame:
    """Distinct (``_key``, ``_item_key``) of a document's and an item's text with as many common bins as
    containment calls for."""
    wanted = wanted_hashes(items, words, least, miss)
    scarcest, lightest = wanted.agg(F.min("shared"), F.min("item_load")).head()
    if scarcest is None:
        return docs.sparkSession.createDataFrame([], "_key string, _item_key string")
    rows = signature_rows(docs, F.col("text"), words, ["_key"])
    # A document contains no item of more than total / least shingles; so many bits no item exceeds.
    rows = rows.where(F.col("bits") <= bins(
        upper(F.col("total")) / least, F.lit(scarcest), F.lit(lightest), miss))
    either = union(F.col("total"), F.col("item_total"), least)
    use = bins(either, F.col("shared"), F.col("item_load"), miss)
    found = rows.join(broadcast_if_small(wanted, BROADCAST_ROWS)[0], "hash").where(
        (F.col("bits") <= use) & (F.col("item_bits") <= use))
    # Copies of a text bring each hash again, so hashes are counted once.
    return stored(
        found.groupBy("_key", "_item_key", needed(either, F.col("shared"), use, miss).alias("needed"))
        .agg(F.collect_set("hash").alias("hashes")).where(F.size("hashes") >= F.col("needed"))
        .select("_key", "_item_key"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text contains an item; all columns kept. A row without a
    text stays."""
    docs, at, names = hidden(docs)
    keyed = docs.withColumn("key", F.md5(at[text]))
    found = find_contained(keyed.select("key", F.col(at[text]).alias("text")), items.select(
        "item_id", F.col(text).alias("text")), doc_id="key", **options)
    leaked = stored(found.select("key").distinct())
    return restored(
        keyed.join(broadcast_if_small(leaked, BROADCAST_ROWS)[0], "key", "left_anti"), names)
