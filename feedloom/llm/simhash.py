"""Near-duplicate groups by SimHash: a grid range-join on segment popcounts, verified exactly.

A fingerprint is cut into 32 segments of two bits. The vector of the segments' bit counts is its
embedding: the Manhattan distance of two embeddings is at most the number of differing bits, so it
is a lower bound. The join works on a grid over that space, with one cell per vector of half the
segments: where two embeddings are at most 3 apart, they are at most 1 apart in one of the halves,
so one of the two reaches the other's cell by raising at most one count. Candidates pass the
Manhattan bound on all segments first, then the exact bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import hidden, partitions, restored, stored, with_row_key
from feedloom.llm.components import components, forest

SEED, LOW_BITS = 42, np.uint64(0x5555555555555555)
#: Rows of a cell that one task joins with the others at a time; larger cells are split by this.
CELL = 4096
#: Pairs compared at once, and shingles counted at once.
PAIRS, SHINGLES = 1 << 21, 1 << 16


def simhash(text: str | None, length: int) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > length:
        begins, ends = begins[:len(words) - length + 1], ends[length - 1:]
    else:
        begins, ends = begins[:1], ends[-1:]
    n, digest, counts = len(begins), xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        pairs = zip(begins[at:at + SHINGLES].tolist(), ends[at:at + SHINGLES].tolist())
        hashes = np.array([digest(joined[b:e], SEED) for b, e in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, length: int) -> Column:
    """SimHash of the ``length``-word shingles of the text, ASCII letters lower-cased; bigint."""
    @F.pandas_udf("bigint")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([simhash(text, length) for text in batch], dtype="int64")

    return compute(text)


def embed(prints: np.ndarray) -> np.ndarray:
    """Each two-bit segment's popcount in unary (00, 01, 11): the number of bits in which two such
    codes differ is the Manhattan distance of the popcount vectors."""
    shifted = prints >> np.uint64(1)
    return ((prints | shifted) & LOW_BITS) | ((prints & shifted & LOW_BITS) << np.uint64(1))


def grid_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row in its own cell of each half (role 0), and one in each cell that a raised count
    leads to (role 1)."""
    for batch in batches:
        prints = batch["fingerprint"].to_numpy().view(np.uint64)
        codes = embed(prints)
        for half in (0, 1):
            code = (codes >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            cells, who, roles = [code], [prints], [np.zeros(len(prints), np.int8)]
            for bit in range(32):
                flag = np.uint64(1 << bit)
                raised = (code & flag) == 0
                if bit % 2:
                    raised &= (code & np.uint64(1 << (bit - 1))) != 0
                cells.append(code[raised] | flag)
                who.append(prints[raised])
                roles.append(np.ones(int(raised.sum()), np.int8))
            yield pd.DataFrame({
                "cell": np.concatenate(cells).astype(np.int64) + (half << 32),
                "role": np.concatenate(roles), "fingerprint": np.concatenate(who).view(np.int64)})


def joined_cells(bits: int):
    """Links within cells. Rows come sorted by cell, part and role; of a cell that goes on in the
    next batch its own rows are kept, at most about CELL of them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            fresh = 0 if kept is None else len(kept)
            cell, part = rows["cell"].to_numpy(), rows["part"].to_numpy()
            own = rows["role"].to_numpy() == 0
            starts = np.flatnonzero(np.concatenate(
                [[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])]))
            sizes = np.diff(np.append(starts, len(rows)))
            owners = np.add.reduceat(own, starts, dtype=np.int64)
            yield from links(rows["fingerprint"].to_numpy(), starts, owners, sizes, fresh, bits)
            last = rows.iloc[starts[-1]:]
            kept = last[own[starts[-1]:]]

    return run


def links(prints, starts, owners, sizes, fresh: int, bits: int) -> Iterator[pd.DataFrame]:
    """A forest of the links between the first ``owners`` rows of each cell and all its rows. Rows
    before ``fresh`` were compared with each other before."""
    prints = prints.view(np.uint64)
    useful = np.flatnonzero((owners > 0) & (sizes > 1))
    # Blocks of a cell's owners against all its rows, PAIRS at a time.
    rows_at_once = np.maximum(1, PAIRS // sizes[useful])
    blocks = -(-owners[useful] // rows_at_once)
    which = np.repeat(useful, blocks)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    step = np.repeat(rows_at_once, blocks)
    left_from = starts[which] + nth * step
    left_n = np.minimum(step, owners[which] - nth * step)
    pairs = left_n * sizes[which]
    group = np.cumsum(pairs) // PAIRS
    for g in np.unique(group):
        m = np.flatnonzero(group == g)
        of = np.repeat(np.arange(len(m)), pairs[m])
        r = np.arange(int(pairs[m].sum())) - np.repeat(np.cumsum(pairs[m]) - pairs[m], pairs[m])
        width = sizes[which[m]][of]
        i, j = left_from[m][of] + r // width, starts[which[m]][of] + r % width
        # Two owners meet once, and rows kept from the batch before do not meet again.
        new = (i < j) & (j >= fresh)
        a, b = prints[i[new]], prints[j[new]]
        near = np.bitwise_count(embed(a) ^ embed(b)) <= bits
        a, b = a[near], b[near]
        near = (np.bitwise_count(a ^ b) <= bits) & (a != b)
        if near.any():
            node, root = forest(a[near].view(np.int64), b[near].view(np.int64))
            yield pd.DataFrame({"a": node, "b": root})


def near_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fingerprint``s within ``bits`` of each other.

    Cells with many rows are split into parts of about CELL of their own rows, each met by all rows
    of the cell, so no task holds a large group. From each block only a spanning forest of its
    links comes out, not the pairs. Two cells per half serve up to 3 bits.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the grid of two halves reaches 3 bits at most")
    rows = stored(prints.mapInPandas(grid_rows, "cell bigint, role tinyint, fingerprint bigint"))
    large = rows.where("role = 0").groupBy("cell").count().where(f"count > {CELL}").select(
        "cell", F.ceil(F.col("count") / CELL).cast("int").alias("parts"))
    if large.isEmpty():
        rows = rows.withColumn("part", F.lit(0))
    else:
        own_part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
        parts = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(
            F.col("role") == 0, F.array(own_part)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        # Own rows also visit the other parts of their cell, there like raised ones.
        visits = F.when(F.col("role") == 0, F.filter(
            F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != own_part))
        rows = rows.join(large, "cell", "left")
        rows = rows.withColumn("part", F.explode(parts)).unionByName(
            rows.where("parts is not null and role = 0").withColumn("part", F.explode(visits))
            .withColumn("role", F.lit(1).cast("tinyint")))
    rows = rows.select("cell", "part", "role", "fingerprint")
    return (
        rows.repartition(partitions(rows), "cell", "part")
        .sortWithinPartitions("cell", "part", "role")
        .mapInPandas(joined_cells(bits), "a bigint, b bigint")
    )


def grouped(rows: DataFrame, bits: int) -> DataFrame:
    """``fingerprint`` and ``root``, the least fingerprint that it reaches, for each that has a
    neighbour within ``bits``. ``rows`` should be stored, as it is read for the fingerprints."""
    links_ = near_links(rows.select("fingerprint").distinct(), bits)
    return components(links_, "a", "b").withColumnRenamed("node", "fingerprint")


def with_roots(rows: DataFrame, bits: int) -> DataFrame:
    roots = grouped(rows, bits)
    return rows.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, bits: int = 3
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint) and ``component_id`` per row of ``docs``.

    ``component_id`` is the smallest id of the documents reachable over links of at most ``bits``
    differing bits; ids that are null do not count, a group without another id gets null. Null and
    wordless texts have the fingerprint 0 and link like any other. Equal texts, repeated rows and
    ids are all kept; other columns are not looked at; an empty table gives an empty one. Only
    distinct fingerprints take part in the join, so a group of copies of any size is one of them.
    """
    rows = stored(docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), length).alias("fingerprint")))
    roots = stored(grouped(rows, bits))
    firsts = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(
        roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = firsts.groupBy("root").agg(F.min("least").alias("component_id"))
    named = firsts.join(ids, "root").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(
        F.col("doc_id").alias(doc_id), "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, bits: int = 3
) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (null ids last), between
    rows of one id the one whose key over all columns is smallest. All columns are kept."""
    key = "key"
    docs, at, names = hidden(docs)
    keyed = with_row_key(docs, key)
    rows = stored(keyed.select(
        F.col(at[doc_id]).alias("doc_id"), key,
        fingerprint(F.col(at[text]), length).alias("fingerprint")))
    roots = grouped(rows, bits)
    firsts = rows.groupBy("fingerprint").agg(first_row(F.struct("doc_id", key)).alias("first"))
    kept = (
        firsts.join(roots, "fingerprint", "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root"))
        .agg(first_row(F.col("first")).alias("first"))
        .select(F.col(f"first.{key}").alias(key))
    )
    return restored(keyed.join(kept, key, "left_semi").dropDuplicates([key]), names)


def first_row(row: Column) -> Column:
    """The least struct of an id and a key, null ids last."""
    return F.min_by(row, F.struct(row["doc_id"].isNull(), row))
