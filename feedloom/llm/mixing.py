"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree.

A source's target in words gives every document of it the same expected number of copies. The
fractional parts are rounded in pairs: mass in words moves from one document of a pair to the other
at random until one of them is integral, so expectations hold for each document and the words of
the source stay exactly as they were. A leaf of the tree rounds a few thousand documents and hands
one fractional document on; the root rounds the last one, so a source misses its target by less
than the words of one document.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import hidden, restored, stored, with_row_key, word_array

#: Documents that one leaf rounds on average, and leaves below one inner node.
LEAF, FAN_IN = 4096, 256


def targets(sizes: dict, weights: Callable[[int], float], share: float, cap: float) -> dict:
    """Target words per source. Sources in order of code points, null last, weigh ``weights(0)``,
    ``weights(1)`` and so on and share ``share`` times all words. No target exceeds ``cap`` times
    its source; what is over goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights(i) for i, s in enumerate(order)}
    out, left = {}, share * sum(sizes.values())
    free = list(order)
    while free:
        unit = left / sum(weight[s] for s in free) if left > 0 else 0.0
        full = [s for s in free if unit * weight[s] >= cap * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in free}
        out |= {s: float(cap * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out


def pivot(chance: list[float], words: list[float], draws: list[float]) -> tuple[list, int, float]:
    """Decisions (0 or 1, None for the one left over), the index of the one left over (-1 if none)
    and its chance. ``chance`` lies in (0, 1), ``words`` is positive."""
    decided: list = [None] * len(chance)
    i, p = -1, 0.0
    for j, q in enumerate(chance):
        if i < 0:
            i, p = j, q
            continue
        v, w = words[i], words[j]
        to_i, to_j = min((1 - p) * v, q * w), min(p * v, (1 - q) * w)
        if draws[j] * (to_i + to_j) < to_j:
            if (1 - p) * v <= q * w:
                decided[i], i, p = 1, j, q - to_i / w
            else:
                decided[j], p = 0, p + to_i / v
        elif p * v <= (1 - q) * w:
            decided[i], i, p = 0, j, q + to_j / w
        else:
            decided[j], p = 1, p - to_j / v
        if p <= 1e-12 or p >= 1 - 1e-12:
            decided[i], i = round(p), -1
    return decided, i, p


NODE = "source_no int, node bigint, row string, chance double, words double, extra int"


def rounded_node(level: int, seed: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        rng = np.random.default_rng(
            [seed, level, int(rows["source_no"][0]), int(rows["node"][0])])
        decided, left, p = pivot(
            rows["chance"].tolist(), rows["words"].tolist(), rng.random(len(rows)).tolist())
        if left >= 0 and last:
            decided[left] = int(rng.random() < p)
        elif left >= 0:
            rows.loc[left, "chance"] = p
        rows["extra"] = pd.array(decided, "Int32")
        return rows

    return run


def mix(
    docs: DataFrame, weights: Callable[[int], float], share: float, cap: int = 2, seed: int = 0,
    source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies`` (0 to ``cap``).

    Null and blank texts have no words and get copies at their chance, drawn from their key. A null
    source is a source of its own. Rows that are equal in all columns are rounded together and
    share what they get evenly. Columns of these four names are replaced, all others are kept. An
    empty table gives an empty one. Draws depend on the rows' content and ``seed``, so reruns and
    recomputed tasks agree. The driver holds one number per source; documents only meet in nodes of
    a few thousand, however large their source is.
    """
    spark = docs.sparkSession
    docs, at, names = hidden(docs, "size", "source_size", "target", "copies")
    keyed = with_row_key(docs, "_row")
    rows = stored(
        keyed.select("_row", F.col(at[source]).cast("string").alias("_source"),
                     F.size(word_array(F.col(at[text]))).cast("bigint").alias("size"))
        .groupBy("_row", "_source", "size").agg(F.count("*").alias("times")))
    totals = {r[0]: (r[1], r[2]) for r in rows.groupBy("_source").agg(
        F.sum(F.col("size") * F.col("times")), F.count("*")).collect()}
    goal = targets({s: size for s, (size, _) in totals.items()}, weights, share, cap)
    leaves = {s: -(-n // LEAF) for s, (_, n) in totals.items()}
    table = spark.createDataFrame(
        [(s, i, size, float(goal[s]), goal[s] / size if size else 0.0, leaves[s])
         for i, (s, (size, _)) in enumerate(sorted(totals.items(), key=lambda x: (x[0] is None, x[0])))],
        "_name string, source_no int, source_size bigint, target double, rate double, leaves bigint")
    rows = rows.join(table, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name", "_source")
    # Rows of one key together expect ``times`` times the rate; what is open is one copy of them.
    expected = F.col("times") * F.col("rate")
    whole = F.floor(expected + 1e-9)
    chance = F.greatest(expected - whole, F.lit(0.0))
    rows = rows.withColumns({"whole": whole, "chance": F.when(chance > 1e-9, chance).otherwise(0.0)})
    open_rows = rows.where("chance > 0 and size > 0").select(
        "source_no", F.pmod(F.xxhash64("_row"), F.col("leaves")).alias("node"),
        F.col("_row").alias("row"), "chance",
        F.col("size").cast("double").alias("words"), F.lit(None).cast("int").alias("extra"))
    extras = reduced(open_rows, max(leaves.values(), default=1), seed)
    hashed = F.xxhash64("_row", F.lit(seed)) / F.lit(float(1 << 64)) + 0.5
    rows = rows.join(extras, rows["_row"] == extras["row"], "left").withColumn("_total", F.col("whole") + F.when(
        F.col("size") > 0, F.coalesce("extra", F.lit(0))).otherwise((hashed < F.col("chance")).cast("int")))
    rows = stored(rows.select("_row", "size", "source_size", "target", "times", "_total"))
    out = keyed.join(rows, "_row")
    if rows.where("times > 1").isEmpty():
        copies = F.col("_total")
    else:
        nth = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
        copies = F.floor(F.col("_total") / F.col("times")) + (
            nth <= F.col("_total") % F.col("times")).cast("int")
    return restored(out, names, "size", "source_size", "target", copies.cast("int").alias("copies"))


def reduced(rows: DataFrame, leaves: int, seed: int) -> DataFrame:
    """``row`` and ``extra`` (0 or 1) of every row, rounded up the tree."""
    done, level = [], 0
    while True:
        last = leaves <= 1
        rounded = stored(rows.groupBy("source_no", "node").applyInPandas(
            rounded_node(level, seed, last), NODE))
        done.append(rounded.where("extra is not null").select("row", "extra"))
        if last:
            break
        rows = rounded.where("extra is null").withColumn(
            "node", F.floor(F.col("node") / FAN_IN).cast("bigint"))
        leaves, level = -(-leaves // FAN_IN), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def mixed_rows(docs: DataFrame, *args, **options) -> DataFrame:
    """``docs`` with each row as often as its copies say, columns as they were."""
    docs, at, names = hidden(docs)
    options = {"source": "source", "text": "text"} | options
    options |= {k: at[options[k]] for k in ("source", "text")}
    mixed = mix(docs, *args, **options).where("copies > 0")
    # An outer explode: the optimiser derives no further filter from it.
    return restored(mixed.select("*", F.explode_outer(F.sequence(F.lit(1), F.col("copies")))), names)
