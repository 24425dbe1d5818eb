"""Helpers shared by the operators on documents: words, shingles, row keys, ranges, storage."""

from __future__ import annotations

import math
import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.sources.files import set_checkpoint_dir

SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
LEAST = -(1 << 63)


def or_empty(text: str | Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_array(text: Column) -> Column:
    """The runs of characters other than ASCII white space; null and blank texts have none."""
    trimmed = F.btrim(or_empty(text), F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, GAP)).otherwise(
        F.array().cast("array<string>"))


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` computed exactly once per row. The optimiser may move an expression
    into the filters and loops that use it; it does not look through a generator."""
    return df.select("*", F.inline_outer(F.array(F.struct(
        *[value.alias(name) for name, value in columns.items()]))))


def shingle_hashes(words: str, length: int = 5) -> Column:
    """A 64-bit hash per run of ``length`` words of the array column ``words``.

    A shorter, non-empty text is one shingle as a whole. ``words`` has to be a column computed
    before, not an expression, as each run refers to it ``length`` times.
    """
    last = F.greatest(F.size(words) - length, F.lit(0))
    runs = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(length)]))
    return F.when(F.size(words) > 0, runs).otherwise(F.array().cast("array<bigint>"))


def with_row_key(df: DataFrame, name: str, salt: str = "") -> DataFrame:
    """``df`` with 128 bits of md5 over all its columns: the same for equal rows, whatever they
    hold. Pinned, as the optimiser would else write the columns out in each condition on the key."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return pinned(df, **{name: F.md5(F.concat(F.lit(salt), row))})


def hidden(docs: DataFrame, *replaced: str) -> tuple[DataFrame, dict[str, str], list[str]]:
    """``docs`` without the columns ``replaced`` and with names that no operator uses for its own,
    the new name per old one, and the old names, for ``restored``. So columns of any name pass."""
    docs = docs.drop(*replaced)
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names)), docs.columns


def restored(df: DataFrame, names: list[str], *more: str | Column) -> DataFrame:
    return df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], *more)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_starts(df: DataFrame, key: str, parts: int) -> list[int]:
    """The first key of each of at most ``parts`` ranges that hold about as many rows.

    ``key`` is a non-null bigint. The starts are keys that occur, the least key among them. The
    sketches are merged in two levels, so no task takes in more than a 64th of them; the driver
    gets ``parts`` numbers.
    """
    ranks = ", ".join(f"{i / parts}D" for i in range(parts))
    found = (
        df.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
        .agg(F.expr(f"kll_sketch_agg_bigint({key}, 400)").alias("sketch"), F.min(key).alias("least"))
        .agg(F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"), F.min("least").alias("least"))
        .where("least is not null")
        .selectExpr("least", f"kll_sketch_get_quantile_bigint(sketch, array({ranks})) as starts")
        .head()
    )
    return sorted({found["least"], *found["starts"]}) if found else []


def range_of(key: Column, starts: list[int]) -> Column:
    """The index of the last start at or below ``key``. Two levels, so that a row is compared with
    about twice the square root of the number of ranges."""
    if len(starts) < 2:
        return F.lit(0)
    stride = math.isqrt(len(starts))
    groups = [starts[i:i + stride] for i in range(0, len(starts), stride)]

    def literal(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("bigint") for v in values])

    def below(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda n, v: n + F.when(v <= key, 1).otherwise(0))

    coarse = F.greatest(below(literal([g[0] for g in groups])) - 1, F.lit(0))
    fine = F.get(F.array(*[literal(g) for g in groups]), coarse)
    return coarse * stride + F.greatest(below(fine) - 1, F.lit(0))


def placed(df: DataFrame, group: str, *order: str | Column) -> DataFrame:
    """``df`` with ``place`` (from 0) and ``members``, a row's place among the rows of its ``group`` by
    ``order`` and their number. Rows equal in group and order come in any order, once.

    One sort over all tasks, whatever the size of a group: a row's number is the number of rows in
    the partitions before its own plus its index there, less that of the group's first row. A last
    key splits rows that are equal otherwise. ``df`` should be stored, as the sort reads it twice.
    ``group`` isn't null. The columns ``_row``, ``_part`` and ``_shift`` are the function's own.
    """
    low = (1 << 33) - 1
    rows = stored(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(partitions(df), group, *order, "_row")
        .sortWithinPartitions(group, *order, "_row")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_row", 33), "_row": F.col("_row").bitwiseAND(F.lit(low))}))
    # A row per partition of a group, so that the join meets a large group in as many parts. The
    # window runs over a row per partition, whose number is a setting.
    seen = stored(rows.groupBy("_part", group).agg(F.min("_row").alias("_least"), F.count("*").alias("n")))
    before = seen.groupBy("_part").agg(F.sum("n").alias("n")).select("_part", (
        F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    seen = seen.join(F.broadcast(before), "_part")
    groups = seen.groupBy(group).agg(
        F.min(F.col("_least") + F.col("_before")).alias("_first"), F.sum("n").alias("members"))
    shifts = stored(seen.join(groups, group).select(
        "_part", group, "members", (F.col("_before") - F.col("_first")).alias("_shift")))
    return rows.join(shifts, ["_part", group]).withColumn(
        "place", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def broadcast_if_light(df: DataFrame, weight: str, most: int) -> DataFrame:
    """``df`` with a broadcast hint if the sum of the expression ``weight`` over its rows, which
    should follow its size in memory, is at most ``most``. For rows of unbounded width, where a
    count of rows bounds nothing."""
    total = df.selectExpr(f"sum({weight})").head()[0] or 0
    return F.broadcast(df) if total <= most else df


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder, which all executors share, so that
    a lost executor costs no recomputation. The folder is the one the cluster names in
    spark.checkpoint.dir; a cluster that names none and has no shared warehouse is refused."""
    set_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the Python workers, once per application, for sessions that were
    started without it. The archive of it lies with the driver; Spark copies it to the workers."""
    _ship(spark.sparkContext)


@lru_cache(maxsize=1)
def _ship(context: SparkContext) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(package.rglob("*.py")):
            file.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
