"""Reading the nine relational inputs."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contracts import COLUMN_KINDS, FILLED, KINDS, REQUIRED_TABLES, SOURCE_COLUMNS, TABLE_KEYS


def from_parquet(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables stored as ``root``/<name>."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in SOURCE_COLUMNS}


def from_catalog(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Tables and views of the catalog."""
    prefix = f"{database}." if database else ""
    return {name: spark.table(prefix + name) for name in SOURCE_COLUMNS}


def from_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    ranges: dict[str, tuple[str, object, object, int]] | None = None,
) -> dict[str, DataFrame]:
    """Tables of a live database.

    ``options`` holds url, user, password, driver and the like. ``ranges`` gives per table the
    column, lower bound, upper bound and number of parallel range queries; a table without one is
    read by a single task, which suits the small tables only. Only needed columns are fetched.
    """
    return {
        name: jdbc_reader(spark, options, name, (ranges or {}).get(name)).load().select(*columns)
        for name, columns in SOURCE_COLUMNS.items()
    }


def jdbc_reader(spark: SparkSession, options: dict[str, str], table: str, split: tuple | None):
    """The configured reader of one table."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    for key, value in jdbc_split(split).items():
        reader = reader.option(key, value)
    return reader


def jdbc_split(split: tuple | None) -> dict[str, str]:
    if split is None:
        return {}
    column, low, high, parts = split
    return {
        "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
        "numPartitions": str(parts),
    }


def missing_tables(
    spark: SparkSession, names: list[str] = REQUIRED_TABLES, database: str | None = None
) -> list[str]:
    """Names the catalog does not know."""
    prefix = f"{database}." if database else ""
    return [name for name in names if not spark.catalog.tableExists(prefix + name)]


def missing_columns(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Columns the dataset build reads but a given table lacks, per table."""
    gaps = {
        name: [c for c in columns if name not in tables or c not in tables[name].columns]
        for name, columns in SOURCE_COLUMNS.items()
    }
    return {name: columns for name, columns in gaps.items() if columns}


def column_kind(name: str) -> str:
    """The kind of an input column; those without another are numbers."""
    return next((kind for kind, names in COLUMN_KINDS.items() if name in names), "number")


def wrong_types(tables: dict[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Columns whose type the build can't use, with that type, per table. Read off the schemas, so a
    database's tables are checked without a query for rows."""
    faults = {}
    for name, columns in SOURCE_COLUMNS.items():
        found = dict(tables[name].dtypes) if name in tables else {}
        bad = {c: found[c] for c in columns if c in found
               and re.split("[(<]", found[c])[0] not in KINDS[column_kind(c)]}
        if bad:
            faults[name] = bad
    return faults


def null_keys(tables: dict[str, DataFrame]) -> dict[str, dict[str, int]]:
    """Rows without a value that the build needs, per table and column: one narrow scan a table."""
    faults = {}
    for name, columns in FILLED.items():
        present = [c for c in columns if name in tables and c in tables[name].columns]
        if present:
            found = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present]).head()
            bad = {c: found[c] for c in present if found[c]}
            if bad:
                faults[name] = bad
    return faults


def faults(tables: dict[str, DataFrame]) -> dict[str, dict]:
    """Everything a build could stumble over, by the name of the check; the cheap checks first, and
    no rows are read if they fail."""
    found = {"missing columns": missing_columns(tables), "wrong types": wrong_types(tables)}
    if not any(found.values()):
        found |= {"null keys": null_keys(tables), "repeated keys": repeated_keys(tables)}
    return {check: fault for check, fault in found.items() if fault}


def key_counts(table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key. Null keys match nothing and may repeat."""
    return table.dropna(subset=keys).groupBy(*keys).count()


def repeated_keys(tables: dict[str, DataFrame]) -> dict[str, dict]:
    """One key that occurs twice, per table that has such."""
    found = {}
    for name, keys in TABLE_KEYS.items():
        if name in tables:
            rows = key_counts(tables[name], keys).where("count > 1").take(1)
            if rows:
                found[name] = {k: rows[0][k] for k in keys}
    return found


def repeated_key_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table its distinct keys, and how many of them occur more than once."""
    out = None
    for name, keys in TABLE_KEYS.items():
        rows = key_counts(tables[name], keys).selectExpr(
            f"'{name}' as table_name", "count(*) as keys", "count_if(count > 1) as repeated")
        out = rows if out is None else out.unionByName(rows)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Parquet data can be read at ``path``, on any file system Spark knows."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
