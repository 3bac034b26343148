"""Parquet table scans and source row counts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema for scans that only count rows.
NO_COLUMNS = T.StructType([])

# Error conditions of a folder that does not exist yet or holds no file.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

# Names of the tables shipped with the test data (one parquet file each).
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(base: str, name: str) -> str:
    """``<base>/<name>.parquet``."""
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Scan one parquet table; ``columns`` narrows the ReadSchema at the scan.

    The schema is read from the files each time, so a rewritten table shows its new columns.
    """
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none yet; other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in _ABSENT:
            return None
        raise


def table_counts(
    spark: SparkSession, base: str, names: Iterable[str] = TABLES
) -> DataFrame:
    """(table_name, row_count) for every table, in one job.

    Each branch reads no columns at all (empty ReadSchema): parquet answers the
    count from row-group metadata, so the cost does not grow with row width.
    The empty schema is also declared up front, which skips schema inference
    (a footer read per table on the driver).
    """
    parts = [
        spark.read.schema(NO_COLUMNS).parquet(table_path(base, n))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, parts)
