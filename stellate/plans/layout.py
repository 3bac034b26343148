"""Physical layout that readers can prune: folders rewritten one by one, folders chosen at run time, files clustered by a range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.plans.warehouse import write_counted
from stellate.session import stage

RANGES = "_ranges"


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the folders (values of ``by``) that ``df`` holds; all others keep their files.

    ``df`` must not read ``path`` itself: stage it first.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def reload_partitions(spark: SparkSession, path: str, by: Sequence[str], where: Column, change) -> int:
    """Rewrite the rows of the folders that ``where`` (on ``by``) selects by ``change``; returns the rows written.

    The changed rows are staged in the shared folder before any folder is
    replaced, so a failing change leaves the table as it was.  Rows that the
    change moves out of the selected folders are refused, for they would replace
    the folder they move to.
    """
    rows = stage(change(spark.read.parquet(path).where(where)), "reload")
    if not rows.where(~F.coalesce(where, F.lit(False))).isEmpty():
        raise ValueError("the change moves rows out of the folders that are reloaded")
    overwrite_partitions(rows, path, by)
    return rows.count()


def join_pruned(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, how: str = "inner") -> DataFrame:
    """Join a fact with one folder per ``fact_key`` to a filtered dimension, so that only folders the filter leaves are read.

    The dimension's rows are known at run time only; Spark runs it first and
    hands its keys to the fact's scan (dynamic partition pruning).  That needs a
    filter on the dimension and the fact's folder column as the join key, and
    an inner or semi join, so the fact's other folders cannot matter.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("folders can only be left out by an inner or semi join")
    return fact.join(dimension, fact[fact_key] == dimension[dimension_key], how)


def write_clustered(df: DataFrame, path: str, sort_by: Sequence[str], files: int, row_group_bytes: int | None = None) -> int:
    """Write about ``files`` files, each with its own range of ``sort_by``, rows sorted, and a list of the files' ranges beside them.

    Ranges are split by sampled quantiles of the whole sort key, so a hot leading
    value spreads over several files when later columns tell its rows apart.
    Each file's smallest and largest leading value go to ``<path>/_ranges`` (a row
    per file), which ``read_range`` reads first.
    """
    writer = df.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by)
    rows = write_counted(writer, path) if row_group_bytes is None else _write_sized(writer, path, row_group_bytes)
    lead = F.col(sort_by[0])
    spark = df.sparkSession
    spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(lead).alias("low"), F.max(lead).alias("high"), F.count(F.lit(1)).alias("rows"), F.count_if(lead.isNull()).alias("nulls"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")
    return rows


def _write_sized(df: DataFrame, path: str, row_group_bytes: int) -> int:
    df.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def read_range(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high`` of a clustered table: only files whose range meets it are opened, and row groups outside
    are skipped by the pushed filter.  ``column`` is the leading sort column."""
    met = spark.read.parquet(f"{path}/{RANGES}").where((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    files = [r["file"] for r in met.select("file").orderBy("file").collect()]  # a row per file that is read
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files]).where(F.col(column).between(F.lit(low), F.lit(high)))
