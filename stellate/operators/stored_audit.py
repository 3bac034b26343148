"""Completeness audit from stored counts of each partition.

Counts of rows and of non-null values add up over partitions.  They are stored
once a partition, with a mark of the partition's files (names, lengths, times);
an audit lists the files, reads only partitions whose mark changed, and adds the
rest from the store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.sources.tables import read_if_present

_FILE = r"([^/]+)$"


def partition_marks(spark: SparkSession, path: str, by: str) -> DataFrame:
    """(part, mark): a digest of the files of every folder ``by=<value>``, from the listing alone (no file is opened)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    named = files.select(
        F.regexp_extract("path", rf"/{by}=([^/]+)/[^/]+$", 1).alias("part"), F.regexp_extract("path", _FILE, 1).alias("file"),
        F.col("length"), F.col("modificationTime").alias("at"),
    ).where("part <> ''")
    # a sum of row hashes does not depend on order and needs no list in one place
    one = F.xxhash64("file", "length", F.unix_micros("at"))
    return named.groupBy("part").agg(F.sum(one.cast("decimal(38,0)")).alias("mark"), F.count(F.lit(1)).alias("files"))


def count_partitions(spark: SparkSession, path: str, by: str, columns: Sequence[str], parts: Sequence[str] | None = None) -> DataFrame:
    """(part, total, n_<column>...): rows and non-null values of each folder; ``parts`` limits the folders that are read."""
    df = spark.read.parquet(path)
    key = F.coalesce(F.col(by).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    if parts is not None:
        df = df.where(key.isin(list(parts)))  # on the folder column: the others are not listed for the scan
    return df.groupBy(key.alias("part")).agg(F.count(F.lit(1)).alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in columns])


def audit_partitions(spark: SparkSession, path: str, by: str, columns: Sequence[str], store: str) -> tuple[DataFrame, list[str]]:
    """(column_name, non_null, total, pct over the whole table; folders that were read).

    ``store`` keeps part, mark and counts; it is replaced as a whole after each
    audit that read anything (a row per folder).  A folder whose files changed, a new folder, and columns
    that the store lacks are counted again; folders that are gone leave it.
    """
    marks = partition_marks(spark, path, by)
    held = read_if_present(spark, store)
    names = [f"n_{c}" for c in columns]
    if held is None or not set(names) <= set(held.columns):
        known = spark.createDataFrame([], "part string, mark decimal(38,0), total long, " + ", ".join(f"`{n}` long" for n in names))
    else:
        known = held.select("part", "mark", "total", *names)
    now = {r["part"]: r["mark"] for r in marks.collect()}  # a row per folder
    kept = [r for r in known.collect() if now.get(r["part"]) == r["mark"]]
    fresh = sorted(set(now) - {r["part"] for r in kept})
    rows = [tuple(r) for r in kept]
    if fresh:
        counted = {r["part"]: r for r in count_partitions(spark, path, by, columns, fresh).collect()}
        for part in fresh:
            r = counted.get(part)  # files without rows count nothing
            rows.append((part, now[part], *((r["total"], *[r[n] for n in names]) if r else (0, *[0] * len(names)))))
    counts = spark.createDataFrame(rows, known.schema)
    if fresh or len(rows) != len(kept) or held is None:
        counts.coalesce(1).write.mode("overwrite").parquet(store)
    total = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    long = total.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(n).alias("non_null")) for c, n in zip(columns, names)])).alias("r"))
    return long.select("r.column_name", "r.non_null", "total", F.try_divide(F.col("r.non_null") * 100.0, F.col("total").cast("double")).alias("pct")), fresh
