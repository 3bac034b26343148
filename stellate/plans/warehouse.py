"""Writing, loading and laying out warehouse tables.

Row counts come from an ``Observation`` attached to the write itself, so a
table is computed once, not once to write and again to count.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.contract import NOT_NULL, PRIMARY_KEY, Contract, apply_contract
from stellate.operators.profile import largest_share
from stellate.sources.tables import NO_COLUMNS


def write_counted(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    sample_rows: int | None = None,
    sample_order: Sequence[str] | None = None,
) -> int:
    """Write ``df`` and return the number of rows written (one pass).

    ``sample_rows`` writes only the first rows by ``sample_order`` (a trial
    load of a few rows per table).
    """
    if sample_rows is not None:
        order = list(sample_order) if sample_order else df.columns[:1]
        df = df.orderBy(*order).limit(sample_rows)
    obs = Observation(f"write_{uuid.uuid4().hex}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def write_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    sample_rows: int | None = None,
    parallel: int = 4,
    sample_order: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Write each table under ``base/<name>``; report (table_name, rows, seconds, path).

    ``sample_rows`` writes the first rows of each table by ``sample_order[name]``,
    by default by all its columns, so the sample is the same each time.
    Up to ``parallel`` writes run as concurrent Spark jobs, so small tables
    use free task slots instead of waiting for the largest one to finish.
    """

    def _one(item: tuple[str, DataFrame]) -> tuple[str, int, float, str]:
        name, df = item
        path = f"{base.rstrip('/')}/{name}"
        t0 = time.perf_counter()
        order = (sample_order or {}).get(name) or [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        rows = write_counted(df, path, sample_rows=sample_rows, sample_order=order)
        return name, rows, time.perf_counter() - t0, path

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        report = list(pool.map(_one, tables.items()))
    return spark.createDataFrame(
        report, "table_name string, rows long, seconds double, path string"
    )


def read_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, actual) by reading each written table back (metadata-only count)."""
    parts = [
        spark.read.schema(NO_COLUMNS).parquet(p).agg(F.count(F.lit(1)).alias("actual")).select(
            F.lit(name).alias("table_name"), "actual"
        )
        for name, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_table(
    spark: SparkSession,
    source_path: str,
    contract: Contract,
    target_path: str | None = None,
    table_name: str | None = None,
    mode: str = "overwrite",
    optional: Sequence[str] = (),
) -> DataFrame:
    """Load a parquet table into a contract *by column name*, then store it (a missing column is an error unless ``optional``).

    Stored at ``target_path`` (files), or as catalog table ``table_name``;
    with both, the catalog table is external at ``target_path`` (a shared
    folder rather than the session's warehouse folder).  Returns the loaded
    data read back from storage (lineage cut).
    """
    src = spark.read.parquet(source_path)
    shaped = apply_contract(src, contract, optional)
    if table_name:
        writer = shaped.write.mode(mode).format("parquet")
        if target_path:
            writer = writer.option("path", target_path)
        writer.saveAsTable(table_name)
        return spark.table(table_name)
    if not target_path:
        raise ValueError("give target_path or table_name")
    shaped.write.mode(mode).parquet(target_path)
    return spark.read.parquet(target_path)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """``DROP TABLE IF EXISTS`` for each name (absent tables are fine)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_tables(
    spark: SparkSession, contracts: Sequence[Contract], base: str, prefix: str = ""
) -> dict[str, str]:
    """Create an empty parquet table per contract under ``base/<name>``.

    Returns contract name -> catalog table name.  Locations are explicit, so
    the tables live in the shared folder rather than a machine-local warehouse.
    CHAR widths are part of the column types, so Spark refuses longer values at
    every insert; Spark does not check NOT NULL or keys of Parquet tables, so
    these go to table properties, from which ``insert_checked`` enforces them.
    """
    made = {}
    for c in contracts:
        table = f"{prefix}{c.name}"
        held = ", ".join(f"'{k}' = '{v}'" for k, v in c.properties().items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({c.column_ddl()}) USING parquet "
            f"TBLPROPERTIES ({held}) LOCATION '{base.rstrip('/')}/{c.name}'"
        )
        made[c.name] = table
    return made


def table_constraints(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """Columns that must not be NULL, and the primary key, as the catalog holds them."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}  # a row per property
    return {k: [c for c in held.get(k, "").split(",") if c] for k in (NOT_NULL, PRIMARY_KEY)}


def insert_checked(df: DataFrame, table: str, overwrite: bool = False) -> int:
    """Insert into a catalog table by column *name*, under the constraints that the table itself holds; returns rows inserted.

    A NULL in a NOT NULL column, a key that repeats in ``df`` or (when appending)
    is stored already, or a value longer than its CHAR width fails the insert as a
    whole: nothing of ``df`` is stored.  A missing or extra column is refused.
    """
    spark = df.sparkSession
    target = spark.table(table)
    if set(df.columns) != set(target.columns):
        raise ValueError(f"{table}: columns {sorted(set(df.columns) ^ set(target.columns))} are not in both table and data")
    rules = table_constraints(spark, table)
    keys = rules[PRIMARY_KEY]
    if keys:
        rows = df.select(*[F.col(f"`{k}`") for k in keys], F.lit(1).alias("_own"))
        if not overwrite:
            rows = rows.unionByName(target.select(*[F.col(f"`{k}`") for k in keys], F.lit(0).alias("_own")))
        twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_own").alias("_own")).where("_n > 1 and _own = 1")
        first = twice.limit(1).collect()
        if first:
            raise ValueError(f"{table}: key {[first[0][k] for k in keys]} would be stored {first[0]['_n']} times")
    return _insert(df.select(*[F.col(f"`{c}`") for c in target.columns]), rules[NOT_NULL], table, overwrite)


def _insert(shaped: DataFrame, required: Sequence[str], table: str, overwrite: bool) -> int:
    refused = {c: F.when(F.col(f"`{c}`").isNull(), F.raise_error(F.lit(f"{table}: {c} is null"))).otherwise(F.col(f"`{c}`")) for c in required}
    obs = Observation(f"insert_{uuid.uuid4().hex}")
    shaped.withColumns(refused).observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=overwrite)
    return int(obs.get["rows"])


def insert_by_name(df: DataFrame, contract: Contract, table: str, overwrite: bool = False, optional: Sequence[str] = ()) -> int:
    """Insert into a contract table matching columns by *name*; returns rows inserted.

    ``insertInto`` is positional, so the frame is first shaped to the
    contract's column order by name with tolerant casts (``apply_contract``).  A
    NULL in a NOT NULL column or a value beyond its CHAR width fails the insert.
    """
    return _insert(apply_contract(df, contract, optional), [c.name for c in contract.columns if not c.nullable], table, overwrite)


def choose_buckets(
    df: DataFrame, rows_per_bucket: int = 4_000_000, max_buckets: int = 65_536
) -> int:
    """Bucket count from the data volume: about ``rows_per_bucket`` rows per
    bucket, at least the cluster's default parallelism.

    Tables that will be joined must share one count: size it on the larger.
    A table that asks for more than ``max_buckets`` is refused: raise the
    bound or ``rows_per_bucket`` knowingly, instead of getting larger buckets.
    """
    rows = df.count()
    floor = df.sparkSession.sparkContext.defaultParallelism
    buckets = int(max(floor, -(-rows // rows_per_bucket)))
    if buckets > max_buckets:
        raise ValueError(f"{rows} rows ask for {buckets} buckets, more than {max_buckets}")
    return buckets


def save_bucketed(
    df: DataFrame,
    table_name: str,
    key: Sequence[str],
    buckets: int,
    path: str | None = None,
    mode: str = "overwrite",
    files_per_bucket: int | None = None,
) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``key`` as a catalog table.

    Two tables bucketed the same way on the join key join without a shuffle.
    ``path`` makes it an external table in a shared folder.  A bucket is
    written as up to ``files_per_bucket`` files by as many tasks, dealt by a
    hash of the whole row (the same on a retry), so a key holding a large
    share of the rows does not land in one write task.  By default the number
    follows the largest key's share: one file for an even table.
    """
    if files_per_bucket is None:
        files_per_bucket = max(1, -(-int(largest_share(df, key) * buckets * 1000) // 1000))
    if files_per_bucket == 1:
        # one shuffle into exactly the bucket layout: one file per bucket instead of one per (task, bucket)
        laid_out = df.repartition(buckets, *key)
    else:
        bucket = F.pmod(F.hash(*key), F.lit(buckets))  # the hash that bucketBy uses
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_bucket))
        laid_out = df.repartition(buckets * min(files_per_bucket, 8), bucket, salt)
    writer = laid_out.write.mode(mode).format("parquet").bucketBy(buckets, *key).sortBy(*key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    files_per_value: int | None = None,
) -> int:
    """Write with one directory per value of ``by`` (enables partition pruning).

    Without ``files_per_value`` every task writes one file per value it
    holds.  With it, rows are first shuffled on (``by``, salt) where the salt
    is a hash of the whole row modulo ``files_per_value``: each value is
    written by that many tasks at most, and a value holding a large share of
    the rows is still spread over several writers.  The salt is a hash, not a
    random number, so a retried task sends every row to the same place.
    """
    if files_per_value:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(*[F.col(c) for c in by], salt)
    return write_counted(df, path, mode=mode, partition_by=by)


def read_partitions(spark: SparkSession, path: str, predicate) -> DataFrame:
    """Read a partitioned table with a predicate on the partition columns;
    only matching directories are listed and scanned."""
    return spark.read.parquet(path).filter(predicate)
