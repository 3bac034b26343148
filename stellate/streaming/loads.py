"""Loads that go on from what is stored: generated ids, calendar dates, dimension rows.

A table that grows load by load keeps each load in its own folder, ``load=<n>``.
A retried load overwrites its own folder and is computed from the loads before
it alone, so whatever a failed attempt left behind, the retry gives the same rows
with the same ids: no gap and no repeat.  A small ledger (one row a load, beside
the data) says where the next load's ids start, so no stored id is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stellate.operators.clean import dedup_by_key
from stellate.operators.dims import time_dimension
from stellate.operators.keys import dense_key
from stellate.operators.lookup import fits
from stellate.plans.layout import overwrite_partitions
from stellate.plans.warehouse import write_counted
from stellate.session import stage
from stellate.sources.tables import read_if_present
from stellate.streaming.refresh import split_new_keys

LOAD, LEDGER = "load", "_ledger"
# Touched folders above this many are joined instead of listed in a filter.
MAX_LISTED_PARTITIONS = 10_000


class Load(NamedTuple):
    """What a load did: rows appended, rows whose key was known, the first id given."""

    appended: int
    known: int
    first_id: int


class Upsert(NamedTuple):
    """What an upsert did: rows inserted, rows changed, folders rewritten."""

    inserted: int
    changed: int
    rewritten: int


def read_loads(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The rows of a load-by-load table (those of loads before ``before``), or None when there is no table yet."""
    rows = read_if_present(spark, target)
    if rows is None or LOAD not in rows.columns:
        return None
    if before is not None:
        rows = rows.where(F.col(LOAD) < before)
    return rows.drop(LOAD)


def _ledger(spark: SparkSession, target: str) -> dict[int, tuple[int, int]]:
    """load -> (first id, rows): a row per load."""
    rows = read_if_present(spark, f"{target}/{LEDGER}")
    return {} if rows is None else {r[LOAD]: (r["first_id"], r["rows"]) for r in rows.collect()}


def append_load(
    spark: SparkSession,
    batch: DataFrame,
    target: str,
    keys: Sequence[str],
    load: int,
    order_by: Sequence[str] | None = None,
    id_col: str = "id",
) -> Load:
    """Append the rows of ``batch`` whose keys no earlier load holds, as folder ``load=<load>``.

    With ``order_by`` the new rows get ids (``id_col``) that go on from the
    earlier loads, in that order and then by all other columns.  One row a key
    is kept (see ``dedup_by_key``); keys are compared null-safely.  Loads come
    in ascending order: a load older than a stored one is refused, the latest
    may be repeated.  A batch with other columns than the table is refused.
    """
    ledger = _ledger(spark, target)
    if any(n > load for n in ledger):
        raise ValueError(f"load {load} comes after load {max(ledger)}, which is stored")
    existing = read_loads(spark, target, before=load)
    if existing is not None:
        own = [c for c in existing.columns if not (order_by and c == id_col)]
        if set(own) != set(batch.columns):
            raise ValueError(f"batch columns {sorted(set(batch.columns) ^ set(own))} are not in both batch and table")
        existing = existing.select(*own)
    new, known = split_new_keys(existing, batch, list(keys))
    first = max((a + n for load_n, (a, n) in ledger.items() if load_n < load), default=0)
    if order_by:
        new = dense_key(new, [*order_by, *[c for c in new.columns if c not in order_by]], id_col, start=first)
    rows = write_counted(new, f"{target}/{LOAD}={load}")
    entry = spark.createDataFrame([(load, first, rows)], f"{LOAD} long, first_id long, rows long")
    entry.drop(LOAD).write.mode("overwrite").parquet(f"{target}/{LEDGER}/{LOAD}={load}")
    return Load(rows, 0 if known is None else known.count(), first)


def append_dates(spark: SparkSession, columns: Sequence[tuple[DataFrame, str]], target: str, load: int) -> Load:
    """Rows of the calendar dimension for dates of the columns that it does not hold yet."""
    dates = reduce(DataFrame.unionByName, [df.select(F.col(c).cast("date").alias("time")) for df, c in columns])
    return append_load(spark, time_dimension(dates.distinct()), target, ["time"], load)


def _matches(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def upsert_partitioned(spark: SparkSession, changes: DataFrame, target: str, keys: Sequence[str], by: str) -> Upsert:
    """Bring changed and new rows into a table with one folder per value of ``by``; only folders they touch are rewritten.

    Rows equal to the stored ones are no changes, so a repeated batch rewrites
    nothing.  A row that moves to another folder leaves its old one, also when
    that becomes empty.  Of several changes of one key one stays (see
    ``dedup_by_key``).  The new folders are written to the shared scratch folder
    first, so a failure before the last step leaves the table as it was, and
    a repetition after a failure within it completes the rest.
    """
    keys = list(keys)
    fresh = stage(dedup_by_key(changes, keys), "upsert-changes")
    existing = read_if_present(spark, target)
    if existing is None:
        rows = write_counted(fresh, target, partition_by=[by])
        return Upsert(rows, 0, fresh.select(by).distinct().count())
    if set(existing.columns) != set(fresh.columns):
        raise ValueError(f"columns {sorted(set(fresh.columns) ^ set(existing.columns))} are not in both changes and table")
    rest = [c for c in fresh.columns if c not in keys]
    wanted = fresh.select(*keys)
    probe = F.broadcast(wanted) if fits(wanted, 200_000) else wanted
    place = existing.select(*keys, F.struct(*rest).alias("_stored"))
    held = stage(place.join(probe, _matches(place, probe, keys), "left_semi"), "upsert-stored")
    joined = fresh.join(held, _matches(fresh, held, keys), "left").select(*[fresh[c] for c in fresh.columns], held["_stored"])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_stored.{c}")) for c in rest])
    delta = stage(joined.withColumn("_new", F.col("_stored").isNull()).where(F.col("_new") | differs), "upsert-delta")
    totals = delta.agg(F.count_if("_new").alias("new"), F.count_if(~F.col("_new")).alias("changed")).first()
    if not totals["new"] + totals["changed"]:
        return Upsert(0, 0, 0)
    touched = delta.select(F.col(by).alias("v")).unionByName(delta.where(~F.col("_new")).select(F.col(f"_stored.{by}").alias("v"))).distinct()
    folders = [r["v"] for r in touched.limit(MAX_LISTED_PARTITIONS + 1).collect()]
    if len(folders) > MAX_LISTED_PARTITIONS:
        inside = existing.join(touched, existing[by].eqNullSafe(touched["v"]), "left_semi")
    else:  # literals prune the folders before anything is read
        listed = F.col(by).isin([v for v in folders if v is not None])
        inside = existing.where(F.coalesce(listed, F.lit(False)) | (F.col(by).isNull() if None in folders else F.lit(False)))
    kept = inside.join(delta.select(*keys), _matches(inside, delta, keys), "left_anti")
    result = stage(kept.select(*fresh.columns).unionByName(delta.select(*fresh.columns)), "upsert-folders")
    left = {r["v"] for r in result.select(F.col(by).alias("v")).distinct().collect()} if len(folders) <= MAX_LISTED_PARTITIONS else set(folders)
    overwrite_partitions(result, target, [by])
    for v in folders:
        if v not in left:  # all rows moved away: the folder stays, without rows
            name = "__HIVE_DEFAULT_PARTITION__" if v is None else v
            result.drop(by).limit(0).write.mode("overwrite").parquet(f"{target}/{by}={name}")
    return Upsert(totals["new"], totals["changed"], len(folders) if len(folders) <= MAX_LISTED_PARTITIONS else touched.count())


def refresh_star(
    spark: SparkSession,
    base: str,
    load: int,
    facts: DataFrame,
    fact_name: str,
    keys: Sequence[str],
    date_columns: Sequence[str],
    order_by: Sequence[str] | None = None,
    dimensions: dict[str, tuple[DataFrame, Sequence[str], str]] | None = None,
) -> dict[str, Load | Upsert]:
    """One load of a fact with its dimensions: dates first, then changed dimension rows, then the facts.

    Dimensions precede facts, so at every moment each stored fact's dates are in
    ``<base>/time``.  ``dimensions``: name -> (changes, keys, partition column).
    Repeating a load changes nothing.
    """
    facts = stage(facts, "load-facts")
    done: dict[str, Load | Upsert] = {"time": append_dates(spark, [(facts, c) for c in date_columns], f"{base}/time", load)}
    for name, (changes, own_keys, by) in (dimensions or {}).items():
        done[name] = upsert_partitioned(spark, changes, f"{base}/{name}", own_keys, by)
    done[fact_name] = append_load(spark, facts, f"{base}/{fact_name}", keys, load, order_by)
    return done


def start_loads(
    spark: SparkSession,
    source_dir: str,
    schema,
    checkpoint_location: str,
    one_load: Callable[[DataFrame, int], None],
    max_files: int | None = None,
) -> StreamingQuery:
    """Stream parquet drops; every micro-batch is one load, numbered by the stream's own batch number.

    The number comes from the checkpoint, so a batch that is retried after a
    failure repeats its load instead of adding one.  ``one_load`` gets the
    micro-batch and its number.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source_dir).writeStream.foreachBatch(one_load)
        .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    )
