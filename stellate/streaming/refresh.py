"""Periodic refresh of a warehouse table with newly arrived rows.

New batches land as files in a folder; a Structured Streaming query picks up
each new file set and appends only rows whose key is not yet in the target.
Keys are compared null-safely, so a retried micro-batch appends nothing twice,
NULL keys included.  The refresh is insert-only: rows of known keys are not
written, and their number (and how many of them differ from the stored row)
is reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stellate.operators.clean import dedup_by_key
from stellate.operators.lookup import DEFAULT_BROADCAST_ROWS, fits
from stellate.plans.warehouse import write_counted
from stellate.session import stage
from stellate.sources.tables import read_if_present

class Refresh(NamedTuple):
    """What a batch did: rows appended, rows whose key was known, and those of them that differ from the stored row."""

    appended: int
    known: int
    changed: int


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def in_key_range(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` within the batch's range of every key (or NULL there).

    One row of minima and maxima comes to the driver; as literals they reach the scan, which skips
    the row groups and, where a key partitions the table, the folders outside the range.
    """
    ends = batch.agg(*[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for i, k in enumerate(keys):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        own = F.col(k).isNull()
        existing = existing.where(own if lo is None else own | F.col(k).between(F.lit(lo), F.lit(hi)))
    return existing


def split_new_keys(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    max_broadcast_keys: int = DEFAULT_BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """(new, known): rows of ``batch``, one per key, by whether their key is in ``existing``; known ones with the stored row.

    The deduplicated batch is written once (Parquet in the shared folder).  Only the batch's key range
    of the table is read; while the batch fits a broadcast its keys meet the
    table on the map side, so the table is not shuffled.
    """
    keys = list(keys)
    fresh = stage(dedup_by_key(batch, keys), "refresh-batch")
    if existing is None:
        return fresh, None
    rest = [c for c in fresh.columns if c not in keys]
    stored = in_key_range(existing, fresh, keys).select(*keys, F.struct(*rest or keys).alias("_stored"))
    wanted = fresh.select(*keys)
    small = fits(wanted, max_broadcast_keys)
    seen = stored.join(F.broadcast(wanted) if small else wanted, _same_keys(stored, wanted, keys), "left_semi")
    seen = stage(dedup_by_key(seen, keys), "refresh-known")
    new = fresh.join(seen, _same_keys(fresh, seen, keys), "left_anti")
    known = fresh.join(seen, _same_keys(fresh, seen, keys)).select(*[fresh[c] for c in fresh.columns], seen["_stored"])
    return new, known


def append_new_keys(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], max_broadcast_keys: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``batch`` (one per key) whose key is absent from ``existing``."""
    return split_new_keys(existing, batch, keys, max_broadcast_keys)[0]


def refresh_once(spark: SparkSession, batch: DataFrame, target_path: str, keys: Sequence[str]) -> Refresh:
    """Append the new-key rows of ``batch`` to the parquet table at ``target_path``.

    A batch with other columns than the table is refused rather than cut to fit.
    """
    existing = read_if_present(spark, target_path)
    if existing is not None and set(existing.columns) != set(batch.columns):
        raise ValueError(f"batch columns {sorted(set(batch.columns) ^ set(existing.columns))} are not in both batch and table")
    new, known = split_new_keys(existing, batch, keys)
    if existing is None:
        return Refresh(write_counted(new, target_path, mode="append"), 0, 0)
    rest = [c for c in batch.columns if c not in keys]
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_stored.{c}")) for c in rest], F.lit(False))
    totals = known.agg(F.count(F.lit(1)).alias("known"), F.count_if(differs).alias("changed")).first()
    return Refresh(write_counted(new.select(*existing.columns), target_path, mode="append"), totals["known"], totals["changed"])


def start_refresh(
    spark: SparkSession,
    source_dir: str,
    schema,
    target_path: str,
    keys: Sequence[str],
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Stream parquet drops from ``source_dir`` into ``target_path``.

    ``available_now`` processes what is there and stops (a scheduled daily or
    weekly refresh); otherwise it runs every ``processing_time``.
    """
    if read_if_present(spark, target_path) is None:
        # an empty table with the schema, so every micro-batch can anti-join
        spark.createDataFrame([], schema).write.parquet(target_path)
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def _batch(df: DataFrame, _epoch: int) -> None:
        refresh_once(df.sparkSession, df, target_path, keys)

    writer = (
        stream.writeStream.foreachBatch(_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
