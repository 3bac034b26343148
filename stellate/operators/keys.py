"""Dense surrogate keys 0..n-1 without a single-partition window.

Plan:
1. range-partition on the ordering columns (split points are sampled, so a
   hot value of a leading column is spread over several partitions as long
   as the full ordering is unique) and sort within partitions; the number of
   ranges follows the session (``spark.sql.shuffle.partitions``, coalesced by
   adaptive execution) unless given;
2. one Parquet write into the shared scratch folder, each row with its
   partition and place inside it: partition contents are now fixed, the two
   reads below agree and prune columns, and a lost executor re-reads the files
   instead of re-running the sample and shuffle;
3. count rows per partition (one number per partition, the same first pass
   ``RDD.zipWithIndex`` makes), turn the counts into running offsets and
   broadcast them (their size is the partition count, not the data);
4. id = offset of the partition + position inside the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.lookup import bounded_broadcast
from stellate.session import scratch_path

# Partitions above this many would make the offset table too large to broadcast.
MAX_OFFSET_PARTITIONS = 1_000_000


def dense_key(
    df: DataFrame,
    order_by: Sequence[str | Column],
    id_col: str = "id",
    num_partitions: int | None = None,
    start: int = 0,
) -> DataFrame:
    """Add ``id_col`` (long) = ``start`` + 0-based rank of each row by ``order_by``.

    ``order_by`` must identify rows uniquely for the ids to be reproducible;
    the result equals ``row_number() OVER (ORDER BY order_by) - 1 + start``.
    A later load goes on from ``start`` (see ``stellate.streaming.loads``).
    """
    if id_col in df.columns:
        raise ValueError(f"column {id_col!r} already exists; choose another id_col")
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order_by)
    else:
        ranged = df.repartitionByRange(*order_by)
    ranged = ranged.sortWithinPartitions(*order_by)
    path = scratch_path(df.sparkSession, "dense-key")
    # monotonically_increasing_id = (partition index << 33) + row index in the partition
    ranged.select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
    ).write.parquet(path)
    tagged = df.sparkSession.read.parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect()
    offsets_rows, running = [], start
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets_rows.append((r["_pid"], running))
        running += r["_cnt"]
    offsets = df.sparkSession.createDataFrame(offsets_rows, "_pid int, _off long")
    offsets = bounded_broadcast(offsets, MAX_OFFSET_PARTITIONS, known_rows=len(offsets_rows))
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        tagged.join(offsets, "_pid")
        .withColumn(id_col, (F.col("_off") + position).cast("long"))
        .drop("_pid", "_mid", "_off")
        .select(id_col, *[F.col(f"`{c}`") for c in df.columns])
    )
