"""Steps the operators share: scratch tables, distributed ranks, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.session import scratch_path

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_observed(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """``stored``, with totals taken while writing (no second pass)."""
    seen = Observation()
    out = stored(df.observe(seen, *[c.alias(k) for k, c in aggregates.items()]), name)
    return out, seen.get


def row_places(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of every row and its place, place_file and place_row: unique, and the same when a task runs again."""
    place = [F.xxhash64("_metadata.file_path").alias("place_file"), F.col("_metadata.row_index").alias("place_row")]
    try:
        return df.select(*columns, *place)
    except AnalysisException:  # not a plain scan: give the rows a place first
        own = stored(df.select(*columns), "places")
        return own.select("*", *place)


def ordered_rank(df: DataFrame, keys: list[str], rank: str = "rank", name: str = "ranked") -> DataFrame:
    """Adds the 0-based position in the order of ``keys`` (ties: any order, fixed by one write).

    Rows are range-partitioned and sorted, written once with their place inside
    the partition, and the partitions' row counts become running offsets.  Only
    that table (a row per partition) passes through a window without key.
    """
    spark = df.sparkSession
    at = F.monotonically_increasing_id()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.shiftright(at, 33).cast("int"))
        .withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = stored(placed, name)
    # a row per range partition: bounded by the session's shuffle width
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + F.col("_at"))
        .drop("_part", "_at", "_before")
    )


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows meanwhile, for tasks whose rows are packed blocks of many values."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def meet_on_grid(pieces: DataFrame, parts: DataFrame, blocks: int, shelves: int) -> DataFrame:
    """Every packed piece of queries (``piece`` int) beside every packed part of an index (``part`` long), by block and shelf.

    Each side is shuffled once, a piece to every shelf and a part to every block; a task holds the parts of a
    shelf and streams the pieces of a block past them.
    """
    left = pieces.withColumn("block", F.col("piece") % blocks).withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    right = parts.withColumn("shelf", F.pmod(F.xxhash64("part"), F.lit(shelves)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.join(right, ["block", "shelf"])


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    ``edges`` has long columns a, b.  Alternates the two star steps of the
    MapReduce algorithm of Kiveris et al. (2014); each round is written to the
    shared folder, minima are partial aggregates, and the joins on a hot node
    are plain shuffled joins that adaptive execution can split.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(least, "u")
        if large:
            return moved.where("v > u and v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a > b").distinct()

    stats = dict(n=F.count(F.lit(1)), s=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    now, last = stored_observed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges", **stats)
    for _ in range(rounds):
        if not last["n"]:
            break
        now, seen = stored_observed(star(star(now, True), False), "edges", **stats)
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("components did not settle")
    own = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
