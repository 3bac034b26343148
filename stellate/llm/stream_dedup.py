"""Operator 6, exact deduplication as a stateful stream.

Two texts are equal when they are identical after every run of ASCII white
space became one space; null counts as empty.  Each row's fingerprint (SHA-256
of the normalised text, doc_id, and a locator: file path and row index of the
content) is streamed into keyed state on disk (RocksDB, checkpointed to the
shared folder, no watermark and so no expiry).  Per digest the state retains
the smallest identifier seen, its locator and a count; partial aggregation
before the state's shuffle keeps a hot digest small.  A row whose digest is
held by another row is a hit: its full bytes are read through its locator and
compared with the holder's.  Rows of a digest that two different texts share
are grouped again by their text, so the digest never decides alone.

Of equal texts the smallest doc_id stays (null ids last, then file and row
order, so of repeated rows exactly one stays).  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from stellate.llm.common import stored
from stellate.session import scratch_path

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a store is closed when its task ends: open ones hold 4 MB of disk each whatever their size
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
FILTER_SLOTS = 1 << 20  # bound of the broadcast prefilter, in rows


def normalised(text: Column) -> Column:
    """White-space runs as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text, file, row: every row with the place of its content."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    try:
        return docs.select(*own, *place)
    except AnalysisException:  # not a plain scan: give the rows a place first
        return stored(docs.select(*own), "located").select("doc_id", "text", *place)


def fingerprints(rows: DataFrame, digest_chars: int = 64) -> DataFrame:
    """doc_id, file, row, text_sha256, digest (the state's key)."""
    sha = F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)
    return rows.select("doc_id", "file", "row", sha.alias("text_sha256")).withColumn(
        "digest", F.substring("text_sha256", 1, digest_chars))


def keyed_state(prints: DataFrame) -> DataFrame:
    """Streaming or batch: digest, first (smallest identifier and its locator), n."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    return prints.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, feed: DataFrame, target: str, state_dir: str) -> None:
    """Drain a stream of fingerprints; every micro-batch writes its changed keys to ``target``.

    A repeated batch overwrites its own folder, so a restart from ``state_dir`` adds nothing twice.
    """
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        query = (
            keyed_state(feed).writeStream.outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", state_dir)
            .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{target}/batch={i}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _same_bytes(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """file, row, same: whether each hit's whole normalised text equals its holder's."""
    slot = F.pmod(F.xxhash64("file", "row"), F.lit(FILTER_SLOTS)).cast("int")
    places = hits.select("file", "row").unionByName(hits.select(F.col("first.file").alias("file"), F.col("first.row").alias("row")))
    # at most FILTER_SLOTS small integers, whatever the input: it thins the scan before the join on the locator
    wanted = places.select(slot.alias("slot")).distinct()
    thin = rows.withColumn("slot", slot).join(F.broadcast(wanted), "slot", "left_semi").select("file", "row", normalised(F.col("text")).alias("t"))
    mine = thin.join(hits.select("file", "row", F.col("first.file").alias("hfile"), F.col("first.row").alias("hrow")), ["file", "row"])
    held = thin.join(hits.select(F.col("first.file").alias("file"), F.col("first.row").alias("row")).distinct(), ["file", "row"])
    held = held.select(F.col("file").alias("hfile"), F.col("row").alias("hrow"), F.col("t").alias("held"))
    return mine.join(held, ["hfile", "hrow"]).select("file", "row", (F.col("t") == F.col("held")).alias("same"))


def exact_dedup(docs: DataFrame, files_per_trigger: int = 64, digest_chars: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, file, row for every row of ``docs``.

    ``digest_chars`` shortens the state's key (for tests of colliding digests).
    """
    spark = docs.sparkSession
    rows = located(docs)
    feed_path, target, state = (scratch_path(spark, x) for x in ("feed", "updates", "state"))
    fingerprints(rows, digest_chars).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path)
    run_stream(spark, stream, target, state)
    schema = keyed_state(feed).schema
    changed = spark.read.schema(schema).parquet(target) if not feed.isEmpty() else spark.createDataFrame([], schema)
    last = changed.groupBy("digest").agg(F.max_by("first", "n").alias("first"), F.max("n").alias("n"))
    members = stored(feed.join(last, "digest"), "members")
    hit = ~(F.col("file").eqNullSafe(F.col("first.file")) & F.col("row").eqNullSafe(F.col("first.row")))
    hits = members.where(hit).select("file", "row", "first", "digest")
    checked = stored(_same_bytes(rows, hits), "checked")
    clash = checked.where("not same")
    if not clash.isEmpty():
        # different texts under one digest: group those digests again by the text itself
        again = members.join(members.join(clash, ["file", "row"], "left_semi").select("digest").distinct(), "digest", "left_semi")
        texts = again.select("doc_id", "file", "row", "text_sha256", "digest").join(rows.select("file", "row", normalised(F.col("text")).alias("t")), ["file", "row"])
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
        groups = texts.groupBy("digest", "t").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        texts = texts.join(groups, ["digest", "t"]).drop("t")
        members = members.join(again.select("digest").distinct(), "digest", "left_anti").unionByName(texts)
    return members.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (~hit).alias("kept"), "text_sha256", "file", "row")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    columns = docs.columns
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        docs.select(*place)
    except AnalysisException:
        # neutral names: a column called _metadata would hide the place
        docs = stored(docs.toDF(*[f"c{i}" for i in range(len(columns))]), "located")
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    keyed = docs.select(*own, *place)
    ids = docs.select(F.col(docs.columns[columns.index("doc_id")]).alias("doc_id"), F.col(docs.columns[columns.index("text")]).alias("text"), "_metadata")
    gone = exact_dedup(ids).where("not kept").select(F.col("file").alias("_file"), F.col("row").alias("_row"))
    return keyed.join(gone, ["_file", "_row"], "left_anti").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
