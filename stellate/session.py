"""Session defaults and the shared scratch location.

Scratch output (checkpoints, round-trip tables, rendered fixtures) always goes
under the folder the cluster names in ``spark.checkpoint.dir``.  Where that
setting is absent a private folder serves a local master, as in tests; any
other master is refused, because its executors could not see the folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SUBDIR = "stellate-scratch"


def build_session(
    master: str | None = None,
    app_name: str = "stellate",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    advisory_partition_bytes: str | None = None,
    max_split_bytes: str | None = None,
) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and no web UI.

    ``shuffle_partitions`` is the initial shuffle width (adaptive execution
    coalesces it down to ``advisory_partition_bytes`` per partition at run
    time); ``max_split_bytes`` caps the bytes a scan task reads.  Size them
    so that one partition fits comfortably in an executor core's memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if advisory_partition_bytes:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = advisory_partition_bytes
    if max_split_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = max_split_bytes
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stellate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{_SCRATCH_SUBDIR}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared scratch folder and read it back: columnar, prunable, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: data is written to the shared folder, so a lost
    executor does not force a recompute of the whole lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
