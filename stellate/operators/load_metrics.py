"""Metrics of a load taken on the way, without another read.

Several named sets of aggregates ride on the one write of a table: rows read,
rows a de-duplication removes, values a cast loses.  Place them after the last
shuffle where the same number can be had there (rows per key after a
de-duplication instead of rows before it): a lost executor can make Spark run
the tasks before a shuffle again, and those would count twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stellate.functions.casts import loss_aggregates


class LoadMetrics:
    """Observations by (table, kind); values are there once the observed frames have been written."""

    def __init__(self) -> None:
        self._seen: dict[tuple[str, str], Observation] = {}

    def watch(self, df: DataFrame, table: str, kind: str, *aggregates: Column) -> DataFrame:
        if (table, kind) in self._seen:
            raise ValueError(f"{kind} of {table} is watched already")
        self._seen[table, kind] = Observation(f"{table}_{kind}_{uuid.uuid4().hex}")
        return df.observe(self._seen[table, kind], *aggregates)

    def rows(self, df: DataFrame, table: str) -> DataFrame:
        """Watch the rows of a source."""
        return self.watch(df, table, "rows", F.count(F.lit(1)).alias("rows"))

    def duplicates(self, df: DataFrame, table: str, count: str) -> DataFrame:
        """Watch a de-duplicated frame whose column ``count`` has the rows of each key; drops that column."""
        n = F.col(f"`{count}`")
        return self.watch(
            df, table, "duplicates", F.coalesce(F.sum(n), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_out"), F.count_if(n > 1).alias("duplicated_keys"),
        ).drop(count)

    def losses(self, df: DataFrame, table: str, converted: Mapping[str, tuple[Column, Column]]) -> DataFrame:
        """Watch what conversions lose (see ``loss_aggregates``)."""
        return self.watch(df, table, "losses", *loss_aggregates(converted))

    def _of(self, kind: str) -> dict[str, dict]:
        return {table: seen.get for (table, k), seen in self._seen.items() if k == kind}

    def source_report(self, spark: SparkSession) -> DataFrame:
        """(table_name, row_count): rows read of each source, by its own count or its de-duplication's."""
        counts = {t: int(v["rows_in"]) for t, v in self._of("duplicates").items()} | {t: int(v["rows"]) for t, v in self._of("rows").items()}
        return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")

    def duplicate_report(self, spark: SparkSession) -> DataFrame:
        """(table_name, rows_in, rows_out, duplicate_rows, duplicated_keys)."""
        rows = [(t, int(v["rows_in"]), int(v["rows_out"]), int(v["rows_in"]) - int(v["rows_out"]), int(v["duplicated_keys"])) for t, v in self._of("duplicates").items()]
        return spark.createDataFrame(rows, "table_name string, rows_in long, rows_out long, duplicate_rows long, duplicated_keys long")

    def loss_report(self, spark: SparkSession) -> DataFrame:
        """(table_name, column_name, non_null_in, lost)."""
        rows = [(t, k.removesuffix("__in"), int(n), int(v[f"{k.removesuffix('__in')}__lost"]))
                for t, v in self._of("losses").items() for k, n in v.items() if k.endswith("__in")]
        return spark.createDataFrame(rows, "table_name string, column_name string, non_null_in long, lost long")
