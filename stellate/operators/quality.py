"""Load reconciliation and completeness audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def counts_frame(spark: SparkSession, counts: Mapping[str, int], value: str) -> DataFrame:
    """(table_name, <value>) from a small name -> count mapping (one row per table)."""
    return spark.createDataFrame(
        [(k, int(v)) for k, v in counts.items()], f"table_name string, {value} long"
    )


def row_count_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Reconcile (table_name, expected) with (table_name, actual).

    Output: table_name, expected, actual, missing = expected - actual, ok.
    A table present on one side only shows NULL on the other and ok = false.
    Each side has one row per table, so the two are stacked and grouped (one
    shuffle, hash aggregation) rather than joined.
    """
    stacked = expected.select(
        "table_name", F.col("expected").cast("long").alias("expected"), F.lit(None).cast("long").alias("actual")
    ).unionByName(
        actual.select(
            "table_name", F.lit(None).cast("long").alias("expected"), F.col("actual").cast("long").alias("actual")
        )
    )
    j = stacked.groupBy("table_name").agg(F.max("expected").alias("expected"), F.max("actual").alias("actual"))
    return j.select(
        "table_name",
        "expected",
        "actual",
        (F.col("expected") - F.col("actual")).alias("missing"),
        F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("ok"),
    )


def completeness_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Percent of non-null values of audited columns, one scan per table.

    Output: table_name, column_name, pct (double; NULL for an empty table),
    ok (pct = 100).
    """
    parts = []
    for name, (df, cols) in tables.items():
        agg = df.agg(
            F.count(F.lit(1)).alias("__total"),
            *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(cols)],
        )
        parts.append(
            agg.select(
                F.lit(name).alias("table_name"),
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(c).alias("column_name"),
                                F.try_divide(
                                    F.col(f"__c{i}").cast("double") * 100.0,
                                    F.col("__total").cast("double"),
                                ).alias("pct"),
                            )
                            for i, c in enumerate(cols)
                        ]
                    )
                ).alias("r"),
            ).select("table_name", "r.column_name", "r.pct")
        )
    audit = reduce(DataFrame.unionByName, parts)
    return audit.withColumn("ok", F.coalesce(F.col("pct") == 100.0, F.lit(False)))
