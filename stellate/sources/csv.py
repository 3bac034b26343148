"""Delimited text in and out.

Raw CSV is read with every column as a string, exactly as a header-only read
without schema inference does; typing happens later in the conform step where
failed casts can be counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_strings(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Header CSV scan, all columns strings.

    With ``columns`` given the schema is fixed up front (no pass over the
    header of every file); otherwise names come from the header row.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Header CSV writer, one file per partition."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
