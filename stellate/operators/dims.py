"""Time dimension from the date columns of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.functions.dates import date_parts


def distinct_dates(sources: Sequence[tuple[DataFrame, str | Column]], name: str = "time") -> DataFrame:
    """SQL ``UNION`` (distinct) of date columns from several DataFrames.

    Each branch projects one DATE column; the distinct runs as a partial
    aggregate per task, so only distinct dates per task are shuffled.  A NULL
    date survives as one row, as in SQL.
    """
    parts = [
        df.select((F.col(c) if isinstance(c, str) else c).cast("date").alias(name)) for df, c in sources
    ]
    return reduce(DataFrame.union, parts).distinct()


def time_dimension(dates: DataFrame, col: str = "time", drop_null: bool = True) -> DataFrame:
    """One row per distinct date with its calendar attributes.

    NULL is removed because ``time`` is the dimension key.
    """
    d = dates.select(F.col(col).cast("date").alias("time"))
    if drop_null:
        d = d.filter(F.col("time").isNotNull())
    d = d.distinct()
    parts = date_parts("time")
    return d.select("time", *[v.alias(k) for k, v in parts.items()])
