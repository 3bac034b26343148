"""Queries across the star: facts by month and place, and two facts side by side.

Each fact is aggregated to the shared grain *before* any fact-to-fact join,
so neither fact's rows multiply; dimensions are reduced to the grain of the
join key first (a city with several demographic rows counts once).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_grain(date_col: str | Column, grain: str = "month") -> list[Column]:
    """Grouping columns for a date: (year, month) or month of year only."""
    d = (F.col(date_col) if isinstance(date_col, str) else date_col).cast("date")
    if grain == "month":
        return [F.year(d).alias("year"), F.month(d).alias("month")]
    if grain == "month_of_year":
        return [F.month(d).alias("month")]
    raise ValueError(f"unknown grain {grain!r}")


def by_month_and_place(
    fact: DataFrame,
    date_col: str | Column,
    place_col: str | Column,
    measures: Sequence[Column] | None = None,
    grain: str = "month",
    place_name: str = "place",
) -> DataFrame:
    """Aggregate a fact to (year, month, place); default measure is a row count ``n``."""
    place = (F.col(place_col) if isinstance(place_col, str) else place_col).alias(place_name)
    aggs = list(measures) if measures else [F.count(F.lit(1)).alias("n")]
    return fact.groupBy(*month_grain(date_col, grain), place).agg(*aggs)


def drill_across(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two aggregates on their shared grain columns.

    Keys are compared null-safely: an unknown place is one row, not one per fact.
    """
    keys = list(keys)
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
    rest = [left[c] for c in left.columns if c not in keys] + [right[c] for c in right.columns if c not in keys]
    return left.join(right, same, "full").select(*[F.coalesce(left[k], right[k]).alias(k) for k in keys], *rest)

