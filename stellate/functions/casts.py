"""Tolerant casts and the count of values they could not convert.

On ANSI Spark a plain ``CAST('40.9' AS INT)`` raises and ``try_cast`` gives
NULL.  Text bound for an integral type is read as a double first, so
``'40.9'`` becomes 40 (truncated) while junk such as ``'n/a'`` becomes NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_type(t: T.DataType | str) -> T.DataType:
    return T._parse_datatype_string(t) if isinstance(t, str) else t


def tolerant_cast(c: Column | str, to: T.DataType | str, source: T.DataType | None = None) -> Column:
    """Cast that never raises: failures become NULL.

    ``source`` is the input type when known; string input headed for an
    integral type goes through double so decimals truncate instead of failing.
    """
    col = F.col(c) if isinstance(c, str) else c
    target = _as_type(to)
    if isinstance(target, T.DateType):
        if source is None or isinstance(source, T.StringType):
            return F.try_to_date(F.trim(col.cast("string")))
        return col.try_cast(target)
    if isinstance(target, _INTEGRAL) and (source is None or isinstance(source, T.StringType)):
        # exact integer text first (no precision loss above 2**53), then via double
        return F.coalesce(col.try_cast(target), col.try_cast("double").try_cast(target))
    return col.try_cast(target)


def cast_columns(df: DataFrame, casts: Mapping[str, T.DataType | str]) -> DataFrame:
    """Replace each named column by its tolerant cast, keeping column order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {name: tolerant_cast(name, to, types.get(name)) for name, to in casts.items()}
    )


def loss_aggregates(converted: Mapping[str, tuple[Column, Column]]) -> list[Column]:
    """Named aggregates per column (source value, converted value): values present before, and those of them NULL after.

    They can run in any aggregation, also one observed on a write (see ``stellate.operators.load_metrics``).
    """
    out = []
    for name, (src, to) in converted.items():
        out.append(F.count(src).alias(f"{name}__in"))
        out.append(F.count_if(src.isNotNull() & to.isNull()).alias(f"{name}__lost"))
    return out


def cast_loss_report(df: DataFrame, casts: Mapping[str, T.DataType | str]) -> DataFrame:
    """(column_name, non_null_in, lost) per cast column, in one aggregate pass.

    ``lost`` counts values that were present before the cast and NULL after.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    wide = df.agg(*loss_aggregates({name: (F.col(name), tolerant_cast(name, to, types.get(name))) for name, to in casts.items()}))
    return wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.col(f"{name}__in").alias("non_null_in"),
                        F.col(f"{name}__lost").alias("lost"),
                    )
                    for name in casts
                ]
            )
        ).alias("r")
    ).select("r.*")
