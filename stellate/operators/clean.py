"""Cleaning: column drops and renames, filters, de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.profile import completeness


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop named columns; names that are absent are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, old: str = " ", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name (other characters kept)."""
    mapping = {c: c.replace(old, new) for c in df.columns if old in c}
    return df.withColumnsRenamed(mapping) if mapping else df


def low_completeness_columns(
    df: DataFrame, threshold: float = 80.0, keep: Iterable[str] = ()
) -> list[str]:
    """Columns whose non-null percentage is below ``threshold``.

    The report has one row per column, so collecting it is bounded by the
    schema width, not by the data.
    """
    keep = set(keep)
    report = completeness(df).filter(F.col("pct") < threshold).select("column_name")
    return [r.column_name for r in report.collect() if r.column_name not in keep]


def drop_low_completeness(df: DataFrame, threshold: float = 80.0, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns less than ``threshold`` percent complete, except ``keep``."""
    return df.drop(*low_completeness_columns(df, threshold, keep))


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every named column is not NULL (pushed to the scan as IsNotNull)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond) if cond is not None else df


def filter_equals(df: DataFrame, col: str, value: object) -> DataFrame:
    """Keep rows where ``col`` equals a literal (pushed to the scan as EqualTo)."""
    return df.filter(F.col(col) == F.lit(value))


def filter_not_sentinel(df: DataFrame, col: str, sentinel: str = "None") -> DataFrame:
    """Drop rows holding the missing-value text; NULL rows drop too (NULL <> x is NULL)."""
    return df.filter(F.col(col) != F.lit(sentinel))


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType)


def _orderable(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return F.to_json(F.struct(c)) if _has_map(df.schema[name].dataType) else c


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: str = "first",
    count: str | None = None,
) -> DataFrame:
    """One row per key; ``count`` names a column for the number of rows the key had.

    The survivor is deterministic: the row that sorts first (``keep='first'``)
    or last by ``order_by`` and then by every other column, nulls first.  It is
    computed as ``min``/``max`` of a struct per key, an aggregate that runs
    partially on every map task, so a key holding a third of the data is
    reduced before the shuffle instead of landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order_by or []) if c not in keys]
    # a type without an order (MAP, also nested) is ranked by its JSON text
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    more = [F.col(f"`{count}`")] if count else []
    fields = [_orderable(df, c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [_orderable(df, c).alias(f"_t{i}") for i, c in enumerate(rest) if _has_map(df.schema[c].dataType)]
    if any(_has_map(df.schema[c].dataType) for c in rest):
        ordered = F.struct(*fields, *[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(rest) if not _has_map(df.schema[c].dataType)])
        whole = F.struct(*[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rest)])
        by = F.min_by if keep == "first" else F.max_by
        agg = df.groupBy(*keys).agg(by(whole, ordered).alias("_s"), *counted)
        return agg.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_s._r{rest.index(c)}").alias(c) for c in df.columns], *more)
    fields += [F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rest)]
    if not rest:
        return df.groupBy(*keys).agg(*counted) if count else df.select(*keys).distinct()
    pick = F.min if keep == "first" else F.max
    agg = df.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_s"), *counted)
    out = {c: F.col(f"_s._r{i}") for i, c in enumerate(rest)}
    return agg.select(*[F.col(f"`{c}`") if c in keys else out[c].alias(c) for c in df.columns], *more)


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows_in, rows_out, duplicate_rows, duplicated_keys in one aggregate pass.

    ``rows_in - rows_out = duplicate_rows``: the number a key de-duplication removes.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


def chain_filters(df: DataFrame, *predicates: Column) -> DataFrame:
    """Apply predicates in sequence; Catalyst merges them into one Filter."""
    for p in predicates:
        df = df.filter(p)
    return df
