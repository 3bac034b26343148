"""Profiling: completeness, schema, group counts, mismatches, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null count and percentage per column, long format, least complete first.

    One aggregate pass (partial aggregation on every task, a single-row final
    stage) followed by a reshape of that single row.  Text such as ``'None'``
    counts as present; the percentage of an empty table is NULL.
    Columns: column_name, non_null, total, pct.
    """
    cols = list(columns) if columns else df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(cols)],
    )
    long = counts.select(
        "__total",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"__c{i}").alias("non_null"))
                    for i, c in enumerate(cols)
                ]
            )
        ).alias("r"),
    )
    return long.select(
        "r.column_name",
        "r.non_null",
        F.col("__total").alias("total"),
        F.try_divide(F.col("r.non_null").cast("double") * 100.0, F.col("__total").cast("double")).alias("pct"),
    ).orderBy("pct", "column_name")


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) from the DataFrame schema."""
    spark = df.sparkSession
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Schema report joined with per-column non-null counts (one scan).

    Both sides have one row per column (every column is profiled), so the
    schema side is broadcast into an inner join.
    """
    comp = completeness(df).select("column_name", "non_null", "total")
    return comp.join(F.broadcast(schema_report(df)), "column_name").select(
        "position", "column_name", "data_type", "nullable", "non_null", "total"
    )


def group_count(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """Rows per group, with map-side partial counts."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def mismatch_count(
    df: DataFrame, a: Column | str, b: Column | str, weight: Column | str | None = None
) -> DataFrame:
    """Rows where ``a <> b`` (a NULL on either side is not counted).

    ``weight`` counts a pre-aggregated row as that many rows.
    """
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    w = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    return df.agg(
        F.coalesce(F.sum(F.when(ca != cb, w)), F.lit(0)).cast("long").alias("n_mismatch")
    )


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows by a stable order (a TakeOrdered plan, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def top_key_share(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` most frequent key values with their share of all rows.

    One partially aggregated count per key, then a top-n (no full sort).
    Use it before bucketing or range-partitioning on a key: a value holding
    a large share puts that share in one bucket file, which no reader can
    split.  Columns: the keys, n_rows, share.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    total = per_key.agg(F.sum("n_rows")).scalar()  # scalar subquery, evaluated once
    top = per_key.orderBy(F.col("n_rows").desc(), *keys).limit(n)
    return top.select(*keys, "n_rows", (F.col("n_rows") / total).alias("share"))


def largest_share(df: DataFrame, keys: Sequence[str], tracked: int = 1000) -> float:
    """Share of the most frequent key value among all rows, from a sketch of ``tracked`` values: one pass without a shuffle of keys.

    The sketch can only overstate a count, by less than a ``tracked``-th of the rows or so; an empty frame gives 0.
    """
    key = F.xxhash64(*keys)
    top = df.select(key.alias("k")).agg(F.expr(f"approx_top_k(k, 1, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows")).first()  # one row
    return top["top"][0]["count"] / top["rows"] if top["rows"] and top["top"] else 0.0


def frequent_hashes(df: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """``xxhash64`` of each key value that holds at least ``share`` of the rows (down to a ten-thousandth), from a sketch as in ``largest_share``.

    The sketch errs by a third of ``share`` at most and upwards only: none is missed, and a value with a little less may be named.
    """
    share = max(share, 1e-4)
    most = int(1.5 / share) + 1
    top = df.select(F.xxhash64(*[df[k] for k in keys]).alias("k")).agg(
        F.expr(f"approx_top_k(k, {most}, {max(1000, 8 * most)})").alias("top"), F.count(F.lit(1)).alias("rows")
    ).first()  # one row
    return [x["item"] for x in top["top"] or () if x["count"] >= share * top["rows"]]
