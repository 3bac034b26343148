"""Join forms that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.lookup import bounded_broadcast
from stellate.operators.profile import frequent_hashes
from stellate.session import cut_lineage

# Rows of both sides that one task joins, on average.
ROWS_PER_TASK = 500_000


def left_join_skew_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``left LEFT OUTER JOIN right`` whose tasks stay small, whatever the row count and the largest key.

    ``keys`` pairs (left column, right column); output columns are the left
    columns followed by the right columns, as in the plain left join.  Few
    rows (``rows_per_task`` for each core, both sides counted first) are left to
    adaptive execution (``_left_join_by_parts``).  It sizes tasks by compressed
    bytes, of which sorted keys take next to none, so more rows are dealt by
    key over a width that follows their number instead.  Keys with over
    ``rows_per_task`` rows of a side (a sketch of each side finds them) are joined
    apart (``_left_join_hot``), and rows with a NULL key, which match nothing,
    are then not dealt at all.
    """
    spark = left.sparkSession
    n_left, n_right = left.count(), right.count()
    if n_left + n_right <= rows_per_task * spark.sparkContext.defaultParallelism:
        return _left_join_by_parts(left, right, keys)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(n_left + n_right) // rows_per_task))
    sides = [(left, [lk for lk, _ in keys], n_left), (right, [rk for _, rk in keys], n_right)]
    hashes = [frequent_hashes(df, cols, rows_per_task / n) if n > rows_per_task else [] for df, cols, n in sides]
    if not any(hashes):
        return _left_join_dealt(left, right, keys, width)
    if any(left.schema[lk].dataType != right.schema[rk].dataType for lk, rk in keys):
        return _left_join_by_parts(left, right, keys)  # equal after a cast only: a key is no single value then
    names = [f"__hk{i}" for i in range(len(keys))]
    (_, lks, _), (_, rks, _) = sides
    hot_right = _key_values(right, rks, hashes[1], names)
    hot_left = _key_values(left, lks, hashes[0], names)
    hot_left = hot_left.join(F.broadcast(hot_right), names, "left_anti")  # hot on the left only
    hot = hot_right.unionByName(hot_left)
    has_key = _all_set(left, lks)
    return (
        _left_join_dealt(
            _of_keys(left.filter(has_key), lks, hot, "left_anti"), _of_keys(right.filter(_all_set(right, rks)), rks, hot, "left_anti"), keys, width
        )
        .unionByName(_left_join_hot(left, right, keys, hot_left, hot_right))
        .unionByName(_without_match(left.filter(~has_key), right))
    )


def _all_set(df: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(Column.__and__, [df[c].isNotNull() for c in cols])


def _key_values(df: DataFrame, cols: Sequence[str], hashes: Sequence[int], names: Sequence[str]) -> DataFrame:
    """The distinct key values of these hashes (few: a hash seldom has two), as columns ``names``, kept in the shared folder."""
    found = df.filter(F.xxhash64(*[df[c] for c in cols]).isin(list(hashes)) & _all_set(df, cols))
    return cut_lineage(found.select(*[df[c].alias(k) for c, k in zip(cols, names, strict=True)]).distinct())


def _of_keys(df: DataFrame, cols: Sequence[str], keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows with one of the few ``keys`` (or none of them: ``left_anti``)."""
    return df.join(F.broadcast(keys), _equal(df, keys, list(zip(cols, keys.columns, strict=True))), how)


def _left_join_hot(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], hot_left: DataFrame, hot_right: DataFrame) -> DataFrame:
    """The left join of the rows with hot keys (hot on the left only, and on the right).

    The rows of the other side are replicated to the many where they are,
    within the bounds of a broadcast; beyond, adaptive execution splits the
    inner join.  Which hot keys have a right row is a list no longer than the hot keys.
    """
    lks, rks = [lk for lk, _ in keys], [rk for _, rk in keys]
    few, many = bounded_broadcast(_of_keys(left, lks, hot_right)), _of_keys(right, rks, hot_right)
    out = few.join(many, _equal(few, many, keys), "inner")
    many, few = _of_keys(left, lks, hot_left), bounded_broadcast(_of_keys(right, rks, hot_left))
    out = out.unionByName(many.join(few, _equal(many, few, keys), "inner"))
    hot = hot_right.unionByName(hot_left)
    matched = _of_keys(right, rks, hot).select(*[right[rk].alias(k) for rk, k in zip(rks, hot.columns, strict=True)]).distinct()
    return out.unionByName(_without_match(_of_keys(_of_keys(left, lks, hot), lks, matched, "left_anti"), right))


def _equal(a: DataFrame, b: DataFrame, keys: Sequence[tuple[str, str]]) -> Column:
    return reduce(Column.__and__, [a[x] == b[y] for x, y in keys])


def _without_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows with NULL in the columns of ``right``."""
    return left.select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])


def _left_join_dealt(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], width: int) -> DataFrame:
    """The plain left join over ``width`` partitions, which adaptive execution does not merge."""
    a = left.repartition(width, *[left[lk] for lk, _ in keys])
    b = right.repartition(width, *[right[rk] for _, rk in keys])
    return a.join(b, _equal(a, b, keys), "left")


def _left_join_by_parts(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """The left join as (inner join) UNION ALL (unmatched left rows).

    Adaptive execution can split a hot key of either side of an inner join,
    but in an outer join only the preserved side.  The unmatched rows come
    from an anti join against the *distinct* right keys, which are reduced on
    the map side first, so a hot right key never lands whole in one task.
    """
    matched = left.join(right, _equal(left, right, keys), "inner")
    right_keys = right.select(*[F.col(rk).alias(f"__rk{i}") for i, (_, rk) in enumerate(keys)]).distinct()
    unmatched = left.join(right_keys, _equal(left, right_keys, [(lk, f"__rk{i}") for i, (lk, _) in enumerate(keys)]), "left_anti")
    return matched.unionByName(_without_match(unmatched, right))
