"""Code-list lookups: left joins of a fact onto small (code, label) lists.

A lookup side is broadcast only after its rows and bytes have been counted
against bounds; beyond them the join is left to the planner (sort-merge, or a
runtime broadcast chosen by adaptive execution).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest lookup side (rows, and bytes as JSON text) that is broadcast without asking the planner.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 << 20

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (rendered as JSON).

    Both are partial aggregates: each task sends one row of totals, never the rows themselves.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    total = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return total["rows"] <= max_rows and total["bytes"] <= max_bytes


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None
) -> DataFrame:
    """``F.broadcast(df)`` if it is within the bounds of ``fits``, else ``df`` unchanged.

    The check is one pass of partial totals over the small side.  When the
    small side is the result of an expensive plan, materialize it first
    (``stellate.session.cut_lineage``) so the check and the broadcast do not
    both recompute it.
    """
    small = known_rows <= max_rows if known_rows is not None else fits(df, max_rows)
    return F.broadcast(df) if small else df


def _field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _prepare(
    fact_t: T.DataType, codes: DataFrame, code_key: str, label: str, unique: bool
) -> tuple[DataFrame, T.DataType | None]:
    """Lookup side as (``__k``, ``__v``) with one row per key, and the type the
    fact key must be cast to (None when it is used as is)."""
    list_t = _field_type(codes, code_key)
    list_key = F.col(code_key)
    fact_cast = None
    cast_list = isinstance(fact_t, _NUMERIC) and isinstance(list_t, T.StringType)
    if cast_list:
        list_key = F.trim(list_key).try_cast(fact_t)
    elif isinstance(fact_t, T.StringType) and isinstance(list_t, _NUMERIC):
        fact_cast = list_t
    lk = codes.select(list_key.alias("__k"), F.col(label).alias("__v")).filter(F.col("__k").isNotNull())
    if cast_list or not unique:
        lk = lk.groupBy("__k").agg(F.max("__v").alias("__v"))
    return lk, fact_cast


def _join_prepared(
    df: DataFrame,
    code_col: str,
    lk: DataFrame,
    fact_cast: T.DataType | None,
    out: str,
    small: bool,
    default: str | None,
) -> DataFrame:
    key_name, value_name = f"__k_{out}", f"__v_{out}"
    side = lk.select(F.col("__k").alias(key_name), F.col("__v").alias(value_name))
    if small:
        side = F.broadcast(side)
    fact_key = F.col(code_col)
    if fact_cast is not None:
        fact_key = F.trim(fact_key).try_cast(fact_cast)
    joined = df.join(side, fact_key == side[key_name], "left")
    value = F.col(value_name)
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    # withColumn keeps the position when ``out`` replaces an existing column
    # (e.g. a code column decoded into its own label)
    return joined.withColumn(out, value).drop(key_name, value_name)


def merged_codes(codes: DataFrame, to: T.DataType | str, code_key: str = "code", label: str = "label") -> DataFrame:
    """(code, codes, labels): text codes that meet in one value of type ``to`` (``'1'`` and ``'01'``) with different labels.

    ``decode`` takes the greatest label of such a code; this report shows which lists need a look first.
    """
    value = F.trim(F.col(code_key)).try_cast(to)
    return (
        codes.select(value.alias("code"), F.col(code_key).alias("_c"), F.col(label).alias("_l")).where(F.col("code").isNotNull())
        .groupBy("code").agg(F.countDistinct("_c").alias("codes"), F.countDistinct("_l").alias("labels"))
        .where("codes > 1 and labels > 1")
    )


def decode(
    df: DataFrame,
    code_col: str,
    codes: DataFrame,
    out: str,
    code_key: str = "code",
    label: str = "label",
    default: str | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    known_rows: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``out`` = label of ``df[code_col]`` in ``codes``; unmatched rows keep NULL
    (or ``default``) and are never dropped.

    Keys are compared in one declared type: when one side is numeric and the
    other text, the text side is read as that number with ``try_cast`` (so
    ``582.0`` matches ``'582'`` and junk text matches nothing instead of failing
    under ANSI).  The list is reduced to one label per key first, so the join
    cannot multiply fact rows; ``unique=True`` skips that step for lists whose
    codes are distinct by construction (it is still done after a key cast,
    which may merge codes such as ``'1'`` and ``'01'``).
    """
    lk, fact_cast = _prepare(_field_type(df, code_col), codes, code_key, label, unique)
    # the prepared side has at most as many rows as the raw list, so checking
    # the raw list (no shuffle of rows) bounds it
    small = known_rows <= max_broadcast_rows if known_rows is not None else fits(codes, max_broadcast_rows)
    return _join_prepared(df, code_col, lk, fact_cast, out, small, default)


def decode_roles(
    df: DataFrame,
    codes: DataFrame,
    roles: Mapping[str, str],
    code_key: str = "code",
    label: str = "label",
    default: str | None = None,
    known_rows: int | None = None,
    unique: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """One list joined once per role: ``roles`` maps output name -> code column.

    The list is prepared and size-checked once per distinct code type, then
    joined under a different name for every role.
    """
    prepared: dict[str, tuple[DataFrame, T.DataType | None, bool]] = {}
    for out, code_col in roles.items():
        fact_t = _field_type(df, code_col)
        key = fact_t.simpleString()
        if key not in prepared:
            lk, fact_cast = _prepare(fact_t, codes, code_key, label, unique)
            small = (
                known_rows <= max_broadcast_rows if known_rows is not None else fits(codes, max_broadcast_rows)
            )
            prepared[key] = (lk, fact_cast, small)
        lk, fact_cast, small = prepared[key]
        df = _join_prepared(df, code_col, lk, fact_cast, out, small, default)
    return df
