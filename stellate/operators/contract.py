"""Table contracts: declared columns, types, NOT NULL, key and CHAR width.

A contract is applied by column *name* (never by position), with tolerant
casts; rows that break a constraint are set aside with their reasons instead
of being lost silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.casts import tolerant_cast
from stellate.session import stage


@dataclass(frozen=True)
class Col:
    name: str
    dtype: str
    nullable: bool = True
    max_length: int | None = None
    source: str | None = None  # source column name when it differs


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, T._parse_datatype_string(c.dtype), c.nullable) for c in self.columns]
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def without(self, *names: str) -> Contract:
        """The same rules without some columns (and without a key that uses them)."""
        key = () if set(names) & set(self.primary_key) else self.primary_key
        return Contract(self.name, tuple(c for c in self.columns if c.name not in names), key)

    def ddl(self, using: str = "parquet") -> str:
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({self.column_ddl()}) USING {using}"

    def column_ddl(self) -> str:
        """Column list with CHAR widths (checked by Spark at every insert) and NOT NULL."""
        return ", ".join(
            f"`{c.name}` {f'VARCHAR({c.max_length})' if c.max_length is not None else c.dtype}{'' if c.nullable else ' NOT NULL'}"
            for c in self.columns
        )

    def properties(self) -> dict[str, str]:
        """The constraints that Spark's Parquet tables do not check themselves, as table properties."""
        return {NOT_NULL: ",".join(c.name for c in self.columns if not c.nullable), PRIMARY_KEY: ",".join(self.primary_key)}


# Table properties that hold constraints (see ``Contract.properties``).
NOT_NULL, PRIMARY_KEY = "stellate.not_null", "stellate.primary_key"


def apply_contract(df: DataFrame, contract: Contract, optional: Sequence[str] = ()) -> DataFrame:
    """Select and cast to the contract by name; extra columns are dropped (``drift`` names them).

    A missing source column raises unless ``optional`` names its target column, which then is NULL.
    """
    unknown = set(optional) - set(contract.names)
    if unknown:
        raise ValueError(f"{contract.name}: optional columns {sorted(unknown)} are not in the contract")
    types = {f.name.lower(): (f.name, f.dataType) for f in df.schema.fields}
    out = []
    for c in contract.columns:
        src = (c.source or c.name).lower()
        target = T._parse_datatype_string(c.dtype)
        if src in types:
            real, st = types[src]
            expr = F.col(f"`{real}`") if st == target else tolerant_cast(F.col(f"`{real}`"), target, st)
        elif c.name in optional:
            expr = F.lit(None).cast(target)
        else:
            raise ValueError(f"{contract.name}: source column {c.source or c.name!r} is missing (columns: {', '.join(df.columns)})")
        out.append(expr.alias(c.name))
    return df.select(*out)


def drift(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, status, source_type, target_type): how a source's columns differ from the contract: ``missing``, ``extra`` or ``cast``."""
    types = {f.name.lower(): f for f in df.schema.fields}
    wanted = {(c.source or c.name).lower(): c for c in contract.columns}
    rows = []
    for key, c in wanted.items():
        target = T._parse_datatype_string(c.dtype).simpleString()
        if key not in types:
            rows.append((c.source or c.name, "missing", None, target))
        elif types[key].dataType.simpleString() != target:
            rows.append((types[key].name, "cast", types[key].dataType.simpleString(), target))
    rows += [(f.name, "extra", f.dataType.simpleString(), None) for key, f in types.items() if key not in wanted]
    return df.sparkSession.createDataFrame(rows, "column_name string, status string, source_type string, target_type string")


def violations(contract: Contract) -> list[tuple[Column, str]]:
    """(broken, reason) of every constraint; ``broken`` is never NULL."""
    checks = []
    for c in contract.columns:
        if not c.nullable:
            checks.append((F.col(f"`{c.name}`").isNull(), f"{c.name} is null"))
        if c.max_length is not None:
            too_long = F.coalesce(F.length(F.col(f"`{c.name}`")) > c.max_length, F.lit(False))
            checks.append((too_long, f"{c.name} longer than {c.max_length}"))
    return checks


def _any(checks: Sequence[tuple[Column, str]]) -> Column:
    return reduce(lambda a, b: a | b, [broken for broken, _ in checks], F.lit(False))


def _reasons(checks: Sequence[tuple[Column, str]]) -> Column:
    """The reasons of the broken checks as an array, by concatenation (no lambda, stays in generated code)."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(broken, F.array(F.lit(reason))).otherwise(none) for broken, reason in checks])


def is_violated(contract: Contract) -> Column:
    """Whether a conformed row breaks any constraint: an ``OR`` of the plain checks."""
    return _any(violations(contract))


def _flag_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add boolean ``_dup_key``: the row's key value occurs more than once.

    Duplicated keys are found with a partially aggregated count per key and
    joined back; the rows are the preserved side of that left join, so a hot
    key's partition can be split by adaptive skew handling.
    """
    dups = key_violations(df, keys).select(*[F.col(k).alias(f"__dk_{k}") for k in keys])
    cond = None
    for k in keys:
        c = df[k] == dups[f"__dk_{k}"]
        cond = c if cond is None else cond & c
    first = f"__dk_{keys[0]}"
    return (
        df.join(dups, cond, "left")
        .withColumn("_dup_key", F.col(first).isNotNull())
        .drop(*[f"__dk_{k}" for k in keys])
    )


def enforce_contract(
    df: DataFrame,
    contract: Contract,
    mode: str = "quarantine",
    check_key: bool = False,
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of an already conformed DataFrame.

    ``rejects`` carries a ``reasons`` array.  With ``check_key`` every row
    whose primary key value is shared by another row is rejected too (a NULL
    key is left to the NOT NULL check).  In
    ``mode='fail'`` a violation raises (one bounded ``limit(1)`` probe) and
    ``rejects`` is empty.  Rows are split on a plain boolean, and only rejected
    rows build their reasons; with ``materialize`` the rows are written once to
    the shared folder (as Parquet) first, so ``df`` is computed once: repeated keys
    are found in the written rows (key columns only), and both results read those.
    """
    checks, columns = violations(contract), df.columns
    if materialize:
        df = stage(df, f"split-{contract.name}")
    if check_key and contract.primary_key:
        df = _flag_duplicate_keys(df, contract.primary_key)
        checks.append((F.col("_dup_key"), f"{', '.join(contract.primary_key)} duplicated"))
    broken = _any(checks)
    valid = df.filter(~broken).select(*[F.col(f"`{c}`") for c in columns])
    rejects = df.filter(broken).withColumn("reasons", _reasons(checks)).drop("_dup_key")
    if mode == "fail":
        first = rejects.limit(1).collect()
        if first:
            raise ValueError(f"{contract.name}: contract violated: {first[0]['reasons']}")
    return valid, rejects


def reject_summary(rejects: DataFrame) -> DataFrame:
    """(reason, n_rows): rows rejected for each reason (a row may have several)."""
    return (
        rejects.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count ``n``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
