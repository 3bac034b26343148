"""All-or-nothing publication of a set of tables.

All tables of a release are written to fresh folders and checked first; then
the catalog's locations are switched.  Until the switch readers see the old
release whole, and an error anywhere puts every location back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators.contract import Contract
from stellate.plans.warehouse import create_tables, write_tables


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def location(spark: SparkSession, table: str) -> str:
    """Where the catalog says the table's files are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").collect()  # one row
    return rows[0]["data_type"]


def _point(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    base: str,
    prefix: str = "",
    check: Callable[[Mapping[str, DataFrame]], None] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Write every table to a new release folder, check them, switch the catalog to it; report as of ``write_tables``.

    ``contracts`` hold the columns of each table (by table name); a table that the catalog does
    not know is created empty first.  ``check`` gets the written tables and
    raises to reject the release.  The folders of earlier releases stay, so
    running readers and a later ``rollback`` find them.
    """
    release = f"{base.rstrip('/')}/release-{uuid.uuid4().hex[:12]}"
    report = write_tables(spark, tables, release, parallel=parallel)
    written = {n: spark.read.schema(df.schema).parquet(f"{release}/{n}") for n, df in tables.items()}
    for name, contract in contracts.items():
        if name in written and written[name].columns != contract.names:
            raise ValueError(f"{name}: columns {written[name].columns} instead of {contract.names}")
    if check:
        check(written)
    for name in tables:
        table = f"{prefix}{name}"
        if not spark.catalog.tableExists(table):
            create_tables(spark, [contracts[name]], f"{base.rstrip('/')}/empty", prefix)
    switch(spark, {f"{prefix}{n}": f"{release}/{n}" for n in tables})
    return report.withColumn("release", F.lit(release))


def switch(spark: SparkSession, places: Mapping[str, str]) -> dict[str, str]:
    """Point every table to its new folder, or none: an error puts those already switched back.  Returns the old folders."""
    old = {t: location(spark, t) for t in places}
    done = []
    try:
        for table, path in places.items():
            done.append(table)
            _point(spark, table, path)
    except Exception:
        for table in done:
            _point(spark, table, old[table])
        raise
    return old


def rollback(spark: SparkSession, old: Mapping[str, str]) -> None:
    """Back to the folders that ``switch`` returned."""
    switch(spark, old)
