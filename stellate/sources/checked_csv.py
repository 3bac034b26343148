"""Delimited text without silent loss: every line is a row or a reject with its reason.

Lines are read as text, so nothing has been cut or padded when they are judged.
Quoted fields follow the usual rule (a quote inside is doubled); the well-formed
lines are parsed by Spark's own CSV parser.  All values are strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A whole quoted field; possessive, so long fields need no stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_MARK = "\x01"


def _lines(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str) -> DataFrame:
    """line, header (whether it is the header line), file; blank lines are none."""
    line = F.regexp_replace("value", "^﻿", "")
    heads = [sep.join(columns), sep.join(f'"{c}"' for c in columns)]
    return (
        spark.read.text(path).where(F.trim("value") != "")
        .select(line.alias("line"), line.isin(heads).alias("header"), F.col("_metadata.file_path").alias("file"))
    )


def _reason(line: Column, width: int, sep: str) -> Column:
    """Why a line is no row of ``width`` fields; null if it is one."""
    bare = F.regexp_replace(line, _QUOTED, _MARK)
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    beside = F.contains(F.replace(F.concat(F.lit(sep), bare, F.lit(sep)), F.lit(f"{sep}{_MARK}{sep}"), F.lit(f"{sep}{sep}")), F.lit(_MARK))
    return (
        F.when(F.contains(bare, F.lit('"')), F.lit("unbalanced quote"))
        .when(beside, F.lit("text beside a quoted field"))
        .when(fields != width, F.concat(fields.cast("string"), F.lit(f" fields instead of {width}")))
    )


def read_csv_checked(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of header CSV files whose columns are ``columns``.

    ``rejects`` has file, line and reason (too many or too few fields, a quote
    that is not closed, text beside a quoted field).  A line equal to the header is one.  A field
    that spans lines is not read: its lines are rejects.  Empty fields are NULL, quoted or not, as in ``read_csv_strings``.
    """
    if len(sep) != 1:
        raise ValueError("the separator is one character")
    own = _lines(spark, path, columns, sep).where("not header").withColumn("reason", _reason(F.col("line"), len(columns), sep))
    ddl = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("line", F.lit(ddl), {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST"})
    rows = own.where("reason is null").select(parsed.alias("r")).select("r.*")
    return rows, own.where("reason is not null").select("file", "line", "reason")


def header_report(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """(file, headers, lines, ok): files whose header is missing, repeated or names other columns have ok = false."""
    lines = _lines(spark, path, columns, sep)
    return lines.groupBy("file").agg(F.count_if("header").alias("headers"), F.count_if(~F.col("header")).alias("lines")).withColumn("ok", F.col("headers") == 1)
