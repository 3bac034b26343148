"""Code lists: ``value <name>`` blocks of ``code = 'label'`` lines closed by ``;``.

Parsing is a Spark job over any number of label files: each file is one row
(``wholetext``), blocks and entries are pulled out with regular expressions and
exploded, so several files parse in parallel and nothing passes through the
driver.  Lists are small by nature; the result is meant to be broadcast (see
``stellate.operators.lookup.bounded_broadcast``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns of the code-list text format.
# A block: a line starting with "value", an optional "$", the list name, then
# everything up to the first ";".
BLOCK_PATTERN = r"(?ms)^[ \t]*value[ \t]+\$?\w+\s[^;]*;"
# The list name inside a block.
NAME_PATTERN = r"value[ \t]+\$?(\w+)"
# One entry: a quoted or bare code, "=", a quoted label in which '' is a quote.
ENTRY_PATTERN = r"(?m)^[ \t]*('[^'\r\n]*'|-?\w+)[ \t]*=[ \t]*'((?:[^'\r\n]|'')*)'"
# Pieces of the text: a quoted string of one line, a block comment, or anything between.
PIECE_PATTERN = r"(?s)'[^'\r\n]*'|/\*.*?\*/|[^'/]+|['/]"
# A ";" inside quotes is held back as the first of these characters until the blocks are cut; either
# of them in the text itself is written as the second and a digit meanwhile.
HELD = "\ue000\ue001"
_HELD_FORMS = ((HELD[1], HELD[1] + "1"), (HELD[0], HELD[1] + "0"), (";", HELD[0]))


def _hold(c: Column) -> Column:
    for own, held in _HELD_FORMS:
        c = F.replace(c, F.lit(own), F.lit(held))
    return c


def _release(c: Column) -> Column:
    for own, held in reversed(_HELD_FORMS):
        c = F.replace(c, F.lit(held), F.lit(own))
    return c


def _protected(text: Column) -> Column:
    """The text without comments, its quoted ``;`` held back; quotes hide both ``;`` and ``/*``."""
    piece = F.transform(
        F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0)),
        lambda p: F.when(p.startswith("/*"), F.lit(" "))
        .when(p.startswith("'"), _hold(p)).otherwise(p),
    )
    return F.array_join(piece, "")


def _clean_code(c: Column) -> Column:
    return F.trim(_release(F.regexp_replace(c, r"^'|'$", "")))


def _clean_label(c: Column) -> Column:
    return F.trim(_release(F.translate(F.replace(c, F.lit("''"), F.lit("'")), "\t", "")))


def parse_code_lists(
    spark: SparkSession, paths: str | Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """(list_name, code, label) for every entry of every list in ``paths``.

    Codes and labels are trimmed, ``''`` becomes ``'``, tabs are dropped from
    labels.  When a code repeats inside a list the last entry wins.
    """
    raw = spark.read.text(paths, wholetext=True)
    blocks = raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.posexplode(F.regexp_extract_all(_protected(F.col("value")), F.lit(BLOCK_PATTERN), 0)).alias("_bpos", "_block"),
    )
    entries = blocks.select(
        "_file",
        "_bpos",
        F.regexp_extract("_block", NAME_PATTERN, 1).alias("list_name"),
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("_block", F.lit(ENTRY_PATTERN), 1).alias("code"),
                F.regexp_extract_all("_block", F.lit(ENTRY_PATTERN), 2).alias("label"),
            )
        ).alias("_epos", "_e"),
    )
    if names:
        entries = entries.filter(F.col("list_name").isin(list(names)))
    tidy = entries.select(
        "list_name",
        _clean_code(F.col("_e.code")).alias("code"),
        _clean_label(F.col("_e.label")).alias("label"),
        F.struct("_file", "_bpos", "_epos").alias("_pos"),
    )
    return tidy.groupBy("list_name", "code").agg(
        F.max_by("label", "_pos").alias("label")
    )


def code_list(parsed: DataFrame, name: str) -> DataFrame:
    """One list of a parsed file as (code, label)."""
    return parsed.filter(F.col("list_name") == name).select("code", "label")


def inline_code_list(
    spark: SparkSession,
    mapping: Mapping[object, str],
    code_type: T.DataType | str = "string",
    code_col: str = "code",
    label_col: str = "label",
) -> DataFrame:
    """A literal code list with an explicit schema (no inference)."""
    if isinstance(code_type, str):
        code_type = T._parse_datatype_string(code_type)
    schema = T.StructType(
        [T.StructField(code_col, code_type, False), T.StructField(label_col, T.StringType(), True)]
    )
    return spark.createDataFrame(list(mapping.items()), schema)


def render_code_list(
    df: DataFrame, list_col: str, code_col: str, label_col: str, max_entries: int = 10_000
) -> DataFrame:
    """Render (list, code, label) rows as code-list text, one block per row.

    The output has one string column ``value`` suitable for ``write.text``.
    Lines end in CRLF, codes are quoted, codes and labels are tab-padded and
    quotes in labels are doubled, as in hand-written label files.  What the
    format cannot carry is refused: line breaks and tabs in either, quotes in
    codes.  A list longer than ``max_entries``
    is cut into several blocks of the same name by a hash of the code, so no
    block (one row, built in one task) grows with the data; the parser merges
    blocks of one name.
    """
    from stellate.operators.lookup import bounded_broadcast

    code, label = F.col(code_col).cast("string"), F.col(label_col).cast("string")
    refused = F.rlike(code, F.lit("['\t\r\n]")) | F.rlike(label, F.lit("[\t\r\n]"))
    line = F.when(refused, F.raise_error(F.concat(F.lit("a code list cannot carry code "), code, F.lit(" with label "), label))).otherwise(
        F.concat(F.lit("\t'"), code, F.lit("'\t=\t'"), F.replace(label, F.lit("'"), F.lit("''")), F.lit("'")))
    sizes = df.groupBy(F.col(list_col).alias("_list")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(max_entries)).cast("long").alias("_chunks")
    )
    rows = df.select(F.col(list_col).alias("_list"), F.col(code_col).alias("_code"), line.alias("_line"))
    chunked = rows.join(bounded_broadcast(sizes), "_list").select(
        "_list", F.pmod(F.xxhash64("_code"), F.col("_chunks")).alias("_chunk"), "_line"
    )
    grouped = chunked.groupBy("_list", "_chunk").agg(F.array_sort(F.collect_list("_line")).alias("_lines"))
    return grouped.select(
        F.concat(
            F.lit("  value "),
            F.col("_list"),
            F.lit("\r\n"),
            F.array_join("_lines", "\r\n"),
            F.lit("\r\n;\r\n"),
        ).alias("value")
    )
