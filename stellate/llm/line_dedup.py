"""Operator 3, line deduplication by overlapping three-line windows.

A text is split at line feeds; every run of three consecutive lines is a
window, identified by two 64-bit hashes of its lines (trailing blanks are
ignored; windows of blank lines only don't count).  A window that occurs more
than once in the corpus keeps its first occurrence (by doc_id, then position);
the lines that later occurrences cover are merged and removed.  Where a later
occurrence overlaps the first one in the same document, only the lines beyond
the first occurrence are covered, so one copy always remains.

Texts of fewer than three lines, null and empty texts stay as they are.  Rows
that repeat a doc_id are told apart by a digest of the text; full repetitions
of a row share one result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import stored

LINES = 3


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def windows(docs: DataFrame, k: int = LINES) -> DataFrame:
    """doc_id, tag, pos, h1, h2: every window of k lines; tag tells rows of one doc_id apart."""
    keyed = (
        _lines(docs).where("text is not null")
        .withColumn("ls", F.transform(F.split("text", "\n"), lambda x: F.rtrim(x)))
        .where(F.size("ls") >= k)
        .select("doc_id", F.xxhash64("text").alias("tag"), F.expr("transform(ls, x -> if(x = '', 0L, xxhash64(x)))").alias("a"),
                F.expr("transform(ls, x -> if(x = '', 0L, xxhash64(7, x)))").alias("b"))
    )
    spots = keyed.select("doc_id", "tag", "a", "b", F.explode(F.sequence(F.lit(0), F.size("a") - k)).alias("pos"))
    first = [f"a[pos + {i}]" for i in range(k)]
    second = [f"b[pos + {i}]" for i in range(k)]
    return spots.where(" or ".join(f"{x} <> 0" for x in first)).select(
        "doc_id", "tag", "pos", F.expr(f"xxhash64({', '.join(first)})").alias("h1"), F.expr(f"xxhash64({', '.join(second)})").alias("h2"))


def repeated_lines(docs: DataFrame, k: int = LINES) -> DataFrame:
    """doc_id, tag, gone: positions of the lines that go, merged and sorted, for documents that lose any."""
    spots = stored(windows(docs, k), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag", "pos")
    # partial aggregates: a window held by a third of all documents stays a row per task
    groups = spots.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = spots.join(groups, ["h1", "h2"]).where("not (doc_id <=> first.doc_id and tag = first.tag and pos = first.pos)")
    start = F.when(F.expr("doc_id <=> first.doc_id and tag = first.tag"), F.greatest("pos", F.col("first.pos") + k)).otherwise(F.col("pos"))
    covered = later.withColumn("lo", start).where(F.col("lo") < F.col("pos") + k).select("doc_id", "tag", "lo", (F.col("pos") + (k - 1)).alias("hi")).distinct()
    # one document's covered lines: as many as it has lines
    return covered.select("doc_id", "tag", F.explode(F.sequence("lo", "hi")).alias("at")).groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def dedup_lines(docs: DataFrame, k: int = LINES) -> DataFrame:
    """doc_id, text, clean_text, n_lines, n_removed, for every row of ``docs``."""
    gone = repeated_lines(docs, k).select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "gone")
    own = _lines(docs).withColumn("tag", F.xxhash64("text")).withColumn("_ls", F.split("text", "\n"))
    joined = own.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    # the lines are cut once a text (bound as ls), not once a line
    kept = F.expr("transform(array(_ls), ls -> array_join(transform(array_except(sequence(0, size(ls) - 1), gone), i -> get(ls, i)), '\n'))[0]")
    return joined.select(
        "doc_id", "text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("clean_text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_ls")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
