"""The corpus pipeline: documents through five of the training-data operators, each stage written and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.  Nulls in
any column pass through; what each operator makes of null and empty texts is in
its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.common import DOC_COLUMNS, stored, table
from stellate.llm.length_buckets import pack
from stellate.llm.mixing import mixed_rows
from stellate.llm.stream_dedup import kept_rows
from stellate.llm.tensor_minhash import near_duplicates, text_mark
from stellate.llm.weak_quality import classify_quality

NEAR_SHINGLE = 5  # operator 8's own contract has four words


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier keeps; null texts and texts without words go."""
    rest = DOC_COLUMNS
    scored = classify_quality(docs, carry=rest).where("kept")
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id."""
    return kept_rows(docs.select(*DOC_COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, similarity 0.8), the one with the smallest
    doc_id; rows without id stay."""
    marked = docs.select(*DOC_COLUMNS, text_mark().alias("mark"))
    # by id and text: another text under the same doc_id stays
    gone = near_duplicates(docs, k=NEAR_SHINGLE, mark=True).where("not head").select("doc_id", "mark").distinct()
    return marked.join(gone, ["doc_id", "mark"], "left_anti").select(*DOC_COLUMNS)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows at the rates that bring the domains' tokens to the default targets."""
    return mixed_rows(docs.select(*DOC_COLUMNS), table(spark, sf_dir, "labels"))


def length_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document left."""
    return pack(docs)


STAGES = [
    ("weak_label_quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("target_weight_mix", target_mix),
    ("length_bucket_packing", length_batches),
]

# Stages with trained models are not SQL; tests/llm checks each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
