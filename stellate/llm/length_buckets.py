"""Operator 5, packing into optimal length buckets.

One global histogram of token counts (words between ASCII white space) goes to
the driver; its size is bounded: counts up to 1024 have a bin each, above that
a bin keeps ten leading bits, so there are 512 bins per doubling.  Dynamic
programming over the bins finds the bucket boundaries that minimise padding for
at most ``buckets`` buckets; a bucket's length is the largest count in it.
Inside a bucket rows are shuffled by a hash and cut into batches of
``budget // bucket length`` rows (one at least: a text longer than the budget is
a batch of its own).  Every row is placed, by a distributed rank.

Null and empty texts have no tokens and take a slot like others.  Repeated rows
each take a slot.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import ordered_rank, stored

BUCKETS, BUDGET = 16, 16384


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _bin(n: Column) -> Column:
    """The count itself up to 1024; above, its ten leading bits."""
    width = F.when(n <= 1024, F.lit(0)).otherwise(F.greatest(F.floor(F.log2(n.cast("double"))) - 9, F.lit(0))).cast("int")
    return F.expr("shiftright(n_tokens, w)"), width


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of the buckets with the least total of bucket length times rows; ties: fewer buckets."""
    m = len(lengths)
    if not m:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    edge = np.asarray(lengths, dtype=np.float64)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    back, costs = [], []
    for _ in range(min(buckets, m)):
        nxt, where = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + edge[j - 1] * (total[j] - total[:j])
            i = int(np.argmin(cost))
            nxt[j], where[j] = cost[i], i
        back.append(where)
        costs.append(nxt[m])
        best = nxt
    b, j, out = int(np.argmin(costs)), m, []
    for where in reversed(back[: b + 1]):
        out.append(int(lengths[j - 1]))
        j = where[j]
    return out[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch_id, slot, padding for every row of ``docs``."""
    spark = docs.sparkSession
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), token_count(F.col("text")).alias("n_tokens"))
    sized = stored(sized, "token-counts")
    key, width = _bin(F.col("n_tokens"))
    bins = sized.withColumn("w", width).groupBy("w", key.alias("b")).agg(F.max("n_tokens").alias("top"), F.count(F.lit(1)).alias("n"))
    # bounded: 1024 bins and 512 per doubling
    hist = sorted((r["top"], r["n"]) for r in bins.collect())
    bounds = best_boundaries(np.array([h[0] for h in hist], dtype=np.int64), np.array([h[1] for h in hist], dtype=np.int64), buckets)
    if not bounds:
        return spark.createDataFrame([], "doc_id long, n_tokens long, bucket int, bucket_len long, batch_id long, slot int, padding long")
    rows = [0] * len(bounds)
    for top, n in hist:
        rows[int(np.searchsorted(bounds, top))] += n
    fit = [max(1, budget // max(1, b)) for b in bounds]
    first_row = np.concatenate([[0], np.cumsum(rows)])
    first_batch = np.concatenate([[0], np.cumsum([-(-r // f) for r, f in zip(rows, fit)])])

    def pick(values) -> Column:
        out = F.lit(int(values[len(bounds) - 1]))
        for i in range(len(bounds) - 2, -1, -1):
            out = F.when(F.col("bucket") == i, F.lit(int(values[i]))).otherwise(out)
        return out.cast("long")

    bucket = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[i], F.lit(i)).otherwise(bucket)
    placed = sized.withColumn("bucket", bucket).withColumn("_h", F.xxhash64("doc_id", F.lit(5)))
    ranked = ordered_rank(placed, ["bucket", "_h", "doc_id", "n_tokens"], "_rank", "packed")
    at = F.col("_rank") - pick(first_row)
    return (
        ranked.withColumn("bucket_len", pick(bounds)).withColumn("_at", at).withColumn("_fit", pick(fit))
        .select("doc_id", "n_tokens", "bucket", "bucket_len", (pick(first_batch) + F.expr("_at div _fit")).alias("batch_id"),
                F.expr("_at % _fit").cast("int").alias("slot"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
    )
