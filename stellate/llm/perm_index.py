"""Operator 2, approximate nearest neighbours by a permutation index.

``pivots`` vectors (a bounded sample of distinct vectors, by hash) are shared.
Every vector is represented by its ``depth`` nearest pivots in order; per index
segment of about ``segment`` vectors the positions are posted in inverted files,
one posting list (vector, position) a pivot.  A query walks the posting lists of
its own nearest pivots, accumulates Spearman's footrule distance between the two
orders (a pivot missing from an order has position ``depth``), takes the nearest
``share`` of each segment as candidates and reranks them by the inner product of
the original vectors in double precision.  Nearness of pivots is the inner
product with the normalised pivots.

All vectors are indexed once: a segment's vectors and postings are one packed row of a
written table.  Queries, packed in pieces with their own orders, meet the segments
on a grid of blocks of pieces and shelves of at most ``SHELF_SEGMENTS`` segments; a
task keeps the best ``top`` of each of its queries over all its segments, and only
those go on to the merge.  Equal vectors are
indexed once with their top+1 smallest ids (found by a group limit before the
shuffle), which is all that ties to the smaller vec_id can ask for.

Vectors that are null, zero, hold null or non-finite components, or whose length
is not the commonest one (ties: the shorter) take no part, nor do null ids.
Repeated rows (one id, one vector) count once; an id with several vectors is a
candidate with each and asks with the smallest.  ``least`` vectors of a segment are
reranked at least (twice ``top``), so a table of no more is searched exactly.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.llm.common import meet_on_grid, small_batches, stored, stored_observed

PIVOTS, DEPTH, SEGMENT, SHARE, LEAST, TOP = 256, 32, 4096, 0.35, 40, 20
PIECE, BLOCKS, SHELVES, SHELF_SEGMENTS = 512, 64, 64, 64
RESULT = "query_id long, vec_id long, score double"


def orders(x: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """rows x depth: the nearest pivots of each vector, nearest first; ties to the lower pivot."""
    near = x @ pivots.T
    depth = min(depth, near.shape[1])
    part = np.argpartition(-near, depth - 1, axis=1)[:, :depth] if depth < near.shape[1] else np.tile(np.arange(depth), (len(x), 1))
    part.sort(axis=1)
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable"), 1)


def inverted_files(order: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posting lists: vector and position, and the start of each pivot's list."""
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    return (by // order.shape[1]).astype(np.int32), (by % order.shape[1]).astype(np.int16), np.searchsorted(flat[by], np.arange(pivots + 1))


def footrule(order: np.ndarray, vectors: np.ndarray, positions: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Footrule distance, up to a constant, of one query's order to every vector of a segment.

    A shared pivot at positions i and j adds |i - j| in place of (depth - i) + (depth - j).
    """
    depth = len(order)
    lists = [slice(starts[p], starts[p + 1]) for p in order]
    ids = np.concatenate([vectors[s] for s in lists])
    gain = np.concatenate([np.abs(positions[s] - i) - (2 * depth - i - positions[s]) for i, s in enumerate(lists)])
    return np.bincount(ids, weights=gain, minlength=count)


def _vectors(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _index_task(pivots: np.ndarray, depth: int):
    """One segment: its vectors, their ids, and its inverted files, packed in one row."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        x = _vectors(part["v"])
        vectors, positions, starts = inverted_files(orders(x, pivots, depth), len(pivots))
        ends = np.cumsum([0, *part["ids"].str.len()]).astype(np.int32)
        cells = [x, np.concatenate(part["ids"].to_list()).astype(np.int64), ends, vectors, positions, starts.astype(np.int32)]
        return pd.DataFrame([[int(part["part"].iloc[0]), *[c.tobytes() for c in cells]]], columns=["part", "x", "ids", "id_ends", "vectors", "positions", "starts"])
    return run


def _piece_task(pivots: np.ndarray, depth: int):
    """Queries packed with their own orders of pivots."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        q = _vectors(part["v"])
        cells = [part["vec_id"].to_numpy(np.int64), q, orders(q, pivots, depth).astype(np.int32)]
        return pd.DataFrame([[int(part["piece"].iloc[0]), *[c.tobytes() for c in cells]]], columns=["piece", "query_ids", "q", "orders"])
    return run


class _Found:
    """The nearest found so far of each query of a piece."""

    def __init__(self, row, top: int):
        self.queries = np.frombuffer(row.query_ids, np.int64)
        self.q = np.frombuffer(row.q, np.float64).reshape(len(self.queries), -1)
        self.orders = np.frombuffer(row.orders, np.int32).reshape(len(self.queries), -1)
        self.top = top
        self.best = [(np.zeros(0), np.zeros(0, np.int64))] * len(self.queries)

    def search(self, row, share: float, least: int) -> None:
        x = np.frombuffer(row.x, np.float64).reshape(-1, self.q.shape[1])
        ids, ends = np.frombuffer(row.ids, np.int64), np.frombuffer(row.id_ends, np.int32)
        vectors, positions, starts = (np.frombuffer(b, t) for b, t in ((row.vectors, np.int32), (row.positions, np.int16), (row.starts, np.int32)))
        positions = positions.astype(np.int64)
        take = min(len(x), max(least, int(np.ceil(share * len(x)))))
        for k, query in enumerate(self.queries):
            far = footrule(self.orders[k], vectors, positions, starts, len(x))
            cand = np.arange(len(x)) if take == len(x) else np.argpartition(far, take - 1)[:take]
            score = x[cand] @ self.q[k]
            # the query's own vector may hold other ids, so one more than asked for; all ties at the end: the ids decide
            if len(score) > self.top + 1:
                near = np.flatnonzero(score >= -np.partition(-score, self.top)[self.top])
                cand, score = cand[near], score[near]
            many = ends[cand + 1] - ends[cand]
            own = ids[np.repeat(ends[cand] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            score = np.repeat(score, many)
            other = own != query
            s, i = np.concatenate([self.best[k][0], score[other]]), np.concatenate([self.best[k][1], own[other]])
            order = np.lexsort((i, -s))[: self.top]
            self.best[k] = (s[order], i[order])


def _search_task(share: float, least: int, top: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[int, _Found] = {}
        for f in frames:
            for row in f.itertuples(index=False):
                (pieces.get(row.piece) or pieces.setdefault(row.piece, _Found(row, top))).search(row, share, least)
        for p in pieces.values():
            yield pd.DataFrame({"query_id": np.repeat(p.queries, [len(s) for s, _ in p.best]), "vec_id": np.concatenate([i for _, i in p.best]),
                                "score": np.concatenate([s for s, _ in p.best])})
    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array<double>): the rows that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
    common = v.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1)
    return v.join(F.broadcast(common.select("dim")), F.size("v") == F.col("dim"), "left_semi")  # one row


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP, pivots: int = PIVOTS, depth: int = DEPTH, segment: int = SEGMENT,
            piece: int = PIECE, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` nearest of ``vectors`` for each of ``queries`` (both as from ``usable``)."""
    spark = vectors.sparkSession
    # WindowGroupLimit keeps top+1 rows of a vector per task before the shuffle, however many copies there are
    first = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    few = vectors.withColumn("_r", first).where(F.col("_r") <= top + 1)
    index, seen = stored_observed(few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "index", n=F.count(F.lit(1)))
    asked, qseen = stored_observed(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries", n=F.count(F.lit(1)))
    sample = index.orderBy(F.xxhash64("v"), "v").limit(pivots).select("v").collect()  # ``pivots`` rows
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    p = np.array([r["v"] for r in sample], dtype=np.float64)
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    segments = max(1, -(-int(seen["n"]) // segment))
    pieces = max(1, -(-int(qseen["n"]) // piece))
    # the postings are built and written once; every search reads them
    dealt = index.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(segments)))
    parts = stored(dealt.groupBy("part").applyInPandas(
        _index_task(p, depth), "part long, x binary, ids binary, id_ends binary, vectors binary, positions binary, starts binary"), "postings")
    packed = asked.withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.lit(pieces)).cast("int")).groupBy("piece").applyInPandas(
        _piece_task(p, depth), "piece int, query_ids binary, q binary, orders binary")
    met = meet_on_grid(packed, parts, min(pieces, BLOCKS), max(min(segments, SHELVES), -(-segments // SHELF_SEGMENTS)))
    with small_batches(spark, 2):
        found = stored(met.mapInPandas(_search_task(share, least, top), RESULT), "found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
