"""Operator 13, hard negatives by cover trees over norm-augmented candidates.

Scores are integer inner products of quantised vectors.  Every candidate gets one
more coordinate, sqrt(M*M - |x|*|x|) with M the largest norm, so that all have
the same length and the largest inner product with a query (whose added
coordinate is 0) is the nearest neighbour.  A node of a tree stands for a
candidate c and covers others within its radius r; then every score below it lies in
q.c - |q| r .. q.c + |q| r.

1. One row an id is left, and of equal vectors with equal label the smallest ids
   that a result can ask for (found by a group limit before the shuffle).
2. Candidates go to the nearest of at most ``CELLS`` centres (a sample by hash); a
   cell of many rows is split by hash.  Each part of about ``TREE_ROWS``
   becomes a cover tree: the children of a node cover half its power of two, are
   further apart than that, and carry their own measured radius.
3. Queries, packed in pieces, meet all trees on a grid: at most ``BLOCKS`` blocks of
   pieces, and shelves of at most ``SHELF_TREES`` trees (``SHELVES`` at least).  A task keeps the best found so far of each of its queries
   and walks a tree best first: each round opens the nodes of the highest upper
   bounds of every query, scores their children exactly, raises the thresholds, and
   drops nodes whose bounds lie outside all of the query's windows.  Pruning allows
   for rounding, scores are exact integers, so the result is exact.
4. The first search finds each anchor's positives (equal label), the second the
   negatives in the windows of their scores (other label).

Rows with null id, null label, null vector, or any null or non-finite component
take no part; of rows that repeat an id the one with the smallest label, then
vector, counts.  Shorter vectors count as padded with zeros.  Ties go to the
smaller id.  An empty table gives no rows.  A component of 2**24 or more (after
quantisation) is refused.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.llm.common import meet_on_grid, small_batches, stored, stored_observed

CELLS, TREE_ROWS, SHELVES, SHELF_TREES, BLOCKS, PIECE = 256, 2048, 8, 256, 64, 256
LEAF, WIDTH, LIMIT = 8, 32, 1 << 24
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
_FAR = 1 << 62


def quantised(vectors: DataFrame, scale: int = 256, modulus: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label, vec of the rows that take part: components floor(scale * x), labels of ids divisible by ``modulus`` moved on by one."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    checked = f"if(abs(x * {scale}) < {LIMIT}, cast(floor(x * {scale}) as bigint), raise_error('component out of range'))"
    return rows.select("vec_id", F.expr(f"if(vec_id % {modulus} = 0, (label + 1) % {labels}, label)").alias("label"), F.expr(f"transform(embedding, x -> {checked})").alias("vec"))


def cover_tree(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """point, radius, first child, end of children and fresh (not its parent again) of every node, from a matrix of distances."""
    point, radius, first, end, fresh = [0], [float(d[0].max())], [0], [0], [True]
    todo = deque([(0, np.arange(1, len(d)))])

    def add(p: int, below: np.ndarray, new: bool) -> None:
        point.append(p)
        radius.append(float(d[p, below].max()) if len(below) else 0.0)
        first.append(0)
        end.append(0)
        fresh.append(new)
        if len(below):
            todo.append((len(point) - 1, below))

    none = np.zeros(0, dtype=np.int64)
    while todo:
        node, below = todo.popleft()
        if not len(below):
            continue
        first[node] = len(point)
        p, r = point[node], radius[node]
        if len(below) <= LEAF or r <= 0:
            for q in below:
                add(int(q), none, True)
        else:
            half = 2.0 ** (np.ceil(np.log2(r)) - 1)
            away = d[p, below]
            if len(near := below[away <= half]):
                add(p, near, False)
            rest = below[away > half]
            while len(rest):
                q = int(rest[0])
                away = d[q, rest]
                mine = rest[away <= half]
                add(q, mine[mine != q], True)
                rest = rest[away > half]
        end[node] = len(point)
    return np.array(point, np.int32), np.array(radius), np.array(first, np.int32), np.array(end, np.int32), np.array(fresh, bool)


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int32)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _gaps(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Distances of norm-augmented vectors."""
    na, nb = (a * a).sum(1), (b * b).sum(1)
    top = largest * largest
    more = np.sqrt(np.maximum(top - na, 0))[:, None] - np.sqrt(np.maximum(top - nb, 0))[None]
    return np.sqrt(np.maximum(na[:, None] + nb[None] - 2 * (a @ b.T), 0) + more * more)


def _cell_task(centres: np.ndarray, width: int, largest: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            cell = np.zeros(len(f), dtype=np.int32)
            for i in range(0, len(f), 1024):
                cell[i : i + 1024] = _gaps(_padded(f["vec"].iloc[i : i + 1024], width).astype(float), centres, largest).argmin(1)
            yield f.assign(cell=cell)
    return run


def _tree_task(width: int, largest: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["label"], kind="stable")
        x = _padded(part["vec"], width)
        point, radius, first, end, fresh = cover_tree(_gaps(x.astype(float), x.astype(float), largest))
        ends = np.cumsum([0, *part["ids"].str.len()]).astype(np.int32)
        cells = [x, part["label"].to_numpy(np.int64), np.concatenate(part["ids"].to_list()).astype(np.int64), ends, point, radius, first, end, fresh]
        return pd.DataFrame([[(int(part["cell"].iloc[0]) << 32) + int(part["sub"].iloc[0]), *[c.tobytes() for c in cells]]],
                            columns=["part", "vecs", "labels", "ids", "id_ends", "point", "radius", "first", "end", "fresh"])
    return run


def cover_trees(rows: DataFrame, keep: int, tree_rows: int = TREE_ROWS, max_cells: int = CELLS) -> tuple[DataFrame, int, int]:
    """One row per cover tree over ``rows`` (vec_id, label, vec; one row an id), the vectors' width, the number of trees."""
    spark = rows.sparkSession
    place = Window.partitionBy("vec", "label").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= keep)
    norm = F.expr("aggregate(vec, 0D, (a, x) -> a + cast(x as double) * x)")
    groups, seen = stored_observed(few.groupBy("vec", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "candidates",
                                   n=F.count(F.lit(1)), width=F.max(F.size("vec")), norm=F.max(norm))
    width, largest = max(int(seen["width"] or 0), 1), float(np.sqrt(seen["norm"] or 0.0)) + 1e-9
    cells = min(max(-(-int(seen["n"]) // tree_rows), 1), max_cells)
    # a sample of at most ``max_cells`` vectors
    sample = [r["vec"] for r in groups.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(cells).collect()]
    centres = np.unique(_padded(pd.Series(sample), width), axis=0).astype(float) if sample else np.zeros((1, width))
    placed = stored(groups.mapInPandas(_cell_task(centres, width, largest), "vec array<bigint>, label bigint, ids array<bigint>, cell int"), "cells")
    # a row per cell: at most ``max_cells``
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tree_rows).cast("int").alias("subs"))
    dealt = placed.join(F.broadcast(parts), "cell").withColumn("sub", F.pmod(F.xxhash64("vec", "label"), F.col("subs")).cast("int")).drop("subs")
    schema = "part bigint, vecs binary, labels binary, ids binary, id_ends binary, point binary, radius binary, first binary, end binary, fresh binary"
    trees, seen = stored_observed(dealt.groupBy("cell", "sub").applyInPandas(_tree_task(width, largest), schema), "cover-trees", n=F.count(F.lit(1)))
    return trees, width, int(seen["n"])


def _piece_task(width: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        windows = max(part["lo"].str.len().max(), 1)
        lo, hi = np.full((len(part), windows), 1, np.int64), np.full((len(part), windows), 0, np.int64)  # empty windows where a query has fewer
        for i, (a, b) in enumerate(zip(part["lo"], part["hi"])):
            lo[i, : len(a)], hi[i, : len(b)] = a, b
        cells = [part["vec_id"].to_numpy(np.int64), part["label"].to_numpy(np.int64), _padded(part["vec"], width), lo, hi]
        return pd.DataFrame([[int(part["piece"].iloc[0]), *[c.tobytes() for c in cells]]], columns=["piece", "qids", "qlabels", "qvecs", "lo", "hi"])
    return run


class _Piece:
    """The queries of a piece and the best found for each of their windows."""

    def __init__(self, row, width: int, keep: int, same: bool):
        self.ids, self.labels = np.frombuffer(row.qids, np.int64), np.frombuffer(row.qlabels, np.int64)
        self.x = np.frombuffer(row.qvecs, np.int32).reshape(-1, width).astype(float)
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.lo, self.hi = (np.frombuffer(b, np.int64).reshape(len(self.ids), -1) for b in (row.lo, row.hi))
        self.floor = self.lo.copy()  # rises to the last kept score
        self.keep, self.same = keep, same
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, scores: np.ndarray, want: np.ndarray, points: np.ndarray, tree: dict) -> None:
        """Scores (query x point) of newly met points, where wanted."""
        equal = tree["labels"][points][None] == self.labels[:, None]
        want = want & (equal if self.same else ~equal)
        found = [(self.key, self.score, self.id)]
        for w in range(self.lo.shape[1]):
            ok = want & (scores >= self.floor[:, w, None]) & (scores <= self.hi[:, w, None])
            if not ok.any():
                continue
            if ok.sum() > 16 * self.keep * len(self.ids) and scores.shape[1] > self.keep + 1:
                # one more than kept: the query itself may be among them; equal scores all stay
                least = -np.partition(np.where(ok, -scores, np.inf), self.keep, axis=1)[:, self.keep]
                ok &= scores >= least[:, None]
            a, c = np.nonzero(ok)
            p = points[c]
            many = tree["id_ends"][p + 1] - tree["id_ends"][p]
            at = np.repeat(tree["id_ends"][p] - np.cumsum(many) + many, many) + np.arange(many.sum())
            ids, a = tree["ids"][at], np.repeat(a, many)
            s = np.repeat(scores[np.nonzero(ok)].astype(np.int64), many)
            other = ids != self.ids[a]
            found.append((a[other] * self.lo.shape[1] + w, s[other], ids[other]))
        if len(found) == 1:
            return
        key, score, ident = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ident, -score, key))
        key, score, ident = key[order], score[order], ident[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        nth = np.arange(len(key)) - np.repeat(start, np.diff(np.r_[start, len(key)]))
        full = nth == self.keep - 1
        self.floor.reshape(-1)[key[full]] = np.maximum(self.floor.reshape(-1)[key[full]], score[full])
        top = nth < self.keep
        self.key, self.score, self.id = key[top], score[top], ident[top]

    def inside(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Whether bounds (query x node) meet any window that is still open."""
        out = np.zeros(lower.shape, dtype=bool)
        for w in range(self.lo.shape[1]):
            out |= (upper >= self.floor[:, w, None]) & (lower <= self.hi[:, w, None]) & (self.lo[:, w, None] <= self.hi[:, w, None])
        return out

    def walk(self, tree: dict) -> int:
        """Best-first descent through one tree; the number of scores computed."""
        vecs, point, radius, first, end, fresh = (tree[k] for k in ("vecs", "point", "radius", "first", "end", "fresh"))
        scores = self.x @ vecs[point[:1]].T
        self.offer(scores, np.ones(scores.shape, bool), point[:1], tree)
        reach = self.norm[:, None] * radius[None, :1] + 0.5
        nodes, lower, upper = np.zeros(1, np.int64), scores - reach, scores + reach
        upper = np.where(self.inside(lower, upper), upper, -np.inf)
        width, done = WIDTH, scores.size
        while True:
            live = (upper > -np.inf).any(0) & (end[nodes] > first[nodes])
            nodes, lower, upper = nodes[live], lower[:, live], upper[:, live]
            if not len(nodes):
                return done
            chosen = upper > -np.inf
            if len(nodes) > width:
                chosen &= upper >= -np.partition(-upper, width - 1, axis=1)[:, width - 1, None]
            picked = np.flatnonzero(chosen.any(0))
            many = end[nodes[picked]] - first[nodes[picked]]
            child = np.repeat(first[nodes[picked]] - np.cumsum(many) + many, many) + np.arange(many.sum())
            want = chosen[:, np.repeat(picked, many)]
            scores = self.x @ vecs[point[child]].T
            done += scores.size
            new = fresh[child]
            self.offer(scores[:, new], want[:, new], point[child[new]], tree)
            inner = end[child] > first[child]
            reach = self.norm[:, None] * radius[None, child[inner]] + 0.5
            low, up = scores[:, inner] - reach, scores[:, inner] + reach
            up = np.where(want[:, inner], up, -np.inf)
            nodes = np.concatenate([nodes, child[inner]])
            lower = np.concatenate([lower, low], axis=1)
            upper = np.concatenate([np.where(chosen, -np.inf, upper), up], axis=1)
            upper = np.where(self.inside(lower, upper), upper, -np.inf)
            width *= 2


def _open_tree(row, width: int) -> dict:
    kinds = dict(vecs=np.int32, labels=np.int64, ids=np.int64, id_ends=np.int32, point=np.int32, radius=float, first=np.int32, end=np.int32, fresh=bool)
    tree = {k: np.frombuffer(getattr(row, k), t) for k, t in kinds.items()}
    return tree | {"vecs": tree["vecs"].reshape(-1, width).astype(float)}


def _walk_task(width: int, keep: int, same: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: dict[int, _Piece] = {}
        for f in frames:
            for row in f.itertuples(index=False):
                piece = pieces.get(row.piece) or pieces.setdefault(row.piece, _Piece(row, width, keep, same))
                piece.walk(_open_tree(row, width))
        for p in pieces.values():
            n = p.lo.shape[1]
            yield pd.DataFrame({"query_id": p.ids[p.key // n], "window": (p.key % n).astype(np.int32), "score": p.score, "vec_id": p.id})
    return run


def window_search(trees: tuple[DataFrame, int, int], queries: DataFrame, keep: int, same: bool, piece: int = PIECE) -> DataFrame:
    """query_id, window, rank (from 1), vec_id, score: the first ``keep`` candidates of each window lo[i] .. hi[i] of every query.

    ``trees`` as of ``cover_trees``.  ``queries``: vec_id, label, vec, lo, hi (arrays of equal length).  ``same``: candidates of the
    query's label, else of other labels; never the query's own id.
    """
    index, width, count = trees
    asked, seen = stored_observed(queries, "queries", n=F.count(F.lit(1)))
    pieces = max(-(-int(seen["n"]) // piece), 1)
    blocks = min(pieces, BLOCKS)
    packed = asked.withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.lit(pieces)).cast("int")).groupBy("piece").applyInPandas(
        _piece_task(width), "piece int, qids binary, qlabels binary, qvecs binary, lo binary, hi binary")
    met = meet_on_grid(packed, index, blocks, max(SHELVES, -(-count // SHELF_TREES)))
    with small_batches(queries.sparkSession, 16):
        found = stored(met.mapInPandas(_walk_task(width, keep, same), "query_id long, window int, score long, vec_id long"), "window-hits")
    order = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep).select("query_id", "window", "rank", "vec_id", "score")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   tree_rows: int = TREE_ROWS, max_cells: int = CELLS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, vec (quantised).  ``anchors``: vec_id of the rows that ask.  A negative's score lies between ``low`` and
    ``high`` per cent of its positive's.
    """
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")
    one = stored(one, "vectors")
    trees = cover_trees(one, max(positives + 1, negatives), tree_rows, max_cells)
    asking = one.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi")
    wide = asking.withColumn("lo", F.array(F.lit(-_FAR))).withColumn("hi", F.array(F.lit(_FAR)))
    pos = stored(window_search(trees, wide, positives, True).select(
        F.col("query_id").alias("anchor_id"), (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # below 0 the window is empty
    ask = pos.where("positive_score >= 0").withColumn("lo", F.expr(f"({low} * positive_score + 99) div 100")).withColumn("hi", F.expr(f"({high} * positive_score) div 100"))
    ask = ask.withColumn("window", F.row_number().over(Window.partitionBy("anchor_id").orderBy("window")) - 1)
    spans = ask.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("window", "lo", "hi"))).alias("s"))  # ``positives`` at most
    second = asking.join(spans, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "vec", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))
    neg = window_search(trees, second, negatives, False)
    return neg.withColumnRenamed("query_id", "anchor_id").join(ask, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
