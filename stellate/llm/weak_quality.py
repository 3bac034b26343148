"""Operator 1, quality classifier from weak labels.

Nine overlapping heuristic labellers vote junk, good or nothing on every
document (repeated words, repeated word pairs, symbol tails, table bars, capitals,
exclamations, punctuation, vocabulary, sentences).  The corpus is reduced to counts of vote
patterns (3**9 at most, so they fit the driver whatever the input), and
expectation-maximisation over those counts estimates the share of junk and each
labeller's accuracies.  The posterior of a document's pattern labels it, and a
logistic regression over hashed shape features is fitted to the posteriors of a
bounded sample (``sample`` doc_ids, half from each side of 0.5, by hash; of an
id's rows the smallest text, with its own posterior).  The linear scorer then scores every whole text; 0.5 and more is kept.

Null texts and texts without words have score 0 and are not kept.  Repeated rows
get the same score.  With no document on one side of the posterior the scorer
cannot be fitted and the posterior itself is the score.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import textarrays as ta
from stellate.llm.common import stored

LABELLERS = ("repeats", "pairs", "tails", "bars", "capitals", "shouts", "marks", "vocabulary", "sentences")
DIMS, SAMPLE, KEEP = 1 << 14, 6000, 0.5
SHORT = np.array([64, 12])  # bytes and words at which a text speaks half as loud as a long one


def _byte_set(text: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(text.encode(), dtype=np.uint8)] = True
    return out


UPPER, LOWER, DIGIT = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _byte_set("abcdefghijklmnopqrstuvwxyz"), _byte_set("0123456789")
MARK = _byte_set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
STRANGE = _byte_set("#$%&*+<=>@\\^_`{|}~")
# shape class of each byte: lower, upper, digit, blank, line feed, high byte, then every mark by itself
SHAPE = np.zeros(256, dtype=np.uint32)
SHAPE[UPPER], SHAPE[DIGIT], SHAPE[[32, 9, 11, 12, 13]], SHAPE[10], SHAPE[128:] = 1, 2, 3, 4, 5
SHAPE[MARK] = np.arange(6, 6 + MARK.sum())


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[offs[1:]] - total[offs[:-1]]).astype(np.float64)


def labeller_votes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """rows x labellers: -1 junk, 1 good, 0 no vote."""
    start, end, woffs = ta.words(data, offs)
    n = np.diff(woffs)
    h = ta.span_hashes(data, start, end)
    same = np.zeros(len(h), dtype=bool)
    same[1:] = h[1:] == h[:-1]
    same[woffs[:-1][n > 0]] = False
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    one = np.maximum(n, 1)
    letters = np.maximum(_per_row(UPPER[data] | LOWER[data] | (data >= 192), offs), 1)
    kinds = np.array([len(np.unique(h[a:b])) for a, b in zip(woffs[:-1], woffs[1:])], dtype=np.float64)
    pair = h.copy()
    pair[1:] = ta.mix(h[1:] * np.uint64(3) + h[:-1])
    pairs = np.array([len(np.unique(pair[a + 1 : b])) for a, b in zip(woffs[:-1], woffs[1:])], dtype=np.float64) / np.maximum(n - 1, 1)
    repeats = _per_row(same, woffs) / one
    tails = _per_row(STRANGE[last], woffs) / one
    bars = _per_row((last == 124) & (end - start == 1), woffs) / one
    capitals = _per_row(UPPER[data], offs) / letters
    shouts = _per_row(last == 33, woffs) / one
    marks = _per_row(MARK[data], offs) / np.maximum(np.diff(offs), 1)
    variety = kinds / one
    stops = _per_row(last == 46, woffs) / one

    def vote(junk, good):
        return np.where(junk, -1, np.where(good, 1, 0))

    votes = np.stack([
        vote(repeats > 0.2, repeats < 0.05),
        vote((pairs < 0.5) & (n >= 20), pairs > 0.8),
        vote(tails > 0.2, tails < 0.05),
        vote(bars > 0.1, bars < 0.02),
        vote(capitals > 0.4, capitals < 0.2),
        vote(shouts > 0.1, shouts < 0.03),
        vote(marks > 0.1, marks < 0.06),
        vote((variety < 0.25) & (n >= 20) & (n <= 400), variety > 0.5),
        vote((stops < 0.01) & (n >= 40), stops > 0.03),
    ], axis=1).astype(np.int8)
    votes[n < 3] = 0
    return votes


def _vote_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = 3 ** np.arange(len(LABELLERS))
    for batch in batches:
        for lo, hi, data, offs in ta.slices(batch.column(1)):
            code = ((labeller_votes(data, offs) + 1) * base).sum(axis=1)
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(code.astype(np.int32))], ["doc_id", "pattern"])


def weak_votes(docs: DataFrame) -> DataFrame:
    """doc_id, pattern: the votes of all labellers as one base-3 number."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_vote_task, "doc_id long, pattern int")


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict:
    """EM for two classes: share of good, P(vote | class) of each labeller, posterior P(good) of each pattern.

    Starts from the votes themselves (a junk vote outweighs good ones, for a labeller sees one kind of
    junk only); each labeller keeps a weak prior to be better than chance, which fixes which class is which.
    """
    m = len(LABELLERS)
    votes = (patterns[:, None] // 3 ** np.arange(m)) % 3  # 0 junk, 1 none, 2 good
    hot = votes[:, :, None] == np.arange(3)
    counts = counts.astype(np.float64)
    post = np.where((votes == 0).any(axis=1), 0.05, np.where((votes == 2).any(axis=1), 0.95, 0.5))
    prior = np.array([[2.0, 1.0, 1.0], [1.0, 1.0, 2.0]])  # junk class, good class
    total = max(counts.sum(), 1)
    for _ in range(rounds):
        weight = np.stack([(1 - post) * counts, post * counts])
        share = (weight.sum(axis=1) + 1) / (total + 2)
        like = np.einsum("cp,pjv->cjv", weight, hot) + prior[:, None, :]
        like /= like.sum(axis=2, keepdims=True)
        # an abstention says nothing of the class: only cast votes count
        cast = np.where(np.arange(3) == 1, 0.0, np.log(like))
        score = np.log(share)[:, None] + np.einsum("cjv,pjv->cp", cast, hot)
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -60, 60)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            post = new
            break
        post = new
    return {"good": float(share[1]), "junk_vote": like[:, :, 0], "good_vote": like[:, :, 2], "posterior": post}


def shape_indices(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature of every byte position (shapes of 4 bytes, ending there) and of every word (last bytes,
    repetition), with the row of each."""
    c = SHAPE[data]
    code = c.copy()
    since = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))  # a row's first bytes see nothing of the row before
    for back in (1, 2, 3):
        before = np.concatenate([np.zeros(min(back, len(c)), np.uint32), c[:-back]])
        code = code * np.uint32(41) + np.where(since >= back, before, np.uint32(0)) + np.uint32(back)
    at = ((code * np.uint32(2654435761)) >> np.uint32(18)) % np.uint32(DIMS // 2)
    start, end, woffs = ta.words(data, offs)
    h = ta.span_hashes(data, start, end)
    same = np.zeros(len(h), dtype=np.uint32)
    same[1:] = h[1:] == h[:-1]
    same[woffs[:-1][np.diff(woffs) > 0]] = 0
    tail = c[end - 1] * np.uint32(41) + c[np.maximum(end - 2, start)] if len(end) else np.zeros(0, np.uint32)
    long = np.minimum(end - start, 20).astype(np.uint32)
    word = ((tail * np.uint32(2) + same) * np.uint32(21) + long) * np.uint32(2246822519)
    word = DIMS // 2 + (word >> np.uint32(18)) % np.uint32(DIMS // 2)
    rows = np.arange(len(offs) - 1)
    return (np.concatenate([at, word]).astype(np.int64),
            np.concatenate([np.repeat(rows, np.diff(offs)), np.repeat(rows, np.diff(woffs))]))


def _share(rows: np.ndarray, idx: np.ndarray, n: int) -> np.ndarray:
    """Weight of one occurrence: one over the row's count in its family (bytes, words), held down in short rows,
    whose few words say little."""
    family = (idx >= DIMS // 2).astype(np.int64)
    size = np.bincount(rows * 2 + family, minlength=2 * n)
    return 1.0 / (size + np.tile(SHORT, n))[rows * 2 + family]


def _feature_task(posteriors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(len(LABELLERS))
        for batch in batches:
            for lo, hi, data, offs in ta.slices(batch.column(1)):
                idx, rows = shape_indices(data, offs)
                key, inv = np.unique(rows * DIMS + idx, return_inverse=True)
                value = np.bincount(inv, weights=_share(rows, idx, hi - lo), minlength=len(key)).astype(np.float32)
                ends = np.searchsorted(key // DIMS, np.arange(hi - lo + 1))
                code = ((labeller_votes(data, offs) + 1) * base).sum(axis=1)
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo), ta.packed((key % DIMS).astype(np.int32), ends), ta.packed(value, ends),
                    pa.array([posteriors[int(x)] for x in code], pa.float64())], ["doc_id", "idx", "value", "posterior"])
    return run


def fit_scorer(rows: list, steps: int = 300, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression (full-batch, Adam) of posteriors on sparse feature shares; balanced by side."""
    size = np.array([len(r["idx"]) // 4 for r in rows])
    idx = np.frombuffer(b"".join(r["idx"] for r in rows), dtype=np.int32)
    val = np.frombuffer(b"".join(r["value"] for r in rows), dtype=np.float32)
    row = np.repeat(np.arange(len(rows)), size)
    y = np.array([r["posterior"] for r in rows])
    # square roots spread the shares of rare and common shapes
    weight = np.where(y >= 0.5, 0.5 / max((y >= 0.5).sum(), 1), 0.5 / max((y < 0.5).sum(), 1))
    w, b, m, v, mb, vb = np.zeros(DIMS), 0.0, np.zeros(DIMS), np.zeros(DIMS), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=val * w[idx], minlength=len(rows)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        gw = np.bincount(idx, weights=val * g[row], minlength=DIMS) + l2 * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.3 / (1 + t / 100)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-6)
    return w.astype(np.float32), float(b)


def _score_task(w: np.ndarray | None, b: float, posteriors: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(len(LABELLERS))
        for batch in batches:
            for lo, hi, data, offs in ta.slices(batch.column(1)):
                code = ((labeller_votes(data, offs) + 1) * base).sum(axis=1)
                post = np.array([posteriors[int(x)] for x in code])
                if w is None:
                    score = post.copy()
                else:
                    idx, rows = shape_indices(data, offs)
                    z = np.bincount(rows, weights=w[idx] * _share(rows, idx, hi - lo), minlength=hi - lo) + b
                    score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                score[np.diff(ta.words(data, offs)[2]) == 0] = 0.0
                part = batch.slice(lo, hi - lo)
                yield pa.record_batch([*part.columns[:1], *part.columns[2:], pa.array(code.astype(np.int32)), pa.array(post), pa.array(score)],
                                      ["doc_id", *part.schema.names[2:], "pattern", "posterior", "score"])
    return run


def classify_quality(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, pattern, posterior, score, kept for every row of ``docs``; ``carry`` names columns of docs to pass
    through (as c0, c1, ...), so that a filter on the decision needs no join."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    votes = stored(weak_votes(own), "votes")
    # 3**9 patterns at most
    seen = votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    patterns, counts = (np.array([r[k] for r in seen], dtype=np.int64) for k in (0, 1))
    if not len(patterns):
        extra = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
        return spark.createDataFrame([], f"doc_id long, {extra}pattern int, posterior double, score double, kept boolean")
    model = fit_label_model(patterns, counts)
    posteriors = {int(p): float(x) for p, x in zip(patterns, model["posterior"])}
    labels = spark.createDataFrame(list(posteriors.items()), "pattern int, posterior double")
    posts = votes.where("doc_id is not null").join(F.broadcast(labels), "pattern")
    # one row an id before the limit, so that a repeated id takes one place
    by_id = posts.groupBy("doc_id").agg(F.min("posterior").alias("posterior"))
    picked = [
        by_id.where(side).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample // 2).select("doc_id")
        for side in (F.col("posterior") >= 0.5, F.col("posterior") < 0.5)
    ]
    chosen = stored(picked[0].unionByName(picked[1]), "sample")  # at most ``sample`` rows
    train = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = train.mapInArrow(_feature_task(posteriors), "doc_id long, idx binary, value binary, posterior double").collect()
    rows = sorted((r for r in rows if len(r["idx"])), key=lambda r: r["doc_id"])
    y = [r["posterior"] for r in rows]
    w, b = fit_scorer(rows) if rows and min(y) < 0.5 <= max(y) else (None, 0.0)
    b += float(np.log(model["good"] / (1 - model["good"])))  # the fit weighs both sides alike; the corpus doesn't
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    extra = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    scored = whole.mapInArrow(_score_task(w, b, posteriors), f"doc_id long, {extra}pattern int, posterior double, score double")
    return scored.withColumn("kept", F.col("score") >= keep)
