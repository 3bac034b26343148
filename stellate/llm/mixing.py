"""Operator 4, mixing to target weights with soft domain memberships.

A classifier is trained on a bounded sample of the labelled table (documents
joined to ``labels``; ``sample`` rows, by hash, spread over the domains) and
predicts for every document the posterior of each domain: ``clean`` (good and
not toxic), ``toxic`` and ``junk`` (bad, not toxic).  Document d with posteriors
p_d and n_d tokens gets a rate r_d >= 0 such that the expected tokens of each
domain S_k, sum of r_d n_d p_dk, match the targets t_k in the least squares sense.
Projected gradient descent starts at r = 1.  Residuals are weighted by the inverse
of the domains' Gram matrix M (sum of n_d p_d p_d'), rates by tokens: the step is
r <- max(0, r + p_d . M^-1 (t - S)), whose Hessian is a projection, so a step of one
is stable and soft memberships do not slow it down.  A pass over the documents
(narrow, stored) returns only the K sums S_k (once also M) to the driver.

Features are chosen on the executors (counts by domain, in blocks) and only chosen
ones of the sample go to the driver, packed.

``copies`` turns the rate into whole copies: its floor, plus one when a hash of
doc_id (null: of tokens and posteriors) falls below the fraction.  Null and empty
texts have no tokens: rate as by their posteriors, no effect on totals.  Repeated
rows each have the rate.  Without labelled documents all posteriors are equal.  The
fit stops after ``rounds`` passes at the latest; ``fit_mix`` says what it reached
and whether that is within the tolerance.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm import textarrays as ta
from stellate.llm.common import stored, stored_observed
from stellate.llm.length_buckets import token_count

DOMAINS = ("clean", "toxic", "junk")
WEIGHTS = {"clean": 0.98, "toxic": 0.02, "junk": 0.0}
SAMPLE, DIMS, ROUNDS, TOLERANCE, CUT, COUNT_BLOCK = 6000, 1 << 16, 40, 1e-6, 8, 1024


def _letters() -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return out


LETTER = _letters()


def domain_label(quality: Column, toxic: Column) -> Column:
    """0 clean, 1 toxic, 2 junk; null where a label is missing."""
    return F.when(toxic == 1, 1).when(quality == 0, 2).when((quality == 1) & (toxic == 0), 0).cast("int")


def word_indices(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed feature, row, value): which words occur (outer marks cut off, case ignored), as 0/1, and the
    shares of shapes (what follows the letters, repetition, capitals)."""
    start, end, woffs = ta.words(data, offs)
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(woffs))
    letter = LETTER[data]
    # first letter from the word's start, one past the last letter before its end
    nxt = np.minimum.accumulate(np.where(letter, np.arange(len(data)), len(data))[::-1])[::-1] if len(data) else np.zeros(0, int)
    prv = np.maximum.accumulate(np.where(letter, np.arange(len(data)), -1)) if len(data) else np.zeros(0, int)
    a = np.minimum(nxt[start], end) if len(start) else start
    z = np.maximum(prv[end - 1] + 1, a) if len(start) else end
    h = ta.span_hashes(data, a, z)
    tail = ta.span_hashes(data, z, end)
    same = np.zeros(len(h), dtype=np.uint64)
    same[1:] = h[1:] == h[:-1]
    same[woffs[:-1][np.diff(woffs) > 0]] = 0  # a row's first word repeats nothing
    caps = ((data[start] >= 65) & (data[start] <= 90) & (data[np.minimum(start + 1, end - 1)] >= 65) & (data[np.minimum(start + 1, end - 1)] <= 90)).astype(np.uint64) if len(start) else same
    word = (h >> np.uint64(20)) % np.uint64(DIMS // 2)
    shape = np.uint64(DIMS // 2) + (ta.mix(tail * np.uint64(4) + same * np.uint64(2) + caps) >> np.uint64(20)) % np.uint64(DIMS // 2)
    key, inv = np.unique(np.concatenate([rows * DIMS + word.astype(np.int64), rows * DIMS + shape.astype(np.int64)]), return_inverse=True)
    idx, row = key % DIMS, key // DIMS
    times = np.bincount(inv, minlength=len(key))
    size = np.maximum(np.diff(woffs), 1)
    return idx, row, np.where(idx < DIMS // 2, 1.0, 8.0 * times / size[row])


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in ta.slices(batch.column(1)):
            idx, row, value = word_indices(data, offs)
            ends = np.searchsorted(row, np.arange(hi - lo + 1))
            yield pa.record_batch([
                batch.column(0).slice(lo, hi - lo), ta.packed(idx.astype(np.int32), ends), ta.packed(value.astype(np.float32), ends),
                batch.column(2).slice(lo, hi - lo)], ["doc_id", "idx", "value", "domain"])


def _count_task(kinds: int):
    """In how many documents of a domain a feature occurs, by blocks of features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((kinds, DIMS), dtype=np.int64)
        for batch in batches:
            for idx, domain in zip(batch.column(0), batch.column(1)):
                total[domain.as_py()][np.frombuffer(idx.as_buffer(), dtype=np.int32)] += 1
        cut = total.reshape(kinds, -1, COUNT_BLOCK)
        k, block = np.nonzero(cut.any(axis=2))
        ends = np.arange(len(k) + 1, dtype=np.int32) * COUNT_BLOCK
        yield pa.record_batch([pa.array(k.astype(np.int32)), pa.array(block.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(cut[k, block].ravel()))],
                              ["domain", "block", "n"])
    return run


def _sum_counts(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"domain": part["domain"].iloc[:1], "block": part["block"].iloc[:1], "n": [np.sum(np.stack(part["n"].to_numpy()), axis=0)]})


def _thin_task(use: np.ndarray):
    """Keeps the chosen features of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in batch.column(1)]
            val = [np.frombuffer(x.as_buffer(), dtype=np.float32) for x in batch.column(2)]
            ok = [use[i] for i in idx]
            yield pa.record_batch([batch.column(0), pa.array([i[o].tobytes() for i, o in zip(idx, ok)], pa.binary()), pa.array([v[o].tobytes() for v, o in zip(val, ok)], pa.binary()),
                                   batch.column(3)], ["doc_id", "idx", "value", "domain"])
    return run


def chosen_features(counts: np.ndarray, sizes: np.ndarray, least: int = 5, z_least: float = 4.0) -> np.ndarray:
    """Which features tell domains apart: words by the z score of their counts (feature x domain), shapes by their number alone."""
    expect = counts.sum(axis=1, keepdims=True) * sizes / max(sizes.sum(), 1)
    z = np.abs(counts - expect) / np.sqrt(np.maximum(expect, 0.5))
    often = counts.sum(axis=1) >= least
    return often & ((z.max(axis=1) >= z_least) | (np.arange(len(counts)) >= DIMS // 2))


def fit_domains(rows: list, kinds: int, steps: int = 200, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression on the chosen hashed features of the rows (idx, value, domain)."""
    if not rows:
        return np.zeros((DIMS, kinds)), np.zeros(kinds)
    idx = np.frombuffer(b"".join(r["idx"] for r in rows), dtype=np.int32)
    val = np.frombuffer(b"".join(r["value"] for r in rows), dtype=np.float32)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r["idx"]) // 4 for r in rows])
    y = np.array([r["domain"] for r in rows])
    size = np.bincount(y, minlength=kinds).astype(np.float64)
    w, b = np.zeros((DIMS, kinds)), np.log(np.maximum(size, 0.5) / size.sum())
    weight = (1.0 / np.maximum(size, 1) / (size > 0).sum())[y]
    b[:] = np.where(size > 0, 0.0, -20.0)
    m, v = np.zeros_like(w), np.zeros_like(w)
    hot = np.eye(kinds)[y]
    for t in range(1, steps + 1):
        zed = np.stack([np.bincount(row, weights=val * w[idx, k], minlength=len(rows)) for k in range(kinds)], axis=1) + b
        p = np.exp(zed - zed.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = weight[:, None] * (p - hot)
        gw = np.stack([np.bincount(idx, weights=val * g[row, k], minlength=DIMS) for k in range(kinds)], axis=1) + l2 * w
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        rate = 0.2 / (1 + t / 50)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-5)
        b -= rate * g.sum(axis=0)
    return w, b


def _posterior_task(used: np.ndarray, w: np.ndarray, b: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros((DIMS, len(b)))
        full[used] = w
        for batch in batches:
            for lo, hi, data, offs in ta.slices(batch.column(1)):
                idx, row, value = word_indices(data, offs)
                z = np.stack([np.bincount(row, weights=value * full[idx, k], minlength=hi - lo) for k in range(len(b))], axis=1) + b
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                ends = np.arange(hi - lo + 1, dtype=np.int32) * len(b)
                part = batch.slice(lo, hi - lo)
                yield pa.record_batch([*part.columns[:1], *part.columns[2:], pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))],
                                      ["doc_id", *part.schema.names[2:], "p"])
    return run


def train_domains(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(used features, their weights, intercepts) of the domain classifier."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_label(F.col("quality"), F.col("toxic")).alias("domain"))
    known = known.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = stored(known.join(own.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    order = [F.xxhash64("doc_id", F.lit(4)), F.col("doc_id")]
    picked = None
    for k in range(len(DOMAINS)):
        part = known.where(F.col("domain") == k).orderBy(*order).limit(sample // len(DOMAINS))
        picked = part if picked is None else picked.unionByName(part)
    picked = stored(picked, "sample")  # at most ``sample`` rows
    # of an id's rows the smallest text: no more rows than the sample has ids
    train = own.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    schema = "doc_id long, idx binary, value binary, domain int"
    feats = stored(train.select("doc_id", "text", "domain").mapInArrow(_feature_task, schema).where("octet_length(idx) > 0"), "domain-features")
    counts, sizes = np.zeros((DIMS, len(DOMAINS))), np.zeros(len(DOMAINS))
    blocks = feats.select("idx", "domain").mapInArrow(_count_task(len(DOMAINS)), "domain int, block int, n array<long>")
    for r in blocks.groupBy("domain", "block").applyInPandas(_sum_counts, "domain int, block int, n array<long>").collect():  # DIMS counters a domain
        counts[r["block"] * COUNT_BLOCK : (r["block"] + 1) * COUNT_BLOCK, r["domain"]] = r["n"]
    for r in feats.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect():  # a row a domain
        sizes[r["domain"]] = r["n"]
    rows = feats.mapInArrow(_thin_task(chosen_features(counts, sizes)), schema).collect()  # at most ``sample`` rows of chosen features
    rows = sorted(rows, key=lambda r: r["doc_id"])
    w, b = fit_domains(rows, len(DOMAINS))
    used = np.flatnonzero(np.abs(w).max(axis=1) > 0)
    return used, w[used], b


def domain_posteriors(docs: DataFrame, model: tuple, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, p: posterior of each of DOMAINS for every row of ``docs``; ``carry`` as c0, c1, ..."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), token_count(F.col("text")).alias("n_tokens"),
                        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    extra = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(carry))
    return sized.mapInArrow(_posterior_task(*model), f"doc_id long, n_tokens long, {extra}p array<double>")


def pushed(rate: str, pushes: list[list[float]]) -> Column:
    """The rate after the gradient steps in order: one fold over a literal array, whatever their number."""
    if not pushes:
        return F.expr(rate)
    steps = ", ".join(f"array({', '.join(f'{float(g)!r}D' for g in push)})" for push in pushes)
    move = " + ".join(["0D", *[f"p[{k}] * g[{k}]" for k in range(len(pushes[0]))]])
    return F.expr(f"aggregate(array({steps}), {rate}, (r, g) -> greatest(0D, r + ({move})))")


def fit_rates(members: DataFrame, weights: list[float], total: float | None = None, rounds: int = ROUNDS,
              tolerance: float = TOLERANCE) -> tuple[DataFrame, dict]:
    """Adds ``rate`` to rows of (n_tokens, p); returns the targets and reached totals too.

    ``total`` is the token target over all domains; by default as many as the heaviest weighted domain
    supplies at rate 1.
    """
    kinds = len(weights)
    sums = {f"s{k}": F.sum(F.col("rate") * F.col("n_tokens") * F.col("p")[k]) for k in range(kinds)}
    gram = {f"m{k}_{j}": F.sum(F.col("n_tokens") * F.col("p")[k] * F.col("p")[j]) for k in range(kinds) for j in range(kinds)}
    now, seen = stored_observed(members.withColumn("rate", F.lit(1.0)), "members", **sums, **gram)
    supply = np.array([seen[f"s{k}"] or 0.0 for k in range(kinds)])
    share = np.array(weights, dtype=float) / max(sum(weights), 1e-300)
    top = int(np.argmax(share))
    total = supply[top] / share[top] if total is None else total
    target = share * total
    inverse = np.linalg.pinv(np.array([[seen[f"m{k}_{j}"] or 0.0 for j in range(kinds)] for k in range(kinds)]), rcond=1e-9, hermitian=True)
    reached, pending, pushes = supply, [], []
    for _ in range(rounds):
        if np.abs(target - reached).max(initial=0) <= tolerance * max(total, 1):
            break
        pending.append([float(x) for x in inverse @ (target - reached)])
        pushes.append(pending[-1])
        moved = now.withColumn("rate", pushed("rate", pending))  # replayed from the last written rates
        if len(pending) == CUT:
            now, got = stored_observed(moved, "members", **sums)
            pending = []
        else:
            got = moved.agg(*[c.alias(k) for k, c in sums.items()]).first().asDict()
        reached = np.array([got[f"s{k}"] or 0.0 for k in range(kinds)])
    met = bool(np.abs(target - reached).max(initial=0) <= tolerance * max(total, 1))
    return now.withColumn("rate", pushed("rate", pending)), {
        "target": target.tolist(), "reached": reached.tolist(), "supply": supply.tolist(), "met": met, "pushes": pushes}


def copies_of(rate: str, doc_id: str = "doc_id") -> Column:
    one = F.coalesce(F.col(doc_id), F.xxhash64("n_tokens", "p"))  # rows without id draw by what is known of them
    draw = F.shiftrightunsigned(F.xxhash64(one, F.lit(44)), 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + (draw < F.col(rate) - F.floor(rate)).cast("long")).cast("long")


def fit_mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, sample: int = SAMPLE) -> tuple[DataFrame, dict]:
    """(doc_id, n_tokens, p_clean, p_toxic, p_junk, rate, copies for every row of ``docs``; target, reached and supplied tokens by
    domain, and whether the targets are met)."""
    weights = weights or WEIGHTS
    rated, fit = fit_rates(domain_posteriors(docs, train_domains(docs, labels, sample)), [weights[d] for d in DOMAINS])
    rows = rated.select("doc_id", "n_tokens", *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate", copies_of("rate").alias("copies"))
    return rows, {k: dict(zip(DOMAINS, fit[k])) for k in ("target", "reached", "supply")} | {"met": fit["met"]}


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``fit_mix``."""
    return fit_mix(docs, labels, weights, sample)[0]


def mixed_rows(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says.

    The rates are a function of a row's posteriors and the few pushes of the fit, so they are applied in
    one more scan instead of a join.
    """
    weights = weights or WEIGHTS
    model = train_domains(docs, labels, sample)
    _, fit = fit_rates(domain_posteriors(docs, model), [weights[d] for d in DOMAINS])
    rows = domain_posteriors(docs, model, tuple(docs.columns)).withColumn("rate", pushed("1D", fit["pushes"]))
    rows = rows.withColumn("copies", copies_of("rate")).where("copies > 0").withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
