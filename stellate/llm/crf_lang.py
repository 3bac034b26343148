"""Operator 10, language identification with a linear-chain conditional random field.

Words (runs of letters) of a text form one chain.  A word's features are hashed:
its character bigrams and trigrams with word edges, affixes of three letters and
itself, if it is in the lexicon (words seen twice in training).  Weights and the
transitions between languages are learned by maximum likelihood on code-switched
chains spliced from segments of a bounded sample of labelled documents
(``per_language`` documents a language, by hash of doc_id, ``chains`` chains).
Forward-backward gives every word the posterior of each language; a document's
prediction is the language with the largest mean posterior (ties: first by
name), its score that mean.

Long chains are cut into blocks whose transfer matrices are multiplied first, so
the posteriors are those of the whole text at bounded depth of Python loops.

Learning uses text and lang of rows with crc32(doc_id) mod 4 other than 2; a
prediction uses the text only.  Null texts and texts without a letter are ``und``
with score 0; so is everything when there is nothing to learn from.  A null
doc_id is not learned from and not held out.  Repeated rows get equal results.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.llm import textarrays as ta
from stellate.llm.common import stored

BI, TRI, AFFIX, LEX = 1 << 15, 1 << 17, 1 << 16, 1 << 17
OFF_TRI, OFF_AFFIX, OFF_LEX = BI, BI + TRI, BI + TRI + AFFIX
DIMS = BI + TRI + AFFIX + LEX
BLOCK, CHAIN, PER_LANGUAGE, CHAINS, BATCH = 32, 40, 300, 3600, 300
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Lower-case letter of each code point of the basic plane; 0 for what is not a letter."""
    if not _FOLD:
        out = np.zeros(1 << 16, dtype=np.uint32)
        for i in range(1 << 16):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _FOLD.append(out)
    return _FOLD[0]


def letters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0: no letter) of all rows, each followed by two zeros, and the rows' offsets."""
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        at = lead[offs]
    except UnicodeDecodeError:
        rows = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32) for a, b in zip(offs[:-1], offs[1:])]
        points = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
        at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    plane = points < (1 << 16)
    z = _fold()[np.where(plane, points, 0)]
    for point in np.unique(points[~plane]):
        if chr(point).isalpha():
            z[points == point] = point
    size = np.diff(at) + 2
    out_at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(out_at[-1], dtype=np.uint32)
    out[np.arange(len(z)) + 2 * np.repeat(np.arange(len(size)), np.diff(at))] = z
    return out, out_at


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), dtype=np.uint32)
    for p in parts:
        h = (h ^ p) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    return h * np.uint32(2654435761)


def word_spans(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end of each word and word offsets by row."""
    inside = (z != 0).astype(np.int8)
    edge = np.diff(inside, prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return start, end, np.searchsorted(start, at)


def gram_indices(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigram and trigram feature ending at every position."""
    one, two = np.concatenate([[0], z[:-1]]).astype(np.uint32), np.concatenate([[0, 0], z[:-2]]).astype(np.uint32)
    bi = _hash(one, z)
    tri = _hash(two, one, z)
    return (bi >> np.uint32(17)).astype(np.int64), OFF_TRI + (tri >> np.uint32(15)).astype(np.int64)


def grams_at(z: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gram_indices`` of some positions only (each after two letters or edges at least, but for the first two)."""
    one, two = np.where(pos >= 1, z[pos - 1], 0).astype(np.uint32), np.where(pos >= 2, z[pos - 2], 0).astype(np.uint32)
    return (_hash(one, z[pos]) >> np.uint32(17)).astype(np.int64), OFF_TRI + (_hash(two, one, z[pos]) >> np.uint32(15)).astype(np.int64)


def word_indices(z: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prefix and suffix feature, lexicon feature and 64-bit identity of every word."""
    size = (end - start).astype(np.uint32)
    get = lambda i, ok: np.where(ok, z[np.clip(i, 0, len(z) - 1)], 0).astype(np.uint32)
    prefix = _hash(np.ones_like(size), *[get(start + i, size > i) for i in range(3)])
    suffix = _hash(np.full_like(size, 2), *[get(end - 1 - i, size > i) for i in range(3)])
    power, inverse = ta._powers(len(z) + 1)
    total = np.zeros(len(z) + 1, dtype=np.uint64)
    np.cumsum(ta.mix(z.astype(np.uint64)) * power[: len(z)], out=total[1:])
    word = ta.mix((total[end] - total[start]) * inverse[start])
    return (OFF_AFFIX + (prefix >> np.uint32(16)).astype(np.int64), OFF_AFFIX + (suffix >> np.uint32(16)).astype(np.int64),
            OFF_LEX + (word >> np.uint64(47)).astype(np.int64), word)


def emissions(z: np.ndarray, start: np.ndarray, end: np.ndarray, w: np.ndarray) -> np.ndarray:
    """words x languages: the summed weights of each word's features."""
    if not len(start):
        return np.zeros((0, w.shape[1]))
    bi, tri = gram_indices(z)
    per_char = w[bi] + w[tri]
    edges = np.column_stack([start, end + 1]).ravel()  # n-grams up to the one that ends in the word's closing edge
    per_char = np.concatenate([per_char, np.zeros((1, w.shape[1]), w.dtype)])
    out = np.add.reduceat(per_char, edges, axis=0)[::2].astype(np.float64)
    pre, suf, lex, _ = word_indices(z, start, end)
    return out + w[pre] + w[suf] + w[lex]


def forward_backward(e: np.ndarray, woffs: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Posterior of each label of each word; a row's words are one chain, entered from a uniform label."""
    n, k = e.shape
    if not n:
        return np.zeros((0, k))
    e = np.exp(e - e.max(axis=1, keepdims=True))
    e = np.maximum(e, 1e-30)
    step = np.exp(trans - trans.max())
    words = np.diff(woffs)
    blocks = -(-words // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    row = np.repeat(np.arange(len(words)), blocks)
    nth = np.arange(first[-1]) - first[row]
    begin = woffs[row] + nth * BLOCK
    size = np.minimum(woffs[row + 1] - begin, BLOCK)
    norm = lambda a: a / a.max(axis=tuple(range(1, a.ndim)), keepdims=True)
    total = len(size)
    by = np.argsort(-size, kind="stable")  # at step t the blocks that still have words come first
    begin, size = begin[by], size[by]
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(BLOCK)]
    move = np.tile(np.eye(k), (total, 1, 1))
    for t in range(BLOCK):
        m = live[t]
        if not m:
            break
        move[:m] = norm((move[:m] @ step) * e[begin[:m] + t][:, None, :])
    back = np.empty_like(by)
    back[by] = np.arange(total)
    matrix = move[back]
    ahead, behind = np.full((total, k), 1.0 / k), np.ones((total, k))
    deep = int(blocks.max())
    order = np.argsort(-blocks, kind="stable")
    for j in range(1, deep):
        docs = order[: int(np.searchsorted(-blocks[order], -j, "left"))]
        b = first[docs] + j
        ahead[b] = norm(np.einsum("ni,nij->nj", ahead[b - 1], matrix[b - 1]))
    for j in range(1, deep):
        docs = order[: int(np.searchsorted(-blocks[order], -j, "left"))]
        b = first[docs + 1] - 1 - j
        behind[b] = norm(np.einsum("nij,nj->ni", matrix[b + 1], behind[b + 1]))
    ahead, behind = ahead[by], behind[by]
    post = np.zeros((n, k))
    for t in range(BLOCK):
        m = live[t]
        if not m:
            break
        ahead[:m] = norm((ahead[:m] @ step) * e[begin[:m] + t])
        post[begin[:m] + t] = ahead[:m]
    for t in range(BLOCK - 1, -1, -1):
        m = live[t]
        if not m:
            continue
        post[begin[:m] + t] *= behind[:m]
        behind[:m] = norm((e[begin[:m] + t] * behind[:m]) @ step.T)
    return post / post.sum(axis=1, keepdims=True)


def fit(rows: list, languages: list[str], chains: int = CHAINS, steps: int = 600, seed: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by maximum likelihood (Adam on batches of BATCH chains) on spliced chains of CHAIN words.

    rows: (text, lang); each chain joins segments of 4 to 20 words from random documents, so a language
    change shows as often as segments meet.
    """
    k = len(languages)
    # a slice of the sample at a time, so the decoder's temporaries stay small
    parts, ends = [], [np.zeros(1, np.int64)]
    for _, _, data, offs in ta.slices(pa.array([r["text"] for r in rows], pa.large_string())):
        part, part_at = letters(data, offs)
        ends.append(part_at[1:] + ends[-1][-1])
        parts.append(part)
    z, at = np.concatenate(parts or [np.zeros(0, np.uint32)]), np.concatenate(ends)
    del parts, ends
    start, end, woffs = word_spans(z, at)
    label = np.array([languages.index(r["lang"]) for r in rows])
    rng = np.random.default_rng(seed)
    have = [np.flatnonzero((label == i) & (np.diff(woffs) > 0)) for i in range(k)]
    known = [i for i in range(k) if len(have[i])]
    w, trans = np.zeros((DIMS, k)), np.zeros((k, k))
    if not known:
        return w.astype(np.float32), trans
    picks, tags = [], []
    for _ in range(chains):
        took: list[int] = []
        tag: list[int] = []
        while len(took) < CHAIN:
            i = known[rng.integers(len(known))]
            doc = have[i][rng.integers(len(have[i]))]
            size = int(rng.integers(4, 21))
            a = int(rng.integers(woffs[doc], max(woffs[doc] + 1, woffs[doc + 1] - size + 1)))
            part = range(a, min(a + size, int(woffs[doc + 1])))
            took.extend(part)
            tag.extend([i] * len(part))
        picks.append(took[:CHAIN])
        tags.append(tag[:CHAIN])
    pick, y = np.array(picks).ravel(), np.array(tags)
    pre, suf, lex, word = word_indices(z, start, end)
    _, inv, times = np.unique(word, return_inverse=True, return_counts=True)
    in_lexicon = times[inv] >= 2
    size = end - start + 1
    rep = np.repeat(np.arange(len(pick)), size[pick])
    pos = np.arange(size[pick].sum()) - np.repeat(np.cumsum(size[pick]) - size[pick], size[pick]) + np.repeat(start[pick], size[pick])
    own = np.arange(len(pick))
    known_word = in_lexicon[pick]
    bi, tri = grams_at(z, pos)
    idx = np.concatenate([bi, tri, pre[pick], suf[pick], lex[pick][known_word]]).astype(np.int32)
    of = np.concatenate([rep, rep, own, own, own[known_word]]).astype(np.int32)
    del bi, tri, pre, suf, lex, rep, pos
    used, idx = np.unique(idx, return_inverse=True)
    order = np.argsort(of, kind="stable")
    all_idx, all_of = idx[order].astype(np.int32), of[order]
    del idx, of, order
    all_bounds = np.searchsorted(all_of, np.arange(len(pick) + 1))
    v = np.zeros((len(used), k))
    all_hot = np.eye(k)[y]
    batch = min(BATCH, chains)
    m1, m2, t1, t2 = np.zeros_like(v), np.zeros_like(v), np.zeros_like(trans), np.zeros_like(trans)
    for s in range(1, steps + 1):
        at = (s - 1) * batch % max(chains - batch + 1, 1)
        lo, hi = all_bounds[at * CHAIN], all_bounds[(at + batch) * CHAIN]
        idx, of, hot = all_idx[lo:hi], all_of[lo:hi] - at * CHAIN, all_hot[at : at + batch]
        bounds = all_bounds[at * CHAIN : (at + batch) * CHAIN] - lo
        pairs = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
        e = np.add.reduceat(v[idx], bounds, axis=0).reshape(batch, CHAIN, k)
        p = np.exp(e - e.max(axis=2, keepdims=True))
        step = np.exp(trans)
        alpha, beta = np.empty_like(p), np.empty_like(p)
        a = np.full((batch, k), 1.0 / k)
        for t in range(CHAIN):
            a = (a @ step) * p[:, t]
            a /= a.sum(axis=1, keepdims=True)
            alpha[:, t] = a
        b = np.ones((batch, k))
        joint = np.zeros((k, k))
        for t in range(CHAIN - 1, -1, -1):
            beta[:, t] = b
            if t:
                right = p[:, t] * b
                two = alpha[:, t - 1][:, :, None] * step * right[:, None, :]
                joint += (two / two.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = right @ step.T
                b /= b.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        g = (post - hot).reshape(-1, k)[of]
        gv = np.stack([np.bincount(idx, weights=g[:, c], minlength=len(used)) for c in range(k)], axis=1) / batch + 1e-4 * v
        gt = (joint - pairs) / batch
        rate = 0.1 / (1 + s / 60)
        m1, m2 = 0.9 * m1 + 0.1 * gv, 0.99 * m2 + 0.01 * gv * gv
        v -= rate * (m1 / (1 - 0.9 ** s)) / (np.sqrt(m2 / (1 - 0.99 ** s)) + 1e-6)
        t1, t2 = 0.9 * t1 + 0.1 * gt, 0.99 * t2 + 0.01 * gt * gt
        trans = trans - rate * (t1 / (1 - 0.9 ** s)) / (np.sqrt(t2 / (1 - 0.99 ** s)) + 1e-6)
    w[used] = v
    return w.astype(np.float32), trans


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, chains: int = CHAINS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights, transitions) from the rows that may be learned from."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    order = [F.xxhash64("doc_id", F.lit(10)), F.col("doc_id"), F.col("lang")]
    if not languages:
        return [], np.zeros((DIMS, 0), np.float32), np.zeros((0, 0))
    # the first ids by hash of each language: a group limit before the shuffle, one plan whatever the number of languages
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    some = known.where(F.rlike("text", F.lit(r"\p{L}"))).select("doc_id", "lang").distinct()
    ids = some.withColumn("_n", place).where(F.col("_n") <= per_language).drop("_n")
    ids = stored(ids, "language-sample")  # per_language rows a language
    # of an id's rows in a language the smallest text with a letter
    lettered = known.where(F.rlike("text", F.lit(r"\p{L}")))
    rows = lettered.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    weights, trans = fit(rows, languages, chains)
    return languages, weights, trans


def _label(data, offs, w, trans):
    z, at = letters(data, offs)
    start, end, woffs = word_spans(z, at)
    return z, at, start, end, woffs, forward_backward(emissions(z, start, end, w), woffs, trans)


def _predict_task(model, languages: list[str], trans: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in batches:
            for lo, hi, data, offs in ta.slices(batch.column(1)):
                woffs, post = _label(data, offs, w, trans)[4:]
                words = np.diff(woffs)
                total = np.concatenate([np.zeros((1, len(languages))), np.cumsum(post, axis=0)])
                mean = (total[woffs[1:]] - total[woffs[:-1]]) / np.maximum(words, 1)[:, None]
                best = mean.argmax(axis=1)
                score = np.where(words > 0, np.clip(mean.max(axis=1), 0, 1), 0.0)
                best = np.where(words > 0, best, len(languages))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score), pa.array(words.astype(np.int64))],
                                      ["doc_id", "lang_pred", "score", "n_words"])
    return run


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, chains: int = CHAINS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words for every row of ``docs``."""
    languages, weights, trans = train(docs, per_language, chains)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not languages:
        return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_words"))
    model = docs.sparkSession.sparkContext.broadcast(weights)  # DIMS x languages floats
    found = own.mapInArrow(_predict_task(model, languages, trans), "doc_id long, lang_pred string, score double, n_words long")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words")


def label_words(text: str, languages: list[str], weights: np.ndarray, trans: np.ndarray) -> list[tuple[str, str, float]]:
    """(word, language, posterior) of every word of one code-switched text."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    z, at, start, end, _, post = _label(data, np.array([0, len(data)], dtype=np.int64), weights, trans)
    best = post.argmax(axis=1)
    return [(text[a:b], languages[i], float(p[i])) for a, b, i, p in zip(start, end, best, post)]
