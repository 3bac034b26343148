"""Operators 1, 4 and 10 and the pipeline's stages against plain Python versions."""

from __future__ import annotations

import math
import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stellate.llm import crf_lang, mixing, weak_quality
from stellate.llm.common import stored, table
from tests.llm.helpers import awkward, components, frame, shingle_set, squeezed

SF0001 = "/root/testdata/sf0.001"
MASK = (1 << 32) - 1
SPACE = {0x20, *range(0x09, 0x0E)}
UPPER, LOWER, DIGIT = set(range(65, 91)), set(range(97, 123)), set(range(48, 58))
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
STRANGE = set(b"#$%&*+<=>@\\^_`{|}~")


def byte_words(raw: bytes) -> list[bytes]:
    return raw.split() if not set(raw) & {0x1C, 0x1D, 0x1E, 0x1F} else [w for w in bytes(b if b not in SPACE else 32 for b in raw).split(b" ") if w]


def low(word: bytes) -> bytes:
    return bytes(b + 32 if b in UPPER else b for b in word)


# ---------------------------------------------------------------- operator 1


def plain_votes(text: str | None) -> list[int]:
    raw = (text or "").encode()
    words = byte_words(raw)
    n = len(words)
    if n < 3:
        return [0] * 9
    same = [low(w) for w in words]
    repeats = sum(a == b for a, b in zip(same, same[1:])) / n
    pairs = len(set(zip(same, same[1:]))) / max(n - 1, 1)
    tails = sum(w[-1] in STRANGE for w in words) / n
    bars = sum(w == b"|" for w in words) / n
    capitals = sum(b in UPPER for b in raw) / max(sum(b in UPPER or b in LOWER or b >= 192 for b in raw), 1)
    shouts = sum(w[-1:] == b"!" for w in words) / n
    marks = sum(b in MARKS for b in raw) / max(len(raw), 1)
    variety = len(set(same)) / n
    stops = sum(w[-1:] == b"." for w in words) / n

    def vote(junk, good):
        return -1 if junk else 1 if good else 0

    return [vote(repeats > 0.2, repeats < 0.05), vote(pairs < 0.5 and n >= 20, pairs > 0.8), vote(tails > 0.2, tails < 0.05), vote(bars > 0.1, bars < 0.02),
            vote(capitals > 0.4, capitals < 0.2), vote(shouts > 0.1, shouts < 0.03), vote(marks > 0.1, marks < 0.06),
            vote(variety < 0.25 and 20 <= n <= 400, variety > 0.5), vote(stops < 0.01 and n >= 40, stops > 0.03)]


def plain_em(patterns: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Posterior of good for each pattern, by loops over patterns, labellers and votes."""
    votes = {p: [(p // 3 ** j) % 3 for j in range(9)] for p in patterns}
    post = {p: 0.05 if 0 in v else 0.95 if 2 in v else 0.5 for p, v in votes.items()}
    total = sum(patterns.values())
    for _ in range(rounds):
        share = [(sum((1 - post[p]) * n for p, n in patterns.items()) + 1) / (total + 2), (sum(post[p] * n for p, n in patterns.items()) + 1) / (total + 2)]
        like = []
        for c in (0, 1):
            rows = []
            for j in range(9):
                of = [2.0, 1.0, 1.0] if c == 0 else [1.0, 1.0, 2.0]
                for p, n in patterns.items():
                    of[votes[p][j]] += (post[p] if c else 1 - post[p]) * n
                rows.append([x / sum(of) for x in of])
            like.append(rows)
        new = {}
        for p, v in votes.items():
            score = [math.log(share[c]) + sum(math.log(like[c][j][v[j]]) for j in range(9) if v[j] != 1) for c in (0, 1)]
            new[p] = 1 / (1 + math.exp(min(max(score[0] - score[1], -60), 60)))
        done = max(abs(new[p] - post[p]) for p in post) < 1e-9
        post = new
        if done:
            break
    return post


def plain_shape(b: int) -> int:
    if b in MARKS:
        return 6 + sorted(MARKS).index(b)
    return 1 if b in UPPER else 2 if b in DIGIT else 3 if b in (32, 9, 11, 12, 13) else 4 if b == 10 else 5 if b >= 128 else 0


def plain_score(text: str | None, w: np.ndarray, b: float) -> float:
    raw = (text or "").encode()
    if not byte_words(raw):
        return 0.0
    half = weak_quality.DIMS // 2
    shape = [plain_shape(x) for x in raw]
    at = []
    for i, c in enumerate(shape):
        code = c
        for back in (1, 2, 3):
            code = (code * 41 + (shape[i - back] if i >= back else 0) + back) & MASK  # a byte that is not there counts 0
        at.append((((code * 2654435761) & MASK) >> 18) % half)
    z = sum(float(w[x]) / (len(raw) + weak_quality.SHORT[0]) for x in at)
    words, before = [], None
    place = 0
    for word in byte_words(raw):
        start = raw.index(word, place)
        end = place = start + len(word)
        tail = (shape[end - 1] * 41 + shape[max(end - 2, start)]) & MASK
        same = 1 if before == low(word) else 0
        before = low(word)
        words.append((((((tail * 2 + same) * 21 + min(len(word), 20)) * 2246822519) & MASK) >> 18) % half + half)
    z += sum(float(w[x]) / (len(words) + weak_quality.SHORT[1]) for x in words)
    return 1 / (1 + math.exp(-min(max(z + b, -40), 40)))


def captured(monkeypatch, module, name):
    out = {}
    real = getattr(module, name)

    def run(*args, **named):
        out["model"] = real(*args, **named)
        return out["model"]

    monkeypatch.setattr(module, name, run)
    return out


def test_votes_and_label_model_against_plain(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").collect()] + [(i or -1, t) for i, t, *_ in awkward()]
    got = weak_quality.weak_votes(frame(spark, rows)).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, set()).add(sum((v + 1) * 3 ** j for j, v in enumerate(plain_votes(t))))
    assert all(r.pattern in want[r.doc_id] for r in got) and len(got) == len(rows)
    counts: dict[int, int] = {}
    for r in got:
        counts[r.pattern] = counts.get(r.pattern, 0) + 1
    patterns = sorted(counts)
    model = weak_quality.fit_label_model(np.array(patterns), np.array([counts[p] for p in patterns]))
    plain = plain_em(counts)
    assert np.allclose(model["posterior"], [plain[p] for p in patterns], atol=1e-6)


def test_scores_depend_on_the_row_alone():
    # in a slice of several rows each has the features it has alone
    texts = ["Hello there, you.", "there there", "x", "", "|| ## a-b C"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    for module in (weak_quality.shape_indices, mixing.word_indices):
        whole = module(data, offs)
        for i, r in enumerate(raw):
            alone = module(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
            mine = whole[1] == i
            assert sorted(whole[0][mine].tolist()) == sorted(alone[0].tolist())


# ---------------------------------------------------------------- operator 4


def test_rates_solve_the_least_squares(spark):
    # checked without the solver: where targets can be met the optimum is 0 and reached, where they cannot the residual falls and is told
    rng = np.random.default_rng(3)
    for shape, weights, met in ((0.3, [0.5, 0.3, 0.2], True), (50.0, [0.98, 0.01, 0.01], False)):
        n, p = rng.integers(1, 300, 300).astype(float), rng.dirichlet([shape] * 3, 300)
        df = spark.createDataFrame([(i, int(n[i]), [float(x) for x in p[i]]) for i in range(300)], "doc_id long, n_tokens long, p array<double>")
        rated, fit = mixing.fit_rates(df, weights)
        r = np.array([x.rate for x in rated.orderBy("doc_id").collect()])
        reached, target = (r * n) @ p, np.array(fit["target"])
        assert (r >= 0).all() and np.allclose(reached, fit["reached"], rtol=1e-9) and fit["met"] == met
        inverse = np.linalg.inv((n[:, None] * p).T @ p)
        left, start = ((target - x) @ inverse @ (target - x) for x in (reached, n @ p))
        assert left < 1e-6 * start if met else left < start


def plain_posterior(text: str | None, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    idx, _, value = mixing.word_indices(raw, np.array([0, len(raw)]))
    z = b + sum((value[i] * w[x] for i, x in enumerate(idx)), np.zeros(len(b)))
    p = np.exp(z - z.max())
    return p / p.sum()


def plain_copies(doc_id: int, p: np.ndarray, pushes: list) -> int:
    rate = 1.0
    for g in pushes:
        rate = max(0.0, rate + float(p @ np.array(g)))
    one = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    draw = (xxhash.xxh64_intdigest(struct.pack("<i", 44), seed=one) >> 11) / float(1 << 53)
    return math.floor(rate) + (draw < rate - math.floor(rate))


def test_rows_without_id_draw_for_themselves(spark):
    rows = [(None, int(i % 90), [0.5, 0.3 + i / 10000, 0.2 - i / 10000], 0.5) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>, rate double").withColumn("copies", mixing.copies_of("rate"))
    assert 400 < df.agg(F.sum("copies")).first()[0] < 600


# ---------------------------------------------------------------- operator 10


def plain_hash(*parts: int) -> int:
    h = 0
    for p in parts:
        h = ((h ^ p) * 0x01000193) & MASK
        h ^= h >> 15
    return (h * 2654435761) & MASK


def plain_emissions(text: str, w: np.ndarray) -> np.ndarray:
    """words x languages by loops: n-grams of a word's letters with its closing edge, affixes of three letters, the lexicon."""
    z = [int(x) for x in crf_lang.letters(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]]
    out, i = [], 0
    while i < len(z):
        if not z[i]:
            i += 1
            continue
        j = i
        while z[j]:
            j += 1
        total = np.zeros(w.shape[1])
        for at in range(i, j + 1):
            one, two = z[at - 1] if at >= 1 else 0, z[at - 2] if at >= 2 else 0
            total += w[plain_hash(one, z[at]) >> 17] + w[crf_lang.OFF_TRI + (plain_hash(two, one, z[at]) >> 15)]
        total += w[crf_lang.OFF_AFFIX + (plain_hash(1, *[z[i + k] if j - i > k else 0 for k in range(3)]) >> 16)]
        total += w[crf_lang.OFF_AFFIX + (plain_hash(2, *[z[j - 1 - k] if j - i > k else 0 for k in range(3)]) >> 16)]
        letters = np.array(z[i:j], dtype=np.uint32)
        total += w[int(crf_lang.word_indices(np.concatenate([letters, [0, 0]]).astype(np.uint32), np.array([0]), np.array([j - i]))[2][0])]
        out.append(total)
        i = j
    return np.array(out).reshape(-1, w.shape[1])


def test_language_features_and_scores_against_plain(spark, monkeypatch):
    docs = table(spark, SF0001, "documents")
    model = captured(monkeypatch, crf_lang, "train")
    got = {r.doc_id: r for r in crf_lang.identify(docs, 40, 200).collect()}
    languages, w, trans = model["model"]
    for r in docs.orderBy("doc_id").limit(40).collect():
        e = plain_emissions(r.text or "", w.astype(np.float64))
        if not len(e):
            assert got[r.doc_id].lang_pred == crf_lang.UNKNOWN
            continue
        p, step = np.exp(e - e.max(axis=1, keepdims=True)), np.exp(trans - trans.max())
        p = np.maximum(p, 1e-30)
        a, b = np.zeros_like(p), np.ones_like(p)
        v = np.full(len(languages), 1 / len(languages))
        for t in range(len(p)):
            v = (v @ step) * p[t]
            v /= v.sum()
            a[t] = v
        for t in range(len(p) - 2, -1, -1):
            b[t] = step @ (p[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        post = a * b
        mean = (post / post.sum(axis=1, keepdims=True)).mean(axis=0)
        assert got[r.doc_id].n_words == len(e) and abs(got[r.doc_id].score - mean.max()) < 1e-4
        assert got[r.doc_id].lang_pred == languages[int(mean.argmax())]


# ---------------------------------------------------------------- the pipeline


def plain_near(rows: list[tuple[int, str]], k: int) -> list[int]:
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return [i for i, c in components(ids, links).items() if i == c]


def test_pipeline_stages_against_plain(spark, monkeypatch):
    scorer, domains, rates = (captured(monkeypatch, m, n) for m, n in ((weak_quality, "fit_scorer"), (mixing, "train_domains"), (mixing, "fit_rates")))
    label = captured(monkeypatch, weak_quality, "fit_label_model")
    docs = table(spark, SF0001, "documents")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF0001), name)
        after = docs.collect()
        ids = sorted(r.doc_id for r in after)
        if name == "weak_label_quality":
            w, b = scorer["model"]
            b += math.log(label["model"]["good"] / (1 - label["model"]["good"]))
            want = [i for i, t in before if plain_score(t, w, b) >= 0.5]
        elif name == "exact_dedup":
            first: dict[str, int] = {}
            for i, t in sorted(before):
                first.setdefault(squeezed(t), i)
            want = list(first.values())
        elif name == "minhash_near_dedup":
            want = plain_near(before, 5)
        elif name == "target_weight_mix":
            used, w, b = domains["model"]
            full = np.zeros((mixing.DIMS, len(b)))
            full[used] = w
            want = [i for i, t in before for _ in range(plain_copies(i, plain_posterior(t, full, b), rates["model"][1]["pushes"]))]
        else:
            want = [i for i, _ in before]
            tokens = {i: len(byte_words((t or "").encode())) for i, t in before}
            assert all(r.n_tokens == tokens[r.doc_id] <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens for r in after)
            per: dict[int, list] = {}
            for r in after:
                per.setdefault(r.batch_id, []).append(r)
            assert all(len(x) == 1 or x[0].bucket_len * len(x) <= 16384 for x in per.values())
            assert all(sorted(r.slot for r in x) == list(range(len(x))) and len({r.bucket for r in x}) == 1 for x in per.values())
        assert ids == sorted(want), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            before = [(r.doc_id, r.text) for r in after]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF0001).select("doc_id").collect()) == ids
