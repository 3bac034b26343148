"""Operators 1, 4, 10 and 2: held-out labels, brute force, awkward rows."""

from __future__ import annotations

import inspect
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stellate.llm import crf_lang, mixing, perm_index, textarrays as ta, weak_quality
from stellate.llm.common import table
from tests.llm.helpers import awkward, frame, prose

fit_language = crf_lang.fit
SF01, SF001 = "/root/testdata/sf0.1", "/root/testdata/sf0.01"


def test_quality_against_held_out_labels(spark):
    # gold labels are never read by the operator
    got = weak_quality.classify_quality(table(spark, SF01, "documents"))
    both = got.join(table(spark, SF01, "labels"), "doc_id")
    r = both.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")).alias("right"),
                 F.count_if((F.col("quality") == 1) & ~F.col("kept")).alias("lost"), F.count_if(F.col("quality") == 1).alias("good")).first()
    assert r.right > 0.99 and r.lost <= 0.002 * r.good


def test_quality_of_awkward_rows(spark):
    rows = awkward()
    got = weak_quality.classify_quality(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = {4, 5, 6}
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in blank)
    same = [r for r in got if r.doc_id == 12]
    assert len(same) == 2 and same[0] == same[1]
    assert weak_quality.classify_quality(frame(spark, [])).count() == 0


def test_quality_carries_columns(spark):
    docs = frame(spark, awkward())
    out = weak_quality.classify_quality(docs, carry=("lang", "slot"))
    assert [r.c1 for r in out.collect()] == ["s"] * len(awkward())


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    m, n = len(weak_quality.LABELLERS), 20000
    good = rng.random(n) < 0.8
    right = np.linspace(0.7, 0.95, m)
    votes = np.where(rng.random((n, m)) < right, good[:, None], ~good[:, None]) * 2
    votes[rng.random((n, m)) < 0.3] = 1
    patterns, counts = np.unique((votes * 3 ** np.arange(m)).sum(1), return_counts=True)
    model = weak_quality.fit_label_model(patterns, counts)
    assert abs(model["good"] - 0.8) < 0.03
    seen = model["good_vote"][1] / (model["good_vote"][1] + model["junk_vote"][1])
    assert np.abs(seen - right).max() < 0.05


def test_rates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    n = rng.integers(0, 500, 400)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    df = spark.createDataFrame([(i, int(n[i]), [float(x) for x in p[i]]) for i in range(400)], "doc_id long, n_tokens long, p array<double>")
    weights = np.array([0.6, 0.3, 0.1])
    rated, fit = mixing.fit_rates(df, list(weights))
    supply = (n[:, None] * p).sum(0)
    inverse = np.linalg.inv((n[:, None] * p).T @ p)
    total = supply[0] / weights[0]
    r = np.ones(400)
    for _ in range(mixing.ROUNDS):
        reached = (r[:, None] * n[:, None] * p).sum(0)
        if np.abs(weights * total - reached).max() <= mixing.TOLERANCE * total:
            break
        r = np.maximum(0, r + p @ (inverse @ (weights * total - reached)))
    got = np.array([x.rate for x in rated.orderBy("doc_id").collect()])
    assert np.allclose(got, r) and (got >= 0).all()
    assert np.allclose(fit["reached"], fit["target"], rtol=1e-3)


def test_mixing_separates_domains_and_matches_targets(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    # trained on even ids, judged on odd ones
    model = mixing.train_domains(docs, labels.where("doc_id % 2 = 0"))
    p = mixing.domain_posteriors(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    domain = mixing.domain_label(F.col("quality"), F.col("toxic"))
    hit = p.agg(F.avg((F.expr("array_position(p, array_max(p)) - 1") == domain).cast("int"))).first()[0]
    assert hit > 0.9
    rated, fit = mixing.fit_rates(mixing.domain_posteriors(docs, model), [mixing.WEIGHTS[d] for d in mixing.DOMAINS])
    assert rated.where("rate < 0").count() == 0
    miss = np.abs(np.array(fit["reached"]) - fit["target"]).sum() / sum(fit["target"])
    assert miss < np.abs(np.array(fit["supply"]) - fit["target"]).sum() / sum(fit["target"]) * 0.2


def test_mixing_of_awkward_rows(spark):
    rows = awkward()
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (9, 0, 0), (7, 1, 1), (None, 1, 1), (2, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = mixing.mix(docs, labels).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and r.copies >= 0 and abs(r.p_clean + r.p_toxic + r.p_junk - 1) < 1e-9 for r in got)
    out = mixing.mixed_rows(docs, labels)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    none = labels.where("false")
    assert mixing.mix(docs, none).count() == len(rows)
    assert mixing.mix(frame(spark, []), labels).count() == 0


def test_language_on_held_out_documents(spark):
    docs = table(spark, SF01, "documents")
    got = crf_lang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).first()
    assert r.right > 0.97 and r.n > 1000


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = table(spark, SF001, "documents")
    hidden = docs.withColumn("lang", F.when(crf_lang.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in crf_lang.identify(docs, 40, 200).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in crf_lang.identify(hidden, 40, 200).collect()}


def fitted_on(monkeypatch, module, name):
    """The rows that the module's fit gets, which is not run."""
    seen = []

    def fit(rows, *more, **named):
        seen.extend(rows)
        raise StopIteration

    monkeypatch.setattr(module, name, fit)
    return seen


def test_language_learns_from_its_whole_sample(spark, monkeypatch):
    rows = [(i, f"text number {i}", "en" if i % 2 else "fr", "a") for i in range(1000)]
    seen = fitted_on(monkeypatch, crf_lang, "fit")
    with pytest.raises(StopIteration):
        crf_lang.train(frame(spark, rows))
    assert Counter(r["lang"] for r in seen) == {"en": 300, "fr": 300}
    steps = inspect.signature(fit_language).parameters["steps"].default
    assert steps * crf_lang.BATCH >= 60 * 3000  # chains visited


def test_a_repeated_id_takes_one_place_in_the_samples(spark, monkeypatch):
    junk = "!!! ### $$$ ||| BUY BUY BUY BUY !!! ### " * 6
    rows = [(i, (junk if i % 2 else prose(i, 80)) + f" end{i}", "en" if i % 4 < 2 else "fr", "a") for i in range(60)]
    hot = [(8, prose(8, 80) + " end8", "en", "a")] * 300
    docs = frame(spark, rows + hot)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    for module, name, run in ((weak_quality, "fit_scorer", lambda: weak_quality.classify_quality(docs, sample=200)),
                              (mixing, "fit_domains", lambda: mixing.train_domains(docs, labels)),
                              (crf_lang, "fit", lambda: crf_lang.train(docs))):
        seen = fitted_on(monkeypatch, module, name)
        with pytest.raises(StopIteration):
            run()
        ids = [r["doc_id"] for r in seen]
        want = set(range(60)) if module is not crf_lang else {r.doc_id for r in docs.where(~crf_lang.held_out(F.col("doc_id"))).collect()}
        assert len(ids) == len(set(ids)) and set(ids) == want
        if module is weak_quality:
            assert {r["posterior"] >= 0.5 for r in seen} == {True, False}


def test_quality_sample_is_not_filled_by_one_id(spark, monkeypatch):
    # sample of 40: the good side's 20 places go to 20 ids, though the first id by hash has 300 rows
    first = spark.range(0, 60, 2).orderBy(F.xxhash64("id", F.lit(1))).first()[0]
    junk = "!!! ### $$$ ||| BUY BUY BUY BUY !!! ### " * 6
    rows = [(i, (junk if i % 2 else prose(i, 80)) + f" end{i}", "en", "a") for i in range(60)]
    seen = fitted_on(monkeypatch, weak_quality, "fit_scorer")
    with pytest.raises(StopIteration):
        weak_quality.classify_quality(frame(spark, rows + [rows[first]] * 300), sample=40)
    assert len(seen) == 40 and len({r["doc_id"] for r in seen}) == 40


def test_language_of_awkward_rows(spark):
    rows = awkward()
    got = crf_lang.identify(frame(spark, rows), 20, 50).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (4, 5, 6, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de", "es") and 0 <= r.score <= 1
    assert {r.lang_pred for r in crf_lang.identify(frame(spark, [(1, "some text")])).collect()} == {"und"}
    assert crf_lang.identify(frame(spark, [])).count() == 0


def plain_forward_backward(e, trans):
    a, b = np.zeros_like(e), np.ones_like(e)
    p, step = np.exp(e), np.exp(trans)
    v = np.full(e.shape[1], 1.0 / e.shape[1])
    for t in range(len(e)):
        v = (v @ step) * p[t]
        v /= v.sum()
        a[t] = v
    for t in range(len(e) - 2, -1, -1):
        b[t] = step @ (p[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    out = a * b
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_in_blocks_is_exact():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 31, 32, 33, 64, 65, 500, 0, 7]
    woffs = np.concatenate([[0], np.cumsum(sizes)])
    e, trans = rng.normal(0, 2, (woffs[-1], 4)), rng.normal(0, 1, (4, 4))
    got = crf_lang.forward_backward(e, woffs, trans)
    for a, b in zip(woffs[:-1], woffs[1:]):
        assert np.allclose(got[a:b], plain_forward_backward(e[a:b], trans))


def test_code_switched_words_are_labelled(spark):
    docs = table(spark, SF001, "documents")
    languages, weights, trans = crf_lang.train(docs, 60, 800)
    parts = {r.lang: r.text for r in docs.where(crf_lang.held_out(F.col("doc_id")) & (F.length("text") > 800)).groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    text, want = "", []
    for lang in ("en", "de", "fr", "en"):
        piece = " ".join(parts[lang].split()[:30])
        text += piece + " "
        want += [lang] * len(crf_lang.label_words(piece, languages, weights, trans))
    got = [x[1] for x in crf_lang.label_words(text, languages, weights, trans)]
    assert len(got) == len(want) and np.mean([a == b for a, b in zip(got, want)]) > 0.9


def test_word_and_shingle_hashes_follow_the_words():
    texts = ["Ab cd  ef\tgh ij", "ab CD ef gh IJ", "", "x", "ab cd ef gh", None]
    seen = []
    for lo, hi, data, offs in ta.slices(pa.array(texts), limit=8):
        start, end, woffs = ta.words(data, offs)
        sh, soffs = ta.shingles(ta.span_hashes(data, start, end), woffs, 4)
        seen += [sh[a:b].tolist() for a, b in zip(soffs[:-1], soffs[1:])]
    assert seen[0] == seen[1] and len(seen[0]) == 2 and seen[2] == [] and len(seen[3]) == 1 and seen[4] == seen[0][:1] and seen[5] == []


def exact_neighbours(rows, query, top):
    q = dict(rows)[query]
    score = sorted(((-float(np.dot(q, v)), i) for i, v in rows if i != query))
    return [(i, -s) for s, i in score[:top]]


def test_neighbours_are_exact_on_few_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).astype(float).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # ties, more than are asked for
    odd = [(200, None), (201, [0.0] * 8), (202, [1.0] * 7 + [float("nan")]), (203, [1.0] * 7 + [None]), (204, [1.0] * 5), (205, [float("inf")] + [0.0] * 7), (None, rows[1][1]), rows[3]]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in [*rows, *odd]], "vec_id long, embedding array<double>, score int, seg int")
    ok = perm_index.usable(df)
    assert {r.vec_id for r in ok.collect()} == {i for i, _ in rows}
    found = perm_index.nearest(ok, ok.where("vec_id % 20 = 0"), least=100)  # every vector is reranked
    for q in (0, 20, 40, 100, 120):
        got = [(r.vec_id, r.score) for r in found.where(f"query_id = {q}").orderBy("rank").collect()]
        want = exact_neighbours(rows, q, 20)
        assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want])
    assert perm_index.nearest(perm_index.usable(df.where("false")), perm_index.usable(df)).count() == 0


@pytest.mark.parametrize("segment", [perm_index.SEGMENT, 300])
def test_neighbour_recall(spark, segment):
    v = perm_index.usable(table(spark, SF01, "embeddings"))
    queries = v.where("vec_id % 20 = 0")
    found = perm_index.nearest(v, queries, segment=segment)
    rows = sorted((r.vec_id, np.array(r.v)) for r in v.collect())
    x, ids = np.stack([r[1] for r in rows]), np.array([r[0] for r in rows])
    got: dict[int, set] = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits.append(len(set(ids[np.argsort(-s, kind="stable")[:20]]) & got[q]) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbour_recall_of_a_small_table(spark):
    # 500 vectors: the footrule ranks here too, nothing is searched whole
    v = perm_index.usable(table(spark, SF001, "embeddings"))
    got: dict[int, set] = {}
    for r in perm_index.nearest(v, v.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = [(r.vec_id, r.v) for r in v.collect()]
    x, ids = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    hits = []
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(set(ids[np.argsort(-score, kind="stable")[:20]]) & got[q]) / 20)
    print(f"recall {np.mean(hits):.4f} of {len(ids)} vectors, {len(hits)} queries")
    assert np.mean(hits) >= 0.9


def test_footrule_by_hand():
    rng = np.random.default_rng(7)
    x, pivots = rng.normal(size=(40, 6)), rng.normal(size=(12, 6))
    order = perm_index.orders(x, pivots, 5)
    files = perm_index.inverted_files(order, 12)
    place = np.full((40, 12), 5)
    for i in range(40):
        place[i, order[i]] = np.arange(5)
    got = perm_index.footrule(order[0], files[0], files[1].astype(np.int64), files[2], 40)
    want = np.abs(place - place[0]).sum(axis=1)
    assert np.array_equal(got - got.min(), want - want.min())
