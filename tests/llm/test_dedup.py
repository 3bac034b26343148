"""Operators 3, 6 and 8 against plain versions."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from stellate.llm import line_dedup, stream_dedup, tensor_minhash
from stellate.llm.common import connected_components, ordered_rank
from tests.llm.helpers import awkward, components, frame, prose, shingle_set, squeezed


def near_by_hand(rows):
    texts = {i: t for i, t, *_ in rows if i is not None}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def test_near_duplicates_of_awkward_rows(spark):
    rows = awkward()
    got = tensor_minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = near_by_hand(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]


def shared_ids():
    """Rows whose doc_ids bear several texts, near copies of others' among them; (doc_id, text) pairs are unique."""
    rows = []
    for i in range(8):
        base = prose(500 + i, 120).split()
        near = [" ".join("edit" if n == at else w for n, w in enumerate(base)) for at in (30, 60, 90)]
        # id 10+i: a text, its near copy, and a text of its own; id 50+i: another near copy, and the first text again
        rows += [(10 + i, " ".join(base)), (10 + i, near[0]), (10 + i, prose(600 + i, 60)), (50 + i, near[1]), (50 + i, " ".join(base)), (7, near[2]), (7, prose(700 + i, 50))]
    return rows


def test_near_duplicates_of_ids_with_several_texts(spark):
    rows = shared_ids()
    got = {(r.doc_id, r.mark): (r.n_shingles, r.component_id, r.kept, r.head) for r in tensor_minhash.near_duplicates(frame(spark, rows), mark=True).collect()}
    assert len(got) == len(rows)
    texts = sorted({t for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components(range(len(texts)), links)
    least = {c: min(i for i, t in rows if comp[texts.index(t)] == c) for c in set(comp.values())}
    kept: dict[int, int] = {}
    for i, t in rows:
        n, component, keep, head = got[i, hashlib.md5(t.encode()).digest()]
        c = comp[texts.index(t)]
        assert (n, component, keep) == (len(shingle_set(t)), least[c], i == least[c]) and (keep or not head)
        kept[c] = kept.get(c, 0) + head
    assert set(kept.values()) == {1} and len(kept) == 24


def family(seed: int, size: int, far: int) -> list[str]:
    """Copies of one text with few changed words, and some with many."""
    rng = random.Random(seed)
    base = prose(seed, 200).split()
    out = []
    for i in range(size):
        w = list(base)
        for _ in range(far if i % 3 == 0 else rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small_bucket", [32, 3])
def test_near_duplicates_of_large_families_lose_no_link(spark, small_bucket):
    # a family whose members partly miss the threshold to the smallest one; small_bucket 3 sends them through the prefix filter
    texts = [*family(1, 60, 9), *family(2, 60, 14), *[prose(100 + i, 60) for i in range(20)]]
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in tensor_minhash.near_duplicates(frame(spark, rows), small_bucket=small_bucket).collect()}
    assert got == near_by_hand(rows)


def test_prefix_filter_finds_every_link(spark):
    texts = [*family(5, 40, 7), *family(6, 40, 11)]
    docs = frame(spark, list(enumerate(texts)))
    sets = tensor_minhash.shingle_sets(docs)
    hot = sets.select("node", F.size("shingles").cast("long").alias("n"), F.col("node").alias("component"))
    pairs = tensor_minhash._token_pairs(tensor_minhash._prefix_members(hot, sets, 80), 80)
    got = {(r.a, r.b) for r in tensor_minhash._linked(pairs, sets, 80).collect()}
    own = [shingle_set(t) for t in texts]
    want = {(a, b) for a in range(80) for b in range(a + 1, 80) if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])}
    assert got == want and want


PAIRS: dict[str, int] = {}


@pytest.mark.parametrize("first", ["smallest", "largest", "random"])
def test_pairs_of_a_family_do_not_depend_on_numbering(spark, monkeypatch, first):
    # 300 copies of one text, a few words changed in each, some beyond the threshold; the text itself numbered anywhere
    texts = [prose(40, 200), *family(40, 300, 9)]
    seen = {}
    monkeypatch.setattr(tensor_minhash, "_numbered", lambda classes: classes.withColumn("node", {
        "smallest": F.col("doc_id"), "largest": 1000 - F.col("doc_id"), "random": F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))}[first]))
    real = tensor_minhash._linked

    def linked(pairs, sets, percent):
        seen.setdefault("pairs", []).append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(tensor_minhash, "_linked", linked)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in tensor_minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == near_by_hand(rows)
    # the same pairs whatever the numbering, and few: pairs grow with the rows
    PAIRS[first] = sum(seen["pairs"])
    assert max(PAIRS.values()) < 1.2 * min(PAIRS.values()) and PAIRS[first] < 10 * len(texts), (PAIRS, seen)


def test_near_duplicates_of_an_empty_table(spark):
    assert tensor_minhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    want = components({x for p in links for x in p if p[0] != p[1]}, [p for p in links if p[0] != p[1]])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


def test_ordered_rank_is_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = [(r.k, r.id) for r in ordered_rank(df, ["k", "id"]).orderBy("rank").collect()]
    assert got == sorted(got) and ordered_rank(df, ["k", "id"]).agg(F.max("rank"), F.countDistinct("rank")).first()[:] == (999, 1000)


@pytest.mark.parametrize("digest_chars", [64, 1])
def test_exact_dedup_of_awkward_rows(spark, digest_chars):
    # one digest character makes different texts collide, so the full bytes must decide
    rows = awkward()
    got = stream_dedup.exact_dedup(frame(spark, rows), files_per_trigger=1, digest_chars=digest_chars).collect()
    assert len(got) == len(rows)
    groups: dict[str, list] = {}
    for i, t, *_ in rows:
        groups.setdefault(squeezed(t), []).append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept: dict[str, int] = {}
    for r in got:
        ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(kept[s] == 1 for s in by_sha)


def test_exact_dedup_keeps_state_across_batches(spark, tmp_path):
    # the smaller id arrives in a later micro-batch and replaces the holder
    src = str(tmp_path / "docs")
    for ids in ([50, 60], [7, 80], [60, 3]):
        frame(spark, [(i, "same  text" if i != 80 else "other") for i in ids], extra=False).coalesce(1).write.mode("append").parquet(src)
    got = {(r.doc_id, r.kept, r.keep_id, r.group_size) for r in stream_dedup.exact_dedup(spark.read.parquet(src), files_per_trigger=1).collect()}
    assert got == {(50, False, 3, 5), (60, False, 3, 5), (7, False, 3, 5), (3, True, 3, 5), (80, True, 80, 1)}


def test_stream_restart_adds_nothing_twice(spark, tmp_path):
    src, target, state = (str(tmp_path / x) for x in ("feed", "updates", "state"))
    prints = stream_dedup.fingerprints(stream_dedup.located(frame(spark, [(1, "a"), (2, "a"), (3, "b")])))
    prints.write.parquet(src)

    def drain():
        stream = spark.readStream.schema(prints.schema).parquet(src)
        stream_dedup.run_stream(spark, stream, target, state)
        return {r.digest[:4]: r.n for r in spark.read.parquet(target).groupBy("digest").agg(F.max("n").alias("n")).collect()}

    first = drain()
    assert drain() == first and sorted(first.values()) == [1, 2]
    prints.write.mode("append").parquet(src)
    assert sorted(drain().values()) == [2, 4]


def test_exact_dedup_kept_rows_and_empty(spark):
    docs = frame(spark, awkward())
    out = stream_dedup.kept_rows(docs)
    assert out.columns == docs.columns and out.count() == len({squeezed(t) for _, t, *_ in awkward()})
    clash = docs.withColumnRenamed("digest", "_metadata")
    assert stream_dedup.kept_rows(clash).columns == clash.columns
    assert stream_dedup.exact_dedup(frame(spark, [])).count() == 0


def lines_by_hand(rows, k=3):
    """(doc index) -> remaining text; rows in order of doc_id (nulls last)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, spots = {}, {}
    for i in order:
        if rows[i][1] is None:
            continue
        ls = [x.rstrip(" ") for x in rows[i][1].split("\n")]
        for p in range(len(ls) - k + 1):
            w = tuple(ls[p : p + k])
            if any(w):
                spots.setdefault(w, []).append((i, p))
                first.setdefault(w, (i, p))
    gone: dict[int, set] = {}
    for w, at in spots.items():
        for i, p in at:
            if (i, p) != first[w]:
                lo = max(p, first[w][1] + k) if i == first[w][0] else p
                gone.setdefault(i, set()).update(range(lo, p + k))
    return {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) for i, (_, t) in enumerate(rows)}


def test_line_dedup_by_hand(spark):
    rng = random.Random(8)
    pool = [f"line {i}" for i in range(12)] + ["", "  ", "tail  "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a\nb"), (103, "r\nr\nr\nr\nr\nr"), (104, "\n\n\n\n"), (105, "\n".join(f"x{i % 50}" for i in range(5000)))]
    want = lines_by_hand(rows)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    for i, (doc_id, text) in enumerate(rows):
        assert got[doc_id].clean_text == want[i], doc_id
        assert got[doc_id].n_lines == (0 if text is None else len(text.split("\n")))
    assert got[103].n_removed == 3 and got[104].n_removed == 0


def test_line_dedup_time_grows_with_the_lines(spark):
    def seconds(n):
        text = "\n".join(f"line number {i}" for i in range(n))
        docs = frame(spark, [(1, text), (2, text)])
        start = time.perf_counter()
        assert [r.n_removed for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, n]
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(64_000) < 4 * seconds(16_000) + 4


def test_line_dedup_repeated_rows_and_empty(spark):
    rows = [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (None, "a\nb\nc"), (None, "z")]
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    # a fully repeated row shares one result: its windows occur at the same places
    assert sorted((r.doc_id or 0, r.clean_text) for r in got) == [(0, ""), (0, "z"), (1, "a\nb\nc\nd"), (1, "a\nb\nc\nd")]
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
