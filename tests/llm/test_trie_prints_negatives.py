"""Operators 11, 12 and 13 against plain versions, with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import cover_tree, prefix_trie, winnow
from stellate.llm.common import table
from stellate.session import scratch_path
from tests.llm.helpers import awkward, frame, prose

SF001 = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- operator 11

TURNS = "conv_id long, turn long, role string, text string, depth int, node string, id double, block string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 3, "n", 0.5, "b") for r in rows], TURNS)


def plain_trie(rows) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, len(text)))
    paths = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(math.fmod(conv, 100))
        paths[conv] = [x[1:] for x in sorted(own.get(base, []))[:h] + sorted(own[conv])[h:]]
    nodes = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(conv)
    out = []
    for key, convs in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        inner = {k[:-1] for k in nodes if k}
        ends = sorted(c for c in convs if len(paths[c]) == len(key))
        out.append((min(convs), len(key), min(nodes[key[:-1]]) if key else None, len(convs), sum(1 for k in nodes if k and k[:-1] == key), sum(k not in inner for k in below),
                    sum((len(nodes[k]) - 1) * k[-1][1] for k in below if k), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(spark, rows):
    got = prefix_trie.prefix_trie(conversations(spark, rows))
    assert tuple(got.columns) == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1]))


def some_conversations(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        conv = rng.choice([i, 100 * rng.randint(-2, 4) + i, 300 + i])
        rows += [(conv, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["hi", "hello", "", "ok then", "\U0001d400é"])) for t in range(rng.randint(1, 7))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain(spark, seed):
    rows = some_conversations(seed)
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_in_small_blocks(spark, monkeypatch):
    # several blocks of turns, children, arcs and end ids; the tour needs more than one level
    for name, size in (("BLOCK", 3), ("ARC_BLOCK", 16), ("PIECE", 2)):
        monkeypatch.setattr(prefix_trie, name, size)
    real_rank, real_sums, real_ends = prefix_trie.list_rank, prefix_trie.running_sums, prefix_trie.end_digests
    monkeypatch.setattr(prefix_trie, "list_rank", lambda links, w, block=16, name="tour": real_rank(links, w, block, name))
    monkeypatch.setattr(prefix_trie, "running_sums", lambda df, key, order, sums: real_sums(df, key, order, sums, 3))
    monkeypatch.setattr(prefix_trie, "end_digests", lambda ends: real_ends(ends, 2))
    rows = some_conversations(3, 25)
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_awkward_conversations(spark):
    rows = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, None, "system", None),  # null turn first, null text
        (1, 0, None, "a"), (1, 0, None, "a"), (1, 0, "user", "a"),  # repeated rows and ties
        (2, 5, "user", "x" * 70_000), (None, 0, "user", "a"), (None, None, None, None),
        (250, 0, "user", "alone"), (-5, 0, "user", "a"), (7, None, None, None),
        *[(60, t, "user", f"turn {t % 3}") for t in range(120)],  # one long conversation
        *[(1000 + i, 0, "user", "same") for i in range(150)],  # one very common conversation
    ]
    got = trie_rows(spark, rows)
    assert got == plain_trie(rows)
    # conversation 250 has no base: with h over its own turns it is turnless and ends at the root
    assert zlib.crc32(b"250") % 6 >= 1 and got[0][1] == 0
    assert trie_rows(spark, []) == []


def test_list_rank_of_a_random_order(spark):
    # successors far apart: blocks hold few links, so elements are spliced out
    n = 900
    order = np.random.default_rng(5).permutation(n)
    rows = [(int(a), int(b), int(a) + 1) for a, b in zip(order, [*order[1:], -1])]
    got = prefix_trie.list_rank(spark.createDataFrame(rows, "id long, next long, w0 long"), 1, block=32)
    before = dict(zip(order.tolist(), np.r_[0, np.cumsum(order + 1)[:-1]].tolist()))
    assert {r.id: r.before0 for r in got.collect()} == before


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(table(spark, SF001, "conversations")).collect()), key=lambda r: (r[0], r[1]))
    assert got == plain_trie(rows)


# ---------------------------------------------------------------- operator 12


def plain_prints(text: str, k: int = 3, w: int = 4) -> list[tuple[int, int]]:
    codes = [zlib.crc32(x) + 1 for x in re.findall(rb"[^\x20\x09-\x0D]+", text.encode())]
    if not codes:
        return []
    codes += [0] * (k - len(codes))
    hashes = []
    for j in range(len(codes) - k + 1):
        h = 0
        for c in codes[j : j + k]:
            h = (h * 23003 + c) % 274877906899
        hashes.append(h)
    picks = []
    for j in range(max(len(hashes) - w + 1, 1)):
        window = hashes[j : j + w]
        at = j + max(i for i, h in enumerate(window) if h == min(window))
        if at not in picks:
            picks.append(at)
    return [(hashes[p], p) for p in picks]


def plain_neighbours(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc, text, *_) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = plain_prints(text), plain_prints(edited), plain_prints(after)
        show = lambda p: " ".join(f"{h}@{at}" for h, at in p)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), near(a, b), near(a, c)))
    return out


def as_file(spark, rows):
    # one file: rows that repeat a doc_id follow each other in this order
    path = scratch_path(spark, "prints-fixture")
    frame(spark, rows).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_prints_against_plain(spark):
    rows = [*awkward(), (20, "a b c a b c a b c a b c a b c", "en", "a"), (21, "\U0001d400" * 9, None, None), (22, " lead and trail  ", "en", "a"), (23, "tie " * 40, "en", "a")]
    got = winnow.edited_neighbours(as_file(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_neighbours(rows), key=str)
    by_text = defaultdict(set)
    for (doc, text, *_), r in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))):
        by_text[text or ""].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


@pytest.mark.parametrize("k,w", [(1, 1), (2, 3), (5, 6)])
def test_prints_of_other_widths(spark, k, w):
    texts = [prose(70 + i, n) for i, n in enumerate((0, 1, 2, 4, 5, 9, 60))] + ["a a a a a a a a a b a a"]
    got = winnow.winnow(frame(spark, list(enumerate(texts))), "text", "p", k, w).select("doc_id", winnow.entries("p").alias("e")).collect()
    assert {r.doc_id: [tuple(x) for x in r.e] for r in got} == {i: plain_prints(t, k, w) for i, t in enumerate(texts)}


def test_prints_of_tables_of_one_and_no_row(spark):
    one = winnow.edited_neighbours(as_file(spark, [(5, "alpha beta gamma delta", None, None)])).collect()
    assert [tuple(r) for r in one] == plain_neighbours([(5, "alpha beta gamma delta")]) and one[0].near_next == 1
    assert winnow.edited_neighbours(as_file(spark, [])).count() == 0


def test_shared_passage_is_found(spark):
    # the guarantee: a shared run of k + w - 1 words leaves a shared entry
    rng = random.Random(3)
    rows = []
    for i in range(80):
        shared = prose(500 + i, 6)
        for side in (0, 1):
            rows.append((2 * i + side, f"{prose(1000 + 2 * i + side, rng.randint(0, 30))} {shared} {prose(3000 + 2 * i + side, rng.randint(0, 30))}"))
    got = {r.doc_id: set(r.m) for r in winnow.winnow(frame(spark, rows), "text", "p").select("doc_id", winnow.marks("p").alias("m")).collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in range(80))


def test_prints_use_no_python(spark):
    docs = table(spark, SF001, "documents")
    plan = winnow.edited_neighbours(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    r = winnow.edited_neighbours(docs).where("n_chars > 400").agg(F.avg("near_edited").alias("edited"), F.avg("near_next").alias("next")).first()
    assert r.edited > 0.5 and r.next < 0.1


# ---------------------------------------------------------------- operator 13


def plain_negatives(rows, low=80, high=100, k=5):
    one = {}
    for i, label, vec in rows:
        one[i] = min(one.get(i, (label, vec)), (label, vec))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, vec) in one.items():
        if a % 100:
            continue
        scored = sorted((-dot(vec, v), i, lab) for i, (lab, v) in one.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:k]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(fits)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label long, vec array<long>")


def mined(spark, rows, **kw):
    df = vectors(spark, rows)
    got = cover_tree.hard_negatives(df, df.where("vec_id % 100 = 0"), **kw).collect()
    return sorted(tuple(r) for r in got)


def clustered(seed: int, n: int, width: int = 12, clusters: int = 9):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-200, 200, (clusters, width))
    which = rng.integers(0, clusters, n)
    x = centres[which] + rng.integers(-12, 13, (n, width))
    return [(int(i), int(rng.integers(0, 4)), [int(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("tree_rows", [2048, 60])
def test_negatives_against_plain(spark, tree_rows):
    rows = clustered(1, 900)
    assert mined(spark, rows, tree_rows=tree_rows, max_cells=4) == plain_negatives(rows)


def test_negatives_of_equal_vectors_and_ties(spark):
    # a third of all rows share one vector, over several labels; small components give many equal scores
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), [1, 2, -1] if i % 3 == 0 else [int(v) for v in rng.integers(-2, 3, 3)]) for i in range(600)]
    rows += [rows[0], rows[300], (300, 9, [9, 9, 9])]  # repeated rows, an id with two vectors
    rows += [(1000, 1, [5]), (1001, 1, []), (1100, 2, [1, 2, -1, 4])]  # other lengths
    assert mined(spark, rows, tree_rows=40, max_cells=3) == plain_negatives(rows)


def test_negatives_of_awkward_tables(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 0.25], 1, "x"), (100, [0.5, -0.25], 2, "x"), (7, [0.5, 0.125], 9, "x"), (3, None, 1, "x"), (4, [0.5, None], 1, "x"), (5, [inf, 0.5], 1, "x"),
            (6, [nan, 0.5], 1, "x"), (8, [0.5, 0.5], None, "x"), (None, [0.5, 0.5], 1, "x"), (9, [0.0, 0.0], 2, "x"), (10, [-0.001, 0.499], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vec string")
    got = cover_tree.quantised(df)
    assert sorted((r.vec_id, r.label, r.vec) for r in got.collect()) == [
        (0, 2, [128, 64]), (7, 0, [128, 32]), (9, 2, [0, 0]), (10, 1, [-1, 127]), (100, 2, [128, -64])]
    want = plain_negatives([(r.vec_id, r.label, r.vec) for r in got.collect()])
    assert sorted(tuple(r) for r in cover_tree.hard_negatives(got, got.where("vec_id % 100 = 0")).collect()) == want
    none = df.limit(0)
    assert cover_tree.hard_negatives(cover_tree.quantised(none), none).count() == 0


def test_cover_tree_covers_and_separates():
    x = np.array([v for _, _, v in clustered(4, 400)], float)
    d = cover_tree._gaps(x, x, float(np.sqrt((x * x).sum(1).max())))
    point, radius, first, end, fresh = cover_tree.cover_tree(d)
    assert sorted(point[fresh]) == list(range(400))

    def below(node):
        for c in range(first[node], end[node]):
            yield point[c]
            yield from below(c)

    for node in range(len(point)):
        inside = list(below(node))
        assert not inside or d[point[node], inside].max() <= radius[node] + 1e-9
        kids = [c for c in range(first[node], end[node])]
        if len(inside) > cover_tree.LEAF:
            half = 2.0 ** (np.ceil(np.log2(radius[node])) - 1)
            assert all(d[point[a], point[b]] > half for i, a in enumerate(kids) for b in kids[:i])


def test_bounds_skip_nodes_of_clustered_vectors():
    rows = clustered(5, 1500, width=8, clusters=30)
    x = np.array([v for _, _, v in rows], np.int32)
    labels = np.array([label for _, label, _ in rows], np.int64)
    point, radius, first, end, fresh = cover_tree.cover_tree(cover_tree._gaps(x.astype(float), x.astype(float), float(np.sqrt((x.astype(float) ** 2).sum(1).max()))))
    tree = dict(vecs=x.astype(float), labels=labels, ids=np.arange(1500), id_ends=np.arange(1501), point=point, radius=radius, first=first, end=end, fresh=fresh)

    class Row:
        qids, qlabels, qvecs = np.arange(1).tobytes(), labels[:1].tobytes(), x[:1].tobytes()
        lo, hi = np.array([-1 << 62]).tobytes(), np.array([1 << 62]).tobytes()

    piece = cover_tree._Piece(Row, 8, 5, True)
    assert piece.walk(tree) < 0.4 * 1500
    scores = x.astype(np.int64) @ x[0]
    best = sorted((-scores[i], i) for i in range(1, 1500) if labels[i] == labels[0])[:5]
    assert list(zip((-piece.score).tolist(), piece.id.tolist())) == best
