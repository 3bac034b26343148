"""Operator 8, near-duplicate documents: MinHash with tensored banding, verified on full shingle sets.

A banding of L tables with 2r minhashes a table needs 2rL minhashes.  Here two
collections of m = sqrt(L) half keys (r minhashes each) are computed and table
(i, j) is keyed by the pair (half key i of the first, half key j of the
second): 2rm minhashes serve m*m tables.  With r = 2 and m = 10 two sets of
similarity 0.8 share no table with probability 2 * 0.36**10 = 7e-5, less above.

Steps, all of them jobs over the whole input:

1. words, distinct shingles, half keys and a digest of the word sequence per
   document (numpy inside the tasks);
2. documents of equal word sequence become one class with an id of its own;
   only classes go on;
3. half keys held by one class alone are dropped (they cannot meet), the rest
   are paired into table keys; a class's standing is how many classes hold its
   half keys, summed over them;
4. in each bucket every member is compared with the member of the highest standing
   (ties by the digest, so numbering plays no part), on full sets: a family of
   copies gathers around the text that most of them come from; the links
   become connected components;
5. buckets whose members still have several components are compared across them:
   directly when small, else through an exact prefix filter with positions (in any
   common order of shingles, here rare ones first, two sets of similarity s
   share one among the first (1-s)n+1 of the larger and the first
   (1-s)/(1+s)n+1 of the smaller, and no more than what stands behind it) and
   a parity sketch (its differing bits never outnumber the symmetric difference of the
   sets), so no pair is left out and no bucket is expanded into all pairs;
6. the links found there join the components; a component bears the
   smallest doc_id in it, and its class with that doc_id (ties: the smaller
   digest) is its head.

Null or empty texts have an empty set and are linked with nothing.  Each input
row is returned; kept says that its doc_id is its component's.  Rows that repeat a
doc_id with one word sequence get equal results; with other texts each row follows
its own text, so they can have different components (``mark`` adds ``head``: the
row's text is its component's head, so only one of them is).  Extra columns are
ignored.  A null doc_id stays alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm import textarrays as ta
from stellate.llm.common import connected_components, stored

HALF_KEYS, ROWS, SHINGLE, PERCENT = 10, 2, 4, 80
SLOTS, SLOT_BLOCK, PARITY = 1 << 16, 1024, 16  # counters of the rarity sketch, in blocks; 64-bit words of the parity sketch
SMALL_BUCKET = 8  # above it, a bucket of several components goes through the prefix filter


def _digest(text: bytes) -> bytes:
    """Of the lower-cased word sequence."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


def _signature_task(k: int, m: int, r: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(4242)
        flips = rng.integers(0, 1 << 63, 2 * m * r, dtype=np.uint64)
        odd = rng.integers(0, 1 << 63, 2 * m * r, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, data, offs in ta.slices(texts):
                start, end, woffs = ta.words(data, offs)
                sh, soffs = ta.shingles(ta.span_hashes(data, start, end), woffs, k)
                size = np.diff(soffs)
                full = np.flatnonzero(size)
                n = np.zeros(hi - lo, dtype=np.int64)
                keys = np.zeros((hi - lo, 2 * m), dtype=np.uint64)
                seq = []
                raw = data.tobytes()
                for i in range(hi - lo):
                    if size[i]:
                        n[i] = len(np.unique(sh[soffs[i] : soffs[i + 1]]))
                    seq.append(_digest(raw[offs[i] : offs[i + 1]]))
                if len(full):
                    at = soffs[full]
                    for j in range(2 * m):
                        half = np.full(len(full), j + 1, dtype=np.uint64)
                        for x in range(j * r, (j + 1) * r):
                            least = np.minimum.reduceat((sh ^ flips[x]) * odd[x], at)
                            half = ta.mix(half * np.uint64(0x2545F4914F6CDD1D) + least)
                        keys[full, j] = half
                flat = pa.array(keys.view(np.int64).ravel())
                yield pa.record_batch(
                    [ids.slice(lo, hi - lo), pa.array(seq, pa.binary()), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * 2 * m), flat), batch.column(2).slice(lo, hi - lo)],
                    ["doc_id", "seq", "n_shingles", "half", "mark"])
    return run


def text_mark() -> Column:
    """Digest of the text's bytes: names one of several texts that share a doc_id."""
    return F.unhex(F.md5(F.encode(F.col("text").cast("string"), "UTF-8")))


def signatures(docs: DataFrame, k: int = SHINGLE, m: int = HALF_KEYS, r: int = ROWS, mark: bool = False) -> DataFrame:
    """doc_id, seq (digest of the lower-cased word sequence), n_shingles, half (2m half keys), mark (``text_mark``, if asked for)."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (text_mark() if mark else F.lit(None).cast("binary")).alias("mark"))
    return own.mapInArrow(_signature_task(k, m, r), "doc_id long, seq binary, n_shingles long, half array<long>, mark binary")


def _set_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in ta.slices(batch.column(1)):
                start, end, woffs = ta.words(data, offs)
                sh, soffs = ta.shingles(ta.span_hashes(data, start, end), woffs, k)
                sets = [np.unique(sh[soffs[i] : soffs[i + 1]]) for i in range(hi - lo)]
                raw = data.tobytes()
                seq = [_digest(raw[offs[i] : offs[i + 1]]) for i in range(hi - lo)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(seq, pa.binary())],
                    ["node", "shingles", "seq"])
    return run


def shingle_sets(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """node (doc_id), shingles: the distinct shingle fingerprints (64 bit) of each whole text; seq as in ``signatures``."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _set_task(k), "node long, shingles array<long>, seq binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(one, "a").join(two, "b")
        .withColumn("_i", both).withColumn("_u", F.size("sa") + F.size("sb") - F.col("_i"))
        .where(100 * F.col("_i") >= percent * F.col("_u")).select("a", "b")
    )


def _fits(a: str, b: str, percent: int):
    """Sets of such sizes can reach the similarity at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket whose ends lie in different components and whose sizes fit."""
    x = members.select("bucket", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    y = members.select("bucket", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    fit = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _fits("na", "nb", percent)
    return x.join(y, "bucket").where(fit).select("a", "b").distinct()


def _token_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a token, at places, of sizes and with sketches that allow the similarity."""
    probe = prefixes.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("at").alias("ia"), F.col("parity").alias("pa"))
    # a smaller set (ties: the smaller number) is found by its short prefix
    short = prefixes.where("short").select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("at").alias("ib"), F.col("parity").alias("pb"))
    smaller = (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a")))
    behind = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    differ = sum((F.bit_count(F.col("pa")[i].bitwiseXOR(F.col("pb")[i])) for i in range(PARITY)), F.lit(0))
    both = F.col("na") + F.col("nb")
    fit = smaller & (F.col("ca") != F.col("cb")) & _fits("na", "nb", percent) & (behind * (100 + percent) >= both * percent) & (
        differ * (100 + percent) <= both * (100 - percent))
    return probe.join(short, "token").where(fit).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _slot(tokens: np.ndarray) -> np.ndarray:
    return tokens & (SLOTS - 1)  # the tokens are hashes already


def _slot_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        total += np.bincount(_slot(batch.column(0).flatten().to_numpy()), minlength=SLOTS)
    blocks = np.flatnonzero(total.reshape(-1, SLOT_BLOCK).any(axis=1))
    counts = total.reshape(-1, SLOT_BLOCK)[blocks]
    yield pa.record_batch([pa.array(blocks.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(len(blocks) + 1, dtype=np.int32) * SLOT_BLOCK), pa.array(counts.ravel()))],
                          ["block", "n"])


def _sum_slots(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": part["block"].iloc[:1], "n": [np.sum(np.stack(part["n"].to_numpy()), axis=0)]})


def _prefix_task(rarity: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, place, short, at, parity = [], [], [], [], []
            for i, tokens in enumerate(batch.column(3)):
                t = tokens.values.to_numpy()
                n = len(t)
                first = t[np.lexsort((t, rarity[_slot(t)]))][: n - -(-n * percent // 100) + 1]
                spot = np.flatnonzero(rarity[_slot(first)] > 1)  # alone in its slot: nobody shares it, but it keeps its place
                out.append(first[spot])
                place.append(spot)
                short.append(spot < n - -(-2 * n * percent // (100 + percent)) + 1)
                at.append(np.full(len(spot), i))
                bits = np.bincount((ta.mix(t.view(np.uint64) + np.uint64(1)) % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
                parity.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
            if out and len(take := np.concatenate(at)):
                sketches = pa.ListArray.from_arrays(pa.array(np.arange(len(parity) + 1, dtype=np.int32) * PARITY), pa.array(np.concatenate(parity)))
                take = pa.array(take)
                yield pa.record_batch([pa.array(np.concatenate(out)), *[batch.column(c).take(take) for c in range(3)],
                                       pa.array(np.concatenate(place).astype(np.int64)), pa.array(np.concatenate(short)), sketches.take(take)],
                                      ["token", "node", "n", "component", "at", "short", "parity"])
    return run


def _prefix_members(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """token, node, n, component, at, short, parity: the rarest (1-s)n+1 shingles of every hot node with their places, without those
    nobody shares; short: among the first (1-s)/(1+s)n+1."""
    whole = stored(hot.join(sets, "node").select("node", "n", "component", "shingles"), "hot-sets")
    # a task sends at most SLOTS / SLOT_BLOCK rows of counters, whatever it has read
    counts = whole.select("shingles").mapInArrow(_slot_task, "block int, n array<long>").groupBy("block").applyInPandas(
        _sum_slots, "block int, n array<long>")
    rarity = np.zeros(SLOTS, dtype=np.int64)
    for r in counts.collect():  # SLOTS counters
        rarity[r["block"] * SLOT_BLOCK : (r["block"] + 1) * SLOT_BLOCK] = r["n"]
    return whole.mapInArrow(_prefix_task(rarity, percent), "token long, node long, n long, component long, at long, short boolean, parity array<long>")


def _numbered(classes: DataFrame) -> DataFrame:
    return classes.withColumn("node", F.monotonically_increasing_id())


def near_duplicates(docs: DataFrame, k: int = SHINGLE, m: int = HALF_KEYS, r: int = ROWS, percent: int = PERCENT,
                    small_bucket: int = SMALL_BUCKET, mark: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; ``mark`` adds each row's ``text_mark`` and ``head``."""
    sig = stored(signatures(docs, k, m, r, mark), "signatures")
    # a node is a class, whatever its doc_id; the write fixes the ids
    classes = stored(_numbered(
        sig.where("n_shingles > 0 and doc_id is not null").groupBy("seq")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("half").alias("half"))), "classes")
    half = classes.select("node", "n", F.xxhash64("seq").alias("tie"), F.posexplode("half").alias("i", "h"))
    shared = half.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = half.join(shared, "h").groupBy("node", "n", "tie").agg(F.collect_list(F.struct("i", "h")).alias("hs"), F.sum("c").alias("standing"))  # 2m half keys at most
    first = F.expr(f"transform(filter(hs, x -> x.i < {m}), x -> x.h)")
    second = F.expr(f"transform(filter(hs, x -> x.i >= {m}), x -> x.h)")
    rank = ("node", "n", "standing", "tie")
    members = stored(
        own.select(*rank, F.explode(first).alias("h1"), second.alias("hs2"))
        .select(*rank, "h1", F.explode("hs2").alias("h2"))
        .select(F.xxhash64("h1", "h2").alias("bucket"), *rank), "members")
    star = members.groupBy("bucket").agg(F.min(F.struct((-F.col("standing")).alias("down"), "tie", "node", "n")).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1")
    pairs = (
        members.join(star, "bucket").where("node <> p.node")
        .select(F.least("p.node", "node").alias("a"), F.greatest("p.node", "node").alias("b"), F.col("p.n").alias("na"), F.col("n").alias("nb"))
        .where(_fits("na", "nb", percent)).select("a", "b").distinct()
    )
    met = members.join(star.select("bucket"), "bucket", "left_semi").select("node").distinct()
    wanted = stored(classes.select("node", "doc_id", "seq").join(met, "node"), "wanted")
    some = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # rows may repeat a doc_id with another text: the word sequence names the class that a set belongs to
    by_seq = shingle_sets(some, k).groupBy("seq").agg(F.min("shingles").alias("shingles"))
    sets = stored(by_seq.join(wanted.select("seq", "node"), "seq").select("node", "shingles"), "sets")
    found = stored(connected_components(_linked(pairs, sets, percent)), "star-components")
    placed = stored(
        members.select("bucket", "node", "n").join(star.select("bucket"), "bucket", "left_semi").join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node")), "placed")
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("c")).where("x <> y").select("bucket", "c")
    rest = stored(placed.join(open_, "bucket"), "open-buckets")
    across = _across(rest.where(F.col("c") <= small_bucket), percent)
    hot = stored(rest.where(F.col("c") > small_bucket).select("node", "n", "component").distinct(), "hot")
    if not hot.isEmpty():
        across = across.unionByName(_token_pairs(stored(_prefix_members(hot, sets, percent), "prefixes"), percent)).distinct()
    more = stored(_linked(across.join(pairs, ["a", "b"], "left_anti"), sets, percent), "links-across")
    if not more.isEmpty():
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    place = classes.select("seq", "doc_id", "node").join(found, "node")
    heads = place.groupBy("component").agg(F.min(F.struct("doc_id", "seq")).alias("head"))
    linked = place.join(heads, "component").select("node", F.col("head.doc_id").alias("component_id"), (F.col("seq") == F.col("head.seq")).alias("is_head"))
    by_class = classes.select("seq", "doc_id", "node").join(linked, "node", "left").select(
        "seq", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("is_head", F.lit(True)).alias("is_head"))
    # rows without a set have no class: they stand alone
    extra = ["mark"] if mark else []
    out = (
        sig.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("seq")).alias("seq"), *extra)
        .join(by_class, "seq", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    if mark:
        extra += ["head"]
        out = out.withColumn("head", F.col("kept") & F.coalesce("is_head", F.lit(True)))
    return out.select("doc_id", "n_shingles", "component_id", "kept", *extra)
