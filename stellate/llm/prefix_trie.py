"""Operator 11, prefix trie of conversations by the Euler-tour technique.

A conversation's turns are ordered by turn (null first), ties by the digest of role and text; null role or
text is empty.  ``rebuilt`` puts the first h turns of conversation c - c % 100 (all
if fewer, none if absent) before c's own turns after its first h, with h the
unsigned CRC-32 of the decimal c modulo 6.  A node of depth d is a distinct sequence of
the first d rebuilt turns; conversations that start with it are its members.

1. Turns become digests, places come from a distributed rank, and each
   prefix has a 128-bit hash: the running sum of hashes of (place, digest) in four
   parts.  Running sums go over blocks first, so a conversation of any length is
   split.
2. Members aggregate to nodes before they are shuffled.  A node is numbered by its
   rank in the order of (smallest member, depth).
3. Each node has an enter and an exit arc.  The arc after an enter arc is that of the
   first child or the own exit arc, after an exit arc that of the next sibling
   or the parent's exit arc.  Children of one node are linked in blocks of ids.
4. ``list_rank`` ranks the tour: each block of arcs contracts its local chains to
   one element each, the shorter list is ranked in the same way (splicing out a random
   quarter where blocks hold too few links), and sums flow back.
5. The leaves and savings of a subtree are the difference of the prefix sums at its
   node's exit and enter arcs.
6. The ids of the members that end at a node are joined to pieces of text by
   sorted range, then digested in order, one piece a row.

Rows without conv_id take no part.  Repeated rows are turns of their own.  Repeated
conversations are members by conv_id, counted once.  An empty table has no
nodes.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.llm.common import ordered_rank, stored, stored_observed

GROUP, HEADS = 100, 6
BLOCK, ARC_BLOCK, PIECE = 4096, 32768, 4096
PARTS = ("s0", "s1", "s2", "s3")


def _crc_heads(conv: Column) -> Column:
    return F.pmod(F.crc32(F.encode(conv.cast("string"), "UTF-8")), F.lit(HEADS)).cast("int")


def spread_join(rows: DataFrame, table: DataFrame, key: str, block: str) -> DataFrame:
    """Left join of ``rows`` with a table of one row a key, balanced under a hot key: the key's row is copied to each of its blocks first."""
    used = rows.select(key, block).distinct().join(table, key)
    return rows.join(used, [key, block], "left")


def running_sums(df: DataFrame, key: str, order: str, sums: tuple[str, ...], block: int = BLOCK) -> DataFrame:
    """Replaces ``sums`` by their inclusive running sums within the key, in order of the place ``order`` (0, 1, ...); no window holds more than a block."""
    cut = df.withColumn("_block", F.floor(F.col(order) / block).cast("long"))
    totals = cut.groupBy(key, "_block").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_block", *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}") for s in sums])
    inner = Window.partitionBy(key, "_block").orderBy(order)
    summed = cut.select(*[c for c in cut.columns if c not in sums], *[F.sum(s).over(inner).alias(s) for s in sums])
    joined = summed.join(offsets, [key, "_block"])
    return joined.select(*[c for c in df.columns if c not in sums], *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in sums])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, digest, chars: every turn with its place in its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256).alias("digest"), F.length(text).cast("long").alias("chars"))
    ranked = ordered_rank(own, ["conv_id", "turn", "digest"], "rank", "turn-order").withColumn("block", F.floor(F.col("rank") / BLOCK))
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n_own"))
    return spread_join(ranked, first, "conv_id", "block").select("conv_id", (F.col("rank") - F.col("first")).alias("pos"), "digest", "chars", "n_own")


def rebuilt(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, chars) of every rebuilt turn, and (conv_id, length) of every conversation, from ``turns``."""
    sizes = ordered.groupBy("conv_id").agg(F.max("n_own").alias("n_own"))
    sizes = sizes.withColumn("h", _crc_heads(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = sizes.join(bases, "base", "left").withColumn("lead", F.least(F.col("h"), F.coalesce("n_base", F.lit(0))))
    convs = convs.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"))
    heads = ordered.where(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")  # 5 turns of a base
    led = convs.join(heads, "base").where("pos < h").select("conv_id", "pos", "digest", "chars")
    tails = ordered.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("h", _crc_heads(F.col("conv_id"))).where("pos >= h")
    rest = spread_join(tails.drop("n_own", "h"), convs.select("conv_id", "h", "lead"), "conv_id", "block").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "digest", "chars")
    return led.unionByName(rest), convs.select("conv_id", "length")


def members(path: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent (16-byte prefix hashes), chars, at_end: every prefix of every rebuilt conversation, the empty one included."""
    low = F.lit(0xFFFFFFFF)
    one, two = F.xxhash64("digest", "pos"), F.xxhash64("pos", F.lit("second"), "digest")
    parts = [F.shiftrightunsigned(one, 32), one.bitwiseAND(low), F.shiftrightunsigned(two, 32), two.bitwiseAND(low)]
    hashed = path.select("conv_id", "pos", "chars", *[p.alias(s) for p, s in zip(parts, PARTS)])
    own = stored(hashed, "path-hashes")
    summed = running_sums(own.select("conv_id", "pos", "chars", *PARTS, *[F.col(s).alias(f"own_{s}") for s in PARTS]), "conv_id", "pos", PARTS)
    key = F.unhex(F.md5(F.concat_ws(",", (F.col("pos") + 1).cast("string"), *[F.col(s).cast("string") for s in PARTS]).cast("binary")))
    above = F.unhex(F.md5(F.concat_ws(",", F.col("pos").cast("string"), *[(F.col(s) - F.col(f"own_{s}")).cast("string") for s in PARTS]).cast("binary")))
    root = F.unhex(F.md5(F.lit("0,0,0,0,0").cast("binary")))
    below = summed.select("conv_id", (F.col("pos") + 1).alias("depth"), key.alias("node"), above.alias("parent"), "chars")
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"))
    lengths = convs.select("conv_id", "length")
    both = below.unionByName(top).withColumn("block", F.floor(F.col("depth") / BLOCK))
    return spread_join(both, lengths, "conv_id", "block").select("conv_id", "depth", "node", "parent", "chars", (F.col("depth") == F.col("length")).alias("at_end"))


def _chain_task(weights: int):
    """Contracts the chains of successive elements inside one block."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        ids, nxt = part["id"].to_numpy(np.int64), part["next"].to_numpy(np.int64)
        n = len(ids)
        at = np.searchsorted(ids, nxt)
        local = (at < n) & (ids[np.minimum(at, n - 1)] == nxt)
        before = np.arange(n)
        before[at[local]] = np.flatnonzero(local)
        sums = [part[f"w{i}"].to_numpy(np.int64).copy() for i in range(weights)]
        jump, head = before.copy(), before == np.arange(n)
        total = [np.where(head, 0, s[before]) for s in sums]  # of the elements before, back to the jump's target
        for _ in range(max(int(n).bit_length(), 1)):
            total = [t + t[jump] for t in total]
            jump = jump[jump]
        tail = ~local
        out = {"id": ids, "head": ids[jump], "tail_next": np.where(tail, nxt, -2)}
        for i in range(weights):
            out[f"before{i}"], out[f"through{i}"] = total[i], total[i] + sums[i]
        return pd.DataFrame(out)
    return run


def list_rank(links: DataFrame, weights: int, block: int = ARC_BLOCK, name: str = "tour") -> DataFrame:
    """id, before0.. : for every element of the lists the sum of the weights w0.. of the elements before it.

    ``links``: id (0, 1, ... without gaps), next (-1 at a list's end), w0 ..  Each level groups
    ids into blocks of bounded size and goes on with one element a chain.
    """
    ws = [f"w{i}" for i in range(weights)]
    links, seen = stored_observed(links.select("id", "next", *ws), f"{name}-links", n=F.count(F.lit(1)))
    n = int(seen["n"])
    sums = ", ".join(f"before{i} bigint, through{i} bigint" for i in range(weights))
    chains = links.withColumn("block", F.floor(F.col("id") / block)).groupBy("block").applyInPandas(
        _chain_task(weights), f"id bigint, head bigint, tail_next bigint, {sums}")
    chains, seen = stored_observed(chains, f"{name}-chains", heads=F.sum(F.when(F.col("id") == F.col("head"), 1).otherwise(0)))
    befores = [f"before{i}" for i in range(weights)]
    if n <= block:
        return chains.select("id", *befores)
    short = chains.where("tail_next <> -2").select(F.col("head").alias("id"), F.col("tail_next").alias("next"), *[F.col(f"through{i}").alias(f"w{i}") for i in range(weights)])
    inner = _rank_contracted(short, int(seen["heads"] or 0), n, weights, block, name)
    own = inner.select(F.col("id").alias("head"), *[F.col(f"before{i}").alias(f"_off{i}") for i in range(weights)])
    joined = chains.select("id", "head", *befores).join(own, "head")
    return joined.select("id", *[(F.col(f"before{i}") + F.col(f"_off{i}")).alias(f"before{i}") for i in range(weights)])


def _rank_contracted(short: DataFrame, heads: int, n: int, weights: int, block: int, name: str) -> DataFrame:
    """Ranks a list whose ids have gaps: splices out elements at random if blocks contracted little, then numbers the rest anew."""
    ws = [f"w{i}" for i in range(weights)]
    befores = [f"before{i}" for i in range(weights)]
    spliced = None
    if heads > 0.5 * n:
        # an element with coin 0 after one with coin 1 goes; its weights pass to the one before it
        short = stored(short.withColumn("coin", F.pmod(F.xxhash64("id", F.lit(heads)), F.lit(2))), f"{name}-coins")
        ahead = short.select(F.col("next").alias("id"), F.col("id").alias("by"), *[F.col(w).alias(f"by_{w}") for w in ws]).where("id >= 0 and coin = 1")
        spliced = stored(short.where("coin = 0").join(ahead, "id"), f"{name}-spliced")
        gone = spliced.select(F.col("by").alias("id"), F.col("next").alias("over"), *[F.col(w).alias(f"more_{w}") for w in ws], F.lit(True).alias("hit"))
        left = short.join(spliced.select("id"), "id", "left_anti").join(gone, "id", "left")
        short = left.select("id", F.when(F.col("hit"), F.col("over")).otherwise(F.col("next")).alias("next"),
                            *[(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in ws])
    named = ordered_rank(short, ["id"], "new", f"{name}-renumbered")
    ids = named.select(F.col("id").alias("next"), F.col("new").alias("new_next"))
    again = named.join(ids, "next", "left").select(F.col("new").alias("id"), F.coalesce("new_next", F.lit(-1)).alias("next"), *ws)
    ranked = list_rank(again, weights, block, name)
    out = named.select("id", "new").join(ranked.withColumnRenamed("id", "new"), "new").select("id", *befores)
    if spliced is not None:
        # a spliced element follows the one that took its weights
        back = spliced.select(F.col("id").alias("_id"), F.col("by").alias("id"), *[f"by_{w}" for w in ws]).join(out, "id")
        out = stored(out, f"{name}-kept").unionByName(back.select(F.col("_id").alias("id"), *[(F.col(f"before{i}") + F.col(f"by_w{i}")).alias(f"before{i}") for i in range(weights)]))
    return out


def _text_task(piece: int):
    """Consecutive ids of one node, in order, as comma-joined pieces."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            node = f["node"].to_numpy()
            cut = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(f) else []
            rows = []
            for a, b in zip(cut, [*cut[1:], len(f)]):
                ids = f["conv_id"].iloc[a:b].to_list()
                rows += [(node[a], ids[i], ",".join(map(str, ids[i : i + piece]))) for i in range(0, len(ids), piece)]
            yield pd.DataFrame(rows, columns=["node", "first", "ids"])
    return run


def _digest_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's pieces, which arrive in order; a node's state is one digest."""
    node, state = None, None
    for f in frames:
        rows = []
        for key, text in zip(f["node"], f["ids"]):
            if key != node:
                if node is not None:
                    rows.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield pd.DataFrame(rows, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """node, ends_sha256 of (node, conv_id): the digest of each node's ids, ascending, comma-joined."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # sorted ranges split the ids of one node over tasks; a piece is a row afterwards
    pieces = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInPandas(_text_task(piece), "node binary, first bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInPandas(_digest_task, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the rebuilt conversations."""
    ordered = stored(turns(conversations), "turns")
    path, convs = rebuilt(ordered)
    belong = stored(members(path, stored(convs, "convs")), "members")
    grouped = belong.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"),
        F.min("chars").alias("chars"))
    nodes = ordered_rank(grouped, ["conv_id", "depth"], "id", "nodes").withColumn("block", F.floor(F.col("id") / BLOCK))
    # children of one parent meet in blocks of ids; a parent's blocks are few rows
    blocks = nodes.where("depth > 0").groupBy("parent", "block").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("many"))
    blocks = stored(blocks, "child-blocks")
    kids = blocks.groupBy("parent").agg(F.min("least").alias("first_child"), F.sum("many").alias("n_children")).withColumnRenamed("parent", "node")
    over = F.lead("least").over(Window.partitionBy("parent").orderBy("block"))
    above = nodes.select(F.col("node").alias("parent"), F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    linked = blocks.withColumn("next_block", over).join(above, "parent").select("parent", "block", "next_block", "parent_id", "parent_conv_id")
    within = F.lead("id").over(Window.partitionBy("parent", "block").orderBy("id"))
    root = nodes.where("depth = 0").withColumn("sibling", F.lit(None).cast("long")).withColumn("parent_id", F.lit(None).cast("long")).withColumn("parent_conv_id", F.lit(None).cast("long"))
    child = nodes.where("depth > 0").withColumn("sibling", within).join(linked, ["parent", "block"]).withColumn("sibling", F.coalesce("sibling", "next_block")).drop("next_block")
    placed = stored(child.unionByName(root).join(kids, "node", "left").drop("parent", "block"), "placed")
    enter, leave = 2 * F.col("id"), 2 * F.col("id") + 1
    follow = F.coalesce(2 * F.col("sibling"), 2 * F.col("parent_id") + 1, F.lit(-1))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    leaf = F.when(F.col("first_child").isNull(), 1).otherwise(0).cast("long")
    arcs = placed.select(F.explode(F.array(
        F.struct(enter.alias("id"), F.coalesce(2 * F.col("first_child"), leave).alias("next"), leaf.alias("w0"), saved.alias("w1")),
        F.struct(leave.alias("id"), follow.alias("next"), F.lit(0).cast("long").alias("w0"), F.lit(0).cast("long").alias("w1")))).alias("a")).select("a.*")
    tour = list_rank(arcs, 2).select(F.floor(F.col("id") / 2).alias("id"), (F.col("id") % 2).alias("out"), "before0", "before1")
    sums = tour.groupBy("id").agg(*[
        (F.max(F.when(F.col("out") == 1, F.col(f"before{i}"))) - F.max(F.when(F.col("out") == 0, F.col(f"before{i}")))).alias(c) for i, c in enumerate(("n_leaves", "saved_tokens"))])
    ends = end_digests(belong.where("at_end").select("node", "conv_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return placed.join(sums, "id").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))
