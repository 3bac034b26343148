"""Operator 12, document fingerprints by winnowing; DataFrame functions only.

A text's words (runs without ASCII white space) become codes (CRC-32 plus one); every
run of ``k`` words has the rolling polynomial hash of its codes modulo a prime
below 2**38.  Of each window of ``w`` consecutive hashes the smallest is
chosen, of equal ones the rightmost, and kept with its place (number of its
first word, modulo 2**25).  So two texts that share a run of k + w - 1 words share a
fingerprint entry, and a run of fewer than k words matches nothing.  A text of
fewer than k words is one run, fewer than w hashes are one window; a text
without words (null, empty, blank) has an empty fingerprint.

``edited_neighbours`` fingerprints each text and its edited text: its last
floor(n/4) code points are replaced by the first as many (all, if fewer) of the next
document in ascending doc_id, the last document's next being the first.  Null
doc_ids come first; rows that repeat a doc_id follow each other by file and row
and are documents of their own.  Likeness is the Jaccard similarity of the two
sets of hashes, 1 when both are empty.  A table of one row is its own next.
Extra columns are ignored.

Scale: neighbours are found on (place, length) rows alone; then whole texts
are shuffled once by the place of their row (a unique key, so no key is hot), and
the next document sends its needed prefix and its hashes to that place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import ordered_rank, stored_observed
from stellate.llm.stream_dedup import located

WORDS, WINDOW = 3, 4
# Fixed values of the rolling hash: the largest prime below 2**38, and its base.
PRIME, BASE = 274877906899, 23003
PLACE_BITS = 25


def _rolled(codes: str, at: str, k: int) -> str:
    """SQL of the polynomial hash of codes[at .. at+k-1]; reduced only where 63 bits would not hold the next step."""
    out, top = f"get({codes}, {at})", 1 << 32
    for i in range(1, k):
        if top * BASE + (1 << 32) >= 1 << 63:
            out, top = f"({out}) % {PRIME}", PRIME
        out, top = f"({out}) * {BASE} + get({codes}, {at} + {i})", top * BASE + (1 << 32)
    return f"({out}) % {PRIME}"


def winnow(df: DataFrame, text: str, out: str, k: int = WORDS, w: int = WINDOW) -> DataFrame:
    """Adds ``out``: array of longs, the chosen hash of every window with its place, in order of place (see ``entries``).

    An entry holds the hash above the last place minus the place, so the
    smallest entry of a window has the smallest hash and the rightmost place.
    """
    last = (1 << PLACE_BITS) - 1
    words = f"regexp_extract_all(coalesce({text}, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    hashed = f"transform(sequence(0, size(_codes) - {k}), j -> (({_rolled('_codes', 'j', k)}) * {last + 1}) + ({last} - (j & {last})))"
    least = ", ".join(f"get(_hashes, j + {i})" for i in range(w))
    chosen = f"array_distinct(transform(sequence(0, greatest(size(_hashes) - {w}, 0)), j -> least({least})))" if w > 1 else "_hashes"
    return (
        df.withColumn("_words", F.expr(f"transform({words}, x -> crc32(cast(x as binary)) + 1)"))
        .withColumn("_codes", F.expr(f"if(size(_words) < {k}, concat(_words, array_repeat(0L, {k} - size(_words))), _words)"))
        .withColumn("_hashes", F.expr(hashed))
        .withColumn(out, F.expr(f"if(size(_words) = 0, cast(array() as array<bigint>), {chosen})"))
        .drop("_words", "_codes", "_hashes")
    )


def entries(prints: str) -> Column:
    """A fingerprint as array of (hash long, place int)."""
    last = (1 << PLACE_BITS) - 1
    return F.expr(f"transform({prints}, x -> named_struct('hash', shiftright(x, {PLACE_BITS}), 'place', cast({last} - (x & {last}) as int)))")


def as_text(prints: str) -> Column:
    """A fingerprint as ``hash@place`` entries, separated by blanks."""
    last = (1 << PLACE_BITS) - 1
    return F.expr(f"array_join(transform({prints}, x -> concat(cast(shiftright(x, {PLACE_BITS}) as string), '@', cast({last} - (x & {last}) as string))), ' ')")


def marks(prints: str) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.expr(f"array_distinct(transform({prints}, x -> shiftright(x, {PLACE_BITS})))")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - both
    return F.when(whole == 0, F.lit(1.0)).otherwise(both / F.greatest(whole, F.lit(1)))


def edited_neighbours(docs: DataFrame, k: int = WORDS, w: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of ``docs``."""
    rows = located(docs).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("file").alias("file"), "row")
    lengths, seen = stored_observed(rows.select("doc_id", "file", "row", F.length("text").cast("long").alias("n")), "lengths", total=F.count(F.lit(1)))
    total = max(int(seen["total"]), 1)
    ranked = ordered_rank(lengths, ["doc_id", "file", "row"], "rank", "next-order")
    # the row of rank r sends to the row of rank r - 1, which wants n div 4 code points of it
    wants = ranked.select(F.pmod(F.col("rank") + 1, F.lit(total)).alias("rank"), F.col("file").alias("to_file"), F.col("row").alias("to_row"),
                          F.col("doc_id").alias("to_id"), F.expr("cast(n div 4 as int)").alias("wanted"))
    sends = ranked.select("file", "row", "rank").join(wants, "rank").drop("rank")
    # both joins read the same columns of the texts, so the texts are shuffled once (the ids travel with the narrow rows)
    texts = rows.select("file", "row", "text")
    sender = winnow(texts.join(sends.hint("shuffle_hash"), ["file", "row"]), "text", "_prints", k, w)
    sent = sender.select(F.col("to_file").alias("file"), F.col("to_row").alias("row"), F.col("to_id").alias("doc_id"),
                         F.expr("substring(text, 1, wanted)").alias("_head"), marks("_prints").alias("_next"))
    own = texts.join(sent, ["file", "row"]).withColumn("n_chars", F.length("text").cast("long"))
    both = own.withColumn("_edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 4 as int)), _head)"))
    both = winnow(winnow(both, "text", "_prints", k, w), "_edited", "_after", k, w)
    return both.select(
        "doc_id", "n_chars", F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"), as_text("_prints").alias("fingerprint"),
        as_text("_after").alias("edited_fingerprint"), marks("_prints").alias("_a"), marks("_after").alias("_b"), "_next",
    ).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             likeness("_a", "_b").alias("near_edited"), likeness("_a", "_next").alias("near_next"))
