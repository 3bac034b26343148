"""Operator 9, sharding along a Hilbert curve; DataFrame functions only.

Each metadata dimension is quantised to 2**bits cells of near equal row
counts in the dimension's order (from exact counts of its distinct values).
The cell coordinates become an index on the Hilbert curve (Skilling's
transform, folded over the bits), rows are ordered by it, and the order is cut into
runs: shard s holds the ranks from ceil(s*N/shards) on, so counts differ by
one at most (law ``rows``).  Neighbouring cells lie in the same files:
``write_shards`` writes whole rows, a folder a shard, sorted along the curve, with a
list of each file's smallest and largest value of every dimension beside them;
``read_shards`` opens only files whose ranges meet its conditions, on any of the
dimensions.

Ties on the curve go by text checksum and doc_id, so equal texts of one cell lie
together.  Null values of a dimension sort first; null texts have size 1 and
checksum 0.  Repeated rows take neighbouring slots.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stellate.llm.common import ordered_rank, stored_observed

SHARDS, BITS, DIMS, FOLDER = 16, 5, ("source", "lang", "size"), "curve_shard"


def _cells(df: DataFrame, dim: str, bits: int, rows: int) -> DataFrame:
    """(dim, c_dim): the quantised cell of each distinct value, by the share of rows before it."""
    counts = df.groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_rank(counts, [dim], "_rank", f"dim-{dim}")
    # running counts over blocks of values, so no window holds more than a block
    block = F.floor(F.col("_rank") / 4096).cast("long")
    ranked = ranked.withColumn("_block", block)
    blocks = ranked.groupBy("_block").agg(F.sum("n").alias("_bn"))
    before = blocks.select("_block", (F.sum("_bn").over(Window.orderBy("_block")) - F.col("_bn")).alias("_b"))
    within = F.sum("n").over(Window.partitionBy("_block").orderBy("_rank")) - F.col("n")
    return (
        ranked.withColumn("_w", within).join(before, "_block")
        .select(dim, F.floor((F.col("_b") + F.col("_w")) * (1 << bits) / F.lit(max(rows, 1))).cast("int").alias(f"c_{dim}"))
    )


def hilbert_index(df: DataFrame, axes: list[str], bits: int, out: str = "curve") -> DataFrame:
    """Adds the Hilbert curve index of integer coordinates 0 <= x < 2**bits.

    The steps of the transform fold over literal arrays, so the expressions stay small whatever the
    optimizer inlines.
    """
    n = len(axes)
    steps = ", ".join(f"struct({1 << level} as q, {i} as i)" for level in range(bits - 1, 0, -1) for i in range(n))
    turned = f"""aggregate(array({steps}), _x, (a, s) -> transform(a, (v, j) ->
        CASE WHEN (a[s.i] & s.q) <> 0 THEN CASE WHEN j = 0 THEN v ^ (s.q - 1) ELSE v END
             WHEN j = 0 OR j = s.i THEN v ^ ((a[0] ^ a[s.i]) & (s.q - 1)) ELSE v END))""" if bits > 1 else "_x"
    gray = "transform(_x, (v, j) -> aggregate(slice(_x, 1, j + 1), 0, (p, u) -> p ^ u))"
    tops = ", ".join(str(1 << level) for level in range(bits - 1, 0, -1))
    turn = f"aggregate(array({tops}), 0, (t, q) -> CASE WHEN (_x[{n - 1}] & q) <> 0 THEN t ^ (q - 1) ELSE t END)" if bits > 1 else "0"
    places = ", ".join(f"struct({level} as l, {i} as i)" for level in range(bits - 1, -1, -1) for i in range(n))
    index = f"aggregate(array({places}), 0L, (p, s) -> p * 2 + (shiftright(_x[s.i] ^ _t, s.l) & 1))"
    return (
        df.withColumn("_x", F.array(*[F.col(a).cast("int") for a in axes])).withColumn("_x", F.expr(turned)).withColumn("_x", F.expr(gray))
        .withColumn("_t", F.expr(turn)).withColumn(out, F.expr(index)).drop("_x", "_t")
    )


def _ranked(docs: DataFrame, dims: list[str], bits: int, carry: list[str]) -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32, curve, _rank, columns of ``carry`` as _c0, _c1, ... of every row, and the number of rows."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    meta = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(d) for d in dims if d != "size"],
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    meta, seen = stored_observed(meta, "shard-meta", n=F.count(F.lit(1)))
    rows = int(seen["n"])
    placed = meta
    for d in dims:
        cells = _cells(meta, d, bits, rows).withColumnRenamed(d, "_v")
        placed = placed.join(cells, F.col(d).eqNullSafe(F.col("_v")), "left").drop("_v")
    placed = hilbert_index(placed, [f"c_{d}" for d in dims], bits)
    own = ["doc_id", "size", "text_crc32", "curve"]
    return ordered_rank(placed.select(*own, *[f"_c{i}" for i in range(len(carry))]), ["curve", "text_crc32", "doc_id", "size"], "_rank", "curve"), rows


def _shard(rows: int, shards: int) -> Column:
    return F.expr(f"(_rank * {shards}) div {max(rows, 1)}").cast("int")


def hilbert_shards(docs: DataFrame, dims: list[str] | None = None, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve for every row.

    ``dims`` name columns of ``docs`` (or ``size``, the text's bytes + 1).
    """
    ranked, rows = _ranked(docs, dims or list(DIMS), bits, [])
    n = max(rows, 1)
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", _shard(rows, shards)).withColumn("slot", F.col("_rank") - first)
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
    )


def write_shards(docs: DataFrame, path: str, dims: list[str] | None = None, shards: int = SHARDS, bits: int = BITS) -> None:
    """Whole rows of ``docs`` under ``path``/curve_shard=N, sorted along the curve, and ``path``/_ranges (a row a file)."""
    dims = dims or list(DIMS)
    columns = docs.columns
    if FOLDER in columns or "size" in columns and "size" in dims:
        raise ValueError(f"{FOLDER} and, as a dimension, size are added by the shards")
    ranked, rows = _ranked(docs, dims, bits, columns)
    sized = [F.col("size")] if "size" in dims else []
    whole = ranked.withColumn(FOLDER, _shard(rows, shards)).repartitionByRange(shards, FOLDER, "_rank").sortWithinPartitions(FOLDER, "_rank")
    whole = whole.select(*sized, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], FOLDER)
    whole.write.partitionBy(FOLDER).parquet(path)
    spark = docs.sparkSession
    spark.createDataFrame([], whole.schema).coalesce(1).write.parquet(f"{path}/_schema")  # readers of a table without rows need it
    ends = [f(F.col(f"`{d}`")).alias(f"{n}_{i}") for i, d in enumerate(dims) for n, f in (("low", F.min), ("high", F.max))]
    spark.read.schema(whole.schema).parquet(path).groupBy(F.concat_ws("/", F.concat(F.lit(f"{FOLDER}="), F.col(FOLDER)), "_metadata.file_name").alias("file")).agg(
        *ends, F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(f"{path}/_ranges")


def read_shards(spark: SparkSession, path: str, ranges: dict[str, tuple], dims: list[str] | None = None) -> DataFrame:
    """Rows with low <= dimension <= high for every entry of ``ranges``; files whose own ranges lie outside are not opened.

    ``dims`` as given to ``write_shards``.  Null values of a dimension meet no range.
    """
    dims = dims or list(DIMS)
    listed = spark.read.parquet(f"{path}/_ranges")
    for d, (low, high) in ranges.items():
        i = dims.index(d)
        listed = listed.where((F.col(f"low_{i}") <= F.lit(high)) & (F.col(f"high_{i}") >= F.lit(low)))
    files = sorted(r["file"] for r in listed.select("file").collect())  # a row a file that is read
    schema = spark.read.parquet(f"{path}/_schema").schema
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
    for d, (low, high) in ranges.items():
        rows = rows.where(F.col(f"`{d}`").between(F.lit(low), F.lit(high)))
    return rows
