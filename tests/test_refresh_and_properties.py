"""Refresh idempotency and randomized properties of parsing and casting."""

from __future__ import annotations

import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stellate.functions.casts import tolerant_cast
from stellate.session import scratch_path
from stellate.sources.codelists import parse_code_lists, render_code_list
from stellate.sources.tables import read_table
from stellate.streaming.refresh import in_key_range, refresh_once, start_refresh
from tests.conftest import SF001


def test_refresh_once_is_idempotent(spark):
    o = read_table(spark, SF001, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    target = scratch_path(spark, "refresh")
    first = o.filter(F.year("o_orderdate") < 1998)
    n = first.count()
    assert refresh_once(spark, first, target, ["o_orderkey"]) == (n, 0, 0)
    assert refresh_once(spark, first, target, ["o_orderkey"]) == (0, n, 0)  # retried batch appends nothing
    refresh_once(spark, o, target, ["o_orderkey"])
    out = spark.read.parquet(target)
    assert out.count() == o.count() == out.select("o_orderkey").distinct().count()


def test_refresh_null_keys_changed_rows_and_new_columns(spark):
    target = scratch_path(spark, "refresh-null")
    batch = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k int, v string")
    assert refresh_once(spark, batch, target, ["k"]) == (3, 0, 0)
    assert refresh_once(spark, batch, target, ["k"]) == (0, 3, 0)  # the NULL key is known too
    again = spark.createDataFrame([(1, "a2"), (2, "b"), (3, "c")], "k int, v string")
    assert refresh_once(spark, again, target, ["k"]) == (1, 2, 1)
    assert sorted((r.k or 0, r.v) for r in spark.read.parquet(target).collect()) == [(0, "n"), (1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        refresh_once(spark, again.withColumn("extra", F.lit(1)), target, ["k"])
    broken = scratch_path(spark, "refresh-broken")
    spark.createDataFrame([("x",)], "k string").write.text(broken)
    with pytest.raises(Exception):  # not a parquet table: an error, not "no table yet"
        refresh_once(spark, batch, broken, ["k"])


def test_refresh_reads_only_the_batch_key_range(spark):
    target = scratch_path(spark, "refresh-range")
    spark.range(0, 1000).withColumn("day", (F.col("id") / 100).cast("int")).write.partitionBy("day").parquet(target)
    batch = spark.createDataFrame([(990, 9), (2000, 9)], "id long, day int")
    pruned = in_key_range(spark.read.parquet(target), batch, ["day", "id"])
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and ">= 9" in plan and "GreaterThanOrEqual(id,990)" in plan
    assert refresh_once(spark, batch, target, ["day", "id"]) == (1, 1, 0)


def test_refresh_stream_survives_restart(spark):
    o = read_table(spark, SF001, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    drops, target, ckpt = (scratch_path(spark, n) for n in ("drops", "target", "ckpt"))
    o.filter(F.col("o_orderkey") < 8000).write.parquet(f"{drops}/d1")
    start_refresh(spark, f"{drops}/*", o.schema, target, ["o_orderkey"], ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == o.filter(F.col("o_orderkey") < 8000).count()
    # a new drop overlapping the old one; the restarted query resumes from its checkpoint
    o.filter(F.col("o_orderkey") >= 7000).write.parquet(f"{drops}/d2")
    start_refresh(spark, f"{drops}/*", o.schema, target, ["o_orderkey"], ckpt).awaitTermination()
    out = spark.read.parquet(target)
    assert out.count() == o.count() == out.select("o_orderkey").distinct().count()


_label_chars = st.text(
    alphabet=string.ascii_letters + string.digits + " '\"-,.:;()#&/*=\u00e9", min_size=1, max_size=30
).filter(lambda s: s.strip() != "")


def test_labels_with_separators_and_comment_marks(spark, tmp_path):
    entries = {"1": "a; b", "2": "x /* y", "3": "it's", "4": "z */ w", "5": "; value foo 'q' = 'r';", "6": "\ue000;\ue001\ue0010", "\ue001x": "\ue0011;"}
    rows = spark.createDataFrame([("lst", k, v) for k, v in entries.items()], "list_name string, code string, label string")
    path = scratch_path(spark, "marks")
    render_code_list(rows, "list_name", "code", "label").write.text(path)
    assert {r.code: r.label for r in parse_code_lists(spark, path).collect()} == entries
    for code, label in (("a'b", "x"), ("a", "x\ny"), ("a", "\tx")):
        with pytest.raises(Exception, match="cannot carry"):
            render_code_list(spark.createDataFrame([("l", code, label)], rows.schema), "list_name", "code", "label").collect()


def test_many_entries_in_one_block_parse(spark):
    n = 9000  # one block: no pattern may recurse over it
    rows = spark.range(n).select(F.lit("big").alias("l"), F.col("id").cast("string").alias("c"), F.concat(F.lit("it's; "), F.col("id")).alias("v"))
    path = scratch_path(spark, "big")
    render_code_list(rows, "l", "c", "v").coalesce(1).write.text(path)
    assert parse_code_lists(spark, path).where("label = concat(\"it's; \", code)").count() == n


@settings(max_examples=12, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    entries=st.dictionaries(
        st.text(alphabet=string.ascii_uppercase + string.digits + " -.", min_size=1, max_size=5).filter(
            lambda c: c.strip() == c and c != ""
        ),
        _label_chars,
        min_size=1, max_size=20,
    )
)
def test_render_then_parse_round_trips(spark, entries):
    rows = spark.createDataFrame(
        [("lst", k, v) for k, v in entries.items()], "list_name string, code string, label string"
    )
    path = scratch_path(spark, "rt")
    render_code_list(rows, "list_name", "code", "label").write.text(path)
    got = {r.code: r.label for r in parse_code_lists(spark, path).collect()}
    assert got == {k: v.strip() for k, v in entries.items()}


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(
            st.integers(min_value=-(2**40), max_value=2**40).map(str),
            st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda f: f"{f:.3f}"),
            st.sampled_from(["n/a", "", "  12  ", "None", "1e3", "abc"]),
            st.none(),
        ),
        min_size=1, max_size=30,
    )
)
def test_tolerant_int_cast_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.i for r in df.select(tolerant_cast("s", "bigint").alias("i")).collect()]

    def model(v):
        if v is None:
            return None
        t = v.strip()
        try:
            return int(t)
        except ValueError:
            pass
        try:
            f = float(t)
        except ValueError:
            return None
        return int(f) if f == f and abs(f) < 2**63 else None

    assert got == [model(v) for v in values]


def test_long_list_is_cut_into_blocks_and_parses_whole(spark):
    c = read_table(spark, SF001, "customer", ["c_custkey", "c_name"])
    rows = c.select(F.lit("all").alias("list_name"), F.col("c_custkey").alias("code"), F.col("c_name").alias("label"))
    blocks = render_code_list(rows, "list_name", "code", "label", max_entries=100)
    assert blocks.count() >= 15  # 1500 codes, about 100 per block
    path = scratch_path(spark, "long")
    blocks.write.text(path)
    parsed = parse_code_lists(spark, path)
    assert parsed.count() == 1500
    assert parsed.join(c.select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("label")),
                       ["code", "label"]).count() == 1500
