"""Scalar functions and sources on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stellate.functions.casts import cast_columns, cast_loss_report, tolerant_cast
from stellate.functions.dates import date_parts, date_to_day_number, day_number_to_date, parse_date
from stellate.operators import clean, profile
from stellate.session import scratch_path
from stellate.sources.csv import read_csv_strings, write_csv

D = dt.date


def test_day_numbers(spark):
    df = spark.createDataFrame([(20573.0,), (0.0,), (-1.0,), (20573.9,), (None,), (1e12,)], "n double")
    got = [r.d for r in df.select(day_number_to_date("n").alias("d")).collect()]
    assert got == [D(2016, 4, 29), D(1960, 1, 1), D(1959, 12, 31), D(2016, 4, 29), None, None]
    back = spark.createDataFrame([(D(2016, 4, 29),)], "d date").select(date_to_day_number("d").alias("n"))
    assert back.collect()[0].n == 20573


def test_parse_date_uses_month_not_minutes(spark):
    df = spark.createDataFrame([("1743-11-01",), ("2013-09-01",), ("bad",), (None,), ("2013-13-01",)], "s string")
    got = [r.d for r in df.select(parse_date("s").alias("d")).collect()]
    assert got == [D(1743, 11, 1), D(2013, 9, 1), None, None, None]


def test_date_parts_week_edges(spark):
    df = spark.createDataFrame([(D(2016, 1, 1),), (D(2015, 12, 28),), (D(2017, 1, 1),)], "d date")
    rows = df.select(*[v.alias(k) for k, v in date_parts("d").items()]).collect()
    assert [(r.week_of_year, r.day_of_week, r.weekday) for r in rows] == [(53, 6, 4), (53, 2, 0), (52, 1, 6)]


def test_tolerant_casts_by_type(spark):
    df = spark.createDataFrame([("40.9", "2016-04-29", "1.5e2"), ("n/a", "bad", ""), (None, None, None)],
                               "i string, d string, x string")
    out = cast_columns(df, {"i": "int", "d": "date", "x": "double"}).collect()
    assert [tuple(r) for r in out] == [(40, D(2016, 4, 29), 150.0), (None, None, None), (None, None, None)]
    rep = {r.column_name: (r.non_null_in, r.lost) for r in cast_loss_report(df, {"i": "int", "d": "date", "x": "double"}).collect()}
    assert rep == {"i": (2, 1), "d": (2, 1), "x": (2, 1)}
    ts = spark.createDataFrame([(dt.datetime(2020, 5, 1, 13, 0),)], "t timestamp_ntz")
    assert ts.select(tolerant_cast("t", "date", ts.schema["t"].dataType).alias("d")).collect()[0].d == D(2020, 5, 1)


def test_csv_strings_round_trip(spark):
    df = spark.createDataFrame([(1, "a b", 2.5), (2, "c;d", None)], "k int, s string, v double")
    path = scratch_path(spark, "csvt")
    write_csv(df, path, sep=";")
    back = read_csv_strings(spark, path, sep=";")
    assert back.dtypes == [("k", "string"), ("s", "string"), ("v", "string")]
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a b", "2.5"), ("2", "c;d", None)]
    named = read_csv_strings(spark, path, sep=";", columns=["k", "s", "v"])
    assert named.count() == 2


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k long, v string")
    assert clean.duplicate_report(empty, ["k"]).collect()[0][:] == (0, 0, 0, 0)
    assert clean.dedup_by_key(empty, ["k"]).count() == 0
    assert profile.mismatch_count(empty, "k", "v").collect()[0].n_mismatch == 0
    assert [r.pct for r in profile.completeness(empty).collect()] == [None, None]


def test_sentinel_filter_drops_nulls_too(spark):
    df = spark.createDataFrame([("None",), (None,), ("1.5",)], "t string")
    assert [r.t for r in clean.filter_not_sentinel(df, "t").collect()] == ["1.5"]


def test_chain_filters_merge(spark):
    df = spark.range(100).withColumn("m", F.col("id") % 7)
    out = clean.chain_filters(df, F.col("id") > 10, F.col("m") == 3)
    assert out.count() == len([i for i in range(11, 100) if i % 7 == 3])
