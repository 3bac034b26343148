"""Numbered loads, refreshed dimensions, layout that readers prune, published releases, table-held constraints, stored audits, checked files."""

from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stellate.operators import contract
from stellate.operators.load_metrics import LoadMetrics
from stellate.operators.profile import largest_share, top_key_share
from stellate.operators.stored_audit import audit_partitions, count_partitions
from stellate.plans import layout, load_queries, publish, star, warehouse
from stellate.session import scratch_path
from stellate.sources.checked_csv import header_report, read_csv_checked
from stellate.sources.tables import read_table
from stellate.streaming import loads
from tests.conftest import SF001

MEASURES = "country string, city string, date date, average_temp double"
KEYS = ("country", "city", "date")


def measures(spark, rows):
    return spark.createDataFrame([(c, t, d, v) for c, t, d, v in rows], "country string, city string, date string, average_temp double").withColumn(
        "date", F.col("date").cast("date"))


def ids(spark, target):
    return sorted((r.id, r.city, str(r.date), r.average_temp) for r in loads.read_loads(spark, target).collect())


# ---------------------------------------------------------------- loads that go on


def test_ids_go_on_over_loads(spark):
    target = scratch_path(spark, "ids")
    first = measures(spark, [("US", "b", "2024-01-01", 1.0), ("US", "a", "2024-01-01", 2.0), ("US", "a", None, 3.0), ("US", "a", None, 3.5)])
    assert loads.append_load(spark, first, target, KEYS, 0, ["city", "date"]) == (3, 0, 0)
    second = measures(spark, [("US", "a", "2024-01-01", 9.0), ("US", "c", "2024-01-02", 4.0), ("US", "a", "2024-01-02", 5.0)])
    assert loads.append_load(spark, second, target, KEYS, 1, ["city", "date"]) == (2, 1, 3)
    want = [(0, "a", "None", 3.0), (1, "a", "2024-01-01", 2.0), (2, "b", "2024-01-01", 1.0), (3, "a", "2024-01-02", 5.0), (4, "c", "2024-01-02", 4.0)]
    assert ids(spark, target) == want
    # the latest load again: the same rows and ids, nothing twice
    assert loads.append_load(spark, second, target, KEYS, 1, ["city", "date"]) == (2, 1, 3)
    assert ids(spark, target) == want
    # an empty load, then one more
    assert loads.append_load(spark, second.limit(0), target, KEYS, 2, ["city", "date"]) == (0, 0, 5)
    assert loads.append_load(spark, measures(spark, [("US", "d", "2024-01-03", 1.0)]), target, KEYS, 3, ["city", "date"]).first_id == 5
    with pytest.raises(ValueError, match="comes after"):
        loads.append_load(spark, second, target, KEYS, 1, ["city", "date"])
    with pytest.raises(ValueError, match="not in both"):
        loads.append_load(spark, second.withColumn("more", F.lit(1)), target, KEYS, 4, ["city", "date"])


def test_a_load_that_failed_half_way_is_repeated_whole(spark, monkeypatch):
    target = scratch_path(spark, "half")
    first = measures(spark, [("US", c, "2024-01-01", 1.0) for c in "abc"])
    second = measures(spark, [("US", c, "2024-01-02", 2.0) for c in "abcdef"])
    loads.append_load(spark, first, target, KEYS, 0, ["city"])
    real = loads.write_counted

    def half(df, path, **named):
        real(df.where("city < 'd'"), path, **named)  # some of the rows are there, the ledger is not
        raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(loads, "write_counted", half)
    with pytest.raises(RuntimeError):
        loads.append_load(spark, second, target, KEYS, 1, ["city"])
    monkeypatch.setattr(loads, "write_counted", real)
    assert loads.append_load(spark, second, target, KEYS, 1, ["city"]) == (6, 0, 3)
    assert [r[0] for r in ids(spark, target)] == list(range(9))


def test_stream_of_loads_survives_a_failing_batch(spark):
    drops, target, ckpt = (scratch_path(spark, n) for n in ("drops", "numbered", "ckpt"))
    rows = measures(spark, [("US", f"c{i % 7}", f"2024-01-{1 + i // 7:02d}", float(i)) for i in range(63)])
    for n in range(3):
        rows.where(F.col("average_temp").between(n * 18, n * 18 + 26)).coalesce(1).write.parquet(f"{drops}/d{n}")  # drops overlap
    calls = []

    def one_load(batch, number):
        loads.append_load(batch.sparkSession, batch, target, KEYS, number, ["city", "date"])
        calls.append(number)
        if calls == [0, 1]:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        loads.start_loads(spark, f"{drops}/*", rows.schema, ckpt, one_load, max_files=1).awaitTermination()
    loads.start_loads(spark, f"{drops}/*", rows.schema, ckpt, one_load, max_files=1).awaitTermination()
    assert calls == [0, 1, 1, 2]
    got = ids(spark, target)
    assert [r[0] for r in got] == list(range(63)) and sorted(r[3] for r in got) == [float(i) for i in range(63)]


def test_every_fact_date_is_in_the_calendar(spark):
    base = scratch_path(spark, "star")
    batches = [measures(spark, [("US", "a", f"2024-01-{d:02d}", 1.0) for d in days] + [("US", "b", None, 1.0)]) for days in (range(1, 6), range(4, 9))]
    airports = spark.createDataFrame([("K1", "US", "one"), ("K2", "FR", "two")], "id string, country string, name string")
    for _ in range(2):
        for load, batch in enumerate(batches):
            if load < max([n for n in loads._ledger(spark, f"{base}/temperature")], default=0):
                continue
            done = loads.refresh_star(spark, base, load, batch, "temperature", KEYS, ["date"], ["city", "date"], {"airport": (airports, ["id"], "country")})
    assert done["time"].appended == 3 and done["temperature"] == (3, 3, 6) and done["airport"] == (0, 0, 0)
    times = {r.time for r in loads.read_loads(spark, f"{base}/time").collect()}
    dates = {r.date for r in loads.read_loads(spark, f"{base}/temperature").collect()} - {None}
    assert times == dates and len(times) == 8
    assert loads.read_loads(spark, f"{base}/time").count() == 8


def files_of(path):
    found = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)}
    assert found
    return found


def test_upsert_rewrites_only_touched_folders(spark):
    path = scratch_path(spark, "dim")
    rows = [(i, f"n{i}", ["x", "y", "z", None][i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, name string, part string")
    assert loads.upsert_partitioned(spark, df, path, ["id"], "part") == (40, 0, 4)
    before = files_of(path)
    assert loads.upsert_partitioned(spark, df, path, ["id"], "part") == (0, 0, 0)
    assert files_of(path) == before
    changes = spark.createDataFrame([(0, "changed", "x"), (100, "new", "w"), (4, "n4", "x"), (None, "no id", "x")], df.schema)
    assert loads.upsert_partitioned(spark, changes, path, ["id"], "part") == (2, 1, 2)
    after = files_of(path)
    untouched = [f for f in before if "part=x" not in f]
    assert all(after[f] == before[f] for f in untouched)
    # a folder whose rows all move away holds none afterwards; a null folder is one like others
    moved = df.where("part = 'y' or part is null").withColumn("part", F.lit("z"))
    assert loads.upsert_partitioned(spark, moved, path, ["id"], "part") == (0, 20, 3)
    assert loads.upsert_partitioned(spark, moved, path, ["id"], "part") == (0, 0, 0)
    got = {(r.id, r.name, r.part) for r in spark.read.parquet(path).select("id", "name", "part").collect()}
    want = {(i, n, "z" if i % 4 in (1, 3) else p) for i, n, p in rows} - {(0, "n0", "x")} | {(0, "changed", "x"), (100, "new", "w"), (None, "no id", "x")}
    assert got == want
    with pytest.raises(ValueError, match="not in both"):
        loads.upsert_partitioned(spark, df.drop("name"), path, ["id"], "part")


# ---------------------------------------------------------------- layout


def test_reloading_a_year_leaves_other_files_alone(spark):
    path = load_queries._orders_by_year(spark, SF001)
    before = files_of(path)
    n = spark.read.parquet(path).where("order_year = 1997").count()
    assert layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1997, lambda df: df.withColumn("o_totalprice", F.lit(1.0))) == n
    after = files_of(path)
    assert {f for f in before if "order_year=1997" not in f} == {f for f in after if "order_year=1997" not in f}
    assert all(after[f] == before[f] for f in before if "order_year=1997" not in f) and not {f for f in before if "order_year=1997" in f} & set(after)
    assert spark.read.parquet(path).count() == 15000 and spark.read.parquet(path).where("o_totalprice = 1").count() == n
    with pytest.raises(ValueError, match="out of the folders"):
        layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1997, lambda df: df.withColumn("order_year", F.lit(1990)))
    with pytest.raises(Exception):  # a failing change leaves the table as it is
        layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1997, lambda df: df.withColumn("o_totalprice", F.raise_error(F.lit("no")).cast("double")))
    assert spark.read.parquet(path).count() == 15000


def scan_metrics(df):
    """files and rows of every file scan of an executed plan, by walking it through its adaptive stages."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan"):
            m = node.metrics()
            found.append({k: m.apply(k).value() for k in ("numFiles", "numOutputRows") if m.contains(k)} | {"text": node.toString()})
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        else:
            kids = node.children()
            for i in range(kids.size()):
                walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_folders_are_pruned_at_run_time(spark):
    lines, months = load_queries._lines_by_month(spark, SF001)
    summer = months.where((F.col("year") == 1997) & F.col("month").between(6, 8))
    joined = layout.join_pruned(lines, summer, "ship_month", "month_key").select("l_orderkey", "l_quantity", "ship_month")
    rows = joined.collect()
    assert len(rows) == lines.where("ship_month between 199706 and 199708").count() and {r.ship_month for r in rows} == {199706, 199707, 199708}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    fact = [m for m in scan_metrics(joined) if "dynamicpruning" in m["text"]]
    assert fact and fact[0]["numFiles"] == 3 and len(lines.inputFiles()) > 70
    with pytest.raises(ValueError, match="inner or semi"):
        layout.join_pruned(lines, summer, "ship_month", "month_key", "left")


def test_range_reads_open_fewer_files_and_row_groups(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    layout.write_clustered(df, path, ["k"], files=8, row_group_bytes=128 << 10)
    part = layout.read_range(spark, path, "k", 50_000, 51_000)
    assert sorted(r.k for r in part.collect()) == list(range(50_000, 51_001))
    scan = scan_metrics(part)[0]
    assert scan["numFiles"] <= 2 < len(spark.read.parquet(path).inputFiles())
    assert scan["numOutputRows"] < 25_000 / 2  # row groups of the file outside the range are skipped
    assert layout.read_range(spark, path, "k", 900_000, 900_001).count() == 0
    hot = spark.range(20_000).select(F.lit(1).alias("k"), "id").unionByName(spark.range(20_000, 22_000).select(F.lit(2).alias("k"), "id"))
    hot_path = scratch_path(spark, "clustered-hot")
    assert layout.write_clustered(hot, hot_path, ["k", "id"], files=8) == 22_000
    sizes = [r.rows for r in spark.read.parquet(f"{hot_path}/{layout.RANGES}").collect()]
    assert len(sizes) == 8 and max(sizes) < 6000  # the hot leading value is spread


# ---------------------------------------------------------------- publication


A = contract.Contract("a", (contract.Col("k", "bigint", False), contract.Col("v", "string", max_length=3)), primary_key=("k",))


def test_publication_is_all_or_nothing(spark, monkeypatch):
    base, prefix = scratch_path(spark, "pub"), f"p{uuid.uuid4().hex[:8]}_"
    rules = {n: contract.Contract(n, A.columns) for n in ("t1", "t2", "t3")}

    def frames(value):
        return {n: spark.range(5).select(F.col("id").alias("k"), F.lit(value).alias("v")) for n in rules}

    def seen():
        return {n: {r.v for r in spark.table(f"{prefix}{n}").collect()} for n in rules}

    publish.publish(spark, frames("one"), rules, base, prefix)
    assert seen() == {n: {"one"} for n in rules}
    bad = frames("two") | {"t3": spark.range(5).select(F.col("id").alias("k"), F.raise_error(F.lit("source lost")).cast("string").alias("v"))}
    with pytest.raises(Exception, match="source lost"):
        publish.publish(spark, bad, rules, base, prefix)
    assert seen() == {n: {"one"} for n in rules}
    real, calls = publish._point, []

    def failing(spark_, table, path):
        calls.append(table)
        if len(calls) == 3:
            raise RuntimeError("catalog away")
        real(spark_, table, path)

    monkeypatch.setattr(publish, "_point", failing)
    with pytest.raises(RuntimeError):  # in the middle of the switch: the switched ones go back
        publish.publish(spark, frames("six"), rules, base, prefix)
    monkeypatch.setattr(publish, "_point", real)
    assert seen() == {n: {"one"} for n in rules}
    old = {f"{prefix}{n}": publish.location(spark, f"{prefix}{n}") for n in rules}
    publish.publish(spark, frames("two"), rules, base, prefix)
    assert seen() == {n: {"two"} for n in rules}
    publish.rollback(spark, old)
    assert seen() == {n: {"one"} for n in rules}
    with pytest.raises(ValueError, match="columns"):
        publish.publish(spark, frames("x") | {"t1": spark.range(1).toDF("other")}, rules, base, prefix)
    warehouse.drop_tables(spark, list(old))


# ---------------------------------------------------------------- constraints


def test_the_table_refuses_what_its_contract_forbids(spark):
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    table = warehouse.create_tables(spark, [A], scratch_path(spark, "con"), prefix)["a"]
    assert warehouse.table_constraints(spark, table) == {contract.NOT_NULL: ["k"], contract.PRIMARY_KEY: ["k"]}
    good = spark.createDataFrame([("abc", 1), (None, 2)], "v string, k long")  # other column order: matched by name
    assert warehouse.insert_checked(good, table) == 2
    for rows, why in (([("x", None)], "k is null"), ([("x", 1)], "would be stored 2 times"), ([("x", 5), ("y", 5)], "would be stored 2 times"), ([("long", 7)], "EXCEED_LIMIT")):
        with pytest.raises(Exception, match=why):
            warehouse.insert_checked(spark.createDataFrame(rows, good.schema), table)
    with pytest.raises(Exception, match="EXCEED_LIMIT"):  # also by a plain statement
        spark.sql(f"INSERT INTO {table} VALUES (9, 'XXXX')")
    with pytest.raises(ValueError, match="not in both"):
        warehouse.insert_checked(good.drop("v"), table)
    with pytest.raises(Exception, match="k is null"):
        warehouse.insert_by_name(spark.createDataFrame([("x", None)], good.schema), A, table)
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [(1, "abc"), (2, None)]
    assert warehouse.insert_checked(good, table, overwrite=True) == 2
    warehouse.drop_tables(spark, [table])


# ---------------------------------------------------------------- metrics on the way


def test_sources_are_read_once_and_all_casts_are_reported(spark):
    reads = spark.sparkContext.accumulator(0)
    raw = spark.createDataFrame([("A", "1", "n/a"), ("A", "1", "n/a"), ("B", "x", "3")], "City string, Median_Age string, Number_of_Veterans string")

    def count(frames):
        for f in frames:
            reads.add(len(f))
            yield f

    counted = raw.mapInPandas(count, raw.schema)
    for c in star.CASTS["demographics"]:
        if c not in counted.columns:
            counted = counted.withColumn(c, F.lit("1"))
    counted = counted.withColumn("State_Code", F.lit("S")).withColumn("Race", F.lit("R")).withColumn("State", F.lit("T"))
    metrics = LoadMetrics()
    df = metrics.losses(metrics.rows(counted, "demographics"), "demographics", star.converted("demographics", counted))
    valid, rejects = contract.enforce_contract(star.conform_demographics(df, with_id=False), contract.Contract("d", (contract.Col("city", "string", False),), ("city",)), check_key=True, materialize=True)
    assert valid.count() == 1 and rejects.count() == 2
    assert reads.value == 3
    assert [tuple(r) for r in metrics.source_report(spark).collect()] == [("demographics", 3)]
    lost = {r.column_name: (r.non_null_in, r.lost) for r in metrics.loss_report(spark).collect()}
    assert set(lost) == set(star.CASTS["demographics"]) and lost["Number_of_Veterans"] == (3, 2) and lost["Median_Age"] == (3, 1) and lost["Count"] == (3, 0)
    with pytest.raises(ValueError, match="watched already"):
        metrics.rows(counted, "demographics")


def test_largest_share_by_sketch(spark):
    o = read_table(spark, SF001, "lineitem", ["l_orderkey"]).withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")))
    exact = top_key_share(o, ["l_orderkey"], n=1).first()["share"]
    assert exact <= largest_share(o, ["l_orderkey"]) + 1e-9 < exact + 0.01
    assert largest_share(o.limit(0), ["l_orderkey"]) == 0.0


# ---------------------------------------------------------------- stored audits


def test_audit_reads_changed_folders_only(spark):
    path, store = load_queries._orders_by_year(spark, SF001), scratch_path(spark, "audit")
    cols = ["o_orderstatus", "o_totalprice"]

    def scan():
        df = spark.read.parquet(path)
        n = df.count()
        return {c: (df.where(F.col(c).isNotNull()).count(), n) for c in cols}

    def audit():
        report, read = audit_partitions(spark, path, "order_year", cols, store)
        return {r.column_name: (r.non_null, r.total) for r in report.collect()}, read

    years = sorted({str(r.order_year) for r in spark.read.parquet(path).select("order_year").distinct().collect()})
    assert audit() == (scan(), years)
    assert audit() == (scan(), [])  # nothing changed: no file is read
    layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1999, lambda df: df.withColumn("o_totalprice", F.lit(None).cast("double")))
    assert audit() == (scan(), ["1999"])
    extra = spark.read.parquet(path).limit(3).withColumn("order_year", F.lit(2050))
    extra.write.mode("append").partitionBy("order_year").parquet(path)
    assert audit() == (scan(), ["2050"])
    only = count_partitions(spark, path, "order_year", cols, ["1997"])
    only.collect()
    assert scan_metrics(only)[0]["numFiles"] == len([f for f in files_of(path) if "order_year=1997/" in f])
    more, read = audit_partitions(spark, path, "order_year", [*cols, "o_orderkey"], store)  # a column the store lacks
    assert more.count() == 3 and len(read) == len(years) + 1


# ---------------------------------------------------------------- checked files


def test_every_line_is_a_row_or_a_reject(spark, tmp_text):
    long = "y" * 20_000
    text = ("﻿a,b\r\n1,2\r\n3,4,5\r\n6\r\n\r\n7,\"x \"\"q\"\" y\"\r\n8,\"open\r\n9,\"a, b\"\r\n,\r\n10,\"\"\r\n11,\"in\" out\r\n12,pre\"in\"\r\n"
            f"13,\"{long}\"\r\na,b\r\n14, spaced \r\n")
    path = tmp_text("in.csv", text)
    rows, rejects = read_csv_checked(spark, path, ["a", "b"])
    assert sorted(((r.a, r.b) for r in rows.collect()), key=str) == sorted(
        [("1", "2"), ("7", 'x "q" y'), ("9", "a, b"), (None, None), ("10", None), ("13", long), ("14", " spaced ")], key=str)
    assert {r.line: r.reason for r in rejects.collect()} == {
        "3,4,5": "3 fields instead of 2", "6": "1 fields instead of 2", '8,"open': "unbalanced quote", '11,"in" out': "text beside a quoted field", '12,pre"in"': "text beside a quoted field"}
    assert [(r.headers, r.lines, r.ok) for r in header_report(spark, path, ["a", "b"]).collect()] == [(2, 12, False)]
    semi = tmp_text("semi.csv", '"a";"b"\n1;2,5\n"x;y";z\n')
    rows, rejects = read_csv_checked(spark, semi, ["a", "b"], sep=";")
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "2,5"), ("x;y", "z")] and rejects.count() == 0
    other = tmp_text("other.csv", "a,c\n1,2\n")
    assert not header_report(spark, other, ["a", "b"]).first().ok
    with pytest.raises(ValueError):
        read_csv_checked(spark, path, ["a"], sep="||")
