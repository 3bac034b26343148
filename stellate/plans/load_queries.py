"""Queries of loading and layout over the whole test tables: numbered loads, refreshed dimensions, checked files, constraints,
published releases, reloaded and pruned folders, clustered files, audits from stored counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators import contract
from stellate.operators.clean import chain_filters
from stellate.operators.dims import distinct_dates, time_dimension
from stellate.operators.stored_audit import audit_partitions
from stellate.plans import layout, publish, star, warehouse
from stellate.plans.star_queries import _TEMPERATURE, raw_temperature
from stellate.session import cut_lineage, scratch_path, stage
from stellate.sources.checked_csv import read_csv_checked
from stellate.sources.tables import read_table
from stellate.streaming import loads

# Two loads that overlap: the first has the dates before END, the second those from START on.
START, END = "2024-01-10", "2024-01-15"
TEMPERATURE_KEY = ("country", "city", "date")


def _tag() -> str:
    return uuid.uuid4().hex[:12]


def _temperatures(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame]]:
    """All conformed measurements, and the two loads they arrive in (unreadable dates come with the first)."""
    rows = stage(star.conform_temperature(star.clean_temperature(raw_temperature(spark, sf)), with_id=False), "measurements")
    early = F.col("date").isNull() | (F.col("date") < F.lit(END).cast("date"))
    return rows, [rows.where(early), rows.where(F.col("date") >= F.lit(START).cast("date"))]


def q_identity_refresh(spark, sf):
    """Measurements of two overlapping loads, the second loaded twice: ids go on without gap or repeat."""
    _, batches = _temperatures(spark, sf)
    target = scratch_path(spark, "temperature-loads")
    for load, batch in ((0, batches[0]), (1, batches[1]), (1, batches[1])):
        loads.append_load(spark, batch, target, TEMPERATURE_KEY, load, star.ID_ORDER["temperature"])
    return loads.read_loads(spark, target)


def q_star_refresh(spark, sf):
    """The calendar after two loads of measurements, each date with the measurements that fall on it."""
    _, batches = _temperatures(spark, sf)
    base = scratch_path(spark, "star-loads")
    for load, batch in enumerate(batches):
        loads.refresh_star(spark, base, load, batch, "temperature", TEMPERATURE_KEY, ["date"], star.ID_ORDER["temperature"])
    times, facts = loads.read_loads(spark, f"{base}/time"), loads.read_loads(spark, f"{base}/temperature")
    per_date = facts.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return times.join(per_date, times["time"] == per_date["date"], "full").select(
        F.coalesce("time", "date").alias("time"), "year", "month", "day_of_week", F.col("time").isNotNull().alias("in_calendar"), "n")


def q_dimension_upsert(spark, sf):
    """Customers by market segment after changed balances, a segment that moves and new customers, brought in twice."""
    c = read_table(spark, sf, "customer")
    target = scratch_path(spark, "customers-by-segment")
    loads.upsert_partitioned(spark, c, target, ["c_custkey"], "c_mktsegment")
    balance = F.when(F.col("c_custkey") % 10 == 3, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "MOVED").otherwise(F.col("c_mktsegment"))
    changed = c.withColumns({"c_acctbal": balance, "c_mktsegment": segment})
    new = c.where("c_custkey % 10 = 5").withColumn("c_custkey", -F.col("c_custkey"))
    for _ in range(2):
        loads.upsert_partitioned(spark, changed.unionByName(new), target, ["c_custkey"], "c_mktsegment")
    return spark.read.parquet(target).select(*c.columns)


CSV_COLUMNS = ("c_custkey", "c_name", "c_mktsegment")


def _customer_lines(spark: SparkSession, sf: str) -> str:
    """Customers as delimited lines of which some are too long, too short, quoted or badly quoted."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    quoted = F.concat(F.lit('"the ""'), name, F.lit('"", in ""quotes"""'))
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", key, name, segment, F.lit("extra")))
        .when(key % 11 == 0, F.concat_ws(",", key, name))
        .when(key % 13 == 0, F.concat_ws(",", key, F.concat(F.lit('"'), name), segment))
        .when(key % 17 == 0, F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit('" ltd')), segment))
        .when(key % 5 == 0, F.concat_ws(",", key, quoted, segment))
        .when(key % 3 == 0, F.concat_ws(",", key, F.lit(""), segment))
        .otherwise(F.concat_ws(",", key, name, segment))
    )
    path = scratch_path(spark, "customer-lines")
    spark.createDataFrame([(",".join(CSV_COLUMNS),)], "value string").coalesce(1).write.text(f"{path}/head")
    c.select(line.alias("value")).write.text(f"{path}/body")
    return path


def q_scan_csv_checked(spark, sf):
    """Every line as a row or as a reject with its reason."""
    path = _customer_lines(spark, sf)
    rows, rejects = read_csv_checked(spark, [f"{path}/head", f"{path}/body"], CSV_COLUMNS)
    none = F.lit(None).cast("string")
    return rows.select(*CSV_COLUMNS, none.alias("line"), none.alias("reason")).unionByName(
        rejects.select(*[none.alias(c) for c in CSV_COLUMNS], "line", "reason"))


ORDERS = contract.Contract(
    "orders",
    (
        contract.Col("o_orderkey", "bigint", False),
        contract.Col("o_custkey", "bigint", False),
        contract.Col("o_orderstatus", "string", max_length=1),
        contract.Col("o_totalprice", "double"),
    ),
    primary_key=("o_orderkey",),
)
CUSTOMERS = contract.Contract("customer", (contract.Col("c_custkey", "bigint", False), contract.Col("c_name", "string")), primary_key=("c_custkey",))


def _refused(insert) -> bool:
    try:
        insert()
    except Exception as e:  # the refusal is what is asked for; anything else fails the query
        if not any(mark in str(e) for mark in ("is null", "EXCEED_LIMIT_LENGTH", "would be stored", "not in both")):
            raise
        return True
    return False


def q_catalog_constraints(spark, sf):
    """What inserts a contract table refuses, and the rows it holds after each."""
    o = read_table(spark, sf, "orders", ORDERS.names)
    prefix = f"checked_{_tag()}_"
    table = warehouse.create_tables(spark, [ORDERS], scratch_path(spark, "checked"), prefix)["orders"]
    broken = F.col("o_orderkey") % 97 == 0
    other = o.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    attempts = {
        "first load": lambda: warehouse.insert_checked(o, table),
        "null in a required column": lambda: warehouse.insert_checked(other.withColumn("o_custkey", F.when(~broken, F.col("o_custkey"))), table),
        "value beyond its width": lambda: other.withColumn("o_orderstatus", F.when(broken, "XX").otherwise(F.col("o_orderstatus"))).write.insertInto(table),
        "stored keys again": lambda: warehouse.insert_checked(o, table),
        "a column less": lambda: warehouse.insert_checked(other.drop("o_totalprice"), table),
        "new keys": lambda: warehouse.insert_checked(other, table),
    }
    out = []
    for name, insert in attempts.items():
        refused = _refused(insert)
        out.append((name, refused, spark.table(table).count()))
    warehouse.drop_tables(spark, [table])
    return spark.createDataFrame(out, "attempt string, refused boolean, rows long")


def q_staged_publication(spark, sf):
    """Rows of two tables after a release, after one that fails its check, and after the next."""
    o, c = read_table(spark, sf, "orders", ORDERS.names), read_table(spark, sf, "customer", CUSTOMERS.names)
    base, prefix = scratch_path(spark, "releases"), f"pub_{_tag()}_"
    rules = {"orders": ORDERS, "customer": CUSTOMERS}

    def check(written):
        _, rejects = contract.enforce_contract(written["orders"], ORDERS, mode="fail")

    gap = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")))
    more = o.unionByName(o.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    steps = {"first": o, "broken": gap, "next": more}
    out = []
    for step, orders in steps.items():
        published = True
        try:
            publish.publish(spark, {"customer": c, "orders": orders}, rules, base, prefix, check)
        except ValueError:
            published = False
        out += [(step, name, published, spark.table(f"{prefix}{name}").count()) for name in rules]
    warehouse.drop_tables(spark, [f"{prefix}{name}" for name in rules])
    return spark.createDataFrame(out, "step string, table_name string, published boolean, rows long")


def _orders_by_year(spark: SparkSession, sf: str) -> str:
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    path = scratch_path(spark, "orders-by-year")
    warehouse.write_partitioned(o.withColumn("order_year", F.year("o_orderdate")).drop("o_orderdate"), path, ["order_year"])
    return path


def q_partition_reload(spark, sf):
    """Orders by year after one year was reloaded with doubled prices."""
    path = _orders_by_year(spark, sf)
    layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1997, lambda df: df.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return spark.read.parquet(path)


def _lines_by_month(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Lines in a folder per shipping month, and the calendar at month grain."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_quantity", "l_shipdate"])
    path = scratch_path(spark, "lines-by-month")
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    warehouse.write_partitioned(li.withColumn("ship_month", month).drop("l_shipdate"), path, ["ship_month"], files_per_value=1)
    days = time_dimension(distinct_dates([(li.withColumn("l_shipdate", F.col("l_shipdate").cast("date")), "l_shipdate")]))
    months = stage(days.select("year", "month", (F.col("year") * 100 + F.col("month")).alias("month_key")).distinct(), "months")
    return spark.read.parquet(path), months


def q_runtime_pruned_join(spark, sf):
    """Quantity shipped in each summer month of 1997, through the calendar."""
    lines, months = _lines_by_month(spark, sf)
    summer = chain_filters(months, F.col("year") == 1997, F.col("month").between(6, 8))
    joined = layout.join_pruned(lines, summer, "ship_month", "month_key")
    return joined.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 6).alias("quantity"))


def q_range_read(spark, sf):
    """Orders of a key range, from files clustered by the key."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    path = scratch_path(spark, "orders-clustered")
    layout.write_clustered(o, path, ["o_orderkey"], files=16)
    return layout.read_range(spark, path, "o_orderkey", 1000, 5000)


def q_stored_audit(spark, sf):
    """Completeness of orders by year after one year changed, and how many folders the second audit read."""
    path, store = _orders_by_year(spark, sf), scratch_path(spark, "audit-store")
    columns = ["o_orderstatus", "o_totalprice"]
    audit_partitions(spark, path, "order_year", columns, store)
    layout.reload_partitions(spark, path, ["order_year"], F.col("order_year") == 1998,
                             lambda df: df.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))))
    report, read = audit_partitions(spark, path, "order_year", columns, store)
    return cut_lineage(report).select("column_name", "non_null", "total", F.round("pct", 6).alias("pct"), F.lit(len(read)).alias("folders_read"))


LOAD_QUERIES = {
    "identity_refresh": q_identity_refresh,
    "star_refresh": q_star_refresh,
    "dimension_upsert": q_dimension_upsert,
    "scan_csv_checked": q_scan_csv_checked,
    "catalog_constraints": q_catalog_constraints,
    "staged_publication": q_staged_publication,
    "partition_reload": q_partition_reload,
    "runtime_pruned_join": q_runtime_pruned_join,
    "range_read": q_range_read,
    "stored_audit": q_stored_audit,
}

_LOADED = f"""
    {_TEMPERATURE},
    loaded AS (SELECT *, CASE WHEN date IS NULL OR date < DATE '{END}' THEN 0 ELSE 1 END AS load FROM temperature
               QUALIFY row_number() OVER (PARTITION BY country, city, date ORDER BY average_temp NULLS FIRST, uncertanty) = 1)
"""

_COUNTS = {
    "all": "(SELECT count(*) FROM orders)", "more": "(SELECT 2 * count(*) FROM orders)", "customer": "(SELECT count(*) FROM customer)",
}


def _publication_sql() -> str:
    rows = [("first", True, "all"), ("broken", False, "all"), ("next", True, "more")]
    parts = [f"SELECT '{step}' AS step, '{t}' AS table_name, {ok} AS published, {_COUNTS[n if t == 'orders' else 'customer']} AS rows"
             for step, ok, n in rows for t in ("orders", "customer")]
    return " UNION ALL ".join(parts)


def _constraints_sql() -> str:
    rows = [("first load", False, 1), ("null in a required column", True, 1), ("value beyond its width", True, 1), ("stored keys again", True, 1),
            ("a column less", True, 1), ("new keys", False, 2)]
    return " UNION ALL ".join(f"SELECT '{name}' AS attempt, {refused} AS refused, {times} * count(*) AS rows FROM orders" for name, refused, times in rows)


def _csv_sql() -> str:
    key, name, segment = "CAST(c_custkey AS VARCHAR)", "c_name", "c_mktsegment"
    bad = {
        "c_custkey % 7 = 0": (f"{key} || ',' || {name} || ',' || {segment} || ',extra'", "4 fields instead of 3"),
        "c_custkey % 11 = 0": (f"{key} || ',' || {name}", "2 fields instead of 3"),
        "c_custkey % 13 = 0": (f"{key} || ',\"' || {name} || ',' || {segment}", "unbalanced quote"),
        "c_custkey % 17 = 0": (f"{key} || ',\"' || {name} || '\" ltd,' || {segment}", "text beside a quoted field"),
    }
    line = "CASE " + " ".join(f"WHEN {k} THEN {v[0]}" for k, v in bad.items()) + " END"
    reason = "CASE " + " ".join(f"WHEN {k} THEN '{v[1]}'" for k, v in bad.items()) + " END"
    full = f"CASE WHEN c_custkey % 5 = 0 THEN 'the \"' || {name} || '\", in \"quotes\"' WHEN c_custkey % 3 <> 0 THEN {name} END"
    return f"""
        WITH l AS (SELECT *, {line} AS line, {reason} AS reason FROM customer)
        SELECT CASE WHEN reason IS NULL THEN {key} END AS c_custkey, CASE WHEN reason IS NULL THEN {full} END AS c_name,
               CASE WHEN reason IS NULL THEN {segment} END AS c_mktsegment, line, reason
        FROM l
    """


LOAD_SQL = {
    "identity_refresh": f"""
        WITH {_LOADED}
        SELECT row_number() OVER (ORDER BY load, country, city, date NULLS FIRST, average_temp NULLS FIRST, uncertanty) - 1 AS id,
               country, city, date, average_temp, uncertanty
        FROM loaded
    """,
    "star_refresh": f"""
        WITH {_LOADED}
        SELECT date AS "time", CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
               date IS NOT NULL AS in_calendar, count(*) AS n
        FROM loaded GROUP BY date
    """,
    "dimension_upsert": """
        SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
        FROM customer
        UNION ALL SELECT -c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 10 = 5
    """,
    "scan_csv_checked": _csv_sql(),
    "catalog_constraints": _constraints_sql(),
    "staged_publication": _publication_sql(),
    "partition_reload": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
               CAST(year(o_orderdate) AS INTEGER) AS order_year
        FROM orders
    """,
    "runtime_pruned_join": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n_lines, round(sum(l_quantity), 6) AS quantity
        FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) BETWEEN 6 AND 8 GROUP BY 1, 2
    """,
    "range_read": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey BETWEEN 1000 AND 5000",
    "stored_audit": """
        WITH o AS (SELECT CASE WHEN year(o_orderdate) = 1998 THEN nullif(o_orderstatus, 'F') ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders),
        k AS (SELECT count(*) AS total, count(s) AS s, count(p) AS p FROM o)
        SELECT 'o_orderstatus' AS column_name, s AS non_null, total, round(s * 100.0 / total, 6) AS pct, 1 AS folders_read FROM k
        UNION ALL SELECT 'o_totalprice', p, total, round(p * 100.0 / total, 6), 1 FROM k
    """,
}
