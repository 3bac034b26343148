"""The registered queries: every operator run over the whole test tables.

Roles of the test tables: orders and lineitem are the two facts, nation is the
country code list (used in two roles: customer and supplier nation), part is
the airport-like dimension, customer/supplier carry the country codes, and
events stand in for the temperature measurements.  Each query has an
equivalent DuckDB SQL text in ``ORACLE_SQL`` unless its output is not
reproducible in SQL (timings, plan-dependent values).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.casts import cast_loss_report, tolerant_cast
from stellate.functions.dates import date_to_day_number, day_number_to_date, parse_date
from stellate.operators import clean, contract, lookup, marts, profile, quality
from stellate.operators.dims import distinct_dates, time_dimension
from stellate.operators.joins import left_join_skew_safe
from stellate.operators.keys import dense_key
from stellate.plans import warehouse
from stellate.plans.load_queries import LOAD_QUERIES
from stellate.plans.star_queries import STAR_QUERIES
from stellate.session import cut_lineage, scratch_path
from stellate.sources.codelists import inline_code_list, parse_code_lists, render_code_list
from stellate.sources.csv import read_csv_strings, write_csv
from stellate.sources.tables import read_table, table_counts
from stellate.streaming.refresh import refresh_once, start_refresh

Query = Callable[[SparkSession, str], DataFrame]

# Inline code lists for the single-letter codes of the facts.
ORDER_STATUS = {"F": "Fulfilled", "O": "Open", "P": "Partial"}
RETURN_FLAG = {"A": "Accepted", "N": "Not returned", "R": "Returned"}
LINE_STATUS = {"F": "Finished", "O": "Open"}


def _tag() -> str:
    """Unique suffix for catalog tables and views created by a query."""
    return uuid.uuid4().hex[:12]


def _t(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    return read_table(spark, sf, name, cols or None)


def _nation_codes(spark: SparkSession, sf: str) -> DataFrame:
    n = _t(spark, sf, "nation", "n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))


def _customer_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation code; every tenth has a code that no list holds."""
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    return c.withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")))


def _lines_with_orphans(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Lines of which some name a supplier or an order that does not exist, or none at all."""
    li = _t(spark, sf, "lineitem", *dict.fromkeys(("l_orderkey", "l_suppkey", "l_linenumber", *cols)))
    far = F.lit(1 << 40)
    n = F.col("l_linenumber")
    return li.withColumns({
        "l_suppkey": F.when(n == 7, F.col("l_suppkey") + far).when(n == 6, F.lit(None)).otherwise(F.col("l_suppkey")),
        "l_orderkey": F.when((n == 5) & (F.col("l_orderkey") % 4 == 0), F.col("l_orderkey") + far).otherwise(F.col("l_orderkey")),
    })


def _orders_dated(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    return o.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


# ---- sources ---------------------------------------------------------------

def q_scan_counts(spark, sf):
    return table_counts(spark, sf)


def q_scan_csv(spark, sf):
    path = scratch_path(spark, "csv_customer")
    write_csv(_t(spark, sf, "customer"), path)
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return read_csv_strings(spark, path, columns=cols)


def q_scan_csv_semicolon(spark, sf):
    path = scratch_path(spark, "csv_part")
    write_csv(_t(spark, sf, "part"), path, sep=";")
    return read_csv_strings(spark, path, sep=";")


def _customer_lists(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer", "c_custkey", "c_name")
    rows = c.select(
        F.concat(F.lit("cust_"), F.expr("c_custkey div 1000").cast("string")).alias("list_name"),
        F.col("c_custkey").alias("code"),
        F.concat(F.col("c_name"), F.lit("'s shop; /* open */ 'daily'  ")).alias("label"),
    )
    path = scratch_path(spark, "codelists")
    # at most 100 blocks (100,000 entries) per file: each file is parsed as one row
    render_code_list(rows, "list_name", "code", "label").write.option("maxRecordsPerFile", 100).text(path)
    return parse_code_lists(spark, path)


def q_codelist_parse(spark, sf):
    return _customer_lists(spark, sf)


def q_codelist_inline(spark, sf):
    status = inline_code_list(spark, ORDER_STATUS)
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    decoded = lookup.decode(o, "o_orderstatus", status, "status_label", known_rows=len(ORDER_STATUS), unique=True)
    return profile.group_count(decoded, "status_label")


# ---- profiling -------------------------------------------------------------

def _orders_with_gaps(spark, sf) -> DataFrame:
    o = _orders_dated(spark, sf)
    return o.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))).withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )


def q_profile_completeness(spark, sf):
    rep = profile.completeness(_orders_with_gaps(spark, sf))
    return rep.withColumn("pct", F.round("pct", 6))


def q_profile_schema(spark, sf):
    return profile.schema_profile(_t(spark, sf, "orders"))


def q_group_count(spark, sf):
    return profile.group_count(_t(spark, sf, "part", "p_type"), "p_type")


def q_column_mismatch_count(spark, sf):
    # Pre-aggregate lineitem to (order, ship date) before the join: a hot
    # order key collapses to one row per date on the map side.
    li = (
        _t(spark, sf, "lineitem", "l_orderkey", "l_shipdate")
        .groupBy("l_orderkey", F.col("l_shipdate").cast("date").alias("ship_date"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")
    )
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return profile.mismatch_count(j, "order_date", "ship_date", weight="_n")


def q_preview_top_n(spark, sf):
    return profile.preview(_orders_dated(spark, sf), ["o_orderkey"], 5)


# ---- cleaning --------------------------------------------------------------

def q_filter_equals(spark, sf):
    return clean.filter_equals(_orders_dated(spark, sf), "o_orderstatus", "F")


def q_filter_not_null(spark, sf):
    o = _orders_with_gaps(spark, sf).select("o_orderkey", "o_orderpriority")
    return clean.filter_not_null(o, "o_orderpriority")


def _status_text(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit("None"))
        .when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus"))
        .alias("status_text"),
    )


def q_filter_sentinel(spark, sf):
    return clean.filter_not_sentinel(_status_text(spark, sf), "status_text", "None")


def q_drop_columns(spark, sf):
    return clean.drop_columns(_t(spark, sf, "part"), "p_name", "p_brand", "Latitude")


def q_rename_columns(spark, sf):
    p = _t(spark, sf, "part").select(
        F.col("p_partkey").alias("part key"),
        F.col("p_name").alias("part name"),
        F.col("p_type").alias("part type"),
        F.col("p_size").alias("size-class"),
        F.col("p_retailprice").alias("Retail Price"),
    )
    return clean.rename_columns(p)


def q_drop_low_completeness(spark, sf):
    # status ~67 % complete (dropped); priority ~93 % complete (kept): both
    # far from the 80 % threshold at every scale factor
    o = _orders_dated(spark, sf)
    gaps = o.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))).withColumn(
        "o_orderpriority",
        F.when(
            (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"), F.lit(None)
        ).otherwise(F.col("o_orderpriority")),
    )
    return clean.drop_low_completeness(gaps, threshold=80.0)


_LINE_KEYS = ["l_orderkey", "l_linenumber"]


def q_dedup_by_key(spark, sf):
    out = clean.dedup_by_key(_t(spark, sf, "lineitem"), _LINE_KEYS)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def q_dedup_report(spark, sf):
    return clean.duplicate_report(_t(spark, sf, "lineitem", *_LINE_KEYS), _LINE_KEYS)


def _events_text(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        F.when(F.col("value") < 5, F.lit("None"))
        .when(F.col("value") < 6, F.lit(None).cast("string"))
        .otherwise(F.col("value").cast("string"))
        .alias("value_text"),
    )


def q_clean_temperature(spark, sf):
    kept = clean.chain_filters(
        _events_text(spark, sf),
        F.col("event_type") == "click",
        F.col("value_text") != "None",
    )
    return kept.select(
        tolerant_cast("event_id", "bigint").alias("event_id"),
        "event_type",
        parse_date("dt").alias("event_date"),
        tolerant_cast("value_text", "double").alias("value"),
    )


def q_clean_airport(spark, sf):
    p = _t(spark, sf, "part").withColumn("p_type", F.nullif("p_type", F.lit("ECONOMY")))
    p = clean.drop_columns(p, "p_brand")
    return clean.filter_not_null(clean.dedup_by_key(p, ["p_name"]), "p_type")


# ---- code lookups ----------------------------------------------------------

def q_code_lookup(spark, sf):
    return lookup.decode(_customer_codes(spark, sf), "c_nationkey", _nation_codes(spark, sf), "nation_name")


def q_code_lookup_typed(spark, sf):
    c = _customer_codes(spark, sf).select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("nation_code")
    )
    # Codes as text, the way a parsed label file delivers them, plus a code
    # that is not a number at all (must match nothing, and must not fail).
    codes = _nation_codes(spark, sf).select(F.col("code").cast("string").alias("code"), "label")
    codes = codes.unionByName(inline_code_list(spark, {"XX": "not a number"}))
    return lookup.decode(c, "nation_code", codes, "nation_name")


def q_code_lookup_default(spark, sf):
    return lookup.decode(_customer_codes(spark, sf), "c_nationkey", _nation_codes(spark, sf), "nation_name", default="Other")


def q_role_playing_lookup(spark, sf):
    li = _lines_with_orphans(spark, sf)
    sup = lookup.bounded_broadcast(_t(spark, sf, "supplier", "s_suppkey", "s_nationkey"))
    # lines are reduced to (order, supplier) before they meet the suppliers (on the map side while those
    # fit a checked broadcast) and to (order, nation) before the big join; lines of unknown keys stay
    per = li.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("_c"))
    ls = (
        per.join(sup, per["l_suppkey"] == sup["s_suppkey"], "left")
        .groupBy("l_orderkey", "s_nationkey")
        .agg(F.sum("_c").alias("_n"))
    )
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "left").select("o_orderkey", "c_nationkey")
    pairs = (
        ls.join(oc, ls["l_orderkey"] == oc["o_orderkey"], "left")
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("_n").alias("n_lines"))
    )
    decoded = lookup.decode_roles(
        pairs,
        _nation_codes(spark, sf),
        {"customer_nation": "c_nationkey", "supplier_nation": "s_nationkey"},
    )
    return decoded.select("customer_nation", "supplier_nation", "n_lines")


# ---- conform ---------------------------------------------------------------

def q_sas_date(spark, sf):
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderdate")
    n = o.select("o_orderkey", date_to_day_number("o_orderdate").cast("double").alias("day_number"))
    return n.withColumn("order_date", day_number_to_date("day_number"))


def q_parse_date(spark, sf):
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    txt = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date_text"),
    )
    return txt.withColumn("parsed_date", parse_date("date_text"))


def _part_price_text(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part", "p_partkey", "p_size", "p_retailprice")
    return p.select(
        "p_partkey",
        F.when(F.col("p_size") < 5, F.lit("n/a"))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("price_text"),
    )


def q_tolerant_cast(spark, sf):
    p = _part_price_text(spark, sf)
    return p.select(
        "p_partkey",
        tolerant_cast("price_text", "int").alias("price_int"),
        tolerant_cast("price_text", "double").alias("price_double"),
    )


def q_cast_losses(spark, sf):
    return cast_loss_report(_part_price_text(spark, sf), {"price_text": "int"})


def q_conform_fact(spark, sf):
    li = _lines_with_orphans(spark, sf, "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    # suppliers first, on the map side while they fit a checked broadcast; then one shuffle on the order
    sup = lookup.bounded_broadcast(_t(spark, sf, "supplier", "s_suppkey", "s_nationkey"))
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"], "left").drop("o_custkey", "c_custkey")
    fact = (
        li.join(sup, li["l_suppkey"] == sup["s_suppkey"], "left")
        .join(oc, F.col("l_orderkey") == oc["o_orderkey"], "left")
    )
    nations = _nation_codes(spark, sf)
    d = lookup.decode_roles(fact, nations, {"customer_nation": "c_nationkey", "supplier_nation": "s_nationkey"})
    for col, codes, out in (
        ("o_orderstatus", ORDER_STATUS, "order_status"),
        ("l_returnflag", RETURN_FLAG, "return_status"),
        ("l_linestatus", LINE_STATUS, "line_status"),
    ):
        d = lookup.decode(d, col, inline_code_list(spark, codes), out, known_rows=len(codes), unique=True)
    return d.select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        "customer_nation",
        "supplier_nation",
        tolerant_cast("l_quantity", "int", fact.schema["l_quantity"].dataType).alias("quantity"),
        "order_status",
        "return_status",
        "line_status",
    )


def q_conform_measure(spark, sf):
    e = _events_text(spark, sf)
    typed = e.select(
        tolerant_cast("event_id", "bigint").alias("event_id"),
        tolerant_cast("user_id", "bigint").alias("user_id"),
        "event_type",
        parse_date("dt").alias("event_date"),
        tolerant_cast("value_text", "double").alias("value"),
    )
    return dense_key(typed, ["event_id"])


def q_conform_dimension(spark, sf):
    p = _t(spark, sf, "part")
    text = p.select(*[F.col(c).cast("string").alias(c) for c in p.columns])
    return text.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        tolerant_cast("p_size", "int").alias("size"),
        tolerant_cast("p_retailprice", "double").alias("retail_price"),
    )


def q_conform_dimension_wide(spark, sf):
    s = _t(spark, sf, "supplier")
    text = s.select(*[F.col(c).cast("string").alias(c) for c in s.columns])
    typed = text.select(
        tolerant_cast("s_suppkey", "bigint").alias("s_suppkey"),
        F.col("s_name").alias("name"),
        tolerant_cast("s_nationkey", "int").alias("nation"),
        tolerant_cast("s_acctbal", "double").alias("acctbal"),
        tolerant_cast("s_acctbal", "int").alias("acctbal_whole"),
    )
    return dense_key(typed, ["s_suppkey"])


# ---- time dimension and keys ---------------------------------------------------

def _fact_dates(spark, sf) -> DataFrame:
    return distinct_dates(
        [
            (_t(spark, sf, "orders", "o_orderdate"), "o_orderdate"),
            (_t(spark, sf, "lineitem", "l_shipdate"), "l_shipdate"),
        ]
    )


def q_time_union(spark, sf):
    return _fact_dates(spark, sf)


def q_time_dimension(spark, sf):
    return time_dimension(_fact_dates(spark, sf))


def q_time_join(spark, sf):
    # Fact joined to the time dimension, which is replicated to every task
    # (broadcast) once its row count is known to be small: dates are bounded
    # by the calendar, not by the data volume.  The dimension is materialized
    # once, so the size check and the broadcast read the small checkpoint
    # instead of scanning the facts' dates twice.
    dim = lookup.bounded_broadcast(cut_lineage(time_dimension(_fact_dates(spark, sf))))
    li = _t(spark, sf, "lineitem", "l_linenumber", "l_shipdate", "l_quantity").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_shipdate").cast("date")).alias("ship_date"), "l_quantity"
    )
    # lines without a date stay, as one group without a week
    j = li.join(dim, li["ship_date"] == dim["time"], "left")
    return j.groupBy("year", "week_of_year").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 6).alias("sum_qty")
    )


def q_surrogate_key(spark, sf):
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey")
    return dense_key(o, ["o_custkey", "o_orderkey"])


# ---- contract, load, quality ------------------------------------------------

PART = contract.Contract(
    "part",
    (
        contract.Col("p_partkey", "bigint", False),
        contract.Col("p_name", "string"),
        contract.Col("p_type", "string"),
        contract.Col("p_size", "int"),
        contract.Col("p_retailprice", "double"),
    ),
    primary_key=("p_partkey",),
)

ORDERS = contract.Contract(
    "orders",
    (
        contract.Col("o_orderkey", "bigint", False),
        contract.Col("o_custkey", "bigint", False),
        contract.Col("o_orderstatus", "string", max_length=1),
        contract.Col("o_totalprice", "double"),
        contract.Col("o_orderdate", "date", False),
        contract.Col("o_orderpriority", "string"),
    ),
    primary_key=("o_orderkey",),
)

ORDER_LINES = contract.Contract(
    "order_lines",
    (
        contract.Col("o_orderkey", "bigint", False),
        contract.Col("o_orderpriority", "string", max_length=8),
        contract.Col("ship_date", "date", False),
    ),
)


def q_write_roundtrip(spark, sf):
    path = scratch_path(spark, "part_roundtrip")
    warehouse.write_counted(_t(spark, sf, "part"), path)
    return spark.read.parquet(path)


def q_write_sample(spark, sf):
    path = scratch_path(spark, "orders_sample")
    warehouse.write_counted(_orders_dated(spark, sf), path, sample_rows=5, sample_order=["o_orderkey"])
    return spark.read.parquet(path)


def q_load_table(spark, sf):
    # Source columns in another order, one extra column, size stored as text.
    src = _t(spark, sf, "part").select(
        "p_retailprice", F.col("p_size").cast("string").alias("p_size"), "p_brand", "p_type", "p_name", "p_partkey"
    )
    src_path = scratch_path(spark, "part_src")
    src.write.parquet(src_path)
    return warehouse.load_table(spark, src_path, PART, target_path=scratch_path(spark, "part_loaded"))


def q_apply_contract(spark, sf):
    o = _t(spark, sf, "orders")
    shuffled = o.select(*[F.col(c).alias(c.upper()) for c in reversed(o.columns)])
    return contract.apply_contract(shuffled, ORDERS)


def _order_lines(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    li = _t(spark, sf, "lineitem", "l_orderkey", "l_shipdate")
    j = left_join_skew_safe(o, li, [("o_orderkey", "l_orderkey")])
    return contract.apply_contract(j.withColumnRenamed("l_shipdate", "ship_date"), ORDER_LINES)


def q_contract_rejects(spark, sf):
    _, rejects = contract.enforce_contract(_order_lines(spark, sf), ORDER_LINES)
    return contract.reject_summary(rejects)


def q_contract_split(spark, sf):
    # both counts from one pass, on the plain boolean that enforce_contract splits by
    broken = contract.is_violated(ORDER_LINES)
    return _order_lines(spark, sf).agg(F.count_if(~broken).alias("valid_rows"), F.count_if(broken).alias("rejected_rows"))


LINES = contract.Contract(
    "lines",
    (
        contract.Col("l_orderkey", "bigint", False),
        contract.Col("l_linenumber", "int", False),
        contract.Col("l_quantity", "double"),
    ),
    primary_key=("l_orderkey", "l_linenumber"),
)


def q_contract_key_rejects(spark, sf):
    li = contract.apply_contract(_t(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity"), LINES)
    _, rejects = contract.enforce_contract(li, LINES, check_key=True)
    return contract.reject_summary(rejects)


def q_key_uniqueness(spark, sf):
    return contract.key_violations(_t(spark, sf, "lineitem", *_LINE_KEYS), _LINE_KEYS)


def q_bucketed_join(spark, sf):
    tag = _tag()
    lines = _t(spark, sf, "lineitem", "l_orderkey", "l_quantity")
    buckets = warehouse.choose_buckets(lines)  # sized on the larger table
    warehouse.save_bucketed(
        _t(spark, sf, "orders", "o_orderkey", "o_orderstatus"), f"orders_b_{tag}", ["o_orderkey"], buckets,
        path=scratch_path(spark, "orders_bucketed"),
    )
    warehouse.save_bucketed(
        lines, f"lineitem_b_{tag}", ["l_orderkey"], buckets, path=scratch_path(spark, "lineitem_bucketed")
    )
    o, li = spark.table(f"orders_b_{tag}"), spark.table(f"lineitem_b_{tag}")
    # Aggregate lines per order inside each bucket first (no exchange: the
    # table is already bucketed by the key), so a hot order key is one row
    # before the join; bucketed scans cannot be split by skew handling.
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("l_quantity").alias("_q")
    )
    j = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"])
    # a row per status: kept in the shared folder, so the tables can go from the catalog now
    out = cut_lineage(j.groupBy("o_orderstatus").agg(
        F.sum("_n").alias("n_lines"), F.round(F.sum("_q"), 6).alias("sum_qty")
    ))
    warehouse.drop_tables(spark, [f"orders_b_{tag}", f"lineitem_b_{tag}"])
    return out


def q_catalog_load(spark, sf):
    tag = _tag()
    prefix = f"wh_{tag}_"
    warehouse.drop_tables(spark, [f"{prefix}orders", f"{prefix}part", f"{prefix}staging"])
    base = scratch_path(spark, "catalog")
    tables = warehouse.create_tables(spark, [ORDERS, PART], base, prefix)
    # source columns reordered and renamed in case: loaded by name, not position
    o = _t(spark, sf, "orders")
    warehouse.insert_by_name(o.select(*[F.col(c).alias(c.upper()) for c in reversed(o.columns)]), ORDERS,
                             tables["orders"])
    # the tables are external: their files stay when the catalog entries go
    schema = spark.table(tables["orders"]).schema
    warehouse.drop_tables(spark, list(tables.values()))
    return spark.read.schema(schema).parquet(f"{base}/orders")


def q_code_lookup_sql(spark, sf):
    # The same left lookup written as SQL over named relations.
    tag = _tag()
    cust, codes = f"customer_{tag}", f"nation_codes_{tag}"
    _customer_codes(spark, sf).createOrReplaceTempView(cust)
    # the view carries the broadcast hint only if the list is within the checked bound
    lookup.bounded_broadcast(_nation_codes(spark, sf)).createOrReplaceTempView(codes)
    out = spark.sql(
        f"""
        SELECT c.c_custkey, c.c_nationkey, n.label AS nation_name
        FROM {cust} c LEFT JOIN {codes} n ON c.c_nationkey = n.code
        """
    )
    for view in (cust, codes):
        spark.catalog.dropTempView(view)
    return out


_FIVE = ("part", "supplier", "customer", "orders", "lineitem")


def _write_five(spark, sf) -> DataFrame:
    base = scratch_path(spark, "warehouse")
    return warehouse.write_tables(spark, {n: _t(spark, sf, n) for n in _FIVE}, base)


def q_quality_row_counts(spark, sf):
    report = _write_five(spark, sf)
    rows = report.collect()  # one row per table
    expected = quality.counts_frame(spark, {r.table_name: r.rows for r in rows}, "expected")
    actual = warehouse.read_counts(spark, {r.table_name: r.path for r in rows})
    return quality.row_count_check(expected, actual)


def q_load_report(spark, sf):
    # the wall time itself stays in the report; here only that there is one
    return _write_five(spark, sf).select("table_name", "rows", (F.col("seconds") >= 0).alias("timed"))


def q_quality_completeness(spark, sf):
    audit = quality.completeness_audit(
        {
            "orders": (_orders_with_gaps(spark, sf), ("o_orderdate", "o_orderstatus", "o_orderpriority")),
            "lineitem": (_t(spark, sf, "lineitem"), ("l_shipdate", "l_returnflag")),
            "customer": (_t(spark, sf, "customer"), ("c_name", "c_nationkey")),
            "supplier": (_t(spark, sf, "supplier"), ("s_name",)),
            "part": (
                _t(spark, sf, "part").withColumn("p_type", F.nullif("p_type", F.lit("PROMO"))),
                ("p_name", "p_type"),
            ),
        }
    )
    return audit.withColumn("pct", F.round("pct", 6))


# ---- marts -----------------------------------------------------------------

def _orders_with_unknown_customers(spark, sf) -> DataFrame:
    """All orders; every tenth customer's name no customer."""
    return _t(spark, sf, "orders", "o_custkey", "o_orderdate").withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")))


def q_arrivals_by_place(spark, sf):
    o = _orders_with_unknown_customers(spark, sf)
    # orders per (customer, month) first: a hot customer shrinks before the join
    per_cust = marts.by_month_and_place(o, "o_orderdate", "o_custkey", [F.count(F.lit(1)).alias("_n")], place_name="o_custkey")
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    by_nation = (
        per_cust.join(c, per_cust["o_custkey"] == c["c_custkey"], "left")
        .groupBy("year", "month", "c_nationkey")
        .agg(F.sum("_n").alias("n_orders"))
    )
    named = lookup.decode(by_nation, "c_nationkey", _nation_codes(spark, sf), "nation")
    return named.select("year", "month", "nation", "n_orders")


def q_drill_across(spark, sf):
    nations = _nation_codes(spark, sf)
    # orders of unknown customers and lines of unknown suppliers meet in one row without a place
    o = _orders_with_unknown_customers(spark, sf)
    c = _t(spark, sf, "customer", "c_custkey", "c_nationkey")
    per_cust = o.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("_n"))
    left = (
        per_cust.join(c, per_cust["o_custkey"] == c["c_custkey"], "left")
        .groupBy("year", "month", "c_nationkey")
        .agg(F.sum("_n").alias("n_orders"))
    )
    left = lookup.decode(left, "c_nationkey", nations, "nation").drop("c_nationkey")
    li = _lines_with_orphans(spark, sf, "l_shipdate", "l_quantity")
    s = _t(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    per_supp = li.groupBy(
        "l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    ).agg(F.sum("l_quantity").alias("_q"), F.count(F.lit(1)).alias("_c"))
    right = (
        per_supp.join(s, per_supp["l_suppkey"] == s["s_suppkey"], "left")
        .groupBy("year", "month", "s_nationkey")
        .agg((F.sum("_q") / F.sum("_c")).alias("avg_quantity"))
    )
    right = lookup.decode(right, "s_nationkey", nations, "nation").drop("s_nationkey")
    out = marts.drill_across(left, right, ["year", "month", "nation"])
    return out.select("year", "month", "nation", "n_orders", F.round("avg_quantity", 6).alias("avg_quantity"))


def q_partition_pruned_read(spark, sf):
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = scratch_path(spark, "orders_by_year")
    warehouse.write_partitioned(
        o.withColumn("order_year", F.year("o_orderdate")).drop("o_orderdate"), path, ["order_year"]
    )
    return warehouse.read_partitions(spark, path, F.col("order_year") >= 1998)


def _orders_slim(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def q_incremental_append(spark, sf):
    o = _orders_slim(spark, sf)
    target = scratch_path(spark, "orders_target")
    refresh_once(spark, o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date")), target, ["o_orderkey"])
    refresh_once(spark, o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")), target, ["o_orderkey"])
    return spark.read.parquet(target)


def q_incremental_stream(spark, sf):
    o = _orders_slim(spark, sf)
    drops = scratch_path(spark, "orders_drops")
    o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date")).write.parquet(f"{drops}/day=1")
    o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")).write.parquet(f"{drops}/day=2")
    target = scratch_path(spark, "orders_stream_target")
    q = start_refresh(
        spark, f"{drops}/*", o.schema, target, ["o_orderkey"], scratch_path(spark, "orders_stream_ckpt")
    )
    q.awaitTermination()
    return spark.read.parquet(target)


QUERIES: dict[str, Query] = {
    "scan_counts": q_scan_counts,
    "scan_csv": q_scan_csv,
    "scan_csv_semicolon": q_scan_csv_semicolon,
    "codelist_parse": q_codelist_parse,
    "codelist_inline": q_codelist_inline,
    "profile_completeness": q_profile_completeness,
    "profile_schema": q_profile_schema,
    "group_count": q_group_count,
    "column_mismatch_count": q_column_mismatch_count,
    "preview_top_n": q_preview_top_n,
    "filter_equals": q_filter_equals,
    "filter_not_null": q_filter_not_null,
    "filter_sentinel": q_filter_sentinel,
    "drop_columns": q_drop_columns,
    "rename_columns": q_rename_columns,
    "drop_low_completeness": q_drop_low_completeness,
    "dedup_by_key": q_dedup_by_key,
    "dedup_report": q_dedup_report,
    "clean_temperature": q_clean_temperature,
    "clean_airport": q_clean_airport,
    "code_lookup": q_code_lookup,
    "code_lookup_typed": q_code_lookup_typed,
    "code_lookup_default": q_code_lookup_default,
    "role_playing_lookup": q_role_playing_lookup,
    "sas_date": q_sas_date,
    "parse_date": q_parse_date,
    "tolerant_cast": q_tolerant_cast,
    "cast_losses": q_cast_losses,
    "conform_fact": q_conform_fact,
    "conform_measure": q_conform_measure,
    "conform_dimension": q_conform_dimension,
    "conform_dimension_wide": q_conform_dimension_wide,
    "time_union": q_time_union,
    "time_dimension": q_time_dimension,
    "time_join": q_time_join,
    "surrogate_key": q_surrogate_key,
    "write_roundtrip": q_write_roundtrip,
    "write_sample": q_write_sample,
    "load_table": q_load_table,
    "apply_contract": q_apply_contract,
    "catalog_load": q_catalog_load,
    "code_lookup_sql": q_code_lookup_sql,
    "contract_rejects": q_contract_rejects,
    "contract_split": q_contract_split,
    "contract_key_rejects": q_contract_key_rejects,
    "key_uniqueness": q_key_uniqueness,
    "bucketed_join": q_bucketed_join,
    "quality_row_counts": q_quality_row_counts,
    "quality_completeness": q_quality_completeness,
    "load_report": q_load_report,
    "arrivals_by_place": q_arrivals_by_place,
    "drill_across": q_drill_across,
    "partition_pruned_read": q_partition_pruned_read,
    "incremental_append": q_incremental_append,
    "incremental_stream": q_incremental_stream,
    **STAR_QUERIES,
    **LOAD_QUERIES,
}
