"""The named star steps over raw-shaped frames derived from the whole test tables.

Orders stand in for immigration records, events for temperatures, customers for
demographics and parts for airports; the label file is rendered from nation and
region.  Codes, dates and texts are shaped so that every rule meets rows that
break it: unmatched codes, repeated and merging ids, missing dates, junk
numbers, long CHAR values, several airports of one code, airports without place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.dates import date_to_day_number
from stellate.plans import star
from stellate.session import scratch_path
from stellate.sources.codelists import inline_code_list, parse_code_lists, render_code_list
from stellate.sources.tables import read_table


def raw_immigration(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    day = date_to_day_number("o_orderdate").cast("double")
    text = F.lit("x")
    raw = o.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.pmod("o_custkey", F.lit(30)).cast("double").alias("i94cit"),
        F.pmod("o_orderkey", F.lit(27)).cast("double").alias("i94res"),
        F.concat(F.lit("P"), F.pmod("o_custkey", F.lit(40)).cast("string")).alias("i94port"),
        day.alias("arrdate"),
        F.pmod("o_orderkey", F.lit(5)).cast("double").alias("i94mode"),
        F.substring("o_orderpriority", 1, 1).alias("i94addr"),
        F.when(F.col("o_orderstatus") != "P", day + 7).alias("depdate"),
        F.pmod("o_custkey", F.lit(90)).cast("double").alias("i94bir"),
        F.pmod("o_orderkey", F.lit(4)).cast("double").alias("i94visa"),
        (F.pmod("o_custkey", F.lit(80)) + 1930).cast("double").alias("biryear"),
        F.when(F.col("o_custkey") % 97 == 0, "XX").when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("o_orderstatus").alias("visatype"),
        *[text.alias(c) for c in star.IMMIGRATION_DROP],
    )
    again = raw.where("cicid % 10 = 0")  # repeated records
    merging = raw.where("cicid % 11 = 0").withColumn("cicid", F.col("cicid") + 0.5)  # another id, one integer
    return raw.unionByName(again).unionByName(merging)


def raw_temperature(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(
        F.when(F.col("event_id") % 50 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("dt"),
        F.when(F.col("value") < 5, F.lit("None")).when(F.col("value") < 6, F.lit(None).cast("string"))
        .when(F.col("value") < 7, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("AverageTemperature"),
        F.col("user_id").cast("string").alias("AverageTemperatureUncertainty"),
        F.concat(F.lit("city_"), (F.col("user_id") % 50).cast("string")).alias("City"),
        F.when(F.col("event_type") == "click", "United States").otherwise(F.col("event_type")).alias("Country"),
        F.lit("1N").alias("Latitude"),
        F.lit("1W").alias("Longitude"),
    )


def raw_demographics(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("city_"), (key % 50).cast("string")).alias("City"),
        F.col("c_mktsegment").alias("State"),
        F.col("c_acctbal").cast("string").alias("Median Age"),
        key.cast("string").alias("Male Population"),
        (key + 1).cast("string").alias("Female Population"),
        (key * 2 + 1).cast("string").alias("Total Population"),
        F.when(F.col("c_nationkey") < 3, "n/a").otherwise(key.cast("string")).alias("Number of Veterans"),
        (key + 3).cast("string").alias("Foreign-born"),
        F.lit("2.5").alias("Average Household Size"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("State Code"),
        F.col("c_mktsegment").alias("Race"),
        key.cast("string").alias("Count"),
    )


def raw_airport(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    key = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("A"), key.cast("string")).alias("ident"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 5, "n/a").otherwise(F.col("p_size").cast("string")).alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.col("p_brand").alias("iso_country"),
        F.concat(F.lit("US-S"), (key % 25).cast("string")).alias("iso_region"),
        F.when(key % 7 != 0, F.concat(F.lit("city_"), (key % 50).cast("string"))).alias("municipality"),
        F.lit("g").alias("gps_code"),
        F.when(key % 9 != 0, F.concat(F.lit("P"), (key % 60).cast("string"))).alias("iata_code"),
        F.lit("l").alias("local_code"),
        F.lit("1, 1").alias("coordinates"),
    )


def label_file(spark: SparkSession, sf: str) -> str:
    """A label file rendered from nation and region; country labels hold every character the format must quote."""
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    region = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    country = nation.select(F.lit(star.COUNTRY_LIST).alias("list_name"), F.col("n_nationkey").cast("string").alias("code"),
                            F.concat("n_name", F.lit("; it's /* one */ 'land'")).alias("label"))
    state = region.select(F.lit(star.STATE_LIST).alias("list_name"), (F.col("r_regionkey") + 1).cast("string").alias("code"), F.col("r_name").alias("label"))
    port = nation.select(F.lit(star.PORT_LIST).alias("list_name"), F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("label"))
    mode = inline_code_list(spark, {"1": "Air", "2": "Sea", "3": "Land", "03": "Land route"}).select(F.lit(star.MODE_LIST).alias("list_name"), "code", "label")
    path = scratch_path(spark, "labels")
    rows = reduce(DataFrame.unionByName, [country, state, port, mode])
    render_code_list(rows, "list_name", "code", "label").write.option("maxRecordsPerFile", 100).text(path)
    return path


def _immigration(spark: SparkSession, sf: str, port_names: bool = False) -> DataFrame:
    lookups = star.immigration_lookups(spark, parse_code_lists(spark, label_file(spark, sf)))
    return star.conform_immigration(star.clean_immigration(raw_immigration(spark, sf)), lookups, port_names=port_names)


def q_star_immigration(spark, sf):
    return _immigration(spark, sf)


def q_star_port_names(spark, sf):
    return _immigration(spark, sf, port_names=True).groupBy("port", "port_name").agg(F.count(F.lit(1)).alias("n"))


def q_star_temperature(spark, sf):
    return star.conform_temperature(star.clean_temperature(raw_temperature(spark, sf)))


def q_star_demographics(spark, sf):
    return star.conform_demographics(star.clean_demographics(raw_demographics(spark, sf)))


def q_star_airport(spark, sf):
    return star.conform_airport(star.clean_airport(raw_airport(spark, sf)))


def q_star_time(spark, sf):
    return star.build_time(_immigration(spark, sf), star.conform_temperature(star.clean_temperature(raw_temperature(spark, sf)), with_id=False))


def q_star_arrivals_by_city(spark, sf):
    return star.arrivals_by_city(
        _immigration(spark, sf), q_star_airport(spark, sf),
        star.conform_demographics(star.clean_demographics(raw_demographics(spark, sf)), with_id=False))


def q_star_warehouse(spark, sf):
    """Every report of ``build_warehouse`` as (report, table_name, item, value)."""
    out = star.build_warehouse(spark, raw_immigration(spark, sf), raw_temperature(spark, sf), raw_demographics(spark, sf),
                               raw_airport(spark, sf), label_file(spark, sf), scratch_path(spark, "star"))
    shape = {
        "sources": (F.lit("rows"), F.col("row_count")), "load": (F.lit("rows"), F.col("rows")), "row_counts": (F.lit("missing"), F.col("missing")),
        "rejects": (F.col("reason"), F.col("n_rows")), "duplicates": (F.lit("duplicate_rows"), F.col("duplicate_rows")),
        "cast_losses": (F.col("column_name"), F.col("lost")), "merged_codes": (F.col("code").cast("string"), F.col("labels")), "completeness": (F.col("column_name"), F.round("pct", 6)),
    }
    out["merged_codes"] = out["merged_codes"].withColumnRenamed("list_name", "table_name")
    parts = [out[k].select(F.lit(k).alias("report"), "table_name", item.alias("item"), value.cast("double").alias("value")) for k, (item, value) in shape.items()]
    return reduce(DataFrame.unionByName, parts)


STAR_QUERIES = {
    "star_immigration": q_star_immigration,
    "star_port_names": q_star_port_names,
    "star_temperature": q_star_temperature,
    "star_demographics": q_star_demographics,
    "star_airport": q_star_airport,
    "star_time": q_star_time,
    "star_arrivals_by_city": q_star_arrivals_by_city,
    "star_warehouse": q_star_warehouse,
}

_IMMIGRATION = """
    raw AS (
      SELECT o.*, CAST(o_orderkey AS DOUBLE) AS cicid FROM orders o
      UNION ALL SELECT o.*, CAST(o_orderkey AS DOUBLE) + 0.5 FROM orders o WHERE o_orderkey % 11 = 0),
    immigration AS (
      SELECT CAST(trunc(cicid) AS BIGINT) AS id, CAST(o_orderdate AS DATE) AS arrival_date,
             CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 7 END AS departure_date,
             b.n_name || '; it''s /* one */ ''land''' AS birth_country, r.n_name || '; it''s /* one */ ''land''' AS residence_country,
             'P' || (o_custkey % 40) AS port, CAST(o_custkey % 90 AS INTEGER) AS age, CAST(o_custkey % 80 + 1930 AS INTEGER) AS birth_year,
             CASE o_orderkey % 4 WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa,
             CASE WHEN o_custkey % 97 = 0 THEN 'XX' WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
             CASE o_orderkey % 5 WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land route' END AS mode,
             s.r_name AS state, o_orderstatus AS type
      FROM raw LEFT JOIN nation b ON o_custkey % 30 = b.n_nationkey LEFT JOIN nation r ON o_orderkey % 27 = r.n_nationkey
      LEFT JOIN region s ON substr(o_orderpriority, 1, 1) = CAST(s.r_regionkey + 1 AS VARCHAR))
"""
_TEMPERATURE = """
    temperature AS (
      SELECT 'United States' AS country, 'city_' || (user_id % 50) AS city,
             CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS date,
             CASE WHEN value >= 7 THEN value END AS average_temp, CAST(user_id AS DOUBLE) AS uncertanty
      FROM events WHERE event_type = 'click' AND value >= 6)
"""
_DEMOGRAPHICS = """
    demographics AS (
      SELECT c_acctbal AS median_age, CAST(c_custkey AS INTEGER) AS male_population, CAST(c_custkey + 1 AS INTEGER) AS female_population,
             CAST(c_custkey * 2 + 1 AS INTEGER) AS total_population, CAST(CASE WHEN c_nationkey >= 3 THEN c_custkey END AS INTEGER) AS number_veterans,
             CAST(c_custkey + 3 AS INTEGER) AS foreign_born, CAST(2.5 AS DOUBLE) AS average_household, 'S' || c_nationkey AS state_code,
             c_mktsegment AS race, CAST(c_custkey AS INTEGER) AS count, c_mktsegment AS state, 'city_' || (c_custkey % 50) AS city
      FROM customer)
"""
_AIRPORT = """
    airport AS (
      SELECT 'A' || p_partkey AS id, p_type AS type, p_name AS name, CAST(CASE WHEN p_size >= 5 THEN p_size END AS INTEGER) AS elevation,
             'NA' AS continent, p_brand AS country, 'US-S' || (p_partkey % 25) AS region,
             CASE WHEN p_partkey % 7 <> 0 THEN 'city_' || (p_partkey % 50) END AS municipality, 'P' || (p_partkey % 60) AS iata_code
      FROM part WHERE p_partkey % 9 <> 0)
"""
_TIMES = 'SELECT arrival_date AS "time" FROM {i} UNION SELECT departure_date FROM {i} UNION SELECT date FROM {t}'
_BAD = """
    flagged AS (SELECT *, count(*) OVER (PARTITION BY id) > 1 AS dup FROM immigration),
    ok AS (SELECT * FROM flagged WHERE NOT dup AND departure_date IS NOT NULL AND birth_country IS NOT NULL
                                   AND residence_country IS NOT NULL AND length(gender) <= 1),
    warm AS (SELECT * FROM temperature WHERE date IS NOT NULL)
"""


def _pct(table: str, source: str, *columns: str) -> list[str]:
    return [f"SELECT 'completeness', '{table}', '{c}', round(count({c}) * 100.0 / count(*), 6) FROM {source}" for c in columns]


STAR_SQL = {
    "star_immigration": f"WITH {_IMMIGRATION} SELECT * FROM immigration",
    "star_port_names": f"""
        WITH {_IMMIGRATION} SELECT port, n_name AS port_name, count(*) AS n
        FROM immigration LEFT JOIN nation ON port = 'P' || n_nationkey GROUP BY 1, 2
    """,
    "star_temperature": f"""
        WITH {_TEMPERATURE} SELECT row_number() OVER (ORDER BY country, city, date NULLS FIRST, average_temp NULLS FIRST, uncertanty) - 1 AS id, *
        FROM temperature
    """,
    "star_demographics": f"WITH {_DEMOGRAPHICS} SELECT row_number() OVER (ORDER BY state_code, city, race, count) - 1 AS id, * FROM demographics",
    "star_airport": f"WITH {_AIRPORT} SELECT * FROM airport",
    "star_time": f"""
        WITH {_IMMIGRATION}, {_TEMPERATURE}, t AS ({_TIMES.format(i="immigration", t="temperature")})
        SELECT "time", CAST(year("time") AS INTEGER) AS year, CAST(month("time") AS INTEGER) AS month,
               CAST(dayofweek("time") + 1 AS INTEGER) AS day_of_week, CAST(isodow("time") - 1 AS INTEGER) AS weekday,
               CAST(dayofmonth("time") AS INTEGER) AS day_of_month, CAST(dayofyear("time") AS INTEGER) AS day_of_year,
               CAST(weekofyear("time") AS INTEGER) AS week_of_year
        FROM t WHERE "time" IS NOT NULL
    """,
    "star_arrivals_by_city": f"""
        WITH {_IMMIGRATION}, {_AIRPORT}, {_DEMOGRAPHICS},
        p AS (SELECT iata_code, municipality, substr(region, 4) AS state_code,
                     row_number() OVER (PARTITION BY iata_code ORDER BY municipality IS NULL, municipality, substr(region, 4), id) AS n FROM airport),
        c AS (SELECT city, state_code, max(total_population) AS total_population FROM demographics GROUP BY 1, 2),
        m AS (SELECT CAST(year(arrival_date) AS INTEGER) AS year, CAST(month(arrival_date) AS INTEGER) AS month, port, count(*) AS arrivals
              FROM immigration GROUP BY 1, 2, 3)
        SELECT m.year, m.month, m.port, c.city, c.state_code, m.arrivals, c.total_population
        FROM m LEFT JOIN p ON m.port = p.iata_code AND p.n = 1
        LEFT JOIN c ON p.municipality = c.city AND p.state_code = c.state_code
    """,
    "star_warehouse": f"""
        WITH {_IMMIGRATION}, {_TEMPERATURE}, {_DEMOGRAPHICS}, {_AIRPORT}, {_BAD},
        t AS (SELECT * FROM ({_TIMES.format(i="ok", t="warm")}) WHERE "time" IS NOT NULL),
        n(table_name, source_rows, loaded) AS (
          SELECT 'immigration', (SELECT count(*) + count(*) FILTER (o_orderkey % 10 = 0) + count(*) FILTER (o_orderkey % 11 = 0) FROM orders),
                 (SELECT count(*) FROM ok)
          UNION ALL SELECT 'temperature', (SELECT count(*) FROM events), (SELECT count(*) FROM warm)
          UNION ALL SELECT 'demographics', (SELECT count(*) FROM customer), (SELECT count(*) FROM demographics)
          UNION ALL SELECT 'airport', (SELECT count(*) FROM part), (SELECT count(*) FROM airport)
          UNION ALL SELECT 'time', NULL, (SELECT count(*) FROM t)),
        r(report, table_name, item, value) AS (
          SELECT 'sources', table_name, 'rows', source_rows FROM n WHERE source_rows IS NOT NULL
          UNION ALL SELECT 'load', table_name, 'rows', loaded FROM n
          UNION ALL SELECT 'row_counts', table_name, 'missing', 0 FROM n
          UNION ALL SELECT * FROM (
            SELECT 'rejects', 'immigration', 'id duplicated', count(*) AS v FROM flagged WHERE dup
            UNION ALL SELECT 'rejects', 'immigration', 'departure_date is null', count(*) FROM flagged WHERE departure_date IS NULL
            UNION ALL SELECT 'rejects', 'immigration', 'birth_country is null', count(*) FROM flagged WHERE birth_country IS NULL
            UNION ALL SELECT 'rejects', 'immigration', 'residence_country is null', count(*) FROM flagged WHERE residence_country IS NULL
            UNION ALL SELECT 'rejects', 'immigration', 'gender longer than 1', count(*) FROM flagged WHERE length(gender) > 1
            UNION ALL SELECT 'rejects', 'temperature', 'date is null', count(*) FROM temperature WHERE date IS NULL) WHERE v > 0
          UNION ALL SELECT 'duplicates', 'immigration', 'duplicate_rows', count(*) FROM orders WHERE o_orderkey % 10 = 0
          UNION ALL SELECT 'duplicates', 'airport', 'duplicate_rows', 0
          UNION ALL SELECT 'cast_losses', 'temperature', 'dt', count(*) FROM temperature WHERE date IS NULL
          UNION ALL SELECT 'cast_losses', 'temperature', 'AverageTemperature', count(*) FROM temperature WHERE average_temp IS NULL
          UNION ALL SELECT 'cast_losses', 'temperature', 'AverageTemperatureUncertainty', 0
          UNION ALL SELECT 'cast_losses', 'immigration', c, 0 FROM (VALUES ('cicid'), ('arrdate'), ('depdate'), ('i94bir'), ('biryear')) v(c)
          UNION ALL SELECT 'cast_losses', 'demographics', 'Number_of_Veterans', count(*) FROM demographics WHERE number_veterans IS NULL
          UNION ALL SELECT 'cast_losses', 'demographics', c, 0
                    FROM (VALUES ('Median_Age'), ('Male_Population'), ('Female_Population'), ('Total_Population'), ('Foreign-born'), ('Average_Household_Size'), ('Count')) v(c)
          UNION ALL SELECT 'merged_codes', 'mode', '3.0', 2
          UNION ALL SELECT 'cast_losses', 'airport', 'elevation_ft', count(*) FROM airport WHERE elevation IS NULL
          UNION ALL {" UNION ALL ".join([*_pct("immigration", "ok", "arrival_date", "departure_date", "port"), *_pct("temperature", "warm", "city", "country", "date"), *_pct("demographics", "demographics", "city", "state"), *_pct("airport", "airport", "region", "municipality", "iata_code")])})
        SELECT report, table_name, item, CAST(value AS DOUBLE) AS value FROM r
    """,
}
