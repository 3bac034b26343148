"""The named steps of the immigration/temperature star schema.

Sources: immigration (parquet, numeric codes), temperature (CSV), demographics
(CSV with ';'), airport (CSV), and the label file of code lists.  Each step
is a pure DataFrame -> DataFrame function; nothing runs until a write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.casts import tolerant_cast
from stellate.functions.dates import day_number_to_date, parse_date
from stellate.operators.clean import (
    chain_filters,
    dedup_by_key,
    drop_columns,
    filter_not_null,
    rename_columns,
)
from stellate.operators.contract import Col, Contract
from stellate.operators.dims import distinct_dates, time_dimension
from stellate.operators.keys import dense_key
from stellate.operators.load_metrics import LoadMetrics
from stellate.operators.lookup import decode, decode_roles
from stellate.session import cut_lineage
from stellate.sources.codelists import code_list, inline_code_list

# Columns dropped as mostly empty or unused.
IMMIGRATION_DROP = ("entdepu", "occup", "insnum", "visapost")
AIRPORT_DROP = ("coordinates", "Latitude", "Longitude", "local_code", "gps_code")

# Names of the code lists used, and the visa category list,
# which exists only as a comment in the label file.
COUNTRY_LIST = "i94cntyl"
MODE_LIST = "i94model"
STATE_LIST = "i94addrl"
PORT_LIST = "i94prtl"
NUMERIC_LISTS = ("country", "mode", "visa")  # lookups by codes that the fact holds as numbers
VISA_CODES = {"1": "Business", "2": "Pleasure", "3": "Student"}

# Names and types of the five target tables.
IMMIGRATION = Contract(
    "immigration",
    (
        Col("id", "bigint", False),
        Col("arrival_date", "date", False),
        Col("departure_date", "date", False),
        Col("birth_country", "string", False),
        Col("residence_country", "string", False),
        Col("port", "string", False),
        Col("age", "int"),
        Col("birth_year", "int"),
        Col("visa", "string"),
        Col("gender", "string", max_length=1),
        Col("mode", "string"),
        Col("state", "string"),
        Col("type", "string"),
    ),
    primary_key=("id",),
)

TEMPERATURE = Contract(
    "temperature",
    (
        Col("id", "bigint", False),
        Col("country", "string", False),
        Col("city", "string", False),
        Col("date", "date", False),
        Col("average_temp", "double"),
        Col("uncertanty", "double"),
    ),
    primary_key=("id",),
)

AIRPORT = Contract(
    "airport",
    (
        Col("id", "string", False),
        Col("type", "string"),
        Col("name", "string"),
        Col("elevation", "int"),
        Col("continent", "string"),
        Col("country", "string"),
        Col("region", "string"),
        Col("municipality", "string"),
        Col("iata_code", "string"),
    ),
    primary_key=("id",),
)

DEMOGRAPHICS = Contract(
    "demographics",
    (
        Col("id", "bigint", False),
        Col("median_age", "double"),
        Col("male_population", "int"),
        Col("female_population", "int"),
        Col("total_population", "int"),
        Col("number_veterans", "int"),
        Col("foreign_born", "int"),
        Col("average_household", "double"),
        Col("state_code", "string"),
        Col("race", "string"),
        Col("count", "int"),
        Col("state", "string"),
        Col("city", "string"),
    ),
    primary_key=("id",),
)

TIME = Contract(
    "time",
    (
        Col("time", "date", False),
        Col("year", "int"),
        Col("month", "int"),
        Col("day_of_week", "int"),
        Col("weekday", "int"),
        Col("day_of_month", "int"),
        Col("day_of_year", "int"),
        Col("week_of_year", "int"),
    ),
    primary_key=("time",),
)

CONTRACTS = {c.name: c for c in (IMMIGRATION, TEMPERATURE, AIRPORT, DEMOGRAPHICS, TIME)}

# Every converted column of the cleaned sources and its type (``day``: a day number); the conform steps
# convert by this table and the loss report counts by it.
CASTS = {
    "immigration": {"cicid": "bigint", "arrdate": "day", "depdate": "day", "i94bir": "int", "biryear": "int"},
    "temperature": {"dt": "date", "AverageTemperature": "double", "AverageTemperatureUncertainty": "double"},
    "demographics": {
        "Median_Age": "double", "Male_Population": "int", "Female_Population": "int", "Total_Population": "int", "Number_of_Veterans": "int",
        "Foreign-born": "int", "Average_Household_Size": "double", "Count": "int",
    },
    "airport": {"elevation_ft": "int"},
}


def converted(table: str, df: DataFrame) -> dict[str, tuple[Column, Column]]:
    """Column -> (source value, converted value) for every entry of ``CASTS[table]``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name, to in CASTS[table].items():
        own = F.col(f"`{name}`")
        out[name] = (own, day_number_to_date(own) if to == "day" else parse_date(own) if to == "date" else tolerant_cast(own, to, types.get(name)))
    return out


# Audited columns of the completeness check, per table.
AUDITED = {
    "immigration": ("arrival_date", "departure_date", "port"),
    "temperature": ("city", "country", "date"),
    "demographics": ("city", "state"),
    "airport": ("region", "municipality", "iata_code"),
}


# ---- clean ---------------------------------------------------------------

def clean_immigration(df: DataFrame, metrics: LoadMetrics | None = None) -> DataFrame:
    """Drop the unused columns and keep one row per ``cicid`` (deterministic survivor)."""
    return _one_row(drop_columns(df, *IMMIGRATION_DROP), "cicid", "immigration", metrics)


def _one_row(df: DataFrame, key: str, table: str, metrics: LoadMetrics | None) -> DataFrame:
    """One row per key; ``metrics`` takes the rows read and removed on the way."""
    return dedup_by_key(df, [key]) if metrics is None else metrics.duplicates(dedup_by_key(df, [key], count="_n"), table, "_n")


def clean_airport(
    df: DataFrame, types: tuple[str, ...] | None = None, country: str | None = None, metrics: LoadMetrics | None = None
) -> DataFrame:
    """Drop unused columns, one row per ident, keep airports with an IATA code.

    ``types`` / ``country`` optionally narrow to e.g. large US airports.
    """
    out = filter_not_null(_one_row(drop_columns(df, *AIRPORT_DROP), "ident", "airport", metrics), "iata_code")
    if types:
        out = out.filter(F.col("type").isin(list(types)))
    if country:
        out = out.filter(F.col("iso_country") == country)
    return out


def clean_temperature(df: DataFrame, country: str = "United States", sentinel: str = "None") -> DataFrame:
    """Keep one country's measurements that are not the missing-value text (NULL drops too)."""
    return chain_filters(
        df, F.col("Country") == F.lit(country), F.col("AverageTemperature") != F.lit(sentinel)
    )


def clean_demographics(df: DataFrame) -> DataFrame:
    """Column names with spaces become ``_`` (``Foreign-born`` keeps its hyphen)."""
    return rename_columns(df)


# ---- conform -------------------------------------------------------------

def immigration_lookups(spark: SparkSession, parsed_lists: DataFrame) -> dict[str, DataFrame]:
    """The lookups from a parsed label file plus the inline visa list.

    The parsed lists are materialized once, so size checks and joins do not
    parse the label files again.
    """
    parsed_lists = cut_lineage(parsed_lists)
    return {
        "country": code_list(parsed_lists, COUNTRY_LIST),
        "mode": code_list(parsed_lists, MODE_LIST),
        "state": code_list(parsed_lists, STATE_LIST),
        "port": code_list(parsed_lists, PORT_LIST),
        "visa": inline_code_list(spark, VISA_CODES),
    }


def conform_immigration(
    df: DataFrame, lookups: dict[str, DataFrame], state_default: str | None = None, port_names: bool = False
) -> DataFrame:
    """Decode the five codes, convert day numbers to dates and type the columns.

    ``visa`` is the category label and ``type`` the class of admission.
    ``port`` stays the code (the key of the airport table); ``port_names``
    adds its label as ``port_name``.
    """
    d = decode_roles(df, lookups["country"], {"birth_country": "i94cit", "residence_country": "i94res"})
    d = decode(d, "i94mode", lookups["mode"], "mode")
    d = decode(d, "i94addr", lookups["state"], "state", default=state_default)
    d = decode(d, "i94visa", lookups["visa"], "visa", known_rows=len(VISA_CODES), unique=True)
    if port_names:
        d = decode(d, "i94port", lookups["port"], "port_name")
    to = {name: new for name, (_, new) in converted("immigration", df).items()}
    return d.select(
        to["cicid"].alias("id"),
        to["arrdate"].alias("arrival_date"),
        to["depdate"].alias("departure_date"),
        "birth_country",
        "residence_country",
        F.col("i94port").alias("port"),
        to["i94bir"].alias("age"),
        to["biryear"].alias("birth_year"),
        "visa",
        "gender",
        "mode",
        "state",
        F.col("visatype").alias("type"),
        *(["port_name"] if port_names else []),
    )


# Orderings of the numbered tables; together with every other column they identify a row.
ID_ORDER = {
    "temperature": ("country", "city", "date", "average_temp", "uncertanty"),
    "demographics": ("state_code", "city", "race", "count"),
}


def number_rows(name: str, df: DataFrame) -> DataFrame:
    """Dense ``id`` from 0 for a conformed table; ties in the leading order go by the other columns."""
    order = ID_ORDER[name]
    return dense_key(df, [*order, *[c for c in df.columns if c not in order]])


def conform_temperature(df: DataFrame, with_id: bool = True) -> DataFrame:
    """Typed measurements: text date with ``yyyy-MM-dd``, tolerant doubles, dense ``id``."""
    to = {name: new for name, (_, new) in converted("temperature", df).items()}
    out = df.select(
        F.col("Country").alias("country"),
        F.col("City").alias("city"),
        to["dt"].alias("date"),
        to["AverageTemperature"].alias("average_temp"),
        to["AverageTemperatureUncertainty"].alias("uncertanty"),
    )
    if with_id:
        out = number_rows("temperature", out)
    return out


def conform_demographics(df: DataFrame, with_id: bool = True) -> DataFrame:
    """Columns named as after ``clean_demographics`` (spaces -> ``_``)."""
    to = {name: new for name, (_, new) in converted("demographics", df).items()}
    out = df.select(
        to["Median_Age"].alias("median_age"),
        to["Male_Population"].alias("male_population"),
        to["Female_Population"].alias("female_population"),
        to["Total_Population"].alias("total_population"),
        to["Number_of_Veterans"].alias("number_veterans"),
        to["Foreign-born"].alias("foreign_born"),
        to["Average_Household_Size"].alias("average_household"),
        F.col("State_Code").alias("state_code"),
        F.col("Race").alias("race"),
        to["Count"].alias("count"),
        F.col("State").alias("state"),
        F.col("City").alias("city"),
    )
    if with_id:
        out = number_rows("demographics", out)
    return out


def conform_airport(df: DataFrame) -> DataFrame:
    """Airport dimension columns: ``id`` = ident, elevation as a tolerant int."""
    return df.select(
        F.col("ident").alias("id"),
        "type",
        "name",
        converted("airport", df)["elevation_ft"][1].alias("elevation"),
        "continent",
        F.col("iso_country").alias("country"),
        F.col("iso_region").alias("region"),
        "municipality",
        "iata_code",
    )


def build_time(immigration: DataFrame, temperature: DataFrame) -> DataFrame:
    """Time dimension over arrival, departure and measurement dates."""
    dates = distinct_dates(
        [(immigration, "arrival_date"), (immigration, "departure_date"), (temperature, "date")]
    )
    return time_dimension(dates)


def demographics_by_city(demo: DataFrame) -> DataFrame:
    """Demographics at (city, state_code) grain: one row per city.

    The city-level figures repeat on every race row, so each is taken once.
    """
    return demo.groupBy("city", "state_code").agg(
        F.max("total_population").alias("total_population"),
        F.max("foreign_born").alias("foreign_born"),
        F.max("median_age").alias("median_age"),
    )


def arrivals_by_city(immigration: DataFrame, airport: DataFrame, demo: DataFrame) -> DataFrame:
    """Arrivals per month and city: fact -> airport on port = IATA code ->
    city-grain demographics on municipality and state (region ``US-CA`` -> ``CA``).

    Airports and cities are collapsed to one row per join key first, so the
    fact's rows never multiply; of several airports of one code the first by
    (municipality, state, id) is taken whole, airports without a municipality last.
    """
    place = F.struct(
        F.col("municipality").isNull().alias("unknown"),
        "municipality",
        F.regexp_extract("region", r"-(\w+)$", 1).alias("state_code"),
        "id",
    )
    ports = (
        airport.filter(F.col("iata_code").isNotNull())
        .groupBy("iata_code")
        .agg(F.min(place).alias("p"))
        .select("iata_code", "p.municipality", "p.state_code")
    )
    cities = demographics_by_city(demo)
    monthly = immigration.groupBy(
        F.year("arrival_date").alias("year"), F.month("arrival_date").alias("month"), "port"
    ).agg(F.count(F.lit(1)).alias("arrivals"))
    return (
        monthly.join(ports, monthly["port"] == ports["iata_code"], "left")
        .join(
            cities,
            (F.col("municipality") == cities["city"]) & (ports["state_code"] == cities["state_code"]),
            "left",
        )
        .select("year", "month", "port", "city", cities["state_code"], "arrivals", "total_population")
    )


# ---- end to end --------------------------------------------------------------

def build_warehouse(
    spark: SparkSession,
    immigration: DataFrame,
    temperature: DataFrame,
    demographics: DataFrame,
    airport: DataFrame,
    label_paths: str | list[str],
    base: str,
    state_default: str | None = None,
    sample_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Clean, conform, check and write the five tables under ``base``.

    Per table the conformed rows are written once to the scratch folder and
    split by the contract (primary keys included) into valid rows (numbered
    where the table has a generated id, then written to ``base/<table>``) and
    rejected rows (``base/_rejects/<table>``, with reasons).  Returns report
    DataFrames: ``load`` (rows and seconds per table), ``row_counts`` (written
    vs read back), ``completeness`` (audited columns of the loaded tables),
    ``rejects`` (rows per table and reason), ``sources`` (rows read per
    source), ``duplicates`` (rows a key de-duplication removes),
    ``cast_losses`` (values the converted columns could not take) and
    ``merged_codes`` (codes of a list that mean one number but different labels).
    Each source is read once: the counts ride on the write of its conformed rows.
    """
    from functools import reduce

    from stellate.operators.contract import enforce_contract, reject_summary
    from stellate.operators.lookup import merged_codes
    from stellate.operators.quality import completeness_audit, counts_frame, row_count_check
    from stellate.plans.warehouse import read_counts, write_tables
    from stellate.sources.codelists import parse_code_lists

    metrics = LoadMetrics()
    lookups = immigration_lookups(spark, parse_code_lists(spark, label_paths))
    cleaned = {
        "immigration": clean_immigration(immigration, metrics),
        "temperature": clean_temperature(metrics.rows(temperature, "temperature")),
        "demographics": clean_demographics(metrics.rows(demographics, "demographics")),
        "airport": clean_airport(airport, metrics=metrics),
    }
    cleaned = {name: metrics.losses(df, name, converted(name, df)) for name, df in cleaned.items()}
    conformed = {
        "immigration": conform_immigration(cleaned["immigration"], lookups, state_default),
        "temperature": conform_temperature(cleaned["temperature"], with_id=False),
        "demographics": conform_demographics(cleaned["demographics"], with_id=False),
        "airport": conform_airport(cleaned["airport"]),
    }
    valid, rejects = {}, {}
    for name, df in conformed.items():
        numbered = name in ID_ORDER
        rules = CONTRACTS[name].without("id") if numbered else CONTRACTS[name]
        # a generated id is given to the rows that are loaded, so it is dense and cannot repeat
        valid[name], rejects[name] = enforce_contract(df, rules, check_key=True, materialize=True)
        if numbered:
            valid[name] = number_rows(name, valid[name])
    times = build_time(valid["immigration"], valid["temperature"])
    valid["time"], rejects["time"] = enforce_contract(times, CONTRACTS["time"], check_key=True, materialize=True)

    base = base.rstrip("/")
    load = write_tables(spark, valid, base, sample_rows=sample_rows)
    write_tables(spark, rejects, f"{base}/_rejects")
    written = load.collect()  # one row per table
    expected = counts_frame(spark, {r.table_name: r.rows for r in written}, "expected")
    actual = read_counts(spark, {r.table_name: r.path for r in written})
    loaded = {r.table_name: spark.read.parquet(r.path) for r in written}
    audit = completeness_audit({t: (loaded[t], cols) for t, cols in AUDITED.items()})
    reject_report = reduce(
        DataFrame.unionByName,
        [reject_summary(spark.read.parquet(f"{base}/_rejects/{t}")).select(F.lit(t).alias("table_name"), "*")
         for t in rejects],
    )
    merged = [merged_codes(lookups[name], "double").select(F.lit(name).alias("list_name"), "*") for name in NUMERIC_LISTS]
    return {
        "sources": metrics.source_report(spark),
        "duplicates": metrics.duplicate_report(spark),
        "cast_losses": metrics.loss_report(spark),
        "merged_codes": reduce(DataFrame.unionByName, merged),
        "load": load,
        "row_counts": row_count_check(expected, actual),
        "completeness": audit,
        "rejects": reject_report,
    }
