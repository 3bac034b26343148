"""Golden rows of FIXTURES.md §3 through the star-schema steps."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stellate.functions.casts import cast_loss_report
from stellate.operators import clean, contract, profile
from stellate.operators.lookup import decode
from stellate.plans import star
from stellate.sources.codelists import code_list, parse_code_lists

D = dt.date

# List names and entries in the format of the source's label file.
LABELS = (
    "/* country list used for birth and residence */\r\n"
    "  value i94cntyl\r\n"
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'\r\n"
    "   101 =  'ALBANIA'\r\n"
    "   209 =  'JAPAN'\r\n"
    "   111 =  'FRANCE'\r\n"
    "   0   =  'INVALID: STATELESS'\r\n"
    ";\r\n"
    "\r\n"
    "/* travel mode; 9 means not reported */\r\n"
    "value i94model\r\n"
    "\t1 = 'Air'\r\n"
    "\t2 = 'Sea'\r\n"
    "\t3 = 'Land'\r\n"
    "\t9 = 'Not reported' ;\r\n"
    "\r\n"
    "/* state of address */\r\n"
    "value i94addrl\r\n"
    "\t'CA'='CALIFORNIA'\r\n"
    "\t'99'='All Other Codes'\r\n"
    ";\r\n"
)

IMMI_SCHEMA = (
    "cicid double, i94cit double, i94res double, i94port string, arrdate double, i94mode double, "
    "i94addr string, depdate double, i94bir double, i94visa double, biryear double, gender string, "
    "visatype string, entdepu string, occup string, insnum string, visapost string"
)
IMMI_ROWS = [
    (1.0, 101.0, 209.0, "LOS", 20573.0, 1.0, "CA", 20580.0, 40.0, 2.0, 1976.0, "F", "B2", "U", None, None, "X"),
    (1.0, 101.0, 209.0, "LOS", 20573.0, 1.0, "CA", 20580.0, 40.0, 2.0, 1976.0, "F", "B2", "U", None, None, "X"),
    (2.0, 582.0, 582.0, "NYC", 20574.0, 2.0, "XX", None, 25.0, 1.0, 1991.0, "M", "B1", None, None, None, None),
    (3.0, 0.0, 111.0, "MIA", 20575.0, None, None, 20590.0, None, 3.0, None, None, "F1", None, None, None, None),
    (4.0, 111.0, 888.0, "ZZZ", 20576.0, 9.0, "99", 20577.0, 61.0, 2.0, 1955.0, "M", "WT", None, None, None, None),
]
MEXICO = "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"


@pytest.fixture
def lookups(spark, tmp_text):
    parsed = parse_code_lists(spark, tmp_text("labels.txt", LABELS))
    return star.immigration_lookups(spark, parsed)


@pytest.fixture
def immi(spark):
    return spark.createDataFrame(IMMI_ROWS, IMMI_SCHEMA)


def test_immigration_conform(immi, lookups):
    out = star.conform_immigration(star.clean_immigration(immi), lookups)
    assert out.columns == star.IMMIGRATION.names
    rows = {r.id: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    r1, r2, r3, r4 = rows[1], rows[2], rows[3], rows[4]
    assert (r1.arrival_date, r1.departure_date) == (D(2016, 4, 29), D(2016, 5, 6))
    assert (r1.birth_country, r1.residence_country, r1.mode, r1.state, r1.visa, r1.type) == (
        "ALBANIA", "JAPAN", "Air", "CALIFORNIA", "Pleasure", "B2")
    assert (r1.age, r1.birth_year, r1.port, r1.gender) == (40, 1976, "LOS", "F")
    assert r2.departure_date is None
    assert (r2.birth_country, r2.residence_country, r2.mode, r2.state, r2.visa) == (
        MEXICO, MEXICO, "Sea", None, "Business")
    assert (r3.birth_country, r3.residence_country, r3.mode, r3.state, r3.visa, r3.age) == (
        "INVALID: STATELESS", "FRANCE", None, None, "Student", None)
    assert (r4.birth_country, r4.residence_country, r4.mode, r4.state, r4.visa, r4.type) == (
        "FRANCE", None, "Not reported", "All Other Codes", "Pleasure", "WT")
    assert r4.arrival_date == D(2016, 5, 2) and r4.departure_date == D(2016, 5, 3)


def test_immigration_dropped_columns(immi):
    cols = star.clean_immigration(immi).columns
    assert not set(star.IMMIGRATION_DROP) & set(cols)


def test_immigration_duplicates(immi):
    r = clean.duplicate_report(immi, ["cicid"]).collect()[0]
    assert (r.rows_in, r.rows_out, r.duplicate_rows, r.duplicated_keys) == (5, 4, 1, 1)


def test_immigration_contract_rejects(immi, lookups):
    out = star.conform_immigration(star.clean_immigration(immi), lookups)
    valid, rejects = contract.enforce_contract(out, star.IMMIGRATION)
    assert sorted(r.id for r in valid.collect()) == [1, 3]
    reasons = {r.id: list(r.reasons) for r in rejects.collect()}
    assert reasons == {2: ["departure_date is null"], 4: ["residence_country is null"]}


def test_immigration_contract_fail_mode(immi, lookups):
    out = star.conform_immigration(star.clean_immigration(immi), lookups)
    with pytest.raises(ValueError):
        contract.enforce_contract(out, star.IMMIGRATION, mode="fail")


def test_state_default_label(immi, lookups):
    out = star.conform_immigration(star.clean_immigration(immi), lookups, state_default="All Other Codes")
    states = {r.id: r.state for r in out.collect()}
    assert states == {1: "CALIFORNIA", 2: "All Other Codes", 3: "All Other Codes", 4: "All Other Codes"}


TEMP_SCHEMA = (
    "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, "
    "Country string, Latitude string, Longitude string"
)
TEMP_ROWS = [
    ("1849-01-01", "-1.5", "2.1", "Newark", "United States", "40.99N", "74.56W"),
    ("2013-09-01", "21.408", "0.9", "Newark", "United States", "40.99N", "74.56W"),
    ("2013-08-01", None, None, "Newark", "United States", "40.99N", "74.56W"),
    ("2013-07-01", "None", "None", "Los Angeles", "United States", "34.56N", "118.70W"),
    ("2013-09-01", "18.1", "0.5", "Paris", "France", "49.03N", "2.45E"),
    ("bad", "10.0", "0.4", "Los Angeles", "United States", "34.56N", "118.70W"),
]


def test_temperature_clean_and_conform(spark):
    raw = spark.createDataFrame(TEMP_ROWS, TEMP_SCHEMA)
    out = star.conform_temperature(star.clean_temperature(raw))
    assert out.columns == star.TEMPERATURE.names
    got = sorted((r.date or D(1, 1, 1), r.average_temp, r.city) for r in out.collect())
    assert got == [
        (D(1, 1, 1), 10.0, "Los Angeles"),
        (D(1849, 1, 1), -1.5, "Newark"),
        (D(2013, 9, 1), 21.408, "Newark"),  # month kept: pattern uses MM
    ]
    assert sorted(r.id for r in out.collect()) == [0, 1, 2]
    valid, rejects = contract.enforce_contract(out, star.TEMPERATURE)
    assert valid.count() == 2
    assert [list(r.reasons) for r in rejects.collect()] == [["date is null"]]


DEMO_COLS = [
    "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
    "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count",
]
DEMO_ROWS = [
    ("Newark", "New Jersey", "34.6", "138040", "143873", "281913", "5829", "86253", "2.73", "NJ", "Hispanic", "76402"),
    ("Newark", "New Jersey", "34.6", "138040", "143873", "281913", "5829", "86253", "2.73", "NJ", "White", "n/a"),
    ("Hoover", "Alabama", "41.0", "38040", "46799", "84839", "4819", None, "2.58", "AL", "Asian", "40.9"),
]


def test_demographics_rename_and_conform(spark):
    raw = spark.createDataFrame(DEMO_ROWS, ", ".join(f"`{c}` string" for c in DEMO_COLS))
    renamed = star.clean_demographics(raw)
    assert {"Median_Age", "Foreign-born", "Count", "City", "State_Code"} <= set(renamed.columns)
    out = star.conform_demographics(renamed)
    assert out.columns == star.DEMOGRAPHICS.names
    got = sorted((r.city, r.race, r.median_age, r.foreign_born, r["count"]) for r in out.collect())
    assert got == [
        ("Hoover", "Asian", 41.0, None, 40),
        ("Newark", "Hispanic", 34.6, 86253, 76402),
        ("Newark", "White", 34.6, 86253, None),
    ]
    losses = {r.column_name: r.lost for r in cast_loss_report(renamed, {"Count": "int"}).collect()}
    assert losses == {"Count": 1}
    assert star.demographics_by_city(out).count() == 2


AIRP_SCHEMA = (
    "ident string, type string, name string, elevation_ft string, continent string, iso_country string, "
    "iso_region string, municipality string, gps_code string, iata_code string, local_code string, "
    "coordinates string"
)
AIRP_ROWS = [
    ("KLAX", "large_airport", "Los Angeles Intl", "125", "NA", "US", "US-CA", "Los Angeles", "KLAX", "LAX", "LAX", "x"),
    ("KLAX", "large_airport", "Los Angeles Intl", "125", "NA", "US", "US-CA", "Los Angeles", "KLAX", "LAX", "LAX", "x"),
    ("00A", "heliport", "Total Rf Heliport", "11", "NA", "US", "US-PA", "Bensalem", "00A", None, "00A", "x"),
    ("KEWR", "large_airport", "Newark Liberty", "", "NA", "US", "US-NJ", "Newark", "KEWR", "EWR", None, "x"),
    ("XX1", "small_airport", "Somewhere", "18", "NA", "US", "US-NJ", "Newark", "AB", "XX1", "CD", "x"),
]


@pytest.fixture
def airp(spark):
    return spark.createDataFrame(AIRP_ROWS, AIRP_SCHEMA)


def test_airport_clean_and_conform(airp):
    out = star.conform_airport(star.clean_airport(airp))
    assert out.columns == star.AIRPORT.names
    got = sorted((r.id, r.elevation) for r in out.collect())
    assert got == [("KEWR", None), ("KLAX", 125), ("XX1", 18)]
    large = star.clean_airport(airp, types=("large_airport",))
    assert sorted(r.ident for r in large.collect()) == ["KEWR", "KLAX"]


def test_airport_mismatch_and_groups(airp):
    assert profile.mismatch_count(airp, "gps_code", "local_code").collect()[0].n_mismatch == 3
    counts = {r.type: r.n for r in profile.group_count(airp, "type").collect()}
    assert counts == {"large_airport": 3, "heliport": 1, "small_airport": 1}


def test_airport_completeness(airp, spark):
    cols = ["ident", "elevation_ft", "gps_code", "iata_code", "local_code"]
    rep = [(r.column_name, r.non_null, r.pct) for r in profile.completeness(airp.select(*cols)).collect()]
    assert rep == [
        ("iata_code", 4, 80.0),
        ("local_code", 4, 80.0),
        ("elevation_ft", 5, 100.0),
        ("gps_code", 5, 100.0),
        ("ident", 5, 100.0),
    ]
    assert clean.drop_low_completeness(airp.select(*cols), 80.0).columns == cols
    assert clean.drop_low_completeness(airp.select(*cols), 90.0).columns == ["ident", "elevation_ft", "gps_code"]
    assert clean.drop_low_completeness(airp.select(*cols), 90.0, keep=["iata_code"]).columns == [
        "ident", "elevation_ft", "gps_code", "iata_code"]
    empty = profile.completeness(airp.select(*cols).limit(0)).collect()
    assert all(r.pct is None for r in empty) and len(empty) == 5


def test_airport_drop_absent_column(airp):
    assert clean.drop_columns(airp, "Latitude").columns == airp.columns


def test_time_dimension(spark):
    from stellate.operators.dims import distinct_dates

    a = spark.createDataFrame(
        [(D(2016, 4, 29), D(2016, 5, 6)), (D(2016, 4, 30), None), (D(2016, 4, 29), D(2016, 5, 6))],
        "arrival_date date, departure_date date",
    )
    t = spark.createDataFrame([(D(1849, 1, 1),), (D(2013, 9, 1),)], "date date")
    union = distinct_dates([(a, "arrival_date"), (a, "departure_date"), (t, "date")])
    assert union.count() == 6  # five dates and one NULL, as SQL UNION keeps it
    dim = star.build_time(a, t)
    rows = sorted(tuple(r) for r in dim.collect())
    assert rows == [
        (D(1849, 1, 1), 1849, 1, 2, 0, 1, 1, 1),
        (D(2013, 9, 1), 2013, 9, 1, 6, 1, 244, 35),
        (D(2016, 4, 29), 2016, 4, 6, 4, 29, 120, 17),
        (D(2016, 4, 30), 2016, 4, 7, 5, 30, 121, 17),
        (D(2016, 5, 6), 2016, 5, 6, 4, 6, 127, 18),
    ]
    assert dim.columns == star.TIME.names


CODELIST_TEXT = (
    "title 'code lists for the parser test' ;\r\n"
    "/* country codes; the word values inside a comment must not open a block */\r\n"
    "  value i94cntyl\r\n"
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'\r\n"
    "     0 =  'INVALID: STATELESS'\r\n"
    ";\r\n"
    "  value i94model\r\n"
    "\t1 = 'Air'\r\n"
    "\t9 = 'Not reported' ;\r\n"
    "  value $i94prtl\r\n"
    "\t'INT'\t=\t'INT''L FALLS, MN      '\r\n"
    "\t'CP '\t=\t'No PORT Code (CP)'\r\n"
    ";\r\n"
)


def test_codelist_parse_edges(spark, tmp_text):
    parsed = parse_code_lists(spark, tmp_text("labels.txt", CODELIST_TEXT))
    rows = sorted(tuple(r) for r in parsed.collect())
    assert rows == [
        ("i94cntyl", "0", "INVALID: STATELESS"),
        ("i94cntyl", "582", MEXICO),
        ("i94model", "1", "Air"),
        ("i94model", "9", "Not reported"),
        ("i94prtl", "CP", "No PORT Code (CP)"),
        ("i94prtl", "INT", "INT'L FALLS, MN"),
    ]


def test_codelist_last_duplicate_wins_and_many_files(spark, tmp_text):
    a = tmp_text("a.txt", "value l1\n 1 = 'one'\n 1 = 'uno'\n 2 = 'two'\n;\n")
    b = tmp_text("b.txt", "value l2\n 'x' = 'ex'\n;\n")
    parsed = parse_code_lists(spark, [a, b])
    assert sorted(tuple(r) for r in parsed.collect()) == [("l1", "1", "uno"), ("l1", "2", "two"), ("l2", "x", "ex")]
    assert sorted(tuple(r) for r in code_list(parsed, "l2").collect()) == [("x", "ex")]


def test_numeric_fact_codes_match_text_codes(spark):
    fact = spark.createDataFrame([(582.0,), (7.0,), (None,)], "c double")
    codes = spark.createDataFrame([("582", "MX"), ("XX", "junk")], "code string, label string")
    out = decode(fact, "c", codes, "label")
    assert sorted((r.c or -1, r.label) for r in out.collect()) == [(-1, None), (7.0, None), (582.0, "MX")]
    text_fact = spark.createDataFrame([("582",), ("abc",)], "c string")
    int_codes = spark.createDataFrame([(582, "MX")], "code int, label string")
    out2 = decode(text_fact, "c", int_codes, "label")
    assert sorted((r.c, r.label) for r in out2.collect()) == [("582", "MX"), ("abc", None)]


def test_arrivals_by_city_does_not_multiply_rows(spark, airp, lookups, immi):
    fact = star.conform_immigration(star.clean_immigration(immi), lookups)
    airport = star.conform_airport(star.clean_airport(airp))
    demo = star.conform_demographics(star.clean_demographics(
        spark.createDataFrame(DEMO_ROWS, ", ".join(f"`{c}` string" for c in DEMO_COLS))), with_id=False)
    out = star.arrivals_by_city(fact, airport, demo)
    assert out.agg(F.sum("arrivals")).collect()[0][0] == 4


def test_build_warehouse_end_to_end(spark, tmp_text):
    from stellate.session import scratch_path

    out = star.build_warehouse(
        spark,
        spark.createDataFrame(IMMI_ROWS, IMMI_SCHEMA),
        spark.createDataFrame(TEMP_ROWS, TEMP_SCHEMA),
        spark.createDataFrame(DEMO_ROWS, ", ".join(f"`{c}` string" for c in DEMO_COLS)),
        spark.createDataFrame(AIRP_ROWS, AIRP_SCHEMA),
        tmp_text("labels.txt", LABELS),
        scratch_path(spark, "wh"),
    )
    loaded = {r.table_name: r.rows for r in out["load"].collect()}
    assert loaded == {"immigration": 2, "temperature": 2, "demographics": 3, "airport": 3, "time": 6}
    assert all(r.ok and r.missing == 0 for r in out["row_counts"].collect())
    rej = {(r.table_name, r.reason): r.n_rows for r in out["rejects"].collect()}
    assert rej == {
        ("immigration", "departure_date is null"): 1,
        ("immigration", "residence_country is null"): 1,
        ("temperature", "date is null"): 1,
    }
    audit = {(r.table_name, r.column_name): r.pct for r in out["completeness"].collect()}
    assert audit[("airport", "iata_code")] == 100.0 and audit[("demographics", "city")] == 100.0
    assert len(audit) == 11
    wh = out["load"].where("table_name = 'temperature'").first().path
    for name, n in (("temperature", 2), ("demographics", 3)):
        ids = [r.id for r in spark.read.parquet(wh.replace("temperature", name)).collect()]
        assert sorted(ids) == list(range(n))  # numbered after the rejects left
    assert {r.table_name: r.row_count for r in out["sources"].collect()}["immigration"] == 5
    assert {r.table_name: r.duplicate_rows for r in out["duplicates"].collect()}["immigration"] == 1
    assert {(r.table_name, r.column_name): r.lost for r in out["cast_losses"].collect()}[("temperature", "dt")] == 1


def test_build_warehouse_rejects_merging_ids(spark, tmp_text):
    from stellate.session import scratch_path

    rows = [(i, *IMMI_ROWS[0][1:]) for i in (5.2, 5.7, 6.0)]
    out = star.build_warehouse(
        spark, spark.createDataFrame(rows, IMMI_SCHEMA), spark.createDataFrame(TEMP_ROWS, TEMP_SCHEMA),
        spark.createDataFrame(DEMO_ROWS, ", ".join(f"`{c}` string" for c in DEMO_COLS)), spark.createDataFrame(AIRP_ROWS, AIRP_SCHEMA),
        tmp_text("labels.txt", LABELS), scratch_path(spark, "wh"))
    assert {(r.table_name, r.reason): r.n_rows for r in out["rejects"].collect()}[("immigration", "id duplicated")] == 2


def test_conflicting_airports_give_one_whole_place(spark):
    fact = spark.createDataFrame([(1, D(2016, 4, 1), "LAX")], "id int, arrival_date date, port string")
    airport = spark.createDataFrame([("b", "Aaa", "US-NV", "LAX"), ("a", "Los Angeles", "US-CA", "LAX"), ("c", None, "US-AA", "LAX")],
                                    "id string, municipality string, region string, iata_code string")
    demo = spark.createDataFrame([("Aaa", "NV", 5, 1, 2.0), ("Aaa", "CA", 9, 1, 2.0)], "city string, state_code string, total_population int, foreign_born int, median_age double")
    assert [tuple(r) for r in star.arrivals_by_city(fact, airport, demo).collect()] == [(2016, 4, "LAX", "Aaa", "NV", 1, 5)]


def test_example_build_star_runs_on_raw_files(spark, tmp_path, capsys):
    import importlib.util

    from stellate.session import scratch_path

    base = scratch_path(spark, "raw")
    spark.createDataFrame(IMMI_ROWS, IMMI_SCHEMA).write.parquet(f"{base}/immi")
    spark.createDataFrame(TEMP_ROWS, TEMP_SCHEMA).write.option("header", True).csv(f"{base}/temp")
    spark.createDataFrame(DEMO_ROWS, ", ".join(f"`{c}` string" for c in DEMO_COLS)).write.option(
        "header", True).option("sep", ";").csv(f"{base}/demo")
    spark.createDataFrame(AIRP_ROWS, AIRP_SCHEMA).write.option("header", True).csv(f"{base}/airp")
    labels = tmp_path / "labels.txt"
    labels.write_bytes(LABELS.encode())
    path = Path(__file__).resolve().parents[1] / "examples" / "build_star.py"
    spec = importlib.util.spec_from_file_location("build_star", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    mod.main([
        "--immigration", f"{base}/immi", "--temperature", f"{base}/temp", "--demographics", f"{base}/demo",
        "--airport", f"{base}/airp", "--labels", str(labels), "--out", f"{base}/out",
    ])
    out = capsys.readouterr().out
    assert "== row_counts" in out and "residence_country is null" in out
    assert spark.read.parquet(f"{base}/out/immigration").count() == 2
