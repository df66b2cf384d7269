"""Values that must survive being stored: the probe rows of the declared tables."""

from decimal import Decimal

from pyspark.sql import functions as F

from millrace.contracts import Contract, Key, columns
from millrace.functions.numbers import is_infinite
from millrace.operators import checks
from millrace.operators.layout import read_table, write_table

AMOUNTS = [
    ("max_positive", "99999999999999.99"),
    ("max_negative", "-99999999999999.99"),
    ("min_nonzero", "0.01"),
    ("exact_zero", "0.00"),
]
DOUBLES = [("nan", "NaN"), ("pos_inf", "+inf"), ("neg_inf", "-inf"), ("neg_zero", "-0.0")]


def probe_contract(text):
    return Contract("raw", "probe", columns(text + ", load_date date"), Key("load_date", "date"))


def stored(spark, path, contract, rows):
    frame = spark.createDataFrame(rows, "probe_label string, text string")
    cast = [F.col("text").cast(f.dataType).alias(f.name) for f in contract.schema.fields[1:-1]]
    day = F.lit("2024-01-30").cast("date").alias("load_date")
    write_table(frame.select("probe_label", *cast, day), path, contract)
    return read_table(spark, path, contract)


def test_numeric_round_trip(spark, table_path):
    contract = probe_contract("probe_label string, gross_amount numeric, net_amount numeric")
    rows = stored(spark, table_path, contract, AMOUNTS).orderBy("probe_label").collect()
    assert [r.probe_label for r in rows] == sorted(label for label, _ in AMOUNTS)
    expected = {label: Decimal(text) for label, text in AMOUNTS}
    for row in rows:
        assert row.gross_amount == row.net_amount == expected[row.probe_label]


def test_double_round_trip(spark, table_path):
    contract = probe_contract("probe_label string, geocoded_lat double, geocoded_lon double")
    frame = stored(spark, table_path, contract, DOUBLES)
    tests = frame.select(
        "probe_label",
        *[
            F.array(F.isnan(c), is_infinite(F.col(c)), F.col(c) > 0, F.col(c) < 0, F.col(c) == 0).alias(c)
            for c in ("geocoded_lat", "geocoded_lon")
        ],
        F.col("geocoded_lat").cast("string").alias("text"),
    )
    got = {r.probe_label: r for r in tests.collect()}
    for column in ("geocoded_lat", "geocoded_lon"):
        assert got["nan"][column][:2] == [True, False]
        assert got["pos_inf"][column] == [False, True, True, False, False]
        assert got["neg_inf"][column] == [False, True, False, True, False]
        assert got["neg_zero"][column] == [False, False, False, False, True]
    assert got["neg_zero"].text == "0.0"


def test_seventeen_digits(spark, table_path):
    contract = probe_contract("probe_label string, val double")
    frame = stored(spark, table_path, contract, [("seventeen_digits", "0.30000000000000004")])
    row = frame.where(F.col("probe_label") == "seventeen_digits").select(
        F.col("val").cast("string").alias("text"), (F.col("val") == F.lit(0.30000000000000004)).alias("exact")
    ).first()
    assert row.exact and row.text == "0.30000000000000004"


def test_amount_wider_than_its_source_precision_is_reported(spark):
    frame = spark.createDataFrame(AMOUNTS, "probe_label string, text string").select(
        F.col("text").cast("decimal(38,9)").alias("gross_amount")
    )
    report = checks.precision_profile(frame, ["gross_amount"], 14, 2).first()
    assert (report.column_name, report.filled, report.changed) == ("gross_amount", 4, 2)


def test_negative_zero_inside_nested_values_is_normalized(spark, table_path):
    contract = probe_contract("driver_id string, gps gps")
    frame = spark.sql(
        "SELECT 'd' driver_id, named_struct('lat', double('-0.0'), 'lon', 1.5D) gps, date'2024-01-30' load_date "
        "UNION ALL SELECT 'none', NULL, date'2024-01-30'"
    )
    write_table(frame, table_path, contract)
    rows = {r.driver_id: r for r in read_table(spark, table_path, contract).selectExpr(
        "driver_id", "gps", "string(gps.lat) lat").collect()}
    assert rows["d"].lat == "0.0" and rows["d"].gps.lon == 1.5
    assert rows["none"].gps is None
