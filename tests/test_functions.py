from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from yieldmill.functions import exprs, prodtime, spc
from yieldmill.sources.jdbc import JdbcSplit, jdbc_options, read_jdbc


def stamps(spark, *texts):
    rows = [(text,) for text in texts]
    return spark.createDataFrame(rows, "t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))


START = {
    "2024-03-05 06:59:59": "2024-03-04 07:00:01",
    "2024-03-05 07:00:00": "2024-03-04 07:00:01",
    "2024-03-05 07:00:00.000001": None,
    "2024-03-05 07:00:00.500": None,
    "2024-03-05 07:00:00.999999": None,
    "2024-03-05 07:00:01": "2024-03-05 07:00:01",
    "2024-03-05 23:59:59": "2024-03-05 07:00:01",
    "2024-03-05 00:00:00": "2024-03-04 07:00:01",
}


def test_production_start_drops_the_gap(spark):
    df = stamps(spark, *START)
    got = dict(values(df, "t", prodtime.production_start("ts").cast("string")))
    assert got == START


def test_production_start_counts_the_gap_to_the_next_day(spark):
    df = stamps(spark, *START, None)
    got = dict(df.select("t", prodtime.production_start("ts", "next").cast("string")).collect())
    expected = {text: start or "2024-03-05 07:00:01" for text, start in START.items()}
    assert got == {**expected, None: None}
    with pytest.raises(ValueError):
        prodtime.production_start("ts", "other")


def test_production_date_by_hour(spark):
    df = stamps(spark, "2024-03-05 06:59:59.9", "2024-03-05 07:00:00")
    got = values(df, prodtime.production_date("ts"))
    assert got == [(date(2024, 3, 4),), (date(2024, 3, 5),)]


def test_windows():
    assert prodtime.production_window(date(2024, 3, 5)) == (
        datetime(2024, 3, 4, 7, 0, 1),
        datetime(2024, 3, 5, 7, 0, 0),
    )
    assert prodtime.span_window(date(2024, 3, 1), date(2024, 3, 5))[0] == datetime(
        2024, 3, 1, 7, 0, 1
    )


def test_incremental_excludes_watermark_and_current_minute(spark):
    df = stamps(spark, "2024-03-05 10:00:00", "2024-03-05 10:00:01", "2024-03-05 10:05:00")
    df = df.unionByName(stamps(spark, "2024-03-05 10:05:30"))
    as_of, mark = datetime(2024, 3, 5, 10, 5, 45), datetime(2024, 3, 5, 10, 0, 0)
    assert df.filter(prodtime.incremental("ts", mark, as_of)).count() == 2
    assert df.filter(prodtime.incremental("ts", None, as_of)).count() == 3


def test_labels(spark):
    df = spark.createDataFrame([(date(2024, 1, 9), "2024", "Q3")], "d date, y string, q string")
    row = df.select(
        prodtime.month_label(F.col("d"), F.col("y")), prodtime.quarter_digit(F.col("q"))
    ).first()
    assert tuple(row) == ("24JAN", "3")


def test_valid_move(spark):
    rows = [(None, 1), (0, 1), (10, -1), (10, 0), (10, None), (10, 5)]
    df = spark.createDataFrame(rows, "INPUT int, OUTPUT int")
    assert values(df.filter(exprs.valid_move())) == [(10, 0), (10, 5)]


def test_differs_or_null(spark):
    df = spark.createDataFrame([("PSUDO",), (None,), ("x",)], "a string")
    assert values(df.filter(exprs.differs_or_null("a", "PSUDO"))) == [("x",), (None,)]


def test_steady_decimal_and_text_number(spark):
    df = spark.createDataFrame([(0.00499999999999999, "abc"), (1.005, "1e1")], "x double, s string")
    got = df.select(exprs.steady_decimal(F.col("x"), 10, 2), exprs.text_number("s")).collect()
    assert [tuple(row) for row in got] == [
        (Decimal("0.01"), None),
        (Decimal("1.01"), Decimal("10.00")),
    ]
    big = spark.createDataFrame([("123456789012.5",)], "s string")
    assert big.select(exprs.text_number("s")).first()[0] is None


def test_rec_id_is_repeatable_and_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    ids = df.withColumn("id", exprs.rec_id(["x", "y"]))
    first, second = values(ids, "id"), values(ids, "id")
    assert first == second and len(set(first)) == 3


def capability_row(spark, lcl, ucl, spec, mean, sigma):
    kinds = "l double, u double, spec int, m decimal(10,2), s decimal(10,2)"
    number = [None if v is None else Decimal(str(v)) for v in (mean, sigma)]
    df = spark.createDataFrame([(lcl, ucl, spec, *number)], kinds)
    cols = [F.col(name) for name in ("l", "u", "spec", "m", "s")]
    return df.select(
        spc.capability(*cols), spc.capability_between(170, 260, F.col("m"), F.col("s"))
    ).first()


@pytest.mark.parametrize(
    ("case", "cpk", "dot"),
    [
        ((None, None, None, None, None), None, None),
        ((0.0, 0.0, 0, 5, 0), None, None),
        ((0.0, 10.0, 0, 4, 0), None, None),
        ((0.0, 10.0, 0, 4, 1), "1.33", "55.33"),
        ((0.0, 10.0, 0, 8, 1), "0.67", "54.00"),
        ((2.0, 10.0, 2, 4, 0), None, None),
        ((2.0, 10.0, 2, 4, 1), "2.00", "55.33"),
        ((2.0, 10.0, 2, 12, 1), "-0.67", "52.67"),
        ((0.0, 10.0, 0, -1, 1), "-0.33", None),
        ((0.0, None, 0, 6, 1), "2.00", "54.67"),
        ((150.0, 270.0, 150, 200, 10), "2.33", "1.00"),
    ],
)
def test_capability(spark, case, cpk, dot):
    got = capability_row(spark, *case)
    assert [None if v is None else str(v) for v in got] == [cpk, dot]


def test_names_and_triggers(spark):
    rows = [
        ("dtc128", "x"),
        ("DTC149 ", " BondForceFloat"),
        ("DTC149", "BondForce"),
        ("DTC150", "PBIQUALITY"),
        ("DTC150", ""),
        ("DTC150", None),
        (None, "x"),
        ("DTC150", " dispenserpressure"),
    ]
    df = spark.createDataFrame(rows, "m string, v string")
    got = df.select(
        spc.canonical_name(F.col("v")), spc.trigger_limit(F.col("m"), F.col("v"))
    ).collect()
    assert [tuple(row) for row in got] == [
        ("x", 60),
        ("BondForceFloat", 60),
        ("BondForceFloat", 70),
        ("PbiQuality", 60),
        ("0", 70),
        ("0", 70),
        ("x", 100),
        ("DispenserPressure", 70),
    ]


def test_jdbc_options(spark):
    split = JdbcSplit("WW_ID", 1, 900, 16)
    options = jdbc_options("jdbc:x", "T", split, user="u")
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "WW_ID"
    assert options["dbtable"] == "T" and options["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "T")
    with pytest.raises(ValueError):
        JdbcSplit("a", 0, 1, 0).options()
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "T", split, ["a = 1"])
