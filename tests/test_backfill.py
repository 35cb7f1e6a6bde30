import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens.operators.backfill import backfill_months, relative_to_first

SCHEMA = (
    "year string, month string, sessions double, avgSessionDuration double, "
    "view_id string, view_name string"
)


def monthly(spark, *records):
    return spark.createDataFrame(
        [(y, m, s, a, v.lower(), v) for y, m, s, a, v in records], SCHEMA
    ).withColumn("first_of_month", F.to_date(F.concat_ws("-", "year", "month", F.lit("01"))))


def test_late_view_is_filled_and_others_left_alone(spark):
    df = monthly(
        spark,
        ("2009", "11", 5.0, None, "complete"),
        ("2009", "12", 6.0, 1.0, "complete"),
        ("2009", "10", 7.0, 1.0, "early"),
        ("2010", "02", 8.0, 2.0, "late"),
        ("2010", "03", 9.0, 3.0, "late"),
    )
    got = backfill_months(df, "2009-11-01")
    assert got.columns == [*df.columns, "backfill"]
    assert rows(got, "view_name", "first_of_month", "year", "month", "sessions", "backfill") == [
        ("complete", day("2009-11-01"), "2009", "11", 5.0, None),
        ("complete", day("2009-12-01"), "2009", "12", 6.0, None),
        ("early", day("2009-10-01"), "2009", "10", 7.0, None),
        ("late", day("2009-11-01"), "2009", "11", 8.0, True),
        ("late", day("2009-12-01"), "2009", "12", 8.0, True),
        ("late", day("2010-01-01"), "2010", "1", 8.0, True),  # no leading zero
        ("late", day("2010-02-01"), "2010", "02", 8.0, False),
        ("late", day("2010-03-01"), "2010", "03", 9.0, False),
    ]
    # The unchanged view keeps its NULL metric.
    assert got.filter("view_name = 'complete' and avgSessionDuration is null").count() == 1


def test_null_metrics_of_a_late_view_are_filled_from_the_next(spark):
    df = monthly(
        spark,
        ("2010", "01", 1.0, None, "late"),
        ("2010", "02", None, 4.0, "late"),
        ("2010", "03", 3.0, None, "late"),
    )
    got = backfill_months(df, "2009-12-01")
    assert rows(got, "first_of_month", "sessions", "avgSessionDuration", "backfill") == [
        (day("2009-12-01"), 1.0, 4.0, True),
        (day("2010-01-01"), 1.0, 4.0, False),
        (day("2010-02-01"), 3.0, 4.0, False),
        (day("2010-03-01"), 3.0, None, False),  # nothing follows
    ]


def test_same_name_under_two_ids_is_two_series(spark):
    df = monthly(spark, ("2010", "01", 1.0, 1.0, "A"), ("2010", "02", 2.0, 1.0, "A"))
    df = df.withColumn("view_id", F.col("month"))
    got = backfill_months(df, "2009-12-01")
    assert rows(got, "view_id", "month", "sessions") == [
        ("01", "01", 1.0), ("01", "12", 1.0),
        ("02", "02", 2.0), ("02", "1", 2.0), ("02", "12", 2.0),
    ]


def test_one_shuffle(spark):
    df = monthly(spark, ("2010", "01", 1.0, 1.0, "A"))
    plan = backfill_months(df, "2009-12-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_relative_to_first(spark):
    df = monthly(
        spark,
        ("2010", "01", 50.0, 1.0, "A"), ("2010", "02", 75.0, 1.0, "A"),
        ("2010", "01", 0.0, 1.0, "from zero"), ("2010", "02", 5.0, 1.0, "from zero"),
        ("2010", "05", 3.0, 1.0, "single"),
    )
    assert rows(relative_to_first(df), "view_name", "month", "percent_from_first") == [
        ("A", "01", 0.0), ("A", "02", pytest.approx(50.0)),
        ("from zero", "01", None), ("from zero", "02", None),
        ("single", "05", 0.0),
    ]
