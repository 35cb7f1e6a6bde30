import datetime as dt

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens.functions import calendar as cal


def dates(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "date date")


def test_shift_years_has_no_clamping(spark):
    df = dates(spark, "2020-02-29", "2021-02-28", "2021-03-01")
    got = rows(df, "date", cal.shift_years(F.col("date"), -1).alias("s"))
    assert got == [
        (day("2020-02-29"), None),
        (day("2021-02-28"), day("2020-02-28")),
        (day("2021-03-01"), day("2020-03-01")),
    ]
    four = rows(dates(spark, "2020-02-29"), cal.shift_years(F.col("date"), -4).alias("s"))
    assert four == [(day("2016-02-29"),)]


def test_calendar_and_fiscal_years_are_dates(spark):
    df = dates(spark, "2020-09-30", "2020-10-01", "2020-12-31", "2021-01-01")
    got = rows(cal.add_calendar_years(df))
    assert got == [
        (day("2020-09-30"), day("2020-01-01"), day("2020-01-01")),
        (day("2020-10-01"), day("2020-01-01"), day("2021-01-01")),
        (day("2020-12-31"), day("2020-01-01"), day("2021-01-01")),
        (day("2021-01-01"), day("2021-01-01"), day("2021-01-01")),
    ]


def test_string_year_is_kept_when_asked(spark):
    df = spark.createDataFrame([(day("2020-11-01"), "2020")], "first_of_month date, year string")
    got = rows(cal.add_calendar_years(df, "first_of_month", calendar_year=False))
    assert got == [(day("2020-11-01"), "2020", day("2021-01-01"))]


def test_remove_leap_days(spark):
    df = dates(spark, "2020-02-28", "2020-02-29", "2020-03-01")
    assert rows(cal.remove_leap_days(df)) == [
        (day("2020-02-28"), 2, 28),
        (day("2020-03-01"), 3, 1),
    ]


def test_month_start_accepts_one_and_two_digits(spark):
    df = spark.createDataFrame([("2020", "1"), ("2020", "11")], "y string, m string")
    got = rows(df, cal.month_start(F.col("y"), F.col("m")).alias("d"))
    assert got == [(day("2020-01-01"),), (day("2020-11-01"),)]


def test_run_date_is_the_eastern_day(spark):
    # 03:00 UTC is still the evening before on the east coast.
    run = cal.resolve_run_dates(spark, dt.datetime(2021, 6, 21, 3, 0))
    assert run.run_date == day("2021-06-20")
    assert run.yesterday == day("2021-06-19")
    aware = dt.datetime(2021, 6, 21, 3, 0, tzinfo=dt.timezone.utc)
    assert cal.resolve_run_dates(spark, aware) == run


def test_run_dates(spark):
    run = cal.resolve_run_dates(spark, dt.datetime(2021, 5, 20, 16, 0))
    assert run.three_years_ago == day("2018-04-01")
    assert run.one_year_ago == day("2020-05-20")
    assert run.end_of_last_month == day("2021-04-30")
    assert run.thirty_days_ago == day("2021-04-20")
    assert run.seven_days_ago == day("2021-05-13")
    assert run.current_fiscal_year == 2021
    assert run.fiscal_year_start == day("2020-10-01")
    assert run.days_into_fiscal_year == (day("2021-05-20") - day("2020-10-01")).days


@pytest.mark.parametrize(
    ("clock", "fiscal_year", "days"),
    [
        (dt.datetime(2021, 10, 1, 16), 2021, 365),  # yesterday closes the old year
        (dt.datetime(2020, 10, 1, 16), 2020, 366),
        (dt.datetime(2021, 10, 2, 16), 2022, 1),
    ],
)
def test_fiscal_year_follows_yesterday(spark, clock, fiscal_year, days):
    run = cal.resolve_run_dates(spark, clock)
    assert (run.current_fiscal_year, run.days_into_fiscal_year) == (fiscal_year, days)


def test_run_on_leap_day_starts_its_windows_on_28_february(spark):
    run = cal.resolve_run_dates(spark, dt.datetime(2024, 2, 29, 16))
    assert run.one_year_ago == day("2023-02-28")
    assert run.three_years_ago == day("2021-01-01")
