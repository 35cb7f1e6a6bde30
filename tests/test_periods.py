import datetime as dt

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens.operators import periods
from trafficlens.operators.periods import Period

DAILY = "date date, sessions double, users double, view_id string, view_name string"


def daily(spark, *records):
    return spark.createDataFrame(
        [(day(d), s, u, v.lower(), v) for d, s, u, v in records], DAILY
    )


def test_totals_cover_n_plus_one_days_from_the_global_newest(spark):
    df = daily(
        spark,
        ("2020-01-31", 1.0, 1.0, "A"),
        ("2020-01-24", 2.0, 1.0, "A"),  # 7 days before: included
        ("2020-01-23", 4.0, 1.0, "A"),
        ("2020-01-25", 8.0, 2.0, "B"),  # B itself ends earlier
        ("2020-01-10", 16.0, 2.0, "C"),
    )
    got = rows(periods.totals_last_n_days(df, 7, "7 days"))
    assert got == [("A", "a", 3.0, 2.0, "7 days"), ("B", "b", 8.0, 2.0, "7 days")]


def test_users_are_null_if_one_is(spark):
    df = daily(
        spark,
        ("2020-01-31", 1.0, 1.0, "A"),
        ("2020-01-30", 1.0, None, "A"),
        ("2020-01-30", 1.0, None, "B"),
        ("2019-06-01", 1.0, None, "C"),
        ("2020-01-30", 1.0, 3.0, "C"),  # the NULL lies outside the week
    )
    got = rows(periods.totals_last_n_days(df, 7, "w"), "view_name", "users")
    assert got == [("A", None), ("B", None), ("C", 3.0)]


def test_multi_period_equals_single_ones(spark):
    df = daily(
        spark,
        *[
            (str(day("2020-12-31") - dt.timedelta(days=k)), float(k % 7), 1.0 if k % 5 else None, v)
            for k in range(0, 400, 3)
            for v in ("A", "B")
        ],
        ("2020-03-03", 5.0, 1.0, "only in the year"),
    )
    one_by_one = None
    for n, label in ((365, "365 days"), (30, "30 days"), (7, "7 days"), (91, "current fiscal year")):
        single = periods.totals_last_n_days(df, n, label)
        one_by_one = single if one_by_one is None else one_by_one.unionByName(single)
    together = periods.totals_multi_period(df, 91)
    assert rows(together) == rows(one_by_one)
    assert rows(periods.totals_multi_period(df, 91, as_of="2020-12-31")) == rows(together)


def test_standard_periods(spark):
    days = spark.range(1).select(
        F.explode(F.expr("sequence(date'2019-01-01', date'2021-12-31')")).alias("date")
    )
    fanned = periods.period_fanout(days, periods.standard_periods("2021-05-20"))
    got = rows(
        fanned.groupBy("period").agg(F.count("*"), F.min("date"), F.max("date"))
    )
    last = day("2021-05-19")
    assert got == [
        ("30 days", 30, day("2021-04-20"), last),
        ("365 days", 365, day("2020-05-20"), last),
        ("7 days", 7, day("2021-05-13"), last),
        ("current fiscal year", 231, day("2020-10-01"), last),
    ]


def test_fanout_of_timestamps_includes_the_last_evening(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 2, 23, 59),), (dt.datetime(2020, 1, 3, 0, 0),)],
        "ts timestamp_ntz",
    )
    got = periods.period_fanout(df, [Period("p", "2020-01-01", "2020-01-02")], "ts")
    assert got.count() == 1


# ------------------------------------------------------------ year over year


def compare(df, n=7, **kw):
    return {
        r["view_name"]: r.asDict() for r in periods.compare_to_last_year(df, n, "p", **kw).collect()
    }


def test_comparison(spark):
    df = daily(
        spark,
        ("2021-06-10", 30.0, 1.0, "A"),  # window 06-04..06-10: n days
        ("2021-06-04", 30.0, 1.0, "A"),
        ("2021-06-03", 99.0, 1.0, "A"),
        ("2020-06-04", 40.0, 1.0, "A"),
        ("2020-06-10", 10.0, 1.0, "A"),
        ("2020-06-11", 99.0, 1.0, "A"),
        ("2021-06-05", 1.0, 1.0, "late this year"),
        ("2020-06-04", 1.0, 1.0, "late this year"),
        ("2021-06-04", 1.0, 1.0, "late last year"),
        ("2020-06-04", 0.0, 1.0, "late last year"),  # no traffic: not a start
        ("2020-06-05", 1.0, 1.0, "late last year"),
        ("2021-06-04", 1.0, 1.0, "only this year"),
        ("2020-06-04", 1.0, 1.0, "only last year"),
        ("2021-05-01", 1.0, 1.0, "neither"),
    )
    got = compare(df)
    assert got["A"] == {
        "view_name": "A", "view_id": "a",
        "sessions_this_year": 60.0, "n_this_year": 2,
        "first_non_zero_date_this_year": day("2021-06-04"),
        "sessions_last_year": 50.0, "n_last_year": 2,
        "first_non_zero_date_last_year": day("2020-06-04"),
        "percent_change": pytest.approx(20.0), "period": "p",
    }
    assert got["late this year"]["percent_change"] is None
    assert got["late last year"]["percent_change"] is None
    assert got["late last year"]["n_last_year"] == 1
    this, last = got["only this year"], got["only last year"]
    assert (this["n_last_year"], this["sessions_last_year"]) == (None, None)
    assert (last["n_this_year"], last["first_non_zero_date_this_year"]) == (None, None)
    assert this["percent_change"] is None and last["percent_change"] is None
    assert "neither" not in got


def test_leap_day_inside_the_window_is_ignored(spark):
    df = daily(
        spark,
        ("2020-03-02", 1.0, 1.0, "A"), ("2020-02-29", 50.0, 1.0, "A"), ("2020-02-25", 1.0, 1.0, "A"),
        ("2019-02-25", 1.0, 1.0, "A"),
    )
    got = compare(df)["A"]
    assert (got["sessions_this_year"], got["n_this_year"]) == (2.0, 2)
    assert got["percent_change"] == pytest.approx(100.0)


@pytest.mark.parametrize("newest", ["2020-02-29", "2020-03-06"])
def test_window_bound_on_leap_day_has_no_last_year(spark, newest):
    # The first window ends, the second starts on 29 February.
    df = daily(
        spark,
        ("2020-02-28", 1.0, 1.0, "A"), ("2020-03-01", 1.0, 1.0, "A"),
        ("2019-02-28", 1.0, 1.0, "A"), ("2019-03-01", 1.0, 1.0, "A"),
    )
    got = compare(df, as_of=newest)
    assert got["A"]["sessions_last_year"] is None
    assert got["A"]["percent_change"] is None


def test_long_window_overlaps_last_year(spark):
    df = daily(
        spark,
        ("2021-06-10", 1.0, 1.0, "A"), ("2020-06-01", 2.0, 1.0, "A"), ("2019-06-01", 4.0, 1.0, "A"),
    )
    got = compare(df, n=400)["A"]
    assert got["sessions_this_year"] == 3.0
    assert got["sessions_last_year"] == 6.0


def test_all_periods_equal_single_ones(spark):
    df = daily(
        spark,
        *[
            (str(day("2021-06-10") - dt.timedelta(days=k)), float(k % 4), 1.0, v)
            for v, step in (("A", 1), ("B", 3), ("C", 11))
            for k in range(0, 800, step)
        ],
    )
    single = None
    for n, label in ((7, "7 days"), (30, "30 days"), (253, "fiscal_year")):
        part = periods.compare_to_last_year(df, n, label)
        single = part if single is None else single.unionByName(part)
    assert rows(periods.compare_all_periods(df, 253)) == rows(single)
