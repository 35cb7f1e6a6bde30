import datetime as dt

import pytest
from conftest import day, rows

from trafficlens.operators import summary
from trafficlens.operators.periods import Period
from trafficlens.operators.sessions import sessionize

DEVICE = (
    "deviceCategory string, browser string, dayOfWeekName string, sessions double, "
    "percentNewSessions double, sessionDuration double, view_id string, view_name string, "
    "period string"
)


@pytest.fixture(scope="module")
def numbers(spark):
    df = spark.createDataFrame(
        [
            ("desktop", "Chrome", "Monday", 10.0, 50.0, 100.0, "a", "A", "7 days"),
            ("mobile", "Chrome", "Monday", 20.0, None, 200.0, "b", "B", "7 days"),
            ("desktop", "Safari", "Friday", 40.0, 25.0, 400.0, "a", "A", "30 days"),
            ("desktop", "Safari", "Friday", 99.0, 25.0, 999.0, "double", "D", "30 days"),
        ],
        DEVICE,
    )
    return summary.summary_numbers(df, ["double"])


def test_excluded_views_and_new_sessions(numbers):
    assert rows(numbers, "view_id", "period", "newSessions") == [
        ("a", "30 days", 10.0), ("a", "7 days", 5.0), ("b", "7 days", None),
    ]


def test_portfolio(numbers):
    assert rows(
        summary.portfolio_summary(numbers),
        "period", "total_sessions", "total_session_duration", "avg_session_duration",
        "new_sessions", "apps",
    ) == [("30 days", 40.0, 400.0, 10.0, 10.0, 1), ("7 days", 30.0, 300.0, 10.0, 5.0, 2)]
    by_device = summary.portfolio_summary(numbers, ["deviceCategory"])
    assert rows(by_device, "period", "deviceCategory", "total_sessions") == [
        ("30 days", "desktop", 40.0), ("7 days", "desktop", 10.0), ("7 days", "mobile", 20.0),
    ]


def test_device_report_takes_the_first_hit(spark):
    hits = spark.createDataFrame(
        [
            (1, "a", "A", 1, dt.datetime(2024, 1, 1, 10, 0), "p", "desktop", "Chrome"),
            (2, "a", "A", 1, dt.datetime(2024, 1, 1, 10, 5), "p", "mobile", "Safari"),
            (3, "a", "A", 1, dt.datetime(2024, 1, 3, 10, 5), "p", "mobile", "Safari"),
        ],
        "hit_id bigint, view_id string, view_name string, user_id bigint, ts timestamp_ntz, "
        "pagePath string, deviceCategory string, browser string",
    )
    found = sessionize(hits, first=["deviceCategory", "browser"])
    periods = [Period("early", "2024-01-01", "2024-01-02"), Period("all", "2024-01-01", "2024-01-07")]
    got = summary.device_report(found, periods)
    assert rows(got, "period", "deviceCategory", "browser", "dayOfWeekName", "sessions",
                "percentNewSessions", "sessionDuration") == [
        ("all", "desktop", "Chrome", "Monday", 1.0, 100.0, 300.0),
        ("all", "mobile", "Safari", "Wednesday", 1.0, 0.0, 0.0),
        ("early", "desktop", "Chrome", "Monday", 1.0, 100.0, 300.0),
    ]


def test_annotations_follow_view_and_fiscal_day(spark):
    traffic = spark.createDataFrame(
        [(day("2020-09-30"), "A"), (day("2020-10-01"), "A"), (day("2020-10-01"), "B")],
        "date date, view_name string",
    )
    notes = spark.createDataFrame(
        [("A", day("2020-10-01"), "launch"), ("A", day("2020-10-01"), "talk")],
        "view_name string, event_date date, text string",
    )
    got = summary.annotate_traffic(traffic, notes)
    assert rows(got, "date", "view_name", "fiscal_year", "day_of_fiscal_year", "text") == [
        (day("2020-09-30"), "A", day("2020-01-01"), 365, None),
        (day("2020-10-01"), "A", day("2021-01-01"), 0, "launch"),
        (day("2020-10-01"), "A", day("2021-01-01"), 0, "talk"),
        (day("2020-10-01"), "B", day("2021-01-01"), 0, None),
    ]
