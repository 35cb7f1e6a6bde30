"""Trailing periods: totals, fan-out to overlapping windows, year over year."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.calendar import (
    as_date,
    fiscal_year_start,
    is_leap_day,
    shift_years,
    years_back,
)
from trafficlens.functions.numbers import percent_change

DateLike = Column | dt.date | str

# Labels of the reporting periods.
YEAR_LABEL = "365 days"
MONTH_LABEL = "30 days"
WEEK_LABEL = "7 days"
FISCAL_YEAR_LABEL = "current fiscal year"
FISCAL_YEAR_CHANGE_LABEL = "fiscal_year"


def latest_date(df: DataFrame, date_col: str = "date") -> Column:
    """Newest date of all rows as a scalar subquery (one column is scanned).

    The lazy default where a caller gives no ``as_of``.  Reports over stored
    facts pass :func:`newest_day` instead: a literal bound prunes files.
    """
    return df.select(F.max(F.to_date(F.col(date_col)))).scalar()


def newest_day(df: DataFrame, date_col: str = "date") -> dt.date | None:
    """Newest date of all rows as a value, from a one-row aggregate job."""
    return df.select(F.max(F.to_date(F.col(date_col)))).first()[0]


def _as_of(df: DataFrame, as_of: DateLike | None) -> Column:
    return latest_date(df) if as_of is None else as_date(as_of)


def totals_last_n_days(
    df: DataFrame, n: int | Column, period: str, as_of: DateLike | None = None
) -> DataFrame:
    """Sessions and users per view since ``n`` days before the newest date.

    Both ends count, so the window has n + 1 days.
    """
    return _trailing_totals(df, [(period, n)], as_of)


def totals_multi_period(
    df: DataFrame, fiscal_year_days: int | Column, as_of: DateLike | None = None
) -> DataFrame:
    """Totals of the last year, month, week and fiscal year in one pass."""
    windows = [
        (YEAR_LABEL, 365),
        (MONTH_LABEL, 30),
        (WEEK_LABEL, 7),
        (FISCAL_YEAR_LABEL, fiscal_year_days),
    ]
    return _trailing_totals(df, windows, as_of)


def _trailing_totals(
    df: DataFrame, windows: Sequence[tuple[str, int | Column]], as_of: DateLike | None
) -> DataFrame:
    """Nested windows as conditional sums: one scan and one shuffle of
    one partial row per view, however many windows there are."""
    newest = _as_of(df, as_of)
    day = F.col("date")
    starts = [F.date_sub(newest, n) for _, n in windows]
    earliest = starts[0] if len(starts) == 1 else F.least(*starts)

    aggregates = []
    for i, start in enumerate(starts):
        inside = day.between(start, newest)
        rows = F.count_if(inside)
        aggregates.append(rows.alias(f"rows_{i}"))
        for metric in ("sessions", "users"):
            value = F.when(inside, F.col(metric))
            # NULL as soon as one row inside the window has no value.
            total = F.when(F.count(value) == rows, F.sum(value))
            aggregates.append(total.alias(f"{metric}_{i}"))
    wide = df.filter(day.between(earliest, newest)).groupBy("view_name", "view_id").agg(*aggregates)

    per_window = F.array(
        *[
            F.when(
                F.col(f"rows_{i}") > 0,
                F.struct(
                    F.col(f"sessions_{i}").alias("sessions"),
                    F.col(f"users_{i}").alias("users"),
                    F.lit(label).alias("period"),
                ),
            )
            for i, (label, _) in enumerate(windows)
        ]
    )
    return wide.select(
        "view_name", "view_id", F.explode(F.array_compact(per_window)).alias("t")
    ).select("view_name", "view_id", "t.sessions", "t.users", "t.period")


@dataclass(frozen=True)
class Period:
    """A labelled window of days, both ends included."""

    label: str
    start: DateLike
    end: DateLike


def standard_periods(run_date: DateLike, fiscal: bool = True) -> list[Period]:
    """The report windows ending the day before ``run_date``.

    Week and month have exactly 7 and 30 days; the year starts on the same
    calendar day last year, 28 February for a run on 29 February.  These differ from :func:`totals_multi_period`.
    """
    today = as_date(run_date)
    yesterday = F.date_sub(today, 1)
    periods = [
        Period(YEAR_LABEL, years_back(today, 1), yesterday),
        Period(MONTH_LABEL, F.date_sub(today, 30), yesterday),
        Period(WEEK_LABEL, F.date_sub(today, 7), yesterday),
    ]
    if fiscal:
        periods.append(
            Period(FISCAL_YEAR_LABEL, fiscal_year_start(yesterday), yesterday)
        )
    return periods


def period_fanout(
    facts: DataFrame, periods: Sequence[Period], date_col: str = "date"
) -> DataFrame:
    """One copy of each fact per period it falls in, labelled ``period``.

    A narrow expansion instead of one scan per overlapping window or a range
    join; rows outside all periods are filtered before it, and an aggregation
    that follows combines the copies before its shuffle.
    """
    day = F.to_date(F.col(date_col))
    inside = [day.between(as_date(p.start), as_date(p.end)) for p in periods]
    anywhere = inside[0]
    for condition in inside[1:]:
        anywhere = anywhere | condition
    labels = F.array(
        *[F.when(condition, F.lit(p.label)) for condition, p in zip(inside, periods)]
    )
    return facts.filter(anywhere).withColumn(
        "period", F.explode(F.array_compact(labels))
    )


def compare_to_last_year(
    df: DataFrame, n: int | Column, period: str, as_of: DateLike | None = None
) -> DataFrame:
    """Sessions of the last ``n`` days against the same days one year earlier.

    Window of n days (newest included); the earlier window shifts both of its
    ends by a calendar year.  Rows without traffic and leap days are ignored.
    The change is NULL unless both windows start with data on their first day.
    """
    return _compare(df, [(period, n)], as_of)


def compare_all_periods(
    df: DataFrame, fiscal_year_days: int | Column, as_of: DateLike | None = None
) -> DataFrame:
    """Week, month and fiscal year against last year, in one pass."""
    windows = [
        (WEEK_LABEL, 7),
        (MONTH_LABEL, 30),
        (FISCAL_YEAR_CHANGE_LABEL, fiscal_year_days),
    ]
    return _compare(df, windows, as_of)


def _compare(
    df: DataFrame, windows: Sequence[tuple[str, int | Column]], as_of: DateLike | None
) -> DataFrame:
    """Both sides of every window as conditional aggregates of one shuffle.

    This stands for two filtered aggregations and a full join per window; a
    row may belong to both sides when a window is longer than a year, which a
    condition per side allows and a tag per row would not.
    """
    end = _as_of(df, as_of)
    end_before = shift_years(end, -1)
    day, sessions = F.col("date"), F.col("sessions")

    anywhere, aggregates, per_window = F.lit(False), [], []
    for i, (label, n) in enumerate(windows):
        start = F.date_sub(end, n - 1)
        start_before = shift_years(start, -1)
        sides = {
            "this_year": (day.between(start, end), start),
            "last_year": (day.between(start_before, end_before), start_before),
        }
        fields = []
        for side, (inside, _) in sides.items():
            anywhere = anywhere | inside
            rows = F.count_if(inside)
            aggregates += [
                F.sum(F.when(inside, sessions)).alias(f"sessions_{side}_{i}"),
                F.when(rows > 0, rows).alias(f"n_{side}_{i}"),
                F.min(F.when(inside, day)).alias(f"first_{side}_{i}"),
            ]
            fields += [
                F.col(f"sessions_{side}_{i}").alias(f"sessions_{side}"),
                F.col(f"n_{side}_{i}").alias(f"n_{side}"),
                F.col(f"first_{side}_{i}").alias(f"first_non_zero_date_{side}"),
            ]
        late_start = (F.col(f"first_last_year_{i}") != start_before) | (
            F.col(f"first_this_year_{i}") != start
        )
        change = percent_change(
            F.col(f"sessions_this_year_{i}"), F.col(f"sessions_last_year_{i}")
        )
        fields += [
            F.when(late_start, F.lit(None)).otherwise(change).alias("percent_change"),
            F.lit(label).alias("period"),
        ]
        present = F.coalesce(F.col(f"n_this_year_{i}"), F.col(f"n_last_year_{i}"))
        per_window.append(F.when(present.isNotNull(), F.struct(*fields)))

    wide = (
        df.filter(anywhere & (sessions > 0) & ~is_leap_day(day))
        .groupBy("view_name", "view_id")
        .agg(*aggregates)
    )
    return wide.select(
        "view_name", "view_id", F.explode(F.array_compact(F.array(*per_window))).alias("c")
    ).select("view_name", "view_id", "c.*")
