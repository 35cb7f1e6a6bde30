"""Calendar rules: year shifts, fiscal years and the dates of a report run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The zone that decides which day a report run belongs to, and
# the first month of a fiscal year (named by the calendar year it ends in).
REPORT_ZONE = "America/New_York"
FISCAL_YEAR_FIRST_MONTH = 10

_MONTHS_TO_YEAR_END = 13 - FISCAL_YEAR_FIRST_MONTH


def as_date(value: Column | dt.date | str) -> Column:
    """Accept a Column, a date or an ISO string wherever a date is expected."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def shift_years(day: Column, years: int) -> Column:
    """Same calendar day ``years`` away; NULL if that day does not exist.

    ``add_months`` clamps 29 February to the 28th, so a changed day of month is
    exactly the sign of a day the target year does not have.
    """
    shifted = F.add_months(day, 12 * years)
    return F.when(F.dayofmonth(shifted) == F.dayofmonth(day), shifted)


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, _MONTHS_TO_YEAR_END))


def january_first(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def fiscal_year_start(day: Column) -> Column:
    return F.make_date(fiscal_year(day) - 1, F.lit(FISCAL_YEAR_FIRST_MONTH), F.lit(1))


def is_leap_day(day: Column) -> Column:
    return (F.month(day) == 2) & (F.dayofmonth(day) == 29)


def month_start(year: Column, month: Column) -> Column:
    """First day of a (year, month) pair of strings; one-digit months are fine."""
    return F.to_date(F.concat_ws("-", year, month, F.lit("01")), "yyyy-M-d")


def local_date(utc_clock: Column, zone: str = REPORT_ZONE) -> Column:
    """Calendar date in ``zone`` of a UTC wall-clock timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock))


def remove_leap_days(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Drop 29 February and leave ``month`` and ``day`` columns behind."""
    day = F.col(date_col)
    return df.filter(~is_leap_day(day)).withColumns(
        {"month": F.month(day), "day": F.dayofmonth(day)}
    )


def add_calendar_years(
    df: DataFrame, date_col: str = "date", calendar_year: bool = True
) -> DataFrame:
    """Add ``year`` and ``fiscal_year`` as 1 January dates.

    ``year`` replaces a column of that name; ``calendar_year=False`` leaves it
    alone, as the monthly output does with its string year.
    """
    day = F.col(date_col)
    columns = {"fiscal_year": january_first(fiscal_year(day))}
    if calendar_year:
        columns = {"year": F.to_date(F.trunc(day, "year")), **columns}
    return df.withColumns(columns)


def years_back(day: Column, years: int) -> Column:
    """The same day ``years`` earlier; for 29 February, 28 February.

    The one rule for the start of report windows, so that a run on a leap day
    has all its periods.  Comparisons of days (:func:`shift_years`) have no such
    fallback.
    """
    return F.coalesce(shift_years(day, -years), F.add_months(day, -12 * years))


def run_date_columns(run_date: Column) -> dict[str, Column]:
    """Every date a report run needs, as expressions over its run date."""
    yesterday = F.date_sub(run_date, 1)
    fy_start = fiscal_year_start(yesterday)
    return {
        "run_date": run_date,
        "three_years_ago": F.trunc(years_back(run_date, 3), "quarter"),
        "one_year_ago": years_back(run_date, 1),
        "end_of_last_month": F.date_sub(F.trunc(run_date, "month"), 1),
        "thirty_days_ago": F.date_sub(run_date, 30),
        "seven_days_ago": F.date_sub(run_date, 7),
        "yesterday": yesterday,
        "current_fiscal_year": fiscal_year(yesterday),
        "fiscal_year_start": fy_start,
        "days_into_fiscal_year": F.datediff(run_date, fy_start),
    }


def run_dates(df: DataFrame, clock_col: str, zone: str = REPORT_ZONE) -> DataFrame:
    """Run dates of every UTC clock reading in ``df`` (one output row per row)."""
    run_date = local_date(F.col(clock_col), zone)
    columns = run_date_columns(run_date)
    return df.select(clock_col, *[c.alias(name) for name, c in columns.items()])


@dataclass(frozen=True)
class RunDates:
    """Run dates as driver-side values, so that scans get literal bounds."""

    run_date: dt.date
    three_years_ago: dt.date
    one_year_ago: dt.date
    end_of_last_month: dt.date
    thirty_days_ago: dt.date
    seven_days_ago: dt.date
    yesterday: dt.date
    current_fiscal_year: int
    fiscal_year_start: dt.date
    days_into_fiscal_year: int


def resolve_run_dates(
    spark: SparkSession, now: dt.datetime, zone: str = REPORT_ZONE
) -> RunDates:
    """Evaluate :func:`run_date_columns` for one run at ``now``.

    ``now`` is an aware datetime, or a naive one read as UTC.  The expression
    is constant, so Catalyst folds it and no Spark job runs.
    """
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    clock = F.to_timestamp_ntz(F.lit(now.strftime("%Y-%m-%d %H:%M:%S")))
    columns = run_date_columns(local_date(clock, zone))
    row = spark.sql("SELECT 1").select(
        *[c.alias(name) for name, c in columns.items()]
    ).first()
    return RunDates(**{f.name: row[f.name] for f in fields(RunDates)})
