"""Readers of the report facts and dimensions.

Every report is one stored fact keyed by view; the extraction loop over sites
becomes a date-bounded scan, and bounds given as dates reach the parquet
reader.  All readers take explicit schemas.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trafficlens import schemas
from trafficlens.functions.calendar import RunDates, as_date, month_start
from trafficlens.operators.pages import site_page_views
from trafficlens.operators.periods import Period, period_fanout


def read_fact(spark: SparkSession, path: str | list[str], fact: str) -> DataFrame:
    """A stored fact, from one location or from one location per view.

    Files of a view that lack a column read as NULL there.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schemas.FACTS[fact]).parquet(*paths)


def union_reports(reports: Iterable[DataFrame]) -> DataFrame:
    """Reports with differing columns stacked by name, absent ones NULL."""
    stacked = None
    for report in reports:
        stacked = (
            report
            if stacked is None
            else stacked.unionByName(report, allowMissingColumns=True)
        )
    if stacked is None:
        raise ValueError("no reports to union")
    return stacked


def between(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Rows between two dates, both included."""
    return df.filter(F.col(date_col).between(as_date(start), as_date(end)))


def daily_report(spark: SparkSession, path: str, run: RunDates) -> DataFrame:
    """Daily sessions and users of the last three years, from a quarter's start."""
    daily = read_fact(spark, path, "daily")
    return between(daily, "date", run.three_years_ago, run.yesterday)


# Fixed value: first month of the long-term history.
LONG_TERM_START = dt.date(2009, 10, 1)


def monthly_report(
    spark: SparkSession, path: str, run: RunDates, start: dt.date = LONG_TERM_START
) -> DataFrame:
    """Monthly metrics from the start of the history to the last full month."""
    month = month_start(F.col("year"), F.col("month"))
    return read_fact(spark, path, "monthly").filter(
        month.between(F.lit(start), F.lit(run.end_of_last_month))
    )


def geo_report(daily_geo: DataFrame, periods: list[Period]) -> DataFrame:
    """Sessions by region, country and period from daily geographic counts."""
    return (
        period_fanout(daily_geo, periods)
        .groupBy("region", "country", "view_id", "view_name", "period")
        .agg(F.sum("sessions").alias("sessions"))
        .select("region", "country", "sessions", "view_id", "view_name", "period")
    )


def site_page_report(
    spark: SparkSession, path: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Page views of the site-page report, restricted to candidate paths."""
    return site_page_views(
        between(read_fact(spark, path, "page_views"), "date", start, end)
    )


def read_views(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """View dimension from JSON lines, one object per view.

    With ``array`` a file is one JSON array over several lines.  A line that is
    no JSON fails the read.  Absent keys read as NULL.  ``view_id``/``view_name`` repeat the key and
    label under the names the facts use; the bot filter flag, spelled in many
    ways, becomes a nullable boolean.
    """
    views = spark.read.schema(schemas.VIEWS).json(path, multiLine=array, mode="FAILFAST")
    flag = F.upper(F.trim("botFilteringEnabled"))
    return views.withColumns(
        {
            "botFilteringEnabled": F.when(flag == "TRUE", True).when(
                flag == "FALSE", False
            ),
            "view_id": F.col("viewID"),
            "view_name": F.col("longName"),
        }
    )


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Census population file: five of its columns, by header name.

    A cell that is not of its column's type fails the read, naming its row.
    """
    raw = spark.read.option("header", True).csv(path)
    wanted = schemas.FACTS["population"].fields

    def typed(field) -> Column:
        cell = F.col(field.name)
        if field.dataType == StringType():
            return cell
        value = cell.try_cast(field.dataType)
        problem = F.concat(
            F.lit(f"population: {field.name} of "),
            F.coalesce("NAME", F.lit("a row without a name")),
            F.lit(" is no number: "),
            cell,
        )
        bad = cell.isNotNull() & value.isNull()
        return F.when(bad, F.raise_error(problem)).otherwise(value).alias(field.name)

    return raw.select(*[typed(field) for field in wanted])
