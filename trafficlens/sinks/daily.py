"""Day-partitioned output in which a repeated run replaces exactly its days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.calendar import as_date
from trafficlens.operators.pages import (
    SITE_NUMBER_LENGTHS,
    SITE_PAGE_PATTERN,
    site_page_counts,
    site_page_views,
)
from trafficlens.schemas import OUTPUTS, conform
from trafficlens.session import file_system

DATASET = "monitoring_location_pages"


def write_days(df: DataFrame, path: str, start: dt.date, end: dt.date) -> list[dt.date]:
    """Write the rows of ``start``..``end`` under ``path/date=...``.

    Dynamic overwrite replaces the days that have rows and keeps all others.
    The partition of a day of the range that came out empty is removed, so no
    rows of an earlier run survive.  Which days had rows is observed
    during the write itself; there are at most as many as days in the range.
    The rebalance hint lets adaptive execution size the files of each day.
    Returns the days written with rows.
    """
    rows = df.filter(F.col("date").between(as_date(start), as_date(end)))
    seen = Observation()
    (
        rows.observe(seen, F.collect_set("date").alias("days"))
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    written = sorted(seen.get["days"] or [])
    _clear_days(df.sparkSession, path, set(_days(start, end)) - set(written))
    return written


def _days(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def _clear_days(spark: SparkSession, path: str, days: set[dt.date]) -> None:
    """Remove the partitions of days; no job runs, whatever their number."""
    files, place = file_system(spark, path)
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("date=") and dt.date.fromisoformat(name[5:]) in days:
            files.delete(status.getPath(), True)


def read_days(spark, path: str) -> DataFrame:
    return conform(
        spark.read.schema(OUTPUTS[DATASET]).parquet(path), OUTPUTS[DATASET]
    )


def run_daily(
    page_views: DataFrame,
    path: str,
    start: dt.date,
    end: dt.date | None = None,
    lengths=SITE_NUMBER_LENGTHS,
    pattern: str = SITE_PAGE_PATTERN,
) -> list[dt.date]:
    """Site page counts of a range of days, one partition per day.

    The whole range is one job; the usual run passes yesterday as the only day.
    """
    end = end or start
    in_range = page_views.filter(F.col("date").between(as_date(start), as_date(end)))
    counts = site_page_counts(site_page_views(in_range, pattern), lengths)
    return write_days(conform(counts, OUTPUTS[DATASET]), path, start, end)
