"""Page-level reports: paths through a site, page counts, load times, and
counts by site numbers found in page paths."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.functions.numbers import ratio, strict_sum
from trafficlens.operators.sessions import (
    DEFAULT_GAP,
    SLOT,
    USER,
    attributable,
    hit_slots,
    number_sessions,
    sessionize,
    with_slot,
)

# Lengths of valid site numbers, and the page filter of the
# source report (runs of other lengths pass it and are removed later).
SITE_NUMBER_LENGTHS = (8, 15)
SITE_PAGE_PATTERN = "[0-9]{8,15}"


def site_page_views(page_views: DataFrame, pattern: str = SITE_PAGE_PATTERN) -> DataFrame:
    """Page views whose path may contain a site number."""
    return page_views.filter(F.col("pagePath").rlike(pattern))


def site_numbers(
    page_views: DataFrame, lengths: Sequence[int] = SITE_NUMBER_LENGTHS
) -> DataFrame:
    """Page views with traffic, one row per site number in the path.

    A site number is a maximal run of digits of an accepted length, kept as a
    string; a path that names a site twice gives two rows.
    """
    runs = F.regexp_extract_all("pagePath", F.lit("([0-9]+)"))
    accepted = F.filter(runs, lambda run: F.length(run).isin(list(lengths)))
    return page_views.filter(F.col("uniquePageviews") > 0).withColumn(
        "site_no", F.explode(accepted)
    )


def site_page_counts(
    page_views: DataFrame, lengths: Sequence[int] = SITE_NUMBER_LENGTHS
) -> DataFrame:
    """Unique page views per day and site number."""
    return (
        site_numbers(page_views, lengths)
        .groupBy("date", "site_no")
        .agg(strict_sum(F.col("uniquePageviews")).alias("uniquePageviews"))
    )


def session_paths(hits: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Start and first, second and last page of every session; no second page
    for a session of one hit.

    The second page needs the two earliest hits of a slot.  ``row_number <= 2``
    keeps two rows per group already before the shuffle, and both branches end
    up partitioned by slot, so their join does not shuffle again.
    """
    earliest = W.partitionBy(*SLOT).orderBy("ts", "hit_id")
    rank = F.col("rank")
    openings = (
        with_slot(hits, gap)
        .select(*SLOT, "pagePath", F.row_number().over(earliest).alias("rank"))
        .filter(rank <= 2)
        .groupBy(*SLOT)
        .agg(
            F.max(F.when(rank == 1, F.col("pagePath"))).alias("page_1"),
            F.max(F.when(rank == 2, F.col("pagePath"))).alias("page_2"),
        )
    )
    slots = hit_slots(hits, gap, last=["pagePath"]).join(openings, [*SLOT])
    in_order = W.partitionBy(*USER).orderBy("slot")
    goes_on = F.lead("start_ts").over(in_order) - F.col("end_ts") < F.lit(gap)
    # A slot of one hit continues with the first page of the session's next.
    second = F.when(F.col("hits") > 1, F.col("page_2")).when(
        goes_on, F.lead("page_1").over(in_order)
    )
    numbered = number_sessions(slots.withColumn("second", second), gap)
    return numbered.groupBy(*USER, "session_no").agg(
        F.min("start_ts").alias("start_ts"),
        F.min_by(F.struct("page_1", "second"), "slot").alias("opening"),
        F.max_by("last_hit.pagePath", "slot").alias("exitPagePath"),
    ).select(
        *USER,
        "session_no",
        "start_ts",
        F.col("opening.page_1").alias("landingPagePath"),
        F.col("opening.second").alias("secondPagePath"),
        "exitPagePath",
    )


def landing_second_exit(paths: DataFrame) -> DataFrame:
    """Sessions per view and (landing, second, exit) page."""
    pages = ["landingPagePath", "secondPagePath", "exitPagePath"]
    return (
        paths.groupBy(*pages, "view_id", "view_name")
        .agg(F.count(F.lit(1)).cast("double").alias("sessions"))
        .select(*pages, "sessions", "view_id", "view_name")
    )


def landing_exit_pages(paths: DataFrame) -> DataFrame:
    """The path report of all views as published: no filter, fixed columns."""
    return paths.select(
        "landingPagePath",
        "secondPagePath",
        "exitPagePath",
        "sessions",
        "view_id",
        "view_name",
    )


def page_view_counts(hits: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Page views and unique page views (distinct sessions) per page and day.

    Hits are combined per slot, page and day before anything else; the session
    number is then joined by slot, and sessions are counted after one more
    grouping instead of a distinct aggregate.
    """
    page_slots = (
        with_slot(hits, gap)
        .groupBy(*SLOT, "pagePath", F.to_date("ts").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbers = number_sessions(hit_slots(hits, gap), gap).select(*SLOT, "session_no")
    per_session = (
        page_slots.join(numbers, [*SLOT])
        .groupBy(*USER, "session_no", "pagePath", "date")
        .agg(F.sum("n").alias("n"))
    )
    return per_session.groupBy("pagePath", "date").agg(
        F.count(F.lit(1)).cast("double").alias("uniquePageviews"),
        F.sum("n").cast("double").alias("pageViews"),
    )


def page_load_metrics(hits: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Load-time sample, averages and exit rate per view and page.

    The sample is the hits with a load time.  Page views and exits meet in one
    aggregation of their union; a full join of two aggregates would shuffle
    more and need its keys merged.
    """
    page = ["pagePath", "view_id", "view_name"]
    sampled = F.col("load_ms").isNotNull()

    def total(column: str) -> list:
        in_sample = F.when(sampled, F.col(column))
        return [
            F.sum(in_sample).alias(column),
            F.count(in_sample).alias(f"{column}_n"),
        ]

    loads = (
        attributable(hits)
        .groupBy(*page)
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.count_if(sampled).alias("sample"),
            *total("load_ms"),
            *total("download_ms"),
            *total("dom_ms"),
        )
    )
    exits = (
        sessionize(hits, gap, last=["pagePath"])
        .groupBy(F.col("last_pagePath").alias("pagePath"), "view_id", "view_name")
        .agg(F.count(F.lit(1)).alias("exits"))
    )
    both = loads.unionByName(exits, allowMissingColumns=True)

    def average(column: str):
        return ratio(F.sum(column), F.sum(f"{column}_n"))

    return both.groupBy(*page).agg(
        F.sum("sample").cast("double").alias("pageLoadSample"),
        average("load_ms").alias("avgPageLoadTime"),
        average("download_ms").alias("avgPageDownloadTime"),
        average("dom_ms").alias("avgDomContentLoadedTime"),
        ratio(
            F.coalesce(F.sum("exits"), F.lit(0)) * F.lit(100.0), F.sum("views")
        ).alias("exitRate"),
    )


def page_load(load: DataFrame) -> DataFrame:
    """Pages that have at least one load-time sample."""
    return load.filter(F.col("pageLoadSample") > 0)
