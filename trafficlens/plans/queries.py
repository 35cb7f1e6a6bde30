"""Registered queries: every operator over the sample tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.calendar import (
    add_calendar_years,
    fiscal_year_start,
    month_start,
    remove_leap_days,
    run_dates,
)
from trafficlens.operators import backfill, geo, pages, periods, sessions, summary, views
from trafficlens.plans import jobs
from trafficlens.session import shared_folder, staged
from trafficlens.sinks import daily as daily_sink
from trafficlens.sinks import sessions as session_store
from trafficlens.sources import sample
from trafficlens.sources.readers import geo_report
from trafficlens.streaming import site_counts

Query = Callable[[SparkSession, str], DataFrame]

# Reports read their stored facts several times (a splice checks its input, a
# merge appends to it).  Queries that do so store the derived fact first.

GAP = dt.timedelta(hours=6)
SPLICE = views.SpliceRule("1998-06-16", "BUILDING", "FURNITURE")
MERGES = (
    views.MergeRule("BUILD|FURN", "B+F"),
    views.MergeRule("MACH"),
    views.MergeRule("HOUSE|AUTO", "H+A"),
)
CHAINED_MERGES = (
    views.MergeRule("BUILD|FURN", "B+F"),
    views.MergeRule("^B", "names in B"),
)
LAUNCHES = (
    views.LaunchRule("BUILDING", "1996-06-01"),
    views.LaunchRule("FURNITURE", "1995-03-01"),
)
COUNTRY = geo.Country(
    name="AMERICA",
    regions=("NATION_1", "NATION_6", "NATION_11", "NATION_16", "NATION_21"),
    territory="MIDDLE EAST",
)
CONFIG = jobs.ReportConfig(
    merge_rules=MERGES,
    splice=SPLICE,
    launch_rules=LAUNCHES,
    excluded_view_ids=("v3",),
    backfill_start=dt.date(1995, 2, 1),
    country=COUNTRY,
    suppress=jobs.SuppressRule("BUILDING", "2001-09-01"),
)


def rounded(df: DataFrame, *columns: str, scale: int = 6) -> DataFrame:
    """Fix the scale of columns whose sums depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), scale) for c in columns})


def _fiscal_year_days(as_of):
    """Days from the fiscal year's start to the run date, the day after as_of."""
    day = F.lit(as_of)
    return F.datediff(F.date_add(day, 1), fiscal_year_start(day))


# ------------------------------------------------------------------ views

def _segment_views(spark, sf_dir):
    """Dimension with one id under two names and one segment left out."""
    name = F.col("c_mktsegment")
    names = F.array(name, F.when(name == "BUILDING", F.lit("BUILDING (alias)")))
    return (
        sample.table(spark, sf_dir, "customer")
        .select(name)
        .distinct()
        .filter(name != "MACHINERY")
        .select(
            F.concat(F.lit("v"), F.ascii(name).cast("string")).alias("view_id"),
            F.explode(F.array_compact(names)).alias("view_name"),
        )
    )


def tag_union_views(spark, sf_dir):
    return views.tag_union_views(
        sample.daily(spark, sf_dir),
        _segment_views(spark, sf_dir),
        "1996-01-01",
        "1999-12-31",
    )


RATIOS = ("avgSessionDuration", "pageviewsPerSession", "percentNewSessions")


def _dated_monthly(spark, sf_dir):
    return sample.monthly(spark, sf_dir).withColumn(
        "first_of_month", month_start(F.col("year"), F.col("month"))
    )


def _launched(spark, sf_dir):
    return views.drop_prelaunch(_dated_monthly(spark, sf_dir), LAUNCHES)


def _backfilled(spark, sf_dir):
    started = views.drop_first_period(_launched(spark, sf_dir))
    return backfill.backfill_months(started, "1995-02-01")


def _app_sets(spark, sf_dir):
    """Two named sets of segments that overlap in the middle of the alphabet."""
    name = F.col("view_name")
    sets = F.array(
        F.when(name < "G", F.lit("flagship")), F.when(name > "E", F.lit("portfolio"))
    )
    return (
        sample.table(spark, sf_dir, "customer")
        .select(F.col("c_mktsegment").alias("view_name"))
        .distinct()
        .select("view_name", F.explode(F.array_compact(sets)).alias("set_name"))
    )


VIEW_QUERIES: dict[str, Query] = {
    "tag_union_views": tag_union_views,
    "merge_views_daily": lambda s, d: views.merge_views_daily(sample.daily(s, d), "ALL"),
    "merge_views_monthly": lambda s, d: rounded(
        views.merge_views_monthly(sample.monthly(s, d), "ALL"), *RATIOS
    ),
    "merge_views_geo": lambda s, d: views.merge_views_geo(sample.geo(s, d), "ALL"),
    "add_sum_of_views": lambda s, d: views.add_sum_of_views(
        sample.daily(s, d), "BUILD|FURN", "daily", "B+F"
    ),
    "add_sums_of_views": lambda s, d: views.add_sums_of_views(
        sample.daily(s, d), MERGES, "daily"
    ),
    "add_sums_of_views_chained": lambda s, d: views.add_sums_of_views(
        sample.geo(s, d), CHAINED_MERGES, "geo"
    ),
    "splice_two_views_daily": lambda s, d: views.splice_two_views(
        staged(sample.dense_daily(s, d), "daily"), SPLICE, "date"
    ),
    "splice_two_views_monthly": lambda s, d: rounded(
        views.splice_two_views(
            staged(_dated_monthly(s, d), "monthly"), SPLICE, "first_of_month"
        ),
        *RATIOS,
    ),
    "drop_prelaunch": lambda s, d: rounded(_launched(s, d), *RATIOS),
    "drop_first_period": lambda s, d: rounded(
        views.drop_first_period(_dated_monthly(s, d)), *RATIOS
    ),
    "backfill_months": lambda s, d: rounded(_backfilled(s, d), *RATIOS),
    "relative_to_first": lambda s, d: rounded(
        backfill.relative_to_first(_backfilled(s, d)), *RATIOS, "percent_from_first"
    ),
    "filter_app_set": lambda s, d: views.filter_app_set(
        sample.daily(s, d), _app_sets(s, d), "flagship"
    ),
}

# --------------------------------------------------------------- calendar


def _clock_readings(spark, sf_dir):
    """Distinct order days, each at an hour that varies with the order."""
    orders = sample.table(spark, sf_dir, "orders")
    hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return orders.select((F.col("o_orderdate") + hour).alias("clock")).distinct()


def totals_last_year(spark, sf_dir):
    return periods.totals_last_n_days(
        sample.daily(spark, sf_dir),
        365,
        periods.YEAR_LABEL,
        as_of=sample.latest_order_date(spark, sf_dir),
    )


def totals_multi_period(spark, sf_dir):
    as_of = sample.latest_order_date(spark, sf_dir)
    return periods.totals_multi_period(
        sample.daily(spark, sf_dir), _fiscal_year_days(as_of), as_of
    )


def _compare(n, label) -> Query:
    def query(spark, sf_dir):
        as_of = sample.latest_order_date(spark, sf_dir)
        days = _fiscal_year_days(as_of) if n is None else n
        facts = sample.daily(spark, sf_dir)
        return rounded(
            periods.compare_to_last_year(facts, days, label, as_of), "percent_change"
        )

    return query


def period_fanout(spark, sf_dir):
    fanned = periods.period_fanout(
        sample.daily(spark, sf_dir), sample.order_periods(spark, sf_dir, fiscal=True)
    )
    return fanned.groupBy("view_id", "view_name", "period").agg(
        F.sum("sessions").alias("sessions"), F.count(F.lit(1)).alias("days")
    )


CALENDAR_QUERIES: dict[str, Query] = {
    "totals_last_n_days": totals_last_year,
    "totals_multi_period": totals_multi_period,
    "remove_leap_days": lambda s, d: remove_leap_days(sample.daily(s, d)),
    "compare_to_last_year_7d": _compare(7, periods.WEEK_LABEL),
    "compare_to_last_year_30d": _compare(30, periods.MONTH_LABEL),
    "compare_to_last_year_fy": _compare(None, periods.FISCAL_YEAR_CHANGE_LABEL),
    "add_calendar_years": lambda s, d: add_calendar_years(sample.daily(s, d)),
    "run_dates": lambda s, d: run_dates(_clock_readings(s, d), "clock"),
    "period_fanout": period_fanout,
}

# -------------------------------------------------------------------- geo


def _shares(spark, sf_dir):
    population = geo.population_share(sample.population(spark, sf_dir))
    report = staged(sample.geo(spark, sf_dir), "geo")
    return geo.state_traffic_share(report, population, COUNTRY)


def _suppressed(spark, sf_dir):
    return geo.suppress_until(
        geo.week_vs_year(sample.geo(spark, sf_dir), COUNTRY.name),
        "BUILDING",
        "week_percent_from_average",
        "2001-09-01",
        sample.latest_order_date(spark, sf_dir),
    )


LEAP_DAY = dt.date(2000, 2, 29)
SHARE_RATIOS = ("pop_pct", "sessions_pct", "sessions_population_ratio")
WEEK_RATIOS = ("week_over_year", "weekly_average", "week_percent_from_average")

GEO_QUERIES: dict[str, Query] = {
    "geo_report": lambda s, d: sample.geo(s, d),
    "geo_report_leap_day": lambda s, d: geo_report(
        sample.daily_geo(s, d), periods.standard_periods(LEAP_DAY, fiscal=False)
    ),
    "population_share": lambda s, d: rounded(
        geo.population_share(sample.population(s, d)), "pop_pct"
    ),
    "state_traffic_share": lambda s, d: rounded(_shares(s, d), *SHARE_RATIOS),
    "regionality": lambda s, d: rounded(
        geo.regionality(_shares(s, d)), "region_metric_all"
    ),
    "week_vs_year": lambda s, d: rounded(
        geo.week_vs_year(sample.geo(s, d), COUNTRY.name), *WEEK_RATIOS
    ),
    "suppress_until": lambda s, d: rounded(_suppressed(s, d), *WEEK_RATIOS),
}

# --------------------------------------------------------- hits and pages

DIMENSIONS = ("deviceCategory", "browser")


def _device(spark, sf_dir):
    run_date = sample.latest_event_date(spark, sf_dir) + dt.timedelta(days=1)
    return summary.device_report(
        sessions.sessionize(sample.hits(spark, sf_dir), GAP, first=DIMENSIONS),
        periods.standard_periods(run_date),
    )


def _summary(spark, sf_dir):
    return summary.summary_numbers(_device(spark, sf_dir), CONFIG.excluded_view_ids)


def _portfolio(*by: str) -> Query:
    def query(spark, sf_dir):
        totals = summary.portfolio_summary(_summary(spark, sf_dir), by)
        return rounded(
            rounded(totals, "total_session_duration"),
            "avg_session_duration",
            "new_sessions",
            scale=3,
        )

    return query


METRIC_RATIOS = (
    "sessionDuration",
    "avgSessionDuration",
    "pageviewsPerSession",
    "percentNewSessions",
)
LOAD_RATIOS = (
    "avgPageLoadTime",
    "avgPageDownloadTime",
    "avgDomContentLoadedTime",
    "exitRate",
)


def _session_metrics(*by: str) -> Query:
    def query(spark, sf_dir):
        found = sessions.sessionize(sample.hits(spark, sf_dir), GAP, first=DIMENSIONS)
        return rounded(sessions.session_metrics(found, by), *METRIC_RATIOS)

    return query


def _load(spark, sf_dir):
    return pages.page_load_metrics(sample.hits(spark, sf_dir), GAP)


# Ends of three runs, one of them within sessions.
RUN_ENDS = (
    dt.datetime(2024, 1, 9),
    dt.datetime(2024, 1, 17, 12, 34, 56),
    dt.datetime(2030, 1, 1),
)


def sessions_in_runs(spark, sf_dir):
    """Sessions stored in three runs, each from the hits since the one before."""
    store = shared_folder(spark, "session-store")
    hits = sample.hits(spark, sf_dir)
    for end in RUN_ENDS:
        session_store.extend_sessions(hits, store, end, GAP)
    return session_store.stored_sessions(spark, store).withColumn(
        "session_no", F.coalesce("session_no", F.lit(0)).cast("long")
    )


HIT_QUERIES: dict[str, Query] = {
    "sessionize": lambda s, d: sessions.sessionize(sample.hits(s, d), GAP),
    "sessions_in_runs": sessions_in_runs,
    "tag_hits": lambda s, d: sessions.tag_hits(sample.hits(s, d), GAP).select(
        "hit_id", "view_id", "user_id", "session_no"
    ),
    "session_metrics": _session_metrics("view_id", "view_name"),
    "session_metrics_by_device": _session_metrics("view_id", "view_name", "deviceCategory"),
    "daily_metrics": lambda s, d: sessions.daily_metrics(
        sessions.sessionize(sample.hits(s, d), GAP)
    ),
    "monthly_metrics": lambda s, d: rounded(
        sessions.monthly_metrics(sessions.sessionize(sample.hits(s, d), GAP)), *RATIOS
    ),
    "session_paths": lambda s, d: pages.session_paths(sample.hits(s, d), GAP),
    "landing_exit_pages": lambda s, d: pages.landing_exit_pages(
        pages.landing_second_exit(pages.session_paths(sample.hits(s, d), GAP))
    ),
    "page_view_counts": lambda s, d: pages.page_view_counts(sample.hits(s, d), GAP),
    "page_load_metrics": lambda s, d: rounded(_load(s, d), *LOAD_RATIOS),
    "page_load": lambda s, d: rounded(pages.page_load(_load(s, d)), *LOAD_RATIOS),
    "device_report": lambda s, d: rounded(
        _device(s, d), "percentNewSessions", "sessionDuration"
    ),
    "summary_numbers": lambda s, d: rounded(
        _summary(s, d), "percentNewSessions", "sessionDuration", "newSessions"
    ),
    "portfolio_summary": _portfolio(),
    "sessions_by_day_of_week": _portfolio("dayOfWeekName"),
    "sessions_by_device": _portfolio("deviceCategory"),
    "sessions_by_browser": _portfolio("browser"),
}

# ------------------------------------------------------------ site pages

URL_LENGTHS = (2, 3)
TEXT_LENGTHS = (8, 16)
DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 7))


def daily_site_partitions(spark, sf_dir):
    """Write a week in one job, run its third day again, read everything back."""
    facts = sample.page_views(spark, sf_dir)
    path = shared_folder(spark, "site-days")
    first, last = DAYS
    again = first + dt.timedelta(days=2)
    for start, end in ((first, last), (again, again)):
        daily_sink.run_daily(facts, path, start, end, URL_LENGTHS, "[0-9]{2,3}")
    return daily_sink.read_days(spark, path)


def streaming_site_page_counts(spark, sf_dir):
    """Stream the page files through the counts and read the newest totals.

    The pattern matches the table itself, be it one file or a folder of files.
    """
    stream = (
        site_counts.state_session(spark)
        .readStream.schema(sample.SCHEMAS["pages"])
        .parquet(f"{sf_dir}/pages.parque[t]")
    )
    counts = site_counts.streaming_site_page_counts(
        sample.page_views_of(stream), URL_LENGTHS, lateness="7 days"
    )
    log = shared_folder(spark, "site-log")
    query = site_counts.start_counts(counts, log, shared_folder(spark, "site-checkpoint"))
    query.awaitTermination()
    return site_counts.current_counts(spark, log)


PAGE_QUERIES: dict[str, Query] = {
    "site_page_views": lambda s, d: pages.site_page_views(
        sample.page_views(s, d), "[0-9]{2,3}"
    ),
    "site_page_counts": lambda s, d: pages.site_page_counts(
        sample.page_views(s, d), URL_LENGTHS
    ),
    "site_text_counts": lambda s, d: pages.site_page_counts(
        sample.text_views(s, d), TEXT_LENGTHS
    ),
    "daily_site_partitions": daily_site_partitions,
    "streaming_site_page_counts": streaming_site_page_counts,
}

# ------------------------------------------------------------------ jobs


def _traffic(spark, sf_dir):
    daily = staged(sample.dense_daily(spark, sf_dir), "daily")
    return jobs.three_year_traffic(daily, CONFIG)


def _from_traffic(job) -> Query:
    def query(spark, sf_dir):
        as_of = sample.latest_order_date(spark, sf_dir)
        return job(_traffic(spark, sf_dir), _fiscal_year_days(as_of), as_of)

    return query


def _states(spark, sf_dir):
    return jobs.state_traffic(sample.geo(spark, sf_dir), CONFIG)


def _job_shares(spark, sf_dir):
    states = staged(_states(spark, sf_dir), "states")
    return jobs.state_shares(states, sample.population(spark, sf_dir), CONFIG)


def _job_week(spark, sf_dir):
    return jobs.state_week_vs_year(
        jobs.state_traffic(sample.geo(spark, sf_dir), CONFIG),
        CONFIG,
        sample.latest_order_date(spark, sf_dir),
    )


JOB_QUERIES: dict[str, Query] = {
    "job_three_year_traffic": _traffic,
    "job_year_month_week": _from_traffic(jobs.year_month_week),
    "job_compared_to_last_year": lambda s, d: rounded(
        _from_traffic(jobs.compared_to_last_year)(s, d), "percent_change"
    ),
    "job_long_term_monthly": lambda s, d: rounded(
        jobs.long_term_monthly(staged(sample.monthly(s, d), "monthly"), CONFIG), *RATIOS
    ),
    "job_state_traffic": _states,
    "job_geo": lambda s, d: rounded(_job_shares(s, d), *SHARE_RATIOS),
    "job_regionality": lambda s, d: rounded(
        geo.regionality(_job_shares(s, d)), "region_metric_all"
    ),
    "job_state_week_vs_year": lambda s, d: rounded(_job_week(s, d), *WEEK_RATIOS),
    "annotate_traffic": lambda s, d: summary.annotate_traffic(
        sample.daily(s, d), sample.order_notes(s, d)
    ),
}

QUERIES: dict[str, Query] = {
    **VIEW_QUERIES,
    **CALENDAR_QUERIES,
    **GEO_QUERIES,
    **HIT_QUERIES,
    **PAGE_QUERIES,
    **JOB_QUERIES,
}
