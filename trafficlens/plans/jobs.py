"""The report pipelines: from stored facts to the published datasets.

Which sites are merged, spliced, excluded or cut at a launch date is
configuration, read from JSON; the pipelines contain no site names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.calendar import (
    RunDates,
    add_calendar_years,
    as_date,
    month_start,
    resolve_run_dates,
)
from trafficlens.operators.backfill import backfill_months
from trafficlens.operators.geo import (
    Country,
    population_share,
    regionality,
    state_traffic_share,
    suppress_until,
    week_vs_year,
)
from trafficlens.operators.pages import (
    landing_exit_pages,
    landing_second_exit,
    page_load,
    page_load_metrics,
    session_paths,
)
from trafficlens.operators.periods import (
    compare_all_periods,
    newest_day,
    standard_periods,
    totals_multi_period,
)
from trafficlens.operators.sessions import (
    DEFAULT_GAP,
    daily_metrics,
    hits_since,
    monthly_metrics,
    sessionize,
)
from trafficlens.operators.summary import device_report, summary_numbers
from trafficlens.operators.views import (
    LaunchRule,
    MergeRule,
    SpliceRule,
    add_sums_of_views,
    drop_first_period,
    drop_prelaunch,
    splice_two_views,
    tag_views,
)
from trafficlens.schemas import FACTS, OUTPUTS, conform
from trafficlens.session import delete_folder, staged
from trafficlens.sinks.daily import DATASET, run_daily
from trafficlens.sinks.datasets import dataset_path, replace_datasets, write_dataset
from trafficlens.sinks.sessions import extend_sessions, stored_sessions
from trafficlens.sources.readers import (
    daily_report,
    geo_report,
    monthly_report,
    read_fact,
    read_population,
)

# Fixed value: month to which monthly series are filled back.
BACKFILL_START = dt.date(2009, 11, 1)


@dataclass(frozen=True)
class SuppressRule:
    """The weekly deviation of a view is blank before a date."""

    view_name: str
    until: dt.date | str


@dataclass(frozen=True)
class ReportConfig:
    merge_rules: tuple[MergeRule, ...] = ()
    splice: SpliceRule | None = None
    launch_rules: tuple[LaunchRule, ...] = ()
    excluded_view_ids: tuple[str, ...] = ()
    backfill_start: dt.date = BACKFILL_START
    country: Country = field(default_factory=Country)
    suppress: SuppressRule | None = None

    @classmethod
    def from_json(cls, text: str) -> ReportConfig:
        """Build from a JSON object whose keys are the field names."""
        raw = json.loads(text)
        unknown = set(raw) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown report settings: {sorted(unknown)}")
        values: dict = {}
        for name, kind in (("merge_rules", MergeRule), ("launch_rules", LaunchRule)):
            if name in raw:
                values[name] = tuple(kind(**rule) for rule in raw[name])
        for name, kind in (
            ("splice", SpliceRule),
            ("country", Country),
            ("suppress", SuppressRule),
        ):
            if raw.get(name):
                values[name] = kind(**raw[name])
        if "excluded_view_ids" in raw:
            values["excluded_view_ids"] = tuple(raw["excluded_view_ids"])
        if "backfill_start" in raw:
            values["backfill_start"] = dt.date.fromisoformat(raw["backfill_start"])
        return cls(**values)


def traffic_history(
    facts: DataFrame, config: ReportConfig, method: str, date_col: str
) -> DataFrame:
    """Facts with the merged views added and the spliced series put in place."""
    merged = add_sums_of_views(facts, config.merge_rules, method)
    if date_col not in merged.columns:
        merged = merged.withColumn(date_col, month_start(F.col("year"), F.col("month")))
    if config.splice is None:
        return merged
    return splice_two_views(merged, config.splice, date_col)


def three_year_traffic(daily: DataFrame, config: ReportConfig) -> DataFrame:
    traffic = traffic_history(daily, config, "daily", "date")
    return conform(add_calendar_years(traffic), OUTPUTS["three_year_traffic"])


def year_month_week(
    traffic: DataFrame, fiscal_year_days: int | Column, as_of=None
) -> DataFrame:
    totals = totals_multi_period(traffic, fiscal_year_days, as_of)
    return conform(totals, OUTPUTS["year_month_week"])


def compared_to_last_year(
    traffic: DataFrame, fiscal_year_days: int | Column, as_of=None
) -> DataFrame:
    changes = compare_all_periods(traffic, fiscal_year_days, as_of)
    return conform(changes, OUTPUTS["compared_to_last_year"])


def long_term_monthly(monthly: DataFrame, config: ReportConfig) -> DataFrame:
    history = traffic_history(monthly, config, "monthly", "first_of_month")
    launched = drop_prelaunch(history, config.launch_rules)
    filled = backfill_months(drop_first_period(launched), config.backfill_start)
    dated = add_calendar_years(filled, "first_of_month", calendar_year=False)
    return conform(dated, OUTPUTS["long_term_monthly"])


def state_traffic(geo: DataFrame, config: ReportConfig) -> DataFrame:
    merged = add_sums_of_views(geo, config.merge_rules, "geo")
    return conform(merged, OUTPUTS["state_traffic"])


def state_shares(
    states: DataFrame, population: DataFrame, config: ReportConfig
) -> DataFrame:
    shares = state_traffic_share(states, population_share(population), config.country)
    return conform(shares, OUTPUTS["state_traffic_population_percentages"])


def state_week_vs_year(states: DataFrame, config: ReportConfig, today) -> DataFrame:
    compared = week_vs_year(states, config.country.name)
    if config.suppress is not None:
        compared = suppress_until(
            compared,
            config.suppress.view_name,
            "week_percent_from_average",
            config.suppress.until,
            as_date(today),
        )
    return conform(compared, OUTPUTS["state_week_vs_year"])


DIMENSIONS = ("deviceCategory", "browser")


def facts_from_hits(
    hits: DataFrame,
    run: RunDates,
    gap: dt.timedelta = DEFAULT_GAP,
    store: str | None = None,
) -> dict[str, DataFrame]:
    """The reports that a tracking service would deliver, from raw hits.

    A session is new only if it is its user's first ever.  With ``store``, a
    folder of stored sessions, they are extended by the hits since its last run
    up to the run date, and no older hit is read for them.  Without, all hits
    are sessionized and stored once for the three reports built on them.  Sessions
    belong to the day they start on.
    """
    if store is None:
        found = staged(sessionize(hits, gap, first=DIMENSIONS), "sessions")
    else:
        until = dt.datetime.combine(run.run_date, dt.time())
        extend_sessions(hits, store, until, gap, DIMENSIONS)
        found = stored_sessions(hits.sparkSession, store)
    year_ago = F.lit(run.one_year_ago)
    start = F.to_date("start_ts")
    paths = session_paths(hits_since(hits, year_ago, gap), gap).filter(
        start.between(year_ago, run.yesterday)
    )
    recent = hits_since(hits, run.thirty_days_ago, dt.timedelta(0)).filter(
        F.to_date("ts") <= run.yesterday
    )
    history = found.filter(start <= run.yesterday)
    return {
        "daily": daily_metrics(history.filter(start >= F.lit(run.three_years_ago))),
        "monthly": monthly_metrics(history.filter(start <= run.end_of_last_month)),
        "device": device_report(found, standard_periods(run.run_date)),
        "paths": landing_second_exit(paths),
        "load": page_load_metrics(recent, gap),
    }


def stored_facts(
    spark: SparkSession,
    root: str,
    run: RunDates,
    views: DataFrame | None = None,
    delivered: Collection[str] = (),
    store: str | None = None,
) -> dict[str, DataFrame]:
    """Inputs of :func:`publish_reports` from a folder of stored facts:
    ``hits``, ``daily_geo`` (parquet) and ``population.csv``.

    With ``views``, the dimension, only listed views are reported, under the
    names listed for their ids.  ``delivered`` names reports (``daily``,
    ``monthly``) that a service has stored ready made; they are read through their
    windows instead of being computed from hits.  ``store`` is a folder in which
    sessions are kept from run to run.
    """

    def listed(facts: DataFrame) -> DataFrame:
        return facts if views is None else tag_views(facts, views)

    daily_geo = spark.read.schema(FACTS["daily_geo"]).parquet(f"{root}/daily_geo")
    found = {
        **facts_from_hits(listed(read_fact(spark, f"{root}/hits", "hits")), run, store=store),
        "geo": geo_report(listed(daily_geo), standard_periods(run.run_date, fiscal=False)),
        "population": read_population(spark, f"{root}/population.csv"),
    }
    readers = {"daily": daily_report, "monthly": monthly_report}
    for name in delivered:
        found[name] = listed(readers[name](spark, f"{root}/{name}", run))
    return found


def publish_reports(
    spark: SparkSession,
    facts: Mapping[str, DataFrame],
    config: ReportConfig,
    run: RunDates,
    root: str,
    tier: str = "test",
) -> dict[str, str]:
    """Write every dataset of the dashboard and return their paths.

    ``facts`` holds ``daily``, ``monthly``, ``geo``, ``population``, ``device``,
    ``paths`` and ``load``.  Datasets that others build on are read back from
    their written files, so nothing is computed twice and no cached block can be
    lost with an executor.  All are written to a folder of this run first and
    replace the tier's after the last one succeeded.
    """
    paths = {name: dataset_path(root, tier, name) for name in OUTPUTS if name != DATASET}
    folder = f"{root.rstrip('/')}/_run-{uuid.uuid4().hex}"
    written: dict[str, str] = {}
    try:
        _write_reports(spark, facts, config, run, folder, tier, written)
        replace_datasets(spark, {paths[name]: path for name, path in written.items()})
    finally:
        delete_folder(spark, folder)
    return {name: paths[name] for name in written}


def _write_reports(
    spark: SparkSession,
    facts: Mapping[str, DataFrame],
    config: ReportConfig,
    run: RunDates,
    root: str,
    tier: str,
    written: dict[str, str],
) -> None:
    def publish(name: str, df: DataFrame) -> DataFrame:
        written[name] = write_dataset(df, root, tier, name)
        return spark.read.schema(OUTPUTS[name]).parquet(written[name])

    days = run.days_into_fiscal_year
    traffic = publish("three_year_traffic", three_year_traffic(facts["daily"], config))
    newest = newest_day(traffic)
    publish("year_month_week", year_month_week(traffic, days, newest))
    publish("compared_to_last_year", compared_to_last_year(traffic, days, newest))
    publish("long_term_monthly", long_term_monthly(facts["monthly"], config))

    states = publish("state_traffic", state_traffic(facts["geo"], config))
    shares = publish(
        "state_traffic_population_percentages",
        state_shares(states, facts["population"], config),
    )
    publish("regionality", regionality(shares))
    publish("state_week_vs_year", state_week_vs_year(states, config, run.run_date))

    publish(
        "summary_numbers", summary_numbers(facts["device"], config.excluded_view_ids)
    )
    publish("landing_exit_pages", landing_exit_pages(facts["paths"]))
    publish("page_load", page_load(facts["load"]))


def publish_site_pages(
    spark: SparkSession,
    page_views: DataFrame,
    root: str,
    now: dt.datetime,
    tier: str = "test",
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> str:
    """Add the site page counts of yesterday, or of a range to fill a gap.

    Days accumulate: only the days of the range are replaced.
    """
    yesterday = resolve_run_dates(spark, now).yesterday
    path = dataset_path(root, tier, DATASET)
    run_daily(page_views, path, start or yesterday, end or start or yesterday)
    return path
