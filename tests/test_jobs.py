import datetime as dt
import json

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens import schemas
from trafficlens.functions.calendar import resolve_run_dates
from trafficlens.operators import pages, periods, sessions, summary
from trafficlens.operators.views import LaunchRule, MergeRule, SpliceRule
from trafficlens.plans import jobs
from trafficlens.sinks.daily import read_days

CONFIG_TEXT = """
{
  "merge_rules": [{"pattern": "^A"}, {"pattern": "A one|B", "new_name": "both"}],
  "splice": {"splice_date": "2020-09-09", "fill_in": "B", "fill_with": "A two"},
  "launch_rules": [{"view_name": "A one", "launch": "2020-01-01"}],
  "excluded_view_ids": ["x"],
  "backfill_start": "2020-02-01",
  "country": {"regions": ["Ohio", "Utah"]},
  "suppress": {"view_name": "B", "until": "2021-08-14"}
}
"""
NOW = dt.datetime(2021, 5, 20, 16, 0)


@pytest.fixture(scope="module")
def config():
    return jobs.ReportConfig.from_json(CONFIG_TEXT)


def test_config(config):
    assert config.merge_rules == (MergeRule("^A"), MergeRule("A one|B", "both"))
    assert config.splice == SpliceRule("2020-09-09", "B", "A two")
    assert config.launch_rules == (LaunchRule("A one", "2020-01-01"),)
    assert config.country.territory == "Puerto Rico"
    assert jobs.ReportConfig.from_json("{}") == jobs.ReportConfig()
    assert jobs.ReportConfig().backfill_start == day("2009-11-01")
    with pytest.raises(ValueError, match="merge_rule"):
        jobs.ReportConfig.from_json(json.dumps({"merge_rule": []}))


@pytest.fixture(scope="module")
def facts(spark):
    names = spark.createDataFrame(
        [("a1", "A one", 1.0), ("a2", "A two", 2.0), ("b", "B", 4.0)],
        "view_id string, view_name string, w double",
    )
    daily = names.select(
        F.explode(F.expr("sequence(date'2018-04-01', date'2021-05-19')")).alias("date"),
        (F.col("w") * 10).alias("sessions"),
        F.col("w").alias("users"),
        "view_id",
        "view_name",
    )
    month = F.explode(F.expr("sequence(date'2020-01-01', date'2021-04-01', interval 1 month)"))
    monthly = names.select(month.alias("m"), "*").select(
        F.date_format("m", "yyyy").alias("year"),
        F.date_format("m", "MM").alias("month"),
        (F.col("w") * 100).alias("sessions"),
        F.lit(60.0).alias("avgSessionDuration"),
        F.lit(2.0).alias("pageviewsPerSession"),
        F.lit(50.0).alias("percentNewSessions"),
        "view_id",
        "view_name",
    )
    geo = names.select(
        F.explode(F.array(*map(F.lit, ("Ohio", "Utah", "Bavaria")))).alias("region"), "*"
    ).select(
        "region",
        F.when(F.col("region") == "Bavaria", "Germany").otherwise("United States").alias("country"),
        (F.col("w") * F.length("region")).alias("sessions"),
        "view_id",
        "view_name",
        F.explode(F.array(*map(F.lit, ("365 days", "30 days", "7 days")))).alias("period"),
    )
    population = spark.createDataFrame(
        [("0", "0", 0, "United States", 30), ("2", "3", 39, "Ohio", 20), ("4", "8", 49, "Utah", 10)],
        schemas.FACTS["population"],
    )
    hits = spark.createDataFrame(
        [
            (i, "x" if u == 3 else "a1", "X" if u == 3 else "A one", u,
             dt.datetime(2021, 5, 18, 9 + i % 5, 10 * (i % 3)), f"/p{i % 4}",
             float(i) if i % 2 else None, 1.0, 2.0, "desktop", "Chrome")
            for i in range(60) for u in (i % 4,)
        ],
        schemas.FACTS["hits"],
    )
    run = resolve_run_dates(spark, NOW)
    found = sessions.sessionize(hits, first=["deviceCategory", "browser"])
    return {
        "daily": daily,
        "monthly": monthly,
        "geo": geo,
        "population": population,
        "device": summary.device_report(found, periods.standard_periods(run.run_date)),
        "paths": pages.landing_second_exit(pages.session_paths(hits)),
        "load": pages.page_load_metrics(hits),
    }


@pytest.fixture(scope="module")
def published(spark, facts, config, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("reports"))
    run = resolve_run_dates(spark, NOW)
    paths = jobs.publish_reports(spark, facts, config, run, root)
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def test_all_datasets_have_their_schema(published):
    assert set(published) == set(schemas.OUTPUTS) - {"monitoring_location_pages"}
    for name, df in published.items():
        assert df.schema.simpleString() == schemas.OUTPUTS[name].simpleString(), name
        assert df.count() > 0, name


def test_history_is_merged_then_spliced(published):
    traffic = published["three_year_traffic"]
    days = (day("2021-05-19") - day("2018-04-01")).days + 1
    assert traffic.count() == 5 * days
    on = traffic.filter("date in (date'2020-09-08', date'2020-09-09')")
    assert rows(on.filter("view_name = 'B'"), "date", "sessions", "users", "view_id") == [
        (day("2020-09-08"), 20.0, 2.0, "b"), (day("2020-09-09"), 40.0, 4.0, "b"),
    ]
    # The merged view was built before the splice.
    assert rows(on.filter("view_name = 'both'"), "sessions", "users") == [(50.0, None)] * 2


def test_trailing_totals(published):
    week = published["year_month_week"].filter("period = '7 days'")
    assert rows(week, "view_name", "sessions", "users") == [
        ("A one", 80.0, 8.0), ("A two", 160.0, 16.0), ("B", 320.0, 32.0),
        ("^A", 240.0, None), ("both", 400.0, None),
    ]
    fiscal = published["compared_to_last_year"].filter("period = 'fiscal_year'")
    days = (day("2021-05-20") - day("2020-10-01")).days
    assert rows(fiscal.filter("view_name = 'A one'"), "n_this_year", "n_last_year",
                "sessions_this_year", "percent_change") == [
        (days, days, days * 10.0, pytest.approx(0.0)),
    ]


def test_monthly_history(published):
    monthly = published["long_term_monthly"]
    flags = monthly.groupBy("view_name").agg(
        F.min("first_of_month"), F.count("*"), F.count_if("backfill"), F.count("backfill")
    )
    start = day("2020-02-01")
    # Every view loses its first month; only the launched one is filled back.
    assert rows(flags) == [
        ("A one", start, 15, 1, 15), ("A two", start, 15, 0, 0), ("B", start, 15, 0, 0),
        ("^A", start, 15, 0, 0), ("both", start, 15, 0, 0),
    ]
    assert rows(monthly.filter("backfill"), "view_name", "year", "month") == [("A one", "2020", "2")]
    both = monthly.filter("view_name = 'both'").select("avgSessionDuration", "percentNewSessions")
    assert set(both.collect()) == {(60.0, 50.0)}


def test_geography(published):
    shares = published["state_traffic_population_percentages"].filter("period = '7 days'")
    assert rows(
        shares.select("region", "sessions_pct", "sessions_population_ratio").distinct()
    ) == [("Ohio", 0.5, pytest.approx(0.75)), ("Utah", 0.5, pytest.approx(1.5))]
    assert published["regionality"].count() == 5 * 3
    hidden = published["state_week_vs_year"].filter("week_percent_from_average is null")
    assert rows(hidden.select("view_name").distinct()) == [("B",)]


def test_excluded_view_is_missing_from_the_summary_only(published):
    assert published["summary_numbers"].filter("view_id = 'x'").count() == 0
    assert published["landing_exit_pages"].filter("view_id = 'x'").count() > 0
    assert published["page_load"].filter("pageLoadSample <= 0").count() == 0


def test_site_pages_default_to_yesterday_and_accumulate(spark, tmp_path):
    views = spark.createDataFrame(
        [("/12345678", day(d), float(n), 1.0) for n, d in enumerate(
            ("2021-05-17", "2021-05-18", "2021-05-19", "2021-05-20"), start=1)],
        schemas.FACTS["page_views"],
    )
    root = str(tmp_path)
    path = jobs.publish_site_pages(spark, views, root, NOW)
    assert rows(read_days(spark, path)) == [(day("2021-05-19"), "12345678", 3.0)]
    gap = {"start": day("2021-05-17"), "end": day("2021-05-18")}
    jobs.publish_site_pages(spark, views, root, NOW, **gap)
    assert rows(read_days(spark, path), "uniquePageviews") == [(1.0,), (2.0,), (3.0,)]


def test_a_failed_run_leaves_the_tier_as_it_was(spark, facts, config, tmp_path):
    root = str(tmp_path)
    run = resolve_run_dates(spark, NOW)
    paths = jobs.publish_reports(spark, facts, config, run, root)
    before = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    broken = facts["load"].withColumn("pageLoadSample", F.raise_error(F.lit("no load")).cast("double"))
    few = facts["daily"].limit(1)
    with pytest.raises(Exception, match="no load"):
        jobs.publish_reports(spark, {**facts, "daily": few, "load": broken}, config, run, root)
    assert {name: spark.read.parquet(path).count() for name, path in paths.items()} == before
    assert [p.name for p in tmp_path.iterdir()] == ["test"]
