import datetime as dt
import json

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens import schemas
from trafficlens.__main__ import main
from trafficlens.functions.calendar import resolve_run_dates
from trafficlens.plans import jobs
from trafficlens.sinks.daily import read_days
from trafficlens.sources.readers import read_views


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Hits of three users over 40 days up to the day of the run, and geography."""
    root = str(tmp_path_factory.mktemp("facts"))
    start = "timestamp_ntz'2021-04-11 12:00:00'"
    hits = spark.range(0, 41 * 3).select(
        F.col("id").alias("hit_id"),
        F.lit("a").alias("view_id"),
        F.lit("A").alias("view_name"),
        (F.col("id") % 3).alias("user_id"),
        F.expr(f"{start} + make_dt_interval(int(id div 3))").alias("ts"),
        F.lit("/p").alias("pagePath"),
        F.lit(1.0).alias("load_ms"),
        F.lit(1.0).alias("download_ms"),
        F.lit(1.0).alias("dom_ms"),
        F.lit("desktop").alias("deviceCategory"),
        F.lit("Chrome").alias("browser"),
    )
    hits.write.parquet(f"{root}/hits")
    hits.select(
        F.to_date("ts").alias("date"),
        F.lit("Ohio").alias("region"),
        F.lit("United States").alias("country"),
        F.lit(1.0).alias("sessions"),
        "view_id",
        "view_name",
    ).write.parquet(f"{root}/daily_geo")
    with open(f"{root}/population.csv", "w") as out:
        out.write("REGION,DIVISION,STATE,NAME,POPESTIMATE2019\n0,0,0,United States,5\n2,3,39,Ohio,5\n")
    return root


NOW = ["--now", "2021-05-21T16:00:00"]


def test_reports_and_tables(spark, stored, tmp_path):
    out = str(tmp_path / "out")
    main(["reports", "--facts", stored, "--out", out, *NOW])
    spark.sql("CREATE DATABASE published")
    try:
        main(["declare-tables", "--out", out, "--database", "published"])
        names = [t.name for t in spark.catalog.listTables("published")]
        assert set(names) == set(schemas.OUTPUTS) - {"monitoring_location_pages"}
        # The day of the run itself is not reported.
        assert rows(
            spark.sql("SELECT min(date), max(date), sum(sessions) FROM published.three_year_traffic")
        ) == [(day("2021-04-11"), day("2021-05-20"), 120.0)]
        assert rows(
            spark.sql(
                "SELECT period, sessions, round(newSessions, 9) FROM published.summary_numbers"
                " WHERE dayOfWeekName = 'Sunday'"
            )
        ) == [
            ("30 days", 12.0, 0.0), ("365 days", 18.0, 3.0), ("7 days", 3.0, 0.0),
            ("current fiscal year", 18.0, 3.0),
        ]
        assert rows(spark.sql("SELECT sessions FROM published.landing_exit_pages")) == [(120.0,)]
        assert rows(spark.sql("SELECT pageLoadSample, exitRate FROM published.page_load")) == [
            (90.0, 100.0)
        ]
    finally:
        spark.sql("DROP DATABASE published CASCADE")


def test_views_decide_what_is_reported(spark, stored, tmp_path):
    """An id under two names is reported under both, an unlisted one not at all."""
    views = tmp_path / "views.json"
    lines = [{"longName": name, "viewID": "a"} for name in ("one", "two")]
    views.write_text("\n".join(map(json.dumps, lines)))
    out = str(tmp_path / "out")
    main(["reports", "--facts", stored, "--out", out, "--views", str(views), *NOW])
    found = spark.read.parquet(f"{out}/test/three_year_traffic")
    assert rows(found.groupBy("view_name").sum("sessions")) == [("one", 120.0), ("two", 120.0)]
    views.write_text(json.dumps({"longName": "other", "viewID": "b"}))
    run = resolve_run_dates(spark, dt.datetime(2021, 5, 21, 16))
    facts = jobs.stored_facts(spark, stored, run, read_views(spark, str(views)))
    assert facts["daily"].count() == facts["geo"].count() == 0


def test_delivered_reports_are_read(spark, stored, tmp_path):
    run = resolve_run_dates(spark, dt.datetime(2021, 5, 21, 16))
    spark.createDataFrame(
        [(day(d), 7.0, 1.0, "a", "A") for d in ("2018-03-31", "2021-05-20")], schemas.FACTS["daily"]
    ).write.mode("overwrite").parquet(f"{stored}/daily")
    facts = jobs.stored_facts(spark, stored, run, delivered=["daily"])
    assert rows(facts["daily"], "date", "sessions") == [(day("2021-05-20"), 7.0)]


def test_site_pages(spark, tmp_path):
    views = str(tmp_path / "views")
    spark.createDataFrame(
        [("/12345678", day(f"2021-05-{d}"), 1.0, 1.0) for d in (18, 19, 20)],
        schemas.FACTS["page_views"],
    ).write.parquet(views)
    out = str(tmp_path / "out")
    main(["site-pages", "--page-views", views, "--out", out, *NOW])
    days = f"{out}/test/monitoring_location_pages"
    assert rows(read_days(spark, days), "date") == [(dt.date(2021, 5, 20),)]
    main(["site-pages", "--page-views", views, "--out", out, "--start", "2021-05-18",
          "--end", "2021-05-19"])
    assert read_days(spark, days).count() == 3
