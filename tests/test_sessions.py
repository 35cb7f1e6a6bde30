import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trafficlens.operators import pages, sessions
from trafficlens.sources.readers import read_fact

GAP = dt.timedelta(minutes=30)
START = dt.datetime(2024, 1, 1, 23, 0)
SCHEMA = (
    "hit_id bigint, view_id string, view_name string, user_id bigint, ts timestamp_ntz, "
    "pagePath string, load_ms double, download_ms double, dom_ms double, "
    "deviceCategory string, browser string"
)


def hits(spark, *records):
    """(hit_id, user, seconds after the start, page[, load_ms])."""
    data = []
    for hit_id, user, seconds, page, *load in records:
        ms = load[0] if load else None
        ts = START + dt.timedelta(seconds=seconds)
        data.append((hit_id, "v", "V", user, ts, page, ms, ms, ms, "d", f"b{hit_id}"))
    return spark.createDataFrame(data, SCHEMA)


def brute_force(records, gap):
    """Sessions as lists of (time, hit id, page) per user, by walking the hits."""
    found = []
    for user in {r[1] for r in records}:
        mine = sorted((s, h, p) for h, u, s, p in records if u == user)
        for i, hit in enumerate(mine):
            if i == 0 or hit[0] - mine[i - 1][0] >= gap:
                found.append((user, []))
            found[-1][1].append(hit)
    return found


def random_hits(seed):
    rng = random.Random(seed)
    records, hit_id = [], 0
    for user in range(6):
        at = rng.randrange(4000)
        # User 0 is a crawler: most of the hits, many in one second.
        for _ in range(400 if user == 0 else rng.randrange(1, 40)):
            at += rng.choice([0, 0, 1, 5, 60, 1799, 1800, 1801, 3600, 9000]) if user else rng.choice([0, 0, 0, 1, 1800])
            records.append((hit_id, user, at, rng.choice("abcd")))
            hit_id += 1
    rng.shuffle(records)
    return records


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slots_find_the_sessions_of_a_walk_over_all_hits(spark, seed):
    records = random_hits(seed)
    expected = brute_force(records, 1800)
    df = hits(spark, *records)

    got = sessions.sessionize(df, GAP)
    def clock(seconds):
        return START + dt.timedelta(seconds=seconds)

    assert rows(got, "user_id", "start_ts", "end_ts", "hits") == sorted(
        (u, clock(hs[0][0]), clock(hs[-1][0]), len(hs)) for u, hs in expected
    )
    assert rows(got, "user_id", "session_no") == sorted(
        (u, n + 1)
        for u in range(6)
        for n in range(sum(1 for v, _ in expected if v == u))
    )
    paths = rows(
        pages.session_paths(df, GAP),
        "user_id", "landingPagePath", "secondPagePath", "exitPagePath",
    )
    walked = [
        (u, hs[0][2], hs[1][2] if len(hs) > 1 else None, hs[-1][2]) for u, hs in expected
    ]
    assert paths == sorted(walked, key=lambda r: tuple((v is not None, v) for v in r))

    counts = {(p, d): (u, v) for p, d, u, v in rows(pages.page_view_counts(df, GAP))}
    views, uniques = {}, {}
    for i, (_, hs) in enumerate(expected):
        for s, _, p in hs:
            key = (p, clock(s).date())
            views[key] = views.get(key, 0) + 1
            uniques.setdefault(key, set()).add(i)
    assert counts == {k: (float(len(uniques[k])), float(views[k])) for k in views}

    tagged = sessions.tag_hits(df, GAP)
    assert tagged.count() == len(records)
    assert rows(tagged.groupBy("user_id", "session_no").count(), "user_id", "count") == sorted(
        (u, len(hs)) for u, hs in expected
    )


def test_gap_at_the_threshold_opens_a_session(spark):
    df = hits(spark, (1, 1, 0, "a"), (2, 1, 1800, "a"), (3, 1, 3599, "a"))
    assert rows(sessions.sessionize(df, GAP), "session_no", "hits") == [(1, 1), (2, 2)]


def test_sessions_equal_built_in_session_windows(spark):
    df = hits(spark, *random_hits(6))
    # The built-in window keeps a hit exactly one gap later in the session; with
    # times in whole seconds, a second less gives the same sessions.
    window = F.session_window("ts", "1799 seconds")
    built_in = df.groupBy("user_id", window.alias("w")).agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("hits")
    )
    columns = ("user_id", "start_ts", "end_ts", "hits")
    assert rows(sessions.sessionize(df, GAP), *columns) == rows(built_in, *columns)


def test_longer_gap_gives_fewer_sessions(spark):
    df = hits(spark, *random_hits(7))
    counts = [
        sessions.sessionize(df, dt.timedelta(minutes=m)).count() for m in (1, 10, 30, 120, 600)
    ]
    assert counts == sorted(counts, reverse=True)


def test_hits_shortly_before_a_day_decide_its_sessions(spark):
    df = hits(spark, *random_hits(4))
    cut = "2024-01-02"
    columns = ("user_id", "start_ts", "landingPagePath", "secondPagePath", "exitPagePath")
    since = F.col("start_ts") >= cut
    found = pages.session_paths(sessions.hits_since(df, cut, GAP), GAP).filter(since)
    expected = rows(pages.session_paths(df, GAP).filter(since), *columns)
    assert rows(found, *columns) == expected
    assert 0 < len(expected) < pages.session_paths(df, GAP).count()


def test_hits_stored_by_day_are_pruned(spark, tmp_path):
    path = str(tmp_path / "hits")
    df = hits(spark, *random_hits(4)).withColumn("date", F.to_date("ts"))
    df.write.partitionBy("date").parquet(path)
    stored = read_fact(spark, path, "hits")
    recent = sessions.hits_since(stored, "2024-01-03", GAP)
    assert recent.filter("date < date'2024-01-02'").count() == 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "(date" in plan and ">= 2024-01-02)" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(ts,2024-01-02T23:30" in plan
    columns = ("user_id", "session_no", "hits")
    assert rows(sessions.sessionize(stored, GAP), *columns) == rows(
        sessions.sessionize(df, GAP), *columns
    )
    counts = pages.page_view_counts(stored, GAP)
    assert rows(counts, *sorted(counts.columns)) == rows(
        pages.page_view_counts(df.drop("date"), GAP), *sorted(counts.columns)
    )


def test_midnight_does_not_split(spark):
    df = hits(spark, (1, 1, 3500, "a"), (2, 1, 3700, "a"))
    assert sessions.sessionize(df, GAP).count() == 1


def test_timestamps_with_zone_work_like_clock_times(spark):
    df = hits(spark, *random_hits(5))
    zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
    columns = ("user_id", "session_no", "hits")
    assert rows(sessions.sessionize(zoned, GAP), *columns) == rows(
        sessions.sessionize(df, GAP), *columns
    )


def test_ties_are_broken_by_hit_id(spark):
    df = hits(spark, (2, 1, 0, "b"), (1, 1, 0, "a"), (3, 1, 0, "c"))
    assert rows(pages.session_paths(df, GAP), "landingPagePath", "secondPagePath", "exitPagePath") == [
        ("a", "b", "c")
    ]
    first = sessions.sessionize(df, GAP, first=["browser"], last=["browser"])
    assert rows(first, "browser", "last_browser") == [("b1", "b3")]


def test_second_page_may_lie_in_the_next_slot(spark):
    # Slots are half hours: 23:29:00 and 23:31:00 are in different ones.
    df = hits(spark, (1, 1, 1740, "a"), (2, 1, 1860, "b"), (3, 2, 0, "x"))
    assert rows(pages.session_paths(df, GAP), "landingPagePath", "secondPagePath", "exitPagePath") == [
        ("a", "b", "b"), ("x", None, "x"),
    ]


def test_hits_without_user_or_time_have_no_session(spark):
    df = hits(spark, (1, 1, 0, "a"), (2, None, 0, "a"))
    df = df.unionByName(df.filter("hit_id = 1").withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    assert rows(sessions.sessionize(df, GAP), "user_id", "hits") == [(1, 1)]


def test_metrics(spark):
    df = hits(
        spark,
        (1, 1, 0, "a"), (2, 1, 60, "a"), (3, 1, 7200, "a"),  # two sessions, one new
        (4, 2, 0, "a"),
    )
    found = sessions.sessionize(df, GAP)
    (total,) = sessions.session_metrics(found, ("view_id",)).collect()
    assert total.asDict() == {
        "view_id": "v", "sessions": 3.0, "users": 2.0, "sessionDuration": 60.0,
        "avgSessionDuration": 20.0, "pageviewsPerSession": pytest.approx(4 / 3),
        "percentNewSessions": pytest.approx(200 / 3),
    }
    assert rows(sessions.daily_metrics(found), "date", "sessions", "users") == [
        (dt.date(2024, 1, 1), 2.0, 2.0), (dt.date(2024, 1, 2), 1.0, 1.0),
    ]
    assert rows(sessions.monthly_metrics(found), "year", "month", "sessions") == [
        ("2024", "01", 3.0)
    ]


def test_page_load_metrics(spark):
    df = hits(
        spark,
        (1, 1, 0, "a", 10.0), (2, 1, 10, "b"), (3, 1, 20, "a", 30.0),
        (4, 2, 0, "b"), (5, 2, 10, "a"),
    )
    got = pages.page_load_metrics(df, GAP)
    assert rows(got, "pagePath", "pageLoadSample", "avgPageLoadTime", "exitRate") == [
        ("a", 2.0, 20.0, pytest.approx(200 / 3)),
        ("b", 0.0, None, 0.0),
    ]
    assert rows(pages.page_load(got), "pagePath") == [("a",)]
    assert rows(
        pages.landing_second_exit(pages.session_paths(df, GAP)),
        "landingPagePath", "secondPagePath", "exitPagePath", "sessions",
    ) == [("a", "b", "a", 1.0), ("b", "a", "a", 1.0)]


def test_hits_are_combined_before_every_shuffle(spark):
    """No window sees single hits, so a crawler is no single task."""
    df = hits(spark, (1, 1, 0, "a"))
    plan = sessions.sessionize(df, GAP)._jdf.queryExecution().executedPlan().toString()
    below_first_shuffle = plan[plan.rindex("Exchange"):]
    assert "partial_count" in below_first_shuffle
    assert "Window" not in below_first_shuffle
    paths = pages.session_paths(df, GAP)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in paths[paths.rindex("Exchange"):]


def test_hot_slot_is_split_when_hits_are_tagged(spark):
    """All hits of one user fall into one slot; the join divides them."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    hot = F.col("id") % 2 == 0
    df = spark.range(0, 400000, 1, 8).select(
        F.col("id").alias("hit_id"),
        F.lit("v").alias("view_id"),
        F.lit("V").alias("view_name"),
        F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("user_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 1000)").alias("ts"),
    )
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        tagged = sessions.tag_hits(df, GAP)
        assert len(tagged.collect()) == 400000
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
