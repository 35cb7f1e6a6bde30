import datetime as dt
import random

from conftest import rows

from trafficlens.operators import sessions
from trafficlens.sinks.sessions import extend_sessions, runs, stored_sessions

SCHEMA = (
    "hit_id long, view_id string, view_name string, user_id long, ts timestamp_ntz, browser string"
)
START = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)


def made(spark, seed=1):
    rng = random.Random(seed)
    found, clock = [], START
    for hit_id in range(400):
        clock += dt.timedelta(minutes=rng.choice([1, 10, 29, 30, 31, 90]))
        found.append((hit_id, "a", "A", rng.randrange(4), clock, rng.choice("xyz")))
    return spark.createDataFrame(found, SCHEMA)


def whole(hits):
    found = sessions.sessionize(hits, first=("browser",))
    return [
        (r["user_id"], r["start_ts"], r["end_ts"], r["hits"], r["browser"], r["session_no"] == 1)
        for r in found.collect()
    ]


def stored(spark, root):
    found = stored_sessions(spark, root)
    return [
        (r["user_id"], r["start_ts"], r["end_ts"], r["hits"], r["browser"], r["session_no"] == 1)
        for r in found.collect()
    ]


def test_runs_equal_one_pass_and_read_only_their_hits(spark, tmp_path):
    hits, root = made(spark), str(tmp_path / "store")
    ends = [START + DAY * n + dt.timedelta(minutes=7 * n) for n in range(1, 12)]
    for before, end in zip([START, *ends], ends):
        # Hits of earlier runs are not even there.
        extend_sessions(hits.filter(hits.ts >= before), root, end, first=("browser",))
    assert sorted(stored(spark, root)) == sorted(whole(hits.filter(hits.ts < ends[-1])))
    assert runs(spark, root) == ends
    last = hits.filter(hits.ts >= ends[-2])
    extend_sessions(last, root, ends[-1], first=("browser",))  # a repeated run
    assert sorted(stored(spark, root)) == sorted(whole(hits.filter(hits.ts < ends[-1])))


def test_run_without_hits(spark, tmp_path):
    root = str(tmp_path / "store")
    hits = made(spark)
    extend_sessions(hits.limit(0), root, START, first=("browser",))
    assert stored(spark, root) == []
    extend_sessions(hits, root, START + DAY, first=("browser",))
    extend_sessions(hits.limit(0), root, START + 2 * DAY, first=("browser",))
    assert sorted(stored(spark, root)) == sorted(whole(hits.filter(hits.ts < START + DAY)))


def test_window_of_a_run_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "hits")
    made(spark).write.parquet(path)
    hits = spark.read.parquet(path)
    plan = sessions.sessionize(hits.filter(hits.ts >= START + DAY))
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(ts" in pushed and "IsNotNull(user_id)" in pushed
    assert rows(plan, "user_id")
