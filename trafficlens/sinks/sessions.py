"""Sessions stored run by run, each run reading only the hits since the last.

A store holds three tables, each in a folder per run (``run=<end>``), so that a
repeated run replaces exactly its own rows:

``closed``  sessions that no later hit can continue
``open``    sessions whose last hit is less than the gap before the run's end
``firsts``  the start of the first session ever, of users seen first in this run

The next run takes the open sessions as slots of their own and puts the new hits'
slots behind them, so a session is found whole however many runs it spans.  A
session is its user's first if it starts when ``firsts`` says; no run reads the
hits, or the sessions, of the history.  Hits that arrive after a run that covers
their time are not seen; the runs from that time on have to be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.operators.sessions import (
    DEFAULT_GAP,
    USER,
    hit_slots,
    join_slots,
    slots_of_sessions,
)
from trafficlens.session import file_system


def runs(spark: SparkSession, root: str) -> list[dt.datetime]:
    """Ends of the stored runs, oldest first."""
    files, place = file_system(spark, f"{root}/open")
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(_end(n.removeprefix("run=")) for n in names if n.startswith("run="))


def _name(end: dt.datetime) -> str:
    return end.strftime("%Y%m%dT%H%M%S")


def _end(name: str) -> dt.datetime:
    return dt.datetime.strptime(name, "%Y%m%dT%H%M%S")


def _read(spark: SparkSession, root: str, table: str, ends: Sequence[dt.datetime]) -> DataFrame | None:
    paths = [f"{root}/{table}/run={_name(end)}" for end in ends]
    return spark.read.parquet(*paths) if paths else None


def extend_sessions(
    hits: DataFrame,
    root: str,
    until: dt.datetime,
    gap: dt.timedelta = DEFAULT_GAP,
    first: Sequence[str] = (),
) -> None:
    """Add the sessions of the hits from the last run's end up to ``until``, excluded.

    ``first`` names the columns to keep of a session's first hit; it must be the
    same for all runs of a store.
    """
    spark = hits.sparkSession
    before = [end for end in runs(spark, root) if end < until]

    def moment(at: dt.datetime) -> Column:
        return F.lit(at.isoformat(sep=" ")).cast(hits.schema["ts"].dataType)

    fresh = hits.filter(F.col("ts") < moment(until))
    if before:
        fresh = fresh.filter(F.col("ts") >= moment(before[-1]))
        if "date" in hits.columns:  # prunes a store partitioned by day
            fresh = fresh.filter(F.col("date") >= F.lit(before[-1].date()))
    slots = hit_slots(fresh, gap, first)
    carried = _read(spark, root, "open", before[-1:])
    if carried is not None:
        slots = slots.unionByName(slots_of_sessions(carried, gap))
    found = join_slots(slots, gap)
    place = f"run={_name(until)}"
    is_open = F.col("end_ts") > moment(until) - F.lit(gap)
    found.filter(is_open).write.mode("overwrite").parquet(f"{root}/open/{place}")
    found.filter(~is_open).write.mode("overwrite").parquet(f"{root}/closed/{place}")
    starts = (
        _read(spark, root, "closed", [until])
        .unionByName(_read(spark, root, "open", [until]))
        .groupBy(*USER)
        .agg(F.min("start_ts").alias("first_ts"))
    )
    known = _read(spark, root, "firsts", before)
    if known is not None:
        starts = starts.join(known.select(*USER), [*USER], "left_anti")
    starts.write.mode("overwrite").parquet(f"{root}/firsts/{place}")


def stored_sessions(spark: SparkSession, root: str) -> DataFrame:
    """All sessions of a store; ``session_no`` is 1 for a user's first, else null."""
    ends = runs(spark, root)
    if not ends:
        raise ValueError(f"no sessions are stored in {root}")
    sessions = _read(spark, root, "closed", ends).unionByName(_read(spark, root, "open", ends[-1:]))
    firsts = _read(spark, root, "firsts", ends)
    columns = [c for c in sessions.columns if c not in (*USER, "first_hit")]
    held = sessions.schema["first_hit"].dataType.names if "first_hit" in sessions.columns else []
    return sessions.join(firsts, [*USER], "left").select(
        *USER,
        F.when(F.col("start_ts") == F.col("first_ts"), 1).alias("session_no"),
        *columns,
        *[F.col(f"first_hit.{c}").alias(c) for c in held if c not in ("ts", "hit_id")],
    )
