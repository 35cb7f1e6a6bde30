"""Sessions from raw hits.

A hit opens a new session of its (view, user) when it is the user's first or
comes at least ``gap`` after the previous one.  A running window over hits
would put all hits of one user, a crawler say, into one task.  Instead time is
cut into slots as long as the gap: two hits of a user in one slot are closer
than the gap, so a slot never contains a session border, and hits can be
combined per (view, user, slot) by an ordinary aggregation before and after
the shuffle.  Only slots are put in order, and a user has at most
``history / gap`` of them however many hits were made.

Hits need a view, a user and a time; hits without one belong to no session.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from trafficlens.functions.calendar import as_date
from trafficlens.functions.numbers import ratio

# Fixed value: the customary inactivity limit of web sessions.
DEFAULT_GAP = timedelta(minutes=30)

# The user comes first: sorts compare the leading key's prefix, and that one
# tells most rows apart.
USER = ("user_id", "view_id", "view_name")
SLOT = (*USER, "slot")


def _micros(interval: Column) -> Column:
    """Length of a day-time interval as whole microseconds, which sum exactly."""
    return F.call_function("div", interval, F.lit(timedelta(microseconds=1)))


def _slot(df: DataFrame, time: str, gap: timedelta) -> Column:
    kind = (
        "timestamp_ntz'0001-01-01 00:00:00'"
        if isinstance(df.schema[time].dataType, TimestampNTZType)
        else "timestamp'0001-01-01 00:00:00Z'"
    )
    return F.call_function("div", F.col(time) - F.expr(kind), F.lit(gap))


def attributable(hits: DataFrame) -> DataFrame:
    """Hits with a view, a user and a time; plain tests, which reach the reader."""
    for name in (*USER, "ts"):
        hits = hits.filter(F.col(name).isNotNull())
    return hits


def with_slot(hits: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Attributable hits with the number of their time slot."""
    return attributable(hits).withColumn("slot", _slot(hits, "ts", gap))


def hits_since(
    hits: DataFrame, start: Column | date | str, gap: timedelta = DEFAULT_GAP
) -> DataFrame:
    """The hits that decide which sessions start on or after a day.

    Whether a hit opens a session depends on the ``gap`` before it only.  So
    after this filter, which reaches the scan, every session that starts from
    ``start`` on is found exactly (drop the older starts); session numbers,
    which count from a user's first hit, are not.
    """
    since = as_date(start).cast(hits.schema["ts"].dataType) - F.lit(gap)
    recent = hits.filter(F.col("ts") >= since)
    # A store partitioned by the day of ``ts`` is pruned as well.
    if "date" in hits.columns:
        recent = recent.filter(F.col("date") >= F.to_date(since))
    return recent


def hit_slots(
    hits: DataFrame,
    gap: timedelta = DEFAULT_GAP,
    first: Sequence[str] = (),
    last: Sequence[str] = (),
) -> DataFrame:
    """Hits combined per slot: time span, count, and columns of the first and
    last hit (ordered by time, then hit id) as structs."""

    def ordered(columns: Sequence[str]) -> Column:
        return F.struct("ts", "hit_id", *columns)

    aggregates = [
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.count(F.lit(1)).alias("hits"),
    ]
    if first:
        aggregates.append(F.min(ordered(first)).alias("first_hit"))
    if last:
        aggregates.append(F.max(ordered(last)).alias("last_hit"))
    return with_slot(hits, gap).groupBy(*SLOT).agg(*aggregates)


def number_sessions(slots: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Slots with ``session_no``, counted from 1 per (view, user)."""
    # A slot is there twice if the start of it was stored by an earlier run.
    in_order = W.partitionBy(*USER).orderBy("slot", "start_ts")
    idle = F.col("start_ts") - F.lag("end_ts").over(in_order)
    opens = F.when(idle < F.lit(gap), 0).otherwise(1)
    return slots.withColumn("__opens", opens).select(
        *slots.columns,
        F.sum("__opens")
        .over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
        .alias("session_no"),
    )


def slots_of_sessions(sessions: DataFrame, gap: timedelta) -> DataFrame:
    """Sessions as slots that later slots may continue."""
    return sessions.withColumn("slot", _slot(sessions, "start_ts", gap))


def join_slots(slots: DataFrame, gap: timedelta) -> DataFrame:
    """Sessions of slots: start, end, hits and, if kept, the first hit."""
    aggregates = [
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("hits").alias("hits"),
    ]
    if "first_hit" in slots.columns:
        aggregates.append(F.min("first_hit").alias("first_hit"))
    numbered = number_sessions(slots, gap)
    return numbered.groupBy(*USER, "session_no").agg(*aggregates).drop("session_no")


def sessionize(
    hits: DataFrame,
    gap: timedelta = DEFAULT_GAP,
    first: Sequence[str] = (),
    last: Sequence[str] = (),
) -> DataFrame:
    """One row per session: number, start, end and hits, plus columns taken
    from its first hit (under their own names) and its last hit (``last_*``).

    The final grouping is by the user's window partitioning, so it adds no
    shuffle.
    """
    slots = number_sessions(hit_slots(hits, gap, first, last), gap)
    aggregates = [
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("hits").alias("hits"),
    ]
    if first:
        aggregates.append(F.min_by("first_hit", "slot").alias("first_hit"))
    if last:
        aggregates.append(F.max_by("last_hit", "slot").alias("last_hit"))
    sessions = slots.groupBy(*USER, "session_no").agg(*aggregates)
    return sessions.select(
        *USER,
        "session_no",
        "start_ts",
        "end_ts",
        "hits",
        *[F.col(f"first_hit.{c}").alias(c) for c in first],
        *[F.col(f"last_hit.{c}").alias(f"last_{c}") for c in last],
    )


def tag_hits(hits: DataFrame, gap: timedelta = DEFAULT_GAP) -> DataFrame:
    """Every attributable hit with the number of its session.

    Joined by slot, so a busy user's hits are spread over the slots and
    adaptive execution may split a slot further.
    """
    numbers = number_sessions(hit_slots(hits, gap), gap).select(*SLOT, "session_no")
    return with_slot(hits, gap).join(numbers, [*SLOT]).drop("slot")


def session_metrics(sessions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sessions, users, durations and ratios per group of session columns.

    A session is new when it is its user's first.  Sessions are first combined
    per user, which both counts distinct users and keeps the final groups
    small before their shuffle.
    """
    length = _micros(F.col("end_ts") - F.col("start_ts"))
    user = [c for c in USER if c not in by]
    per_user = sessions.groupBy(*by, *user).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("hits").alias("hits"),
        F.sum(length).alias("micros"),
        F.count_if(F.col("session_no") == 1).alias("new"),
    )
    n = F.sum("n").cast("double")
    duration = F.sum("micros") / 1e6
    return per_user.groupBy(*by).agg(
        n.alias("sessions"),
        F.count(F.lit(1)).cast("double").alias("users"),
        duration.alias("sessionDuration"),
        ratio(duration, n).alias("avgSessionDuration"),
        ratio(F.sum("hits").cast("double"), n).alias("pageviewsPerSession"),
        ratio(F.sum("new") * F.lit(100.0), n).alias("percentNewSessions"),
    )


def daily_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions and users per view and day of the session's start."""
    dated = sessions.withColumn("date", F.to_date("start_ts"))
    return session_metrics(dated, ("view_id", "view_name", "date")).select(
        "date", "sessions", "users", "view_id", "view_name"
    )


def monthly_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions and per-session ratios per view and month, zero-padded."""
    dated = sessions.withColumns(
        {
            "year": F.date_format("start_ts", "yyyy"),
            "month": F.date_format("start_ts", "MM"),
        }
    )
    return session_metrics(dated, ("view_id", "view_name", "year", "month")).select(
        "year",
        "month",
        "sessions",
        "avgSessionDuration",
        "pageviewsPerSession",
        "percentNewSessions",
        "view_id",
        "view_name",
    )
