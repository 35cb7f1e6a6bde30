"""Site page counts over a stream of page views.

Counts are updated as page views arrive.  Every micro-batch writes the new
totals of the (date, site) pairs it changed to a folder of its own, so a
repeated batch overwrites itself and no earlier file is rewritten; readers
take the newest total of each pair.  Page views later than the watermark are
dropped by the stream: ``dropped_rows`` counts them, ``short_days`` names the days
that lack some, and the batch job over those days repairs them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlens.operators.pages import SITE_NUMBER_LENGTHS, site_numbers
from trafficlens.session import delete_folder, file_system
from trafficlens.sinks.daily import write_days

SECONDS_PER_DAY = 86_400
LOGGED = "date date, site_no string, uniquePageviews double"


def streaming_site_page_counts(
    page_views: DataFrame,
    lengths: Sequence[int] = SITE_NUMBER_LENGTHS,
    lateness: str = "2 days",
) -> DataFrame:
    """Streaming counts per day and site number, for the ``update`` mode.

    In ``append`` mode the newest days would not appear before a later page
    view closes them.  The event time is midnight UTC of the day, whatever the
    session's zone, because one-day windows are aligned to UTC.
    """
    midnight = F.timestamp_seconds(F.unix_date("date") * F.lit(SECONDS_PER_DAY))
    counts = (
        site_numbers(page_views, lengths)
        .withColumn("event_time", midnight)
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", "1 day").alias("day"), "site_no")
        .agg(F.sum("uniquePageviews").alias("uniquePageviews"))
    )
    days = F.unix_seconds("day.start") / SECONDS_PER_DAY
    return counts.select(
        F.date_from_unix_date(F.floor(days).cast("int")).alias("date"),
        "site_no",
        "uniquePageviews",
    )


def state_session(spark: SparkSession) -> SparkSession:
    """A session for the stream, sharing the application but not its settings.

    One state partition per core, since every batch opens all of them, and no
    batches without data, which in ``update`` mode would only clear old state.
    """
    session = spark.newSession()
    cores = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(cores))
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return session


def start_counts(counts: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Process all available input and log the changed totals of each batch.

    The log exists from the start, also if no batch follows.
    """
    spark = counts.sparkSession
    spark.createDataFrame([], LOGGED).write.mode("overwrite").parquet(f"{log_path}/batch=-1")

    def write_changes(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_changes)
        .start()
    )


def current_counts(spark: SparkSession, log_path: str) -> DataFrame:
    """Newest total of each (date, site) in the log."""
    return _newest(_read_log(spark, log_path))


def _read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(f"{LOGGED}, batch bigint").parquet(log_path)


def _newest(log: DataFrame) -> DataFrame:
    return log.groupBy("date", "site_no").agg(
        F.max_by("uniquePageviews", "batch").alias("uniquePageviews")
    )


def compact_log(spark: SparkSession, log_path: str) -> int:
    """Fold all batches but the newest into one; returns how many went.

    The folded totals are added to the last of them before the others are
    removed, so a log that is left half-way gives the same totals.  The newest
    batch, which the stream may write again, is not touched.
    """
    files, place = file_system(spark, log_path)
    names = [s.getPath().getName() for s in files.listStatus(place)]
    batches = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    old = [n for n in batches[:-1] if n >= 0]
    if len(old) < 2:
        return 0
    folded = _newest(_read_log(spark, log_path).filter(F.col("batch") <= old[-1]))
    folded.write.mode("append").parquet(f"{log_path}/batch={old[-1]}")
    for batch in old[:-1]:
        delete_folder(spark, f"{log_path}/batch={batch}")
    return len(old) - 1


def dropped_rows(query: StreamingQuery) -> int:
    """Groups of page views that the stream left out as later than the watermark."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def short_days(counts: DataFrame, batch_counts: DataFrame) -> DataFrame:
    """Days whose streamed totals are below those of the batch job, and by how much."""
    streamed = counts.select("date", "site_no", F.col("uniquePageviews").alias("streamed"))
    missing = F.col("uniquePageviews") - F.coalesce("streamed", F.lit(0.0))
    return (
        batch_counts.join(streamed, ["date", "site_no"], "left")
        .groupBy("date")
        .agg(F.sum(missing).alias("missing"))
        .filter("missing > 0")
    )


def publish_counts(
    spark: SparkSession, log_path: str, path: str, start: dt.date, end: dt.date
) -> list[dt.date]:
    """Write the newest totals of a range of days as day partitions, the layout
    of the batch job.  Only the files of these days are replaced."""
    return write_days(current_counts(spark, log_path), path, start, end)
