"""Summary numbers by device, portfolio totals and annotated traffic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.calendar import fiscal_year, fiscal_year_start, january_first
from trafficlens.functions.numbers import ratio
from trafficlens.operators.periods import Period, period_fanout
from trafficlens.operators.sessions import session_metrics

DEVICE_DIMENSIONS = ("deviceCategory", "browser", "dayOfWeekName")


def device_report(sessions: DataFrame, periods: Sequence[Period]) -> DataFrame:
    """Session metrics by device, browser and weekday for every period.

    ``sessions`` carries the device columns of its first hit; the weekday and
    the period follow from the session's start.
    """
    dated = sessions.withColumns(
        {
            "date": F.to_date("start_ts"),
            "dayOfWeekName": F.date_format("start_ts", "EEEE"),
        }
    )
    keys = [*DEVICE_DIMENSIONS, "view_id", "view_name", "period"]
    metrics = session_metrics(period_fanout(dated, periods), keys)
    return metrics.select(
        *DEVICE_DIMENSIONS,
        "sessions",
        "percentNewSessions",
        "sessionDuration",
        "view_id",
        "view_name",
        "period",
    )


def summary_numbers(
    device: DataFrame, excluded_view_ids: Sequence[str] = ()
) -> DataFrame:
    """Device report without double-counted views, with new sessions counted."""
    kept = device
    if excluded_view_ids:
        view_id = F.col("view_id")
        kept = device.filter(
            view_id.isNull() | ~view_id.isin(list(excluded_view_ids))
        )
    return kept.withColumn(
        "newSessions", F.col("percentNewSessions") * 0.01 * F.col("sessions")
    )


def portfolio_summary(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals over all views per period, optionally by further dimensions.

    The views are counted after a grouping by view, whose partial sums already
    shrink the data, rather than by a distinct aggregate over all rows.
    """
    keys = ["period", *by]
    per_view = summary.groupBy(*keys, "view_name", "view_id").agg(
        F.sum("sessions").alias("sessions"),
        F.sum("sessionDuration").alias("duration"),
        F.sum("newSessions").alias("new"),
    )
    return per_view.groupBy(*keys).agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("duration").alias("total_session_duration"),
        ratio(F.sum("duration"), F.sum("sessions")).alias("avg_session_duration"),
        F.sum("new").alias("new_sessions"),
        F.count(F.lit(1)).alias("apps"),
    )


def annotate_traffic(traffic: DataFrame, annotations: DataFrame) -> DataFrame:
    """Daily traffic with the events noted for the same view and day.

    Days are matched by fiscal year and by their offset in it, the axis on
    which the dashboards lay fiscal years over each other.
    """
    keys = ["view_name", "fiscal_year", "day_of_fiscal_year"]

    def on_fiscal_axis(df: DataFrame, date_col: str) -> DataFrame:
        day = F.col(date_col)
        return df.withColumns(
            {
                "fiscal_year": january_first(fiscal_year(day)),
                "day_of_fiscal_year": F.datediff(day, fiscal_year_start(day)),
            }
        )

    notes = on_fiscal_axis(annotations, "event_date").select(*keys, "text")
    return on_fiscal_axis(traffic, "date").join(notes, keys, "left")
