"""Backfill of monthly series to a common start and change since that start."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.functions.calendar import as_date
from trafficlens.functions.numbers import percent_change

VIEW = ("view_id", "view_name")
PERIOD_COLUMNS = ("first_of_month", "year", "month", "backfill")


def backfill_months(df: DataFrame, min_date: Column | dt.date | str) -> DataFrame:
    """Start every view's monthly series at ``min_date``.

    A view that starts later gets one row per missing month, flagged
    ``backfill`` TRUE, with the metrics of the next month that has them; its
    own rows are flagged FALSE and their NULL metrics are filled the same way.
    A view that starts at ``min_date`` or before is left alone and its flag is
    NULL.  Generated months are written without a leading zero.

    Everything happens in one shuffle by view.  Walking a view's months from
    newest to oldest, ``last(ignorenulls)`` over the rows so far is the next
    known value, and the oldest row is expanded into the missing months.  A
    group holds one view's months, so its size follows the calendar.
    """
    target = as_date(min_date)
    month = F.col("first_of_month")
    by_view = W.partitionBy(*VIEW)
    backwards = by_view.orderBy(month.desc())
    so_far = backwards.rowsBetween(W.unboundedPreceding, W.currentRow)

    metrics = [c for c in df.columns if c not in (*VIEW, *PERIOD_COLUMNS)]
    marked = df.withColumns(
        {
            "__start": F.min(month).over(by_view),
            "__oldest": F.lead(F.lit(True), 1, False).over(backwards),
            **{
                f"__next_{c}": F.last(c, ignorenulls=True).over(so_far) for c in metrics
            },
        }
    ).withColumns(
        {
            "__short": F.col("__start") > target,
            "__oldest": ~F.col("__oldest"),
        }
    )
    one_month = F.expr("interval 1 month")
    months = F.when(
        F.col("__short") & F.col("__oldest"),
        F.sequence(target, month, one_month),
    ).otherwise(F.array(month))
    generated = F.col("__month") < month
    return marked.withColumn("__month", F.explode(months)).select(
        *[
            _backfilled(c, metrics, generated).alias(c)
            for c in df.columns
            if c != "backfill"
        ],
        F.when(F.col("__short"), generated).alias("backfill"),
    )


def _backfilled(name: str, metrics: list[str], generated: Column) -> Column:
    if name == "first_of_month":
        return F.col("__month")
    if name in ("year", "month"):
        part = F.year if name == "year" else F.month
        return F.when(generated, part("__month").cast("string")).otherwise(F.col(name))
    if name in metrics:
        return F.when(F.col("__short"), F.col(f"__next_{name}")).otherwise(F.col(name))
    return F.col(name)


def relative_to_first(df: DataFrame, metric: str = "sessions") -> DataFrame:
    """Percent change of each month against the view's first month."""
    in_order = W.partitionBy(*VIEW).orderBy("first_of_month")
    first = F.first(metric).over(in_order)
    return df.withColumn("percent_from_first", percent_change(F.col(metric), first))
