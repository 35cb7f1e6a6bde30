"""Operators over whole sites ("views"): tag, merge, splice, launch rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.functions.calendar import as_date
from trafficlens.functions.numbers import ratio, strict_sum

VIEW_KEYS = ("view_name", "view_id")

def tag_views(facts: DataFrame, views: DataFrame) -> DataFrame:
    """Facts of the listed views with the names listed for their ids.

    How the dimension is joined is left to the planner, which sees its bytes.
    """
    listed = views.select("view_id", "view_name").distinct()
    return facts.drop("view_name").join(listed, "view_id")


def tag_union_views(
    facts: DataFrame,
    views: DataFrame,
    start: Column | dt.date | str,
    end: Column | dt.date | str,
    date_col: str = "date",
) -> DataFrame:
    """Facts of the listed views between two inclusive dates, with view labels.

    ``facts`` carries ``view_id``; ``views`` has one row per (id, name).  An id
    listed under two names yields its facts under both, and a listed view
    without facts yields nothing.
    """
    in_range = facts.filter(F.col(date_col).between(as_date(start), as_date(end)))
    return tag_views(in_range, views)


# --------------------------------------------------------------------------
# Merging views
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class MergeRule:
    """Views whose name matches ``pattern`` are summed into view ``new_name``."""

    pattern: str
    new_name: str | None = None

    @property
    def name(self) -> str:
        return self.pattern if self.new_name is None else self.new_name


_MERGED = "__merged_name"


def _label(grouped: DataFrame) -> DataFrame:
    return grouped.withColumns(
        {"view_name": F.col(_MERGED), "view_id": F.col(_MERGED)}
    ).drop(_MERGED)


def _merge_sessions(matched: DataFrame, *keys: str) -> DataFrame:
    return _label(
        matched.groupBy(_MERGED, *keys).agg(
            strict_sum(F.col("sessions")).alias("sessions")
        )
    )


def _merge_monthly(matched: DataFrame) -> DataFrame:
    """Per-session ratios are turned into totals, summed and divided back."""
    sessions = F.col("sessions")
    totals = matched.groupBy(_MERGED, "year", "month").agg(
        strict_sum(sessions).alias("sessions"),
        strict_sum(sessions * F.col("avgSessionDuration")).alias("_duration"),
        strict_sum(sessions * F.col("pageviewsPerSession")).alias("_pageviews"),
        strict_sum(sessions * F.col("percentNewSessions") * 0.01).alias("_new"),
    )
    return _label(
        totals.select(
            _MERGED,
            "year",
            "month",
            "sessions",
            ratio(F.col("_duration"), sessions).alias("avgSessionDuration"),
            ratio(F.col("_pageviews"), sessions).alias("pageviewsPerSession"),
            (ratio(F.col("_new"), sessions) * 100).alias("percentNewSessions"),
        )
    )


MERGE_METHODS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily": lambda matched: _merge_sessions(matched, "date"),
    "monthly": _merge_monthly,
    "geo": lambda matched: _merge_sessions(matched, "region", "country", "period"),
}


def _merge_all(df: DataFrame, method: str, new_name: str) -> DataFrame:
    return MERGE_METHODS[method](df.withColumn(_MERGED, F.lit(new_name)))


def merge_views_daily(df: DataFrame, new_name: str) -> DataFrame:
    """All rows summed by date into one view; user counts cannot be added."""
    return _merge_all(df, "daily", new_name)


def merge_views_monthly(df: DataFrame, new_name: str) -> DataFrame:
    """All rows merged by month, with ratios weighted by sessions."""
    return _merge_all(df, "monthly", new_name)


def merge_views_geo(df: DataFrame, new_name: str) -> DataFrame:
    """All rows summed by (region, country, period) into one view."""
    return _merge_all(df, "geo", new_name)


def add_sum_of_views(
    df: DataFrame, pattern: str, method: str, new_name: str | None = None
) -> DataFrame:
    """Append one view that is the sum of the views matching ``pattern``."""
    return add_sums_of_views(df, [MergeRule(pattern, new_name)], method)


def add_sums_of_views(
    df: DataFrame, rules: Sequence[MergeRule], method: str
) -> DataFrame:
    """Apply merge rules one after another and keep the original rows.

    Equal to chained :func:`add_sum_of_views` calls, including that a pattern
    matching the name of an earlier merged view counts that view again.  Rules
    that do not see each other's output share one pass over ``df``: each row
    is handed to every rule it matches and all sums come from one aggregation,
    where a chain of unions would read ``df`` 2^n times.
    """
    for batch in _independent_batches(df.sparkSession, rules):
        names = F.array(
            *[
                F.when(F.col("view_name").rlike(r.pattern), F.lit(r.name))
                for r in batch
            ]
        )
        matched = df.withColumn(_MERGED, F.explode(F.array_compact(names)))
        df = df.unionByName(MERGE_METHODS[method](matched), allowMissingColumns=True)
    return df


def _independent_batches(
    spark: SparkSession, rules: Sequence[MergeRule]
) -> list[list[MergeRule]]:
    """Split rules so that no rule matches or repeats a name of its own batch."""
    if not rules:
        return []
    # Constant expressions: folded by the optimizer, no job runs.
    probes = [
        F.lit(earlier.name).rlike(later.pattern).alias(f"m{i}_{j}")
        for j, later in enumerate(rules)
        for i, earlier in enumerate(rules[:j])
    ]
    sees = spark.sql("SELECT 1").select(F.lit(True).alias("ok"), *probes).first()
    batches: list[list[MergeRule]] = [[]]
    start = 0
    for j, rule in enumerate(rules):
        if any(sees[f"m{i}_{j}"] or rules[i].name == rule.name for i in range(start, j)):
            batches.append([])
            start = j
        batches[-1].append(rule)
    return batches


# --------------------------------------------------------------------------
# Splicing two views into one series
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class SpliceRule:
    splice_date: dt.date | str
    fill_in: str
    fill_with: str


def splice_check(df: DataFrame, rule: SpliceRule, date_col: str) -> DataFrame:
    """One row: rows lost and gained by the splice, and the id it assigns.

    The id is that of the latest row of the spliced series: the receiving
    view's own if it has any row from the splice date on, otherwise that of
    the view it is filled with.
    """
    name, day = F.col("view_name"), F.col(date_col)
    cut = as_date(rule.splice_date)
    kept = (name == rule.fill_in) & (day >= cut)
    lent = (name == rule.fill_with) & (day < cut)
    lost = name.isNull() | ((name == rule.fill_in) & ~F.coalesce(kept, F.lit(False)))
    return df.agg(
        F.count_if(lost).alias("rows_lost"),
        F.count_if(lent).alias("rows_gained"),
        F.coalesce(
            F.max_by(F.when(kept, F.col("view_id")), F.when(kept, day)),
            F.max_by(F.when(lent, F.col("view_id")), F.when(lent, day)),
        ).alias("spliced_id"),
    )


def splice_two_views(
    df: DataFrame,
    rule: SpliceRule,
    date_col: str = "date",
    check: bool = True,
    view_id: str | None = None,
) -> DataFrame:
    """Continue one view's history backwards with the rows of another.

    Rows of ``fill_with`` before the splice date appear twice, under their own
    name and under ``fill_in``; older rows of ``fill_in`` itself disappear.
    The row count must not change; with ``check`` the query fails if it would.
    Check and id are one scalar subquery over three columns, so the operator
    stays lazy; the facts themselves are read once.  A caller that knows the id
    passes ``view_id`` and may switch the check off to save that subquery.
    """
    name, day = F.col("view_name"), F.col(date_col)
    cut = as_date(rule.splice_date)
    spliced_id = F.lit(view_id) if view_id is not None else F.col("spliced_id")
    if check:
        spliced_id = F.when(
            F.col("rows_lost") == F.col("rows_gained"), spliced_id
        ).otherwise(
            F.raise_error(
                F.format_string(
                    "splice changes the row count: %d rows lost, %d gained",
                    F.col("rows_lost"),
                    F.col("rows_gained"),
                )
            )
        )
    if check or view_id is None:
        spliced_id = splice_check(df, rule, date_col).select(spliced_id).scalar()

    own = F.struct(name.alias("view_name"), F.col("view_id").alias("view_id"))
    spliced = F.struct(
        F.lit(rule.fill_in).alias("view_name"), spliced_id.alias("view_id")
    )
    labels = (
        F.when((name == rule.fill_in) & (day >= cut), F.array(spliced))
        .when((name == rule.fill_with) & (day < cut), F.array(own, spliced))
        .when(name != rule.fill_in, F.array(own))
    )
    order = df.columns
    return (
        df.withColumn("__label", F.explode(labels))
        .withColumns(
            {"view_name": F.col("__label.view_name"), "view_id": F.col("__label.view_id")}
        )
        .select(*order)
    )


# --------------------------------------------------------------------------
# Launch rules and first periods
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class LaunchRule:
    view_name: str
    launch: dt.date | str


def drop_prelaunch(
    df: DataFrame, rules: Sequence[LaunchRule], date_col: str = "first_of_month"
) -> DataFrame:
    """Keep periods with traffic that lie strictly after the view's launch."""
    day, name = F.col(date_col), F.col("view_name")
    keep = F.col("sessions") > 0
    for rule in rules:
        keep = keep & ((day > as_date(rule.launch)) | (name != rule.view_name))
    return df.filter(keep)


def drop_first_period(df: DataFrame) -> DataFrame:
    """Drop the first, usually incomplete, (year, month) row of every view name.

    A window group holds one view's months, so its size is bounded by the
    length of the history, not by traffic.
    """
    in_order = W.partitionBy("view_name").orderBy("year", "month", "view_id")
    return (
        df.withColumn("__rn", F.row_number().over(in_order))
        .filter(F.col("__rn") > 1)
        .drop("__rn")
    )


def filter_app_set(df: DataFrame, app_sets: DataFrame, set_name: str) -> DataFrame:
    """Rows of the views that belong to a named set of applications."""
    members = app_sets.filter(F.col("set_name") == set_name).select("view_name")
    return df.join(members, "view_name", "left_semi")
