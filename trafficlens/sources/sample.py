"""Report facts derived from the sample star schema and event tables.

Orders stand for sessions: a customer's market segment is the site, the
customer the user, the nation the region.  Events stand for page hits, pages
and documents for page paths.  Every adapter reads the whole table.

Orders are combined per customer (and day, month or period) before they meet
the customer table, so a customer with a large part of all orders is a few
rows by the time keys are shuffled for the join, and users need no distinct
count: one combined row is one user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.functions.numbers import ratio
from trafficlens.schemas import CLOCK, DOUBLE, INT, LONG, STRING, schema
from trafficlens.operators.periods import (
    Period,
    newest_day,
    standard_periods,
)
from trafficlens.sources.readers import geo_report


# A prime, so that no average of prices ends right between two rounded values.
PRICE_PER_SECOND = 997


# The columns that stand for traffic; declared, so no read infers a schema.
SCHEMAS = {
    "orders": schema(
        {
            "o_orderkey": LONG,
            "o_custkey": LONG,
            "o_totalprice": DOUBLE,
            "o_orderdate": CLOCK,
            "o_orderpriority": STRING,
        }
    ),
    "customer": schema({"c_custkey": LONG, "c_nationkey": INT, "c_mktsegment": STRING}),
    "nation": schema({"n_nationkey": INT, "n_name": STRING, "n_regionkey": INT}),
    "region": schema({"r_regionkey": INT, "r_name": STRING}),
    "events": schema(
        {
            "event_id": LONG,
            "ts": CLOCK,
            "user_id": LONG,
            "event_type": STRING,
            "value": DOUBLE,
            "props": STRING,
        }
    ),
    "pages": schema({"page_id": LONG, "url": STRING}),
    "documents": schema({"doc_id": LONG, "text": STRING}),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def latest_order_date(spark: SparkSession, sf_dir: str) -> dt.date:
    return newest_day(table(spark, sf_dir, "orders"), "o_orderdate")


def latest_event_date(spark: SparkSession, sf_dir: str) -> dt.date:
    return newest_day(table(spark, sf_dir, "events"), "ts")


def _view_columns(segment: Column) -> dict[str, Column]:
    view_id = F.concat(F.lit("v"), F.ascii(segment).cast("string"))
    return {"view_id": view_id, "view_name": segment}


def _customers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", *columns
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily traffic: orders and distinct customers per segment and day."""
    per_user = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_user.join(_customers(spark, sf_dir), "o_custkey")
        .groupBy("c_mktsegment", "date")
        .agg(
            F.sum("n").cast("double").alias("sessions"),
            F.count(F.lit(1)).cast("double").alias("users"),
        )
        .withColumns(_view_columns(F.col("c_mktsegment")))
        .select("date", "sessions", "users", "view_id", "view_name")
    )


def dense_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily traffic with a zero row for every day a segment had no order.

    Each segment's row of calendar days is expanded on its own; the calendar
    is the span of all order dates.
    """
    facts = daily(spark, sf_dir)
    day = F.to_date("o_orderdate")
    span = table(spark, sf_dir, "orders").select(F.sequence(F.min(day), F.max(day)))
    calendar = F.explode(span.scalar())
    empty = (
        table(spark, sf_dir, "customer")
        .select("c_mktsegment")
        .distinct()
        .select(
            calendar.alias("date"),
            F.lit(0.0).alias("sessions"),
            F.lit(0.0).alias("users"),
            *[c.alias(n) for n, c in _view_columns(F.col("c_mktsegment")).items()],
        )
    )
    return (
        facts.unionByName(empty)
        .groupBy("date", "view_id", "view_name")
        .agg(F.sum("sessions").alias("sessions"), F.sum("users").alias("users"))
        .select("date", "sessions", "users", "view_id", "view_name")
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly traffic with ratio metrics per session.

    Prices are added in whole cents: exact, and cheaper than decimals.  A
    customer's first order lies in the customer's first month, so the share
    of new sessions needs the months of a customer, not the single orders.
    """
    per_user = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date(F.trunc("o_orderdate", "month")).alias("m"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        )
    )
    first_month = F.min("m").over(W.partitionBy("o_custkey"))
    n = F.col("n").cast("double")
    return (
        per_user.withColumn("is_first", F.col("m") == first_month)
        .join(_customers(spark, sf_dir), "o_custkey")
        .groupBy("c_mktsegment", "m")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).cast("double").alias("users"),
            (F.sum("cents") / 100).alias("price"),
            F.count_if("is_first").cast("double").alias("new"),
        )
        .withColumns(_view_columns(F.col("c_mktsegment")))
        .select(
            F.date_format("m", "yyyy").alias("year"),
            F.date_format("m", "MM").alias("month"),
            n.alias("sessions"),
            (ratio(F.col("price"), n) / PRICE_PER_SECOND).alias("avgSessionDuration"),
            ratio(n, F.col("users")).alias("pageviewsPerSession"),
            ratio(F.col("new") * 100, n).alias("percentNewSessions"),
            "view_id",
            "view_name",
        )
    )


def order_periods(spark: SparkSession, sf_dir: str, fiscal: bool = False) -> list[Period]:
    """Report windows that end with the newest order."""
    run_date = latest_order_date(spark, sf_dir) + dt.timedelta(days=1)
    return standard_periods(run_date, fiscal)


def daily_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by nation (region), world region (country), segment and day."""
    per_user = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_nation = (
        per_user.join(_customers(spark, sf_dir, "c_nationkey"), "o_custkey")
        .groupBy("c_nationkey", "c_mktsegment", "date")
        .agg(F.sum("n").cast("double").alias("sessions"))
    )
    return (
        per_nation.join(_nations(spark, sf_dir), "c_nationkey")
        .withColumns(_view_columns(F.col("c_mktsegment")))
        .select("date", "region", "country", "sessions", "view_id", "view_name")
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geographic report over the year, month and week before the newest day.

    The windows bound the scan of the orders: their dates are values here.
    """
    return geo_report(daily_geo(spark, sf_dir), order_periods(spark, sf_dir))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .join(
            table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        .select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("n_name").alias("region"),
            F.col("r_name").alias("country"),
            "n_regionkey",
        )
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation, plus a row for the territory and a national total
    (``STATE`` 0), as the census file has them."""
    per_nation = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("people"))
        .join(_nations(spark, sf_dir), "c_nationkey")
    )

    def row(name: Column, state: Column, key: Column) -> Column:
        return F.struct(
            key.alias("REGION"),
            key.alias("DIVISION"),
            state.cast("bigint").alias("STATE"),
            name.alias("NAME"),
        )

    key = F.col("n_regionkey").cast("string")
    rows = F.array(
        row(F.col("region"), F.col("c_nationkey") + 1, key),
        row(F.lit("TOTAL"), F.lit(0), F.lit("0")),
        F.when(
            F.col("country") == "MIDDLE EAST", row(F.col("country"), F.lit(100), key)
        ),
    )
    return (
        per_nation.select(F.explode(F.array_compact(rows)).alias("r"), "people")
        .groupBy("r.REGION", "r.DIVISION", "r.STATE", "r.NAME")
        .agg(F.sum("people").alias("POPESTIMATE2019"))
    )


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily page counts with the page's address as path."""
    return page_views_of(table(spark, sf_dir, "pages"))


def page_views_of(pages: DataFrame) -> DataFrame:
    return _counted(pages, F.col("page_id"), F.col("url"))


def text_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a whole document text in place of the path."""
    return _counted(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"))


def _counted(df: DataFrame, key: Column, path: Column) -> DataFrame:
    return df.select(
        path.alias("pagePath"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 7).cast("int")).alias("date"),
        (key % 4).cast("double").alias("uniquePageviews"),
        (key % 4 + key % 3).cast("double").alias("pageViews"),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page hits from events: the event type is the page, the value in whole
    hundredths the load time of two hits in three."""
    k = F.get_json_object("props", "$.k").cast("int")
    load_ms = F.when(k % 3 != 0, F.round(F.col("value") * 100))
    site = (F.col("user_id") % 5).cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("hit_id"),
        F.concat(F.lit("v"), site).alias("view_id"),
        F.concat(F.lit("site "), site).alias("view_name"),
        "user_id",
        "ts",
        F.col("event_type").alias("pagePath"),
        load_ms.alias("load_ms"),
        (load_ms * 2).alias("download_ms"),
        (load_ms * 3).alias("dom_ms"),
        F.element_at(
            F.array(*map(F.lit, ("desktop", "mobile", "tablet"))), k % 3 + 1
        ).alias("deviceCategory"),
        F.element_at(
            F.array(*map(F.lit, ("Chrome", "Edge", "Firefox", "Safari"))), k % 4 + 1
        ).alias("browser"),
    )


def order_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event annotations: per segment and fiscal month, the day and id of the
    first order of that month with urgent priority."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    first = F.min(F.struct("o_orderdate", "o_orderkey")).alias("first")
    per_user = urgent.groupBy(
        "o_custkey", F.trunc("o_orderdate", "month").alias("m")
    ).agg(first)
    return (
        per_user.join(_customers(spark, sf_dir), "o_custkey")
        .groupBy(F.col("c_mktsegment").alias("view_name"), "m")
        .agg(F.min("first").alias("first"))
        .select(
            "view_name",
            F.to_date("first.o_orderdate").alias("event_date"),
            F.concat(F.lit("order "), F.col("first.o_orderkey").cast("string")).alias("text"),
        )
    )
