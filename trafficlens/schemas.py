"""Schemas of the facts the operators read and of the datasets they publish.

Metrics are doubles even when they are counts; ids are strings and are never
cast to numbers.  Published schemas carry their column order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, DOUBLE = StringType(), DoubleType()
INT, LONG = IntegerType(), LongType()
DATE, BOOLEAN, CLOCK = DateType(), BooleanType(), TimestampNTZType()


def schema(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# The columns of the inputs and of the published datasets.
VIEWS = schema(
    {
        "longName": STRING,
        "shortName": STRING,
        "accountName": STRING,
        "viewID": STRING,
        "accountId": STRING,
        "webPropertyId": STRING,
        "internalWebPropertyId": STRING,
        "viewName": STRING,
        "timezone": STRING,
        "websiteUrl": STRING,
        "botFilteringEnabled": STRING,
        "description": STRING,
        "projectContact": STRING,
        "projectContactEmail": STRING,
        "analyticsContact": STRING,
        "analyticsContactEmail": STRING,
    }
)

FACTS: dict[str, StructType] = {
    "daily": schema(
        {
            "date": DATE,
            "sessions": DOUBLE,
            "users": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "monthly": schema(
        {
            "year": STRING,
            "month": STRING,
            "sessions": DOUBLE,
            "avgSessionDuration": DOUBLE,
            "pageviewsPerSession": DOUBLE,
            "percentNewSessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "daily_geo": schema(
        {
            "date": DATE,
            "region": STRING,
            "country": STRING,
            "sessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "geo": schema(
        {
            "region": STRING,
            "country": STRING,
            "sessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "period": STRING,
        }
    ),
    "device": schema(
        {
            "deviceCategory": STRING,
            "browser": STRING,
            "dayOfWeekName": STRING,
            "sessions": DOUBLE,
            "percentNewSessions": DOUBLE,
            "sessionDuration": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "period": STRING,
        }
    ),
    "paths": schema(
        {
            "landingPagePath": STRING,
            "secondPagePath": STRING,
            "exitPagePath": STRING,
            "sessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "load": schema(
        {
            "pagePath": STRING,
            "pageLoadSample": DOUBLE,
            "avgPageLoadTime": DOUBLE,
            "avgPageDownloadTime": DOUBLE,
            "avgDomContentLoadedTime": DOUBLE,
            "exitRate": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "page_views": schema(
        {
            "pagePath": STRING,
            "date": DATE,
            "uniquePageviews": DOUBLE,
            "pageViews": DOUBLE,
        }
    ),
    "population": schema(
        {
            "REGION": STRING,
            "DIVISION": STRING,
            "STATE": LONG,
            "NAME": STRING,
            "POPESTIMATE2019": LONG,
        }
    ),
    "hits": schema(
        {
            "hit_id": LONG,
            "view_id": STRING,
            "view_name": STRING,
            "user_id": LONG,
            "ts": CLOCK,
            "pagePath": STRING,
            "load_ms": DOUBLE,
            "download_ms": DOUBLE,
            "dom_ms": DOUBLE,
            "deviceCategory": STRING,
            "browser": STRING,
        }
    ),
}

OUTPUTS: dict[str, StructType] = {
    "three_year_traffic": schema(
        {
            "date": DATE,
            "sessions": DOUBLE,
            "users": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "year": DATE,
            "fiscal_year": DATE,
        }
    ),
    "year_month_week": schema(
        {
            "view_name": STRING,
            "view_id": STRING,
            "sessions": DOUBLE,
            "users": DOUBLE,
            "period": STRING,
        }
    ),
    "compared_to_last_year": schema(
        {
            "view_name": STRING,
            "view_id": STRING,
            "sessions_this_year": DOUBLE,
            "n_this_year": LONG,
            "first_non_zero_date_this_year": DATE,
            "sessions_last_year": DOUBLE,
            "n_last_year": LONG,
            "first_non_zero_date_last_year": DATE,
            "percent_change": DOUBLE,
            "period": STRING,
        }
    ),
    "long_term_monthly": schema(
        {
            "year": STRING,
            "month": STRING,
            "sessions": DOUBLE,
            "avgSessionDuration": DOUBLE,
            "pageviewsPerSession": DOUBLE,
            "percentNewSessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "first_of_month": DATE,
            "fiscal_year": DATE,
            "backfill": BOOLEAN,
        }
    ),
    "state_traffic": schema(
        {
            "region": STRING,
            "country": STRING,
            "sessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "period": STRING,
        }
    ),
    "state_traffic_population_percentages": schema(
        {
            "view_name": STRING,
            "region": STRING,
            "view_id": STRING,
            "period": STRING,
            "sessions": DOUBLE,
            "DIVISION": STRING,
            "STATE": LONG,
            "POPESTIMATE2019": LONG,
            "pop_pct": DOUBLE,
            "sessions_total_period": DOUBLE,
            "sessions_pct": DOUBLE,
            "sessions_population_ratio": DOUBLE,
            "country": STRING,
        }
    ),
    "regionality": schema(
        {
            "view_name": STRING,
            "view_id": STRING,
            "period": STRING,
            "region_metric_all": DOUBLE,
        }
    ),
    "state_week_vs_year": schema(
        {
            "view_id": STRING,
            "view_name": STRING,
            "region": STRING,
            "365_days": DOUBLE,
            "30_days": DOUBLE,
            "7_days": DOUBLE,
            "week_over_year": DOUBLE,
            "weekly_average": DOUBLE,
            "week_percent_from_average": DOUBLE,
        }
    ),
    "summary_numbers": schema(
        {
            "deviceCategory": STRING,
            "browser": STRING,
            "dayOfWeekName": STRING,
            "sessions": DOUBLE,
            "percentNewSessions": DOUBLE,
            "sessionDuration": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
            "period": STRING,
            "newSessions": DOUBLE,
        }
    ),
    "landing_exit_pages": schema(
        {
            "landingPagePath": STRING,
            "secondPagePath": STRING,
            "exitPagePath": STRING,
            "sessions": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "page_load": schema(
        {
            "pagePath": STRING,
            "pageLoadSample": DOUBLE,
            "avgPageLoadTime": DOUBLE,
            "avgPageDownloadTime": DOUBLE,
            "avgDomContentLoadedTime": DOUBLE,
            "exitRate": DOUBLE,
            "view_id": STRING,
            "view_name": STRING,
        }
    ),
    "monitoring_location_pages": schema(
        {
            "date": DATE,
            "site_no": STRING,
            "uniquePageviews": DOUBLE,
        }
    ),
}


def conform(df: DataFrame, expected: StructType) -> DataFrame:
    """Project ``df`` to the ``expected`` columns in their order.

    Raises if a column is missing or has another type: a published dataset
    must not change shape silently.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got "
        + (actual[f.name].simpleString() if f.name in actual else "no such column")
        for f in expected.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*[F.col(f"`{f.name}`") for f in expected.fields])
