"""Geographic reports: population shares, regionality, week against year."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trafficlens.functions.calendar import as_date
from trafficlens.functions.numbers import percent_change, ratio, strict_sum
from trafficlens.operators.periods import MONTH_LABEL, WEEK_LABEL, YEAR_LABEL

# The fifty states as traffic reports name them.
US_STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii", "Idaho",
    "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine",
    "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi",
    "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina",
    "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
    "Washington", "West Virginia", "Wisconsin", "Wyoming",
)

# Fixed value: weeks in a year, for the weekly average.
WEEKS_PER_YEAR = 52.14


@dataclass(frozen=True)
class Country:
    """Which traffic belongs to the country and how its regions are named.

    Regions are matched by name alone, so a foreign region of the same name
    counts too.  The territory is reported as a country of its own and becomes
    one more region.
    """

    name: str = "United States"
    regions: Sequence[str] = (*US_STATES, "District of Columbia")
    territory: str = "Puerto Rico"


def population_share(population: DataFrame) -> DataFrame:
    """Share of each region in the total population, national rows removed."""
    regions = population.filter(F.col("STATE") != 0)
    total = regions.select(strict_sum(F.col("POPESTIMATE2019"))).scalar()
    return regions.withColumn("pop_pct", ratio(F.col("POPESTIMATE2019"), total))


def state_traffic_share(
    df: DataFrame, population: DataFrame, country: Country = Country()
) -> DataFrame:
    """Sessions per region as a share of the view's total and of population.

    ``population`` is the output of :func:`population_share`.  Every view gets
    a zero row for a region it never had in any period but another view had;
    such rows have no id, period, population or ratios.
    """
    nation, region = F.col("country"), F.col("region")
    domestic = df.filter(
        region.isin(list(country.regions)) | (nation == country.territory)
    ).withColumn(
        "region",
        F.when(nation == country.territory, F.lit(country.territory)).when(
            nation.isNotNull(), region
        ),
    )
    traffic = domestic.groupBy("view_name", "view_id", "period", "region").agg(
        F.coalesce(strict_sum(F.col("sessions")), F.lit(0.0)).alias("sessions")
    )

    # At most one row per region of the country in each of these groups.
    group = ("view_name", "view_id", "period")
    known_group = F.lit(True)
    for key in group:
        known_group = known_group & F.col(key).isNotNull()
    total = F.sum("sessions").over(W.partitionBy(*group))
    named = population.drop("REGION").withColumnRenamed("NAME", "region")
    observed = (
        traffic.withColumn("sessions_total_period", F.when(known_group, total))
        .join(named, "region", "left")
    )

    # The sets hold region names of one country (about fifty), whatever the
    # traffic, so no product of views and regions has to be joined.
    all_regions = domestic.select(F.collect_set("region")).scalar()
    padding = (
        domestic.groupBy("view_name")
        .agg(F.collect_set("region").alias("seen"))
        .select(
            "view_name",
            F.explode(F.array_except(all_regions, F.col("seen"))).alias("region"),
            F.lit(0.0).alias("sessions"),
        )
    )
    padded = observed.unionByName(padding, allowMissingColumns=True)
    sessions_pct = ratio(F.col("sessions"), F.col("sessions_total_period"))
    return padded.select(
        "view_name",
        "region",
        "view_id",
        "period",
        "sessions",
        "DIVISION",
        "STATE",
        "POPESTIMATE2019",
        "pop_pct",
        "sessions_total_period",
        sessions_pct.alias("sessions_pct"),
        ratio(sessions_pct, F.col("pop_pct")).alias("sessions_population_ratio"),
        F.lit(country.name).alias("country"),
    )


def regionality(shares: DataFrame) -> DataFrame:
    """One minus the Gini coefficient of the sessions/population ratios.

    1 means traffic follows population, values near 0 mean that few regions
    cause most of it.  Groups without a usable ratio are left out.
    """
    group = ("view_name", "view_id", "period")
    ratio_col = F.col("sessions_population_ratio")
    ranked = (
        shares.select(*group, ratio_col.alias("x"))
        .dropna("any")
        .withColumn("i", F.row_number().over(W.partitionBy(*group).orderBy("x")))
    )
    n = F.count(F.lit(1))
    gini = (ratio(2 * F.sum(F.col("i") * F.col("x")), F.sum("x")) - (n + 1)) / n
    return (
        ranked.groupBy(*group)
        .agg((1 - gini).alias("region_metric_all"))
        .dropna("any")
    )


def week_vs_year(df: DataFrame, country: str = "United States") -> DataFrame:
    """Sessions of the three periods side by side, and the week's deviation.

    The pivot is a conditional aggregation: the period names are known, so
    neither a job to find them nor a second aggregation is needed.  Several rows
    of a view, region and period add up.
    """

    def in_period(label: str) -> Column:
        return F.sum(F.when(F.col("period") == label, F.col("sessions")))

    year, week = F.col("`365_days`"), F.col("`7_days`")
    average = F.col("weekly_average")
    return (
        df.filter(F.col("country") == country)
        .groupBy("view_id", "view_name", "region")
        .agg(
            in_period(YEAR_LABEL).alias("365_days"),
            in_period(MONTH_LABEL).alias("30_days"),
            in_period(WEEK_LABEL).alias("7_days"),
        )
        .withColumn("week_over_year", ratio(week, year))
        .withColumn("weekly_average", year / WEEKS_PER_YEAR)
        .withColumn("week_percent_from_average", percent_change(week, average))
    )


def suppress_until(
    df: DataFrame,
    view_name: str,
    column: str,
    until: Column | dt.date | str,
    today: Column | dt.date | str,
) -> DataFrame:
    """Blank ``column`` for one view as long as ``today`` is before ``until``."""
    hidden = (as_date(today) < as_date(until)) & (F.col("view_name") == view_name)
    return df.withColumn(column, F.when(hidden, F.lit(None)).otherwise(F.col(column)))
