import pytest
from conftest import rows
from pyspark.sql import functions as F

from trafficlens.operators import geo

GEO = (
    "region string, country string, sessions double, view_id string, "
    "view_name string, period string"
)
US = "United States"


def traffic(spark, *records):
    return spark.createDataFrame(records, GEO)


@pytest.fixture(scope="module")
def population(spark):
    raw = spark.createDataFrame(
        [
            ("0", "0", 0, "United States", 1000),
            ("4", "9", 6, "California", 600),
            ("1", "1", 36, "New York", 300),
            ("X", "X", 72, "Puerto Rico", 100),
        ],
        "REGION string, DIVISION string, STATE bigint, NAME string, POPESTIMATE2019 bigint",
    )
    return geo.population_share(raw)


def test_fixed_state_list():
    assert len(set(geo.US_STATES)) == 50


def test_population_share_counts_territories_but_not_the_national_row(population):
    assert rows(population, "NAME", "pop_pct") == [
        ("California", 0.6), ("New York", 0.3), ("Puerto Rico", 0.1),
    ]


@pytest.fixture(scope="module")
def shares(spark, population):
    df = traffic(
        spark,
        ("California", US, 30.0, "a", "A", "7 days"),
        ("New York", US, 10.0, "a", "A", "7 days"),
        ("California", US, 100.0, "a", "A", "30 days"),  # New York: other period only
        ("San Juan", "Puerto Rico", 3.0, "b", "B", "7 days"),
        ("Ponce", "Puerto Rico", 2.0, "b", "B", "7 days"),
        ("California", "Mexico", 5.0, "b", "B", "7 days"),  # by name, wherever it is
        ("District of Columbia", US, 0.0, "b", "B", "7 days"),
        ("Bavaria", "Germany", 99.0, "b", "B", "7 days"),
        ("Texas", None, 1.0, "c", "C", "7 days"),  # region unknown without a country
    )
    return geo.state_traffic_share(df, population).cache()


def test_shares_and_padding(shares):
    got = rows(
        shares.filter("view_name <> 'C'"),
        "view_name", "region", "period", "sessions", "sessions_total_period", "sessions_pct",
    )
    assert got == [
        ("A", "California", "30 days", 100.0, 100.0, 1.0),
        ("A", "California", "7 days", 30.0, 40.0, 0.75),
        ("A", "District of Columbia", None, 0.0, None, None),
        ("A", "New York", "7 days", 10.0, 40.0, 0.25),
        ("A", "Puerto Rico", None, 0.0, None, None),
        ("B", "California", "7 days", 5.0, 10.0, 0.5),
        ("B", "District of Columbia", "7 days", 0.0, 10.0, 0.0),
        ("B", "New York", None, 0.0, None, None),
        ("B", "Puerto Rico", "7 days", 5.0, 10.0, 0.5),
    ]
    assert set(shares.select("country").distinct().collect()) == {(US,)}


def test_pads_have_no_id_and_no_population(shares):
    pads = shares.filter("period is null and view_name <> 'C'")
    assert pads.filter(
        "view_id is not null or pop_pct is not null or STATE is not null"
        " or sessions_population_ratio is not null"
    ).count() == 0


def test_population_ratio_needs_a_known_region(shares):
    got = rows(
        shares.filter("view_name in ('A', 'B') and period = '7 days'"),
        "view_name", "region", "sessions_population_ratio",
    )
    assert got == [
        ("A", "California", pytest.approx(1.25)),
        ("A", "New York", pytest.approx(0.25 / 0.3)),
        ("B", "California", pytest.approx(0.5 / 0.6)),
        ("B", "District of Columbia", None),
        ("B", "Puerto Rico", pytest.approx(5.0)),
    ]


def test_region_without_country_is_unknown(shares):
    assert rows(shares.filter("view_name = 'C' and period is not null"), "region") == [(None,)]


def test_shares_add_up(shares):
    totals = shares.filter("period is not null").groupBy("view_name", "period").agg(
        F.round(F.sum("sessions_pct"), 9).alias("t")
    )
    assert set(rows(totals, "t")) == {(1.0,)}


def ratios(spark, **groups):
    return spark.createDataFrame(
        [(name, name, "7 days", x) for name, xs in groups.items() for x in xs],
        "view_name string, view_id string, period string, sessions_population_ratio double",
    )


def gini(xs):
    n = len(xs)
    return sum(abs(a - b) for a in xs for b in xs) / (2 * n * sum(xs))


def test_regionality(spark):
    mixed = [0.2, 3.0, 1.0, 1.0]
    df = ratios(
        spark, one=[2.0], equal=[1.5, 1.5, 1.5], zero=[0.0, 0.0], mixed=[*mixed, None], none=[None]
    )
    got = dict(rows(geo.regionality(df), "view_name", "region_metric_all"))
    assert got == {
        "one": 1.0,
        "equal": pytest.approx(1.0),
        "mixed": pytest.approx(1 - gini(mixed)),
    }
    scaled = df.withColumn("sessions_population_ratio", F.col("sessions_population_ratio") * 8)
    again = dict(rows(geo.regionality(scaled), "view_name", "region_metric_all"))
    assert again == {k: pytest.approx(v) if v != 1.0 else 1.0 for k, v in got.items()}


def test_regionality_ignores_pads(shares):
    got = rows(geo.regionality(shares), "view_name", "period")
    assert got == [("A", "30 days"), ("A", "7 days"), ("B", "7 days")]


def test_week_vs_year(spark):
    df = traffic(
        spark,
        ("California", US, 521.4, "a", "A", "365 days"),
        ("California", US, 50.0, "a", "A", "30 days"),
        ("California", US, 15.0, "a", "A", "7 days"),
        ("(not set)", US, 0.0, "a", "A", "365 days"),
        ("(not set)", US, 1.0, "a", "A", "7 days"),
        ("Texas", US, 7.0, "a", "A", "30 days"),
        ("Bavaria", "Germany", 7.0, "a", "A", "7 days"),
    )
    got = geo.week_vs_year(df)
    assert rows(got, "region", "`365_days`", "`30_days`", "`7_days`") == [
        ("(not set)", 0.0, None, 1.0),
        ("California", 521.4, 50.0, 15.0),
        ("Texas", None, 7.0, None),
    ]
    assert rows(got, "region", "week_over_year", "weekly_average", "week_percent_from_average") == [
        ("(not set)", None, 0.0, None),
        ("California", pytest.approx(15 / 521.4), pytest.approx(10.0), pytest.approx(50.0)),
        ("Texas", None, None, None),
    ]


@pytest.mark.parametrize(
    ("today", "hidden"), [("2021-08-13", True), ("2021-08-14", False), ("2021-08-15", False)]
)
def test_suppress_until(spark, today, hidden):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0), (None, 3.0)], "view_name string, x double")
    got = rows(geo.suppress_until(df, "A", "x", "2021-08-14", today))
    assert got == [(None, 3.0), ("A", None if hidden else 1.0), ("B", 2.0)]
