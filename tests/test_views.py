import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from trafficlens.operators import views
from trafficlens.operators.views import LaunchRule, MergeRule, SpliceRule

DAILY = "date date, sessions double, users double, view_id string, view_name string"


def daily(spark, *records):
    return spark.createDataFrame([(day(d), *rest) for d, *rest in records], DAILY)


# ---------------------------------------------------------------- tagging


def test_tag_union_views(spark):
    facts = daily(
        spark,
        ("2020-01-01", 1.0, 1.0, "a", "x"),
        ("2020-01-02", 2.0, 1.0, "a", "x"),
        ("2020-01-31", 3.0, 1.0, "b", "x"),
        ("2020-02-01", 4.0, 1.0, "a", "x"),
        ("2019-12-31", 5.0, 1.0, "a", "x"),
        ("2020-01-05", 6.0, 1.0, "not listed", "x"),
    )
    listed = spark.createDataFrame(
        [("a", "A"), ("a", "A again"), ("b", "B"), ("c", "no rows")],
        "view_id string, view_name string",
    )
    got = rows(
        views.tag_union_views(facts, listed, "2020-01-01", "2020-01-31"),
        "view_name", "view_id", "sessions",
    )
    assert got == [
        ("A", "a", 1.0), ("A", "a", 2.0),
        ("A again", "a", 1.0), ("A again", "a", 2.0),
        ("B", "b", 3.0),
    ]


def test_merged_daily_has_no_users(spark):
    df = daily(
        spark,
        ("2020-01-01", 1.0, 1.0, "a", "A one"),
        ("2020-01-01", 2.0, 1.0, "b", "A two"),
        ("2020-01-02", 4.0, 2.0, "a", "A one"),
    )
    merged = views.add_sum_of_views(df, "^A", "daily", "A all")
    assert rows(merged.filter("view_name = 'A all'"), "date", "sessions", "users", "view_id") == [
        (day("2020-01-01"), 3.0, None, "A all"),
        (day("2020-01-02"), 4.0, None, "A all"),
    ]
    assert merged.count() == 5


def test_default_name_is_the_pattern_and_dot_is_a_wildcard(spark):
    df = daily(
        spark,
        ("2020-01-01", 1.0, 1.0, "a", "shop.org"),
        ("2020-01-01", 2.0, 1.0, "b", "shopXorg"),
        ("2020-01-01", 4.0, 1.0, "c", None),
    )
    merged = views.add_sum_of_views(df, "shop.org", "daily")
    assert rows(merged.filter("view_id = 'shop.org'"), "sessions") == [(3.0,)]


def test_no_match_appends_nothing(spark):
    df = daily(spark, ("2020-01-01", 1.0, 1.0, "a", "A"))
    assert rows(views.add_sum_of_views(df, "zzz", "daily")) == rows(df)


def test_monthly_ratios_are_weighted(spark):
    df = spark.createDataFrame(
        [
            ("2020", "01", 100.0, 10.0, 2.0, 50.0, "a", "A"),
            ("2020", "01", 300.0, 20.0, 4.0, 10.0, "b", "B"),
            ("2020", "02", 0.0, 0.0, 0.0, 0.0, "a", "A"),
        ],
        "year string, month string, sessions double, avgSessionDuration double, "
        "pageviewsPerSession double, percentNewSessions double, view_id string, "
        "view_name string",
    )
    first, second = rows(
        views.merge_views_monthly(df, "all"),
        "month", "sessions", "avgSessionDuration", "pageviewsPerSession", "percentNewSessions",
    )
    assert first == ("01", 400.0, 17.5, 3.5, pytest.approx(20.0))
    assert second == ("02", 0.0, None, None, None)


def test_geo_merge(spark):
    df = spark.createDataFrame(
        [
            ("r", "c", 1.0, "a", "A", "7 days"),
            ("r", "c", 2.0, "b", "B", "7 days"),
            ("r", "c", 4.0, "b", "B", "30 days"),
        ],
        "region string, country string, sessions double, view_id string, "
        "view_name string, period string",
    )
    assert rows(views.merge_views_geo(df, "m"), "period", "sessions", "view_id") == [
        ("30 days", 4.0, "m"),
        ("7 days", 3.0, "m"),
    ]


RULE_SETS = [
    [MergeRule("A", "one"), MergeRule("B", "two")],
    [MergeRule("A", "A sum"), MergeRule("A", "again")],  # sees the earlier sum
    [MergeRule("A", "x"), MergeRule("B", "x"), MergeRule("x", "y")],  # one name twice
    [MergeRule("A|B", "C1"), MergeRule("D", "D1"), MergeRule("C", "C2"), MergeRule("1", "E")],
]


@pytest.mark.parametrize("rules", RULE_SETS)
def test_batched_rules_equal_chained_ones(spark, rules):
    df = daily(
        spark,
        ("2020-01-01", 1.0, 1.0, "a", "A"),
        ("2020-01-01", 2.0, 1.0, "b", "B"),
        ("2020-01-01", 4.0, 1.0, "c", "AB"),
        ("2020-01-02", 8.0, 1.0, "d", "D"),
    )
    chained = df
    for rule in rules:
        matched = chained.filter(F.col("view_name").rlike(rule.pattern))
        chained = chained.unionByName(
            views.merge_views_daily(matched, rule.name), allowMissingColumns=True
        )
    assert rows(views.add_sums_of_views(df, rules, "daily")) == rows(chained)


def test_independent_rules_read_the_input_twice(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily(spark, ("2020-01-01", 1.0, 1.0, "a", "A")).write.parquet(path)
    df = spark.read.parquet(path)
    rules = [MergeRule("A", "1"), MergeRule("B", "2"), MergeRule("C", "3")]
    plan = views.add_sums_of_views(df, rules, "daily")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 2


# --------------------------------------------------------------- splicing

RULE = SpliceRule("2020-01-03", "new", "old")


def series(spark, *extra):
    return daily(
        spark,
        ("2020-01-01", 10.0, 1.0, "o", "old"),
        ("2020-01-02", 11.0, 1.0, "o", "old"),
        ("2020-01-03", 12.0, 1.0, "o", "old"),
        ("2020-01-01", 1.0, 1.0, "n", "new"),
        ("2020-01-02", 1.0, 1.0, "n", "new"),
        ("2020-01-01", 5.0, 1.0, "x", "other"),
        *extra,
    )


def test_splice(spark):
    df = series(spark, ("2020-01-03", 2.0, 1.0, "n", "new"))
    got = views.splice_two_views(df, RULE)
    assert got.columns == df.columns
    assert rows(got.filter("view_name = 'new'"), "date", "sessions", "view_id") == [
        (day("2020-01-01"), 10.0, "n"),
        (day("2020-01-02"), 11.0, "n"),
        (day("2020-01-03"), 2.0, "n"),  # the splice day is the view's own
    ]
    assert rows(got.filter("view_name = 'old'")) == rows(df.filter("view_name = 'old'"))
    assert got.count() == df.count()
    assert rows(views.splice_two_views(got, RULE)) == rows(got)


def test_splice_without_own_rows_takes_the_other_id(spark):
    got = views.splice_two_views(series(spark), RULE)
    assert rows(got.filter("view_name = 'new'"), "sessions", "view_id") == [
        (10.0, "o"), (11.0, "o"),
    ]


@pytest.mark.parametrize(
    "extra",
    [
        ("2020-01-02", 9.0, 1.0, "n", "new"),  # one row too many is replaced
        ("2019-12-31", 9.0, 1.0, "o", "old"),  # one row too many is lent
        ("2020-01-02", 9.0, 1.0, "z", None),  # rows without a name get lost
    ],
)
def test_splice_fails_if_the_row_count_changes(spark, extra):
    df = series(spark, extra)
    # The failure of a subquery reaches Python as a wrapped Java error.
    with pytest.raises(Exception, match="splice changes the row count"):
        views.splice_two_views(df, RULE).collect()
    views.splice_two_views(df, RULE, check=False).collect()


def test_known_id_without_check_needs_no_subquery(spark):
    df = series(spark, ("2020-01-03", 2.0, 1.0, "n", "new"))
    quick = views.splice_two_views(df, RULE, check=False, view_id="n")
    assert "ubquery" not in quick._jdf.queryExecution().executedPlan().toString()
    assert rows(quick) == rows(views.splice_two_views(df, RULE))


# ------------------------------------------------- launch and first period

MONTHLY = "year string, month string, sessions double, view_id string, view_name string"


def monthly(spark, *records):
    return spark.createDataFrame(records, MONTHLY).withColumn(
        "first_of_month", F.to_date(F.concat_ws("-", "year", "month", F.lit("01")))
    )


def test_drop_prelaunch(spark):
    df = monthly(
        spark,
        ("2020", "05", 1.0, "a", "A"),
        ("2020", "06", 1.0, "a", "A"),  # on the launch date: dropped
        ("2020", "07", 1.0, "a", "A"),
        ("2020", "08", 0.0, "a", "A"),
        ("2020", "09", None, "a", "A"),
        ("2020", "01", 1.0, "b", "B"),  # no rule
    )
    got = views.drop_prelaunch(df, [LaunchRule("A", "2020-06-01")])
    assert rows(got, "view_name", "month") == [("A", "07"), ("B", "01")]


def test_drop_first_period(spark):
    df = monthly(
        spark,
        ("2020", "01", 1.0, "a", "A"),
        ("2019", "12", 1.0, "a", "A"),
        ("2020", "02", 1.0, "b", "A"),  # same name, other id
        ("2020", "02", 1.0, "c", "single"),
    )
    got = views.drop_first_period(df)
    assert rows(got, "view_name", "year", "month") == [
        ("A", "2020", "01"), ("A", "2020", "02"),
    ]


def test_filter_app_set(spark):
    df = daily(
        spark,
        ("2020-01-01", 1.0, 1.0, "a", "A"),
        ("2020-01-01", 2.0, 1.0, "b", "B"),
    )
    sets = spark.createDataFrame(
        [("flagship", "A"), ("flagship", "A"), ("portfolio", "B")],
        "set_name string, view_name string",
    )
    assert rows(views.filter_app_set(df, sets, "flagship"), "view_name") == [("A",)]
