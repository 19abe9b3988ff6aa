from datetime import timedelta

import pytest
from conftest import rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.functions.timeparts import hours_between, instant
from wattloom.operators.series import lag_by_join, per_instant, series_gaps, time_bucket, with_trailing_features
from wattloom.plans.silver import demand_by_hour, weather_by_instant

START = ts("2024-01-01 00:00")


def series(spark, points):
    """points: (region, hours after START, value)"""
    data = [(region, START + timedelta(hours=h), value) for region, h, value in points]
    return spark.createDataFrame(data, "region_code int, date_heure timestamp_ntz, consommation double")


def features(df, **options):
    found = with_trailing_features(df, ["region_code"], "consommation", **options)
    return {(r[0], r[1]): (r["conso_moyenne_mobile_7j"], r["conso_j_moins_7"]) for r in found.collect()}


def test_time_bucket_keeps_the_timestamp_type(spark):
    df = series(spark, [(11, 0.25, 1.0), (11, 0.75, 3.0), (11, 1.0, 10.0)])
    for cast in ("timestamp_ntz", "timestamp"):
        typed = df.withColumn("date_heure", F.col("date_heure").cast(cast))
        bucketed = time_bucket(typed, ["region_code"], F.avg("consommation").alias("consommation"))
        assert bucketed.schema["date_heure"].dataType == typed.schema["date_heure"].dataType
        assert sorted(r["consommation"] for r in bucketed.collect()) == [2.0, 10.0]
    largest = time_bucket(df, [], F.max("consommation").alias("top"), unit="day")
    assert rows(largest) == [(START, 10.0)]


def test_hourly_mean_is_a_mean_of_instant_means(spark):
    raw = [("11", ts("2024-01-01 00:00"), 0.0), ("11", ts("2024-01-01 00:00"), 2.0), ("11", ts("2024-01-01 00:30"), 9.0),
           ("44", ts("2024-01-01 00:00"), None), ("44", ts("2024-01-01 01:00"), None), ("44", ts("2024-01-01 01:00"), 4.0)]
    df = spark.createDataFrame(raw, "code_insee_region string, date_heure timestamp_ntz, consommation double")
    assert rows(demand_by_hour(df)) == [
        (11, ts("2024-01-01 00:00"), 5.0),
        (44, ts("2024-01-01 00:00"), None),
        (44, ts("2024-01-01 01:00"), 4.0),
    ]


def test_weather_is_deduplicated_without_truncation(spark):
    raw = [(11, ts("2024-01-01 00:00"), 1.0, None), (11, ts("2024-01-01 00:00"), 3.0, None), (11, ts("2024-01-01 00:30"), 7.0, 1.0)]
    df = spark.createDataFrame(raw, "region_code int, time timestamp_ntz, temperature_2m double, precipitation double")
    assert rows(weather_by_instant(df)) == [
        (11, ts("2024-01-01 00:00"), 2.0, None),
        (11, ts("2024-01-01 00:30"), 7.0, 1.0),
    ]


def test_rolling_frame_includes_both_ends(spark):
    week = 7 * 24
    df = series(spark, [(11, 0, 100.0), (11, 1, 10.0), (11, week, 1.0), (11, week + 1, 4.0)])
    found = features(df)
    at = lambda h: found[(11, START + timedelta(hours=h))]
    assert at(week) == ((100 + 10 + 1) / 3, 100.0)
    # one hour later the first row is out of reach
    assert at(week + 1) == ((10 + 1 + 4) / 3, 10.0)


def test_full_density_frame_has_169_rows(spark):
    df = series(spark, [(11, h, float(h)) for h in range(400)])
    mean, lag = features(df)[(11, START + timedelta(hours=399))]
    assert mean == sum(range(399 - 168, 400)) / 169
    assert lag == 399 - 168


def test_missing_hours_shift_nothing(spark):
    week = 7 * 24
    df = series(spark, [(11, 0, 1.0), (11, 5, 2.0), (11, week + 5, None), (11, week + 6, 3.0)])
    found = features(df)
    # a NULL of its own still gets the mean of the others; an absent instant gives no lag
    assert found[(11, START + timedelta(hours=week + 5))] == (2.0, 2.0)
    assert found[(11, START + timedelta(hours=week + 6))] == (3.0, None)


def test_rows_without_an_instant_are_kept(spark):
    df = spark.createDataFrame([(11, None, 1.0), (11, START, 2.0)], "region_code int, date_heure timestamp_ntz, consommation double")
    assert with_trailing_features(df, ["region_code"], "consommation").count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from([11, 44]), st.integers(-2000, 2000), st.one_of(st.none(), st.integers(0, 1000))),
        min_size=1,
        max_size=120,
        unique_by=lambda p: p[:2],
    ),
    st.sampled_from([1, 3, 7, 10, 56]),
)
def test_stretches_give_the_plain_window(spark, points, bucket_days):
    df = series(spark, [(r, h, None if v is None else float(v)) for r, h, v in points])
    plain = features(df, bucket_days=None)
    assert len(plain) == len(points)
    assert features(df, bucket_days=bucket_days) == plain
    joined = {(r[0], r[1]): r[3] for r in lag_by_join(df, ["region_code"], "consommation").collect()}
    assert joined == {key: value[1] for key, value in plain.items()}


def test_lag_by_join_fans_out_on_repeats(spark):
    df = series(spark, [(11, 0, 1.0), (11, 0, 2.0), (11, 168, 3.0)])
    assert rows(lag_by_join(df, ["region_code"], "consommation").filter("consommation = 3"), "conso_j_moins_7") == [(1.0,), (2.0,)]


def test_one_shuffle_for_mean_and_lag(spark):
    df = series(spark, [(11, 0, 1.0)])
    plan = with_trailing_features(df, ["region_code"], "consommation")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_hours_between_counts_boundaries(spark):
    pairs = [("2024-01-01 00:59:00", "2024-01-01 02:01:00"), ("2024-01-01 00:00:00", "2024-01-01 00:59:59"), ("2024-01-02 00:00:00", "2024-01-01 23:59:00"), ("1969-12-31 23:30:00", "1970-01-01 00:10:00")]
    df = spark.createDataFrame(pairs, "a string, b string").selectExpr("cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    assert [r[0] for r in df.select(hours_between("a", "b")).collect()] == [2, 0, -1, 1]


def test_gaps(spark):
    # hour 2 missing is tolerated; hours 4 and 5 missing are a gap; half hours are none
    df = series(spark, [(11, 0, 1.0), (11, 0.5, 1.0), (11, 1, 1.0), (11, 3, 1.0), (11, 6.25, 1.0), (11, 6.25, 2.0), (44, 0, 1.0)])
    assert rows(series_gaps(df, ["region_code"])) == [(11, START + timedelta(hours=6.25), 3)]
    assert rows(series_gaps(df, ["region_code"], max_hours=1), "ecart_h") == [(2,), (3,)]


def test_gaps_across_years(spark):
    df = series(spark, [(11, 0, 1.0), (11, 20_000, 1.0)])
    assert rows(series_gaps(df, ["region_code"]), "ecart_h") == [(20_000,)]


def test_per_instant_takes_any_aggregate(spark):
    df = series(spark, [(11, 0, 1.0), (11, 0, 5.0)])
    assert rows(per_instant(df, ["region_code"], [F.max("consommation").alias("consommation")]), "consommation") == [(5.0,)]


@pytest.mark.parametrize("value", ["2024-01-01", START.date(), START])
def test_bounds_of_any_kind(spark, value):
    assert spark.range(1).select(instant(value)).first()[0] == START
