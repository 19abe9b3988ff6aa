import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from conftest import day, plan_of, rows, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_jobs import lake, land_consumption  # noqa: F401
from test_propagation import files_of, layers

from wattloom.functions.exact import exact_mean, exact_mean_sql
from wattloom.operators import presence, quality, series, summaries, tables
from wattloom.plans import jobs
from wattloom.plans.silver import build_silver, demand_by_hour
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, SILVER
from wattloom.sources.tables import partition_values, read_table

BY = ["s"]


def random_hours(rng, n=300, start=datetime(2018, 12, 1), spread=24 * 365 * 3):
    """Hours of three series over several bitmaps, some repeated."""
    data = [(rng.randrange(3), start + timedelta(hours=rng.randrange(spread))) for _ in range(n)]
    return data + rng.sample(data, n // 10) + [(1, None)]


def frame(spark, data):
    return spark.createDataFrame(data, "s int, t timestamp_ntz").withColumn("year", F.year("t"))


@pytest.mark.parametrize("start", [datetime(2018, 12, 1), datetime(1968, 6, 1)])
def test_gaps_and_repeats_equal_those_of_rows(spark, start):
    df = frame(spark, random_hours(random.Random(7), start=start))
    whole = presence.presence(df, BY, "t")
    parts = [presence.presence(df.filter(f"pmod(hash(t), 3) = {n}"), BY, "t") for n in range(3)]
    merged = presence.merged_presence(parts[0].union(parts[1]).union(parts[2]), BY)
    gaps = rows(series.series_gaps(df, BY, "t", 5))
    counted = df.filter("t is not null").groupBy("s").agg(F.count("*").alias("nb"), F.countDistinct("t").alias("hours"))
    for some in (whole, merged):
        assert rows(presence.presence_gaps(some, BY, "t", 5)) == gaps
        assert rows(presence.presence_counts(some, BY), "s", "nb", "hours") == rows(counted)
    assert presence.presence(df.limit(0), BY, "t").collect() == []


def test_no_window_and_no_row_per_hour_is_shuffled(spark):
    df = spark.range(0, 40_000).selectExpr("cast(id % 2 as int) as s", "timestamp_ntz'2015-01-01' + make_dt_interval(0, cast(id div 2 as int)) as t")
    bitmaps = presence.presence(df, BY, "t")
    assert bitmaps.count() <= 4 and "Window" not in plan_of(presence.presence_gaps(bitmaps, BY, "t"))
    assert presence.presence_gaps(bitmaps, BY, "t").count() == 0


@pytest.mark.parametrize("cuts", [[], [2020], [2019, 2020, 2021]])
def test_summaries_combine_to_the_gate_of_the_whole(spark, cuts):
    data = [(s, t) for s, t in random_hours(random.Random(8), n=2000) if t]
    data = list(dict.fromkeys(data))
    df = frame(spark, data).withColumn("v", F.col("s") * 10.0)
    part = F.lit(0)
    for cut in cuts:
        part = part + (F.col("year") >= cut).cast("int")
    parted = df.withColumn("part", part)
    told = summaries.partition_summary(parted, BY, ["part"], "t", value="v", max_gap=5, low=5, high=100)
    expected = quality.series_summary(df, BY, "t", as_of="2022-01-01", value="v", max_gap=5, low=5, high=100)
    assert rows(summaries.gate_summary(told, BY, ["part"], as_of="2022-01-01", value="v", max_gap=5)) == rows(expected)


def test_repeated_rows_and_nothing(spark):
    df = frame(spark, [(1, ts("2024-01-01 00:00"))] * 3 + [(1, ts("2023-12-31 23:00"))])
    told = summaries.partition_summary(df, BY, ["year"], "t")
    assert dict(rows(summaries.gate_summary(told, BY, ["year"], as_of="2024-01-01"))) == {"duplicates": 2, "gaps": 0, "freshness": 0, "empty": 0}
    none = summaries.partition_summary(df.limit(0), BY, ["year"], "t")
    assert dict(rows(summaries.gate_summary(none, BY, ["year"])))["empty"] == 1


def test_the_gate_reads_touched_partitions_alone(spark, lake, folder):  # noqa: F811
    jobs.rebuild(spark, lake, now="2024-01-03")
    expected = rows(jobs.silver_summaries(spark, lake))
    assert len(expected) == len(partition_values(spark, lake.silver, SILVER.partition_by)) == 4
    # what the gate needs of this folder is in its summary
    broken = [f for f in files_of(lake.silver) if "region_code=44/year=2023" in f]
    for file in broken:
        with open(file, "wb") as out:
            out.write(b"no parquet")
    untouched = {f for f in files_of(lake.summaries) if "region_code=44/year=2023" in f}
    land_consumption(spark, f"{folder}/daily", "2024-01-03", "2024-01-04")
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-04")
    consumption = read_table(spark, BRONZE_CONSUMPTION, lake.consumption).filter("code_insee_region = '11'")
    plan = build_silver(consumption, read_table(spark, BRONZE_WEATHER, lake.weather), since="2024-01-02")
    tables.upsert_table(plan, SILVER, lake.silver, ["consommation"], touching=jobs.forget_summaries(spark, lake))
    after = rows(jobs.silver_summaries(spark, lake))
    assert [row for row in after if row[-2:] != (11, 2024)] == [row for row in expected if row[-2:] != (11, 2024)]
    assert [row for row in after if row[-2:] == (11, 2024)] != [row for row in expected if row[-2:] == (11, 2024)]
    assert untouched and untouched <= files_of(lake.summaries)


def test_a_gap_between_partitions_is_found(spark, lake, folder):  # noqa: F811
    jobs.rebuild(spark, lake, now="2024-01-03")
    before = layers(spark, lake)
    # 2024-01-03 is missing from here on
    land_consumption(spark, f"{folder}/daily", "2024-01-04", "2024-01-05")
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-05")
    with pytest.raises(quality.DataQualityError, match=r"gaps: 2 row\(s\)$"):
        jobs.rolling_run(spark, lake, as_of=day("2024-01-05"), now="2024-01-05")
    assert layers(spark, lake)[1] == before[1]


def test_a_failed_write_leaves_no_stale_summary(spark, lake, monkeypatch):  # noqa: F811
    jobs.rebuild(spark, lake, now="2024-01-03")
    expected = rows(jobs.silver_summaries(spark, lake))
    write = tables._write

    def fail(df, partition_by, path, *options, **more):
        if path.startswith(lake.silver):
            raise OSError("lost")
        return write(df, partition_by, path, *options, **more)

    monkeypatch.setattr(tables, "_write", fail)
    with pytest.raises(OSError):
        jobs.merge_run(spark, lake, now="2024-01-03")
    monkeypatch.undo()
    assert not partition_values(spark, lake.summaries, SILVER.partition_by)
    assert rows(jobs.silver_summaries(spark, lake)) == expected


def test_counts_come_from_the_write(spark, folder):
    df = spark.createDataFrame([(ts(f"2024-01-0{d} 00:00"), r, float(d)) for d in range(1, 6) for r in (1, 2)], "date_heure timestamp_ntz, region_code int, consommation double")
    df = df.withColumn("year", F.year("date_heure"))
    for gather in (True, False):
        found = tables.overwrite_table(df, SILVER, f"{folder}/t", gather=gather, counts=quality.write_counts(["date_heure"], "consommation", low=2, high=4))
        assert found == {"nb": 10, "null_keys": 0, "outliers": 4}
    assert tables.overwrite_table(df.limit(0), SILVER, f"{folder}/t", counts=quality.write_counts(["date_heure"], "consommation"))["nb"] == 0
    assert tables.overwrite_table(df, SILVER, f"{folder}/t") is None
    assert any("region_code=1/" in f for f in files_of(f"{folder}/t"))


def means(spark, values, parts=1):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return df.agg(exact_mean("v").alias("m")).first()["m"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False), min_size=1, max_size=30))
def test_exact_means_are_near_the_true_mean(spark, values):
    true = sum(map(Fraction, values)) / len(values)
    assert abs(Fraction(means(spark, values)) - true) <= Fraction(1, 10**12) + abs(true) / 2**52


def test_exact_means_do_not_depend_on_order(spark):
    rng = random.Random(9)
    values = [rng.choice([rng.random(), rng.random() * 1e9, -rng.random() * 1e5]) for _ in range(500)]
    found = {means(spark, rng.sample(values, len(values)), parts) for parts in (1, 3, 8) for _ in range(3)}
    assert len(found) == 1
    large = [v for v in values if abs(v) >= 4096]
    assert means(spark, large) == pytest.approx(float(sum(map(Fraction, large)) / len(large)), rel=3e-16)


@settings(max_examples=25, deadline=None)
@given(st.floats(-1e9, 1e9).filter(lambda v: v == 0 or abs(v) >= 1e-3))
def test_the_mean_of_one_value_is_that_value(spark, value):
    assert means(spark, [value]) == means(spark, [value] * 4) == value


def test_means_of_odd_values(spark):
    assert means(spark, [None, None]) is None
    assert means(spark, []) is None
    assert means(spark, [None, 3.0, 4.0]) == 3.5
    assert math.isnan(means(spark, [1.0, float("nan")]))
    assert means(spark, [1.0, float("inf")]) == float("inf")
    assert means(spark, [1e300, 3e300]) == 2e300
    assert means(spark, [-0.5, -1.5]) == -1.0


def test_hours_of_readings_dealt_in_other_ways(spark):
    rng = random.Random(10)
    data = [(datetime(2024, 1, 1, rng.randrange(4), 30 * rng.randrange(2)), str(rng.choice([11, 44])), rng.random() * 1e4) for _ in range(2000)]
    df = spark.createDataFrame(data, "date_heure timestamp_ntz, code_insee_region string, consommation double")
    assert len({tuple(rows(demand_by_hour(df.repartition(n)))) for n in (1, 2, 5, 9)}) == 1
    windowed = df.groupBy("date_heure").agg(F.expr("max(consommation)").alias("consommation"))
    over = F.expr(exact_mean_sql("consommation", "OVER (ORDER BY date_heure ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"))
    plain = F.expr("avg(consommation) OVER (ORDER BY date_heure ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
    for row in windowed.select(over.alias("a"), plain.alias("b")).collect():
        assert row["a"] == pytest.approx(row["b"], rel=1e-14)


def test_a_rolling_run_reads_no_silver_of_untouched_years(spark, lake, folder):  # noqa: F811
    land_consumption(spark, f"{folder}/daily", "2024-01-03", "2024-01-20")
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-20")
    jobs.rebuild(spark, lake, now="2024-01-20")
    for file in files_of(lake.silver):
        if "year=2023" in file:
            with open(file, "wb") as out:
                out.write(b"no parquet")
    land_consumption(spark, f"{folder}/later", "2024-01-19", "2024-01-21", version=2)
    jobs.increment_consumption(spark, lake, f"{folder}/later", as_of="2024-01-21")
    jobs.rolling_run(spark, lake, as_of=day("2024-01-21"), days=3, now="2024-01-21")
    fact = jobs.read_fact(spark, lake)
    assert fact.filter("date_heure >= '2024-01-20'").count() == 48
    # a gap that reaches back into the unread year would still be found by its summary
    assert dict(rows(summaries.gate_summary(jobs.silver_summaries(spark, lake), jobs.SERIES, jobs.PART, as_of="2024-01-21"))) == {
        "duplicates": 0,
        "gaps": 0,
        "freshness": 0,
        "empty": 0,
    }
