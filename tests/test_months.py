"""Bronze in folders of months, or of days where a lake asks for them or has them."""

import os

import pytest
from conftest import day, plan_of, rows, ts
from pyspark.sql import functions as F
from test_jobs import land_consumption, land_weather

from wattloom.operators import tables
from wattloom.plans import jobs
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, CHANGES
from wattloom.sources.generations import located
from wattloom.sources.tables import high_watermark, high_watermarks, partition_values, read_table, since, stored_layout

MONTHS, DAYS = ("year", "month"), ("year", "month", "day")


def built(spark, folder, name, day_folders):
    """Bronze of 2023-11-28 to 2024-01-03 (exclusive), and two more days."""
    lake = jobs.Lake(f"{folder}/{name}", day_folders=day_folders)
    if not os.path.exists(f"{folder}/yearly"):
        land_consumption(spark, f"{folder}/yearly", "2023-11-28", "2024-01-03")
        land_weather(f"{folder}/weather", "2023-11-28", "2024-01-03", "2023")
        land_consumption(spark, f"{folder}/daily", "2024-01-02", "2024-01-05", version=3)
        land_weather(f"{folder}/weather", "2024-01-02", "2024-01-05", "daily")
    weather = f"{folder}/weather/openmeteo-*.json"
    jobs.backfill_consumption(spark, lake, f"{folder}/yearly")
    jobs.backfill_weather(spark, lake, weather)
    # who opens the lake for increments need not know its folders
    same = jobs.Lake(lake.root)
    return lake, [
        rows(jobs.increment_consumption(spark, same, f"{folder}/daily", as_of="2024-01-05")),
        rows(jobs.increment_weather(spark, same, weather, as_of="2024-01-05")),
    ]


def test_a_month_of_bronze_is_one_folder(spark, folder):
    # a folder for each day's few hundred rows made runs over long histories time out
    (monthly, touched), (daily, touched_days) = built(spark, folder, "m", False), built(spark, folder, "d", True)
    assert touched == touched_days == [[(2024, 1, n) for n in (2, 3, 4, 5)], [(11, 2024, 1, n) for n in (2, 3, 4)]]
    for dataset, name in ((BRONZE_CONSUMPTION, "consumption"), (BRONZE_WEATHER, "weather")):
        path, by_day = getattr(monthly, name), getattr(daily, name)
        stored = read_table(spark, dataset, path)
        assert stored.columns == dataset.columns
        assert rows(stored) == rows(read_table(spark, dataset, by_day))
        assert len(partition_values(spark, path, MONTHS)) == len(set(stored.inputFiles())) == 3
        assert not partition_values(spark, path, DAYS)
        # a table with folders of days keeps them, for every day that increments brought
        assert len(partition_values(spark, by_day, DAYS)) == stored.select(*DAYS).distinct().count()


def test_watermark_of_a_month_comes_from_its_files(spark, folder):
    lake, _ = built(spark, folder, "m", False)
    # the local day is an hour ahead
    assert high_watermark(spark, lake.consumption) == day("2024-01-05")
    assert rows(high_watermarks(spark, lake.weather, BRONZE_WEATHER)) == [(11, day("2024-01-04"))]
    os.makedirs(f"{located(spark, lake.consumption)}/year=2025/month=1")
    assert high_watermark(spark, lake.consumption) == day("2024-01-05")


def test_scoped_reads_and_ranges_open_only_their_months(spark, folder):
    lake, _ = built(spark, folder, "m", False)
    stored = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    scoped = since(stored, "date_heure", "2024-01-02")
    assert scoped.count() == stored.filter("date_heure >= '2024-01-02'").count() > 0
    scan = plan_of(scoped).split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "make_date(year" in scan and "day" not in scan
    monthly = BRONZE_CONSUMPTION.by_month()
    touched = spark.createDataFrame([(2023, 12), (2024, 1)], "year int, month int")
    near = tables.in_touched(stored, touched, monthly.partition_by)
    assert near.count() == stored.filter("date >= '2023-12-01'").count()
    # December to January is no range of months of both years
    assert "make_date(year" in plan_of(near).split("PartitionFilters:")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("day_folders", [False, True])
def test_undated_rows_stay_in_their_folder(spark, folder, day_folders):
    lake = jobs.Lake(f"{folder}/lake", day_folders=day_folders)
    layout = lake.bronze(BRONZE_CONSUMPTION)
    schema = BRONZE_CONSUMPTION.schema
    undated = [(ts(f"2024-01-01 0{n}:00"), None, "11", None, None, float(n), None, None, None) for n in (1, 2)]
    tables.overwrite_table(spark.createDataFrame(undated, schema), layout, lake.consumption)
    assert stored_layout(spark, BRONZE_CONSUMPTION, lake.consumption, None) == layout
    late = spark.createDataFrame(undated[:1], schema).withColumn("consommation", F.lit(7.0))
    assert rows(tables.replace_by_key(late, layout, lake.consumption)) == [(None, None, None)]
    assert rows(read_table(spark, BRONZE_CONSUMPTION, lake.consumption), "consommation") == [(2.0,), (7.0,)]


def test_ingested_days_are_told_apart_in_months(spark, folder):
    lake, _ = built(spark, folder, "m", False)
    land_consumption(spark, f"{folder}/late", "2023-12-05", "2023-12-06", version=9)
    assert rows(jobs.ingest_consumption(spark, lake, f"{folder}/late")) == [(2023, 12, 5), (2023, 12, 6)]
    stored = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    assert stored.filter("date between '2023-12-01' and '2023-12-31'").count() == 31 * 2 * 25
    assert spark.read.schema(CHANGES.schema).parquet(lake.changes).select("date_heure").distinct().count() == 24
