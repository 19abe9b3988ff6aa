import json
import os

import pytest
from conftest import day, plan_of, rows, ts
from pyspark.sql import functions as F

from wattloom.functions.regions import parse_region_code, region_from_file_name
from wattloom.functions.timeparts import parse_day
from wattloom.operators import slices
from wattloom.operators.tables import overwrite_table
from wattloom.plans.bronze import bronze_consumption, bronze_weather
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, HOLIDAYS
from wattloom.sources.consumption import read_raw_consumption
from wattloom.sources.generations import located
from wattloom.sources.tables import (
    available_years,
    high_watermark,
    high_watermarks,
    partition_years,
    read_table,
    read_table_or_empty,
    since,
    year_ranges,
)
from wattloom.sources.weather import read_raw_weather

RAW = "date_heure timestamp_ntz, date string, code_insee_region string, libelle_region string, nature string, consommation double"


def weather_file(folder, name, hourly, **more):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        json.dump({"latitude": 1.5, "hourly_units": {"time": "iso8601"}, "hourly": hourly, **more}, file, indent=1)


def hourly(times, temperature, precipitation):
    return {"time": times, "temperature_2m": temperature, "precipitation": precipitation}


def test_zone_aware_and_naive_files_agree(spark, folder):
    naive = spark.createDataFrame([(ts("2024-07-01 22:00"), "2024-07-02", "11", "x", "n", 5.0)], RAW)
    aware = naive.withColumn("date_heure", F.col("date_heure").cast("timestamp"))
    naive.write.parquet(f"{folder}/raw/a.parquet")
    previous = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    aware.write.parquet(f"{folder}/raw/b.parquet")
    spark.conf.set("spark.sql.parquet.outputTimestampType", previous)
    aware.write.parquet(f"{folder}/raw/c.parquet")
    raw = read_raw_consumption(spark, f"{folder}/raw/*.parquet")
    assert dict(raw.dtypes)["date_heure"] == "timestamp_ntz"
    assert rows(raw, "date_heure") == [(ts("2024-07-01 22:00"),)] * 3


def test_extra_columns_are_not_read(spark, folder):
    spark.createDataFrame([(ts("2024-07-01 22:00"), "2024-07-02", "11", "x", "n", 5, 7.0)], RAW.replace("consommation double", "consommation long") + ", nuclear double").write.parquet(
        f"{folder}/raw"
    )
    file_schema = RAW.replace("consommation double", "consommation long")
    raw = read_raw_consumption(spark, f"{folder}/raw", file_schema)
    assert rows(raw, "consommation") == [(5.0,)]
    assert "nuclear" not in plan_of(raw)
    assert "ReadSchema: struct<consommation:bigint>" in plan_of(raw.select("consommation"))


def test_bronze_follows_the_local_day(spark):
    raw = spark.createDataFrame([(ts("2024-06-30 22:00"), "2024-07-01", "11", "x", "n", 5.0)], RAW)
    assert rows(bronze_consumption(raw), "date", "year", "month", "day") == [(day("2024-07-01"), 2024, 7, 1)]


def test_weather_documents(spark, folder):
    raw = f"{folder}/raw"
    weather_file(raw, "openmeteo-11-2024.json", hourly(["2024-01-01T00:00", "2024-01-01T01:00"], [1, None], [0.5, 0.0]))
    # unequal lengths: cut to the shortest, as a zip does
    weather_file(raw, "openmeteo-44-2024.json", hourly(["2024-01-01T00:00", "2024-01-01T01:00"], [2.0], [0.1, 0.2]))
    weather_file(raw, "openmeteo-93-2024.json", hourly([], [], []))
    weather_file(raw, "openmeteo-11-daily.json", hourly(["2024-01-02T00:00"], [9.0], [0.0]))
    backfill = read_raw_weather(spark, f"{raw}/openmeteo-*.json")
    assert rows(backfill, "region_code", "time", "temperature_2m", "precipitation") == [
        (11, ts("2024-01-01 00:00"), 1.0, 0.5),
        (11, ts("2024-01-01 01:00"), None, 0.0),
        (44, ts("2024-01-01 00:00"), 2.0, 0.1),
    ]
    daily = read_raw_weather(spark, f"{raw}/openmeteo-*.json", daily=True)
    assert rows(daily, "region_code", "temperature_2m") == [(11, 9.0)]


def test_weather_measure_missing_from_a_document(spark, folder):
    weather_file(folder, "openmeteo-11-2024.json", {"time": ["2024-01-01T00:00"], "precipitation": [0.5]})
    assert rows(read_raw_weather(spark, folder), "temperature_2m", "precipitation") == [(None, 0.5)]


@pytest.mark.parametrize("text", ['{"hourly": ', '{"other": 1}'])
def test_broken_weather_documents_fail(spark, folder, text):
    with open(f"{folder}/openmeteo-11-2024.json", "w") as file:
        file.write(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD|no hourly values in openmeteo-11-2024.json"):
        read_raw_weather(spark, folder).collect()


def test_region_from_file_name_splits_at_the_last_dash(spark):
    names = spark.createDataFrame([("openmeteo-11-2024.json",), ("openmeteo-a-b-daily.json",)], "name string")
    assert rows(names.select(region_from_file_name("name"))) == [("11",), ("a-b",)]


def test_bad_region_code_fails_or_becomes_null(spark):
    codes = spark.createDataFrame([("11",), ("2A",)], "code string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        codes.select(parse_region_code("code")).collect()
    assert rows(codes.select(parse_region_code("code", "null"))) == [(11,), (None,)]
    with pytest.raises(ValueError):
        parse_region_code("code", "other")


def _bronze(spark, folder, days):
    raw = [(ts(f"{d} 12:00"), d, "11", "x", "n", 1.0) for d in days]
    overwrite_table(bronze_consumption(spark.createDataFrame(raw, RAW)), BRONZE_CONSUMPTION, folder)
    return read_table(spark, BRONZE_CONSUMPTION, folder)


def test_scoped_read_prunes_partitions_and_pushes_the_filter(spark, folder):
    table = _bronze(spark, folder, ["2023-12-31", "2024-01-09", "2024-01-10", "2024-02-01"])
    scoped = since(table, "date_heure", "2024-01-10")
    assert rows(scoped, "date") == [(day("2024-01-10"),), (day("2024-02-01"),)]
    plan = plan_of(scoped)
    assert "make_date(year" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(date_heure" in plan
    assert since(table, "date_heure", None) is table


def test_scoped_read_keeps_undated_rows(spark, folder):
    raw = [(ts("2024-01-10 12:00"), d, "11", "x", "n", 1.0) for d in (None, "2024-01-10")]
    overwrite_table(bronze_consumption(spark.createDataFrame(raw, RAW)), BRONZE_CONSUMPTION, folder)
    table = read_table(spark, BRONZE_CONSUMPTION, folder)
    assert since(table, "date_heure", "2024-01-10").count() == 2
    assert since(table.drop("month", "day"), "date_heure", "2024-01-10").count() == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_bounds_on_either_timestamp_type(spark, folder, kind):
    times = [(ts(t),) for t in ("2024-01-09 23:59", "2024-01-10 00:00", "2024-01-11 00:00")]
    spark.createDataFrame(times, "t timestamp_ntz").select(F.col("t").cast(kind)).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    assert since(table, "t", "2024-01-10").count() == 2
    scoped = slices.between(table, "t", day("2024-01-10"), ts("2024-01-11 00:00"))
    assert scoped.count() == 1
    assert "GreaterThanOrEqual(t" in plan_of(scoped)


def test_watermark_is_the_newest_partition(spark, folder):
    _bronze(spark, folder, ["2023-12-31", "2024-01-09", "2024-02-01", "2024-02-10"])
    assert high_watermark(spark, folder) == day("2024-02-10")
    # folder names alone count: files are not opened, and a folder without any is no day
    stored = located(spark, folder)
    newest = f"{stored}/year=2024/month=2"
    for file in os.listdir(f"{newest}/day=10"):
        with open(f"{newest}/day=10/{file}", "w") as broken:
            broken.write("not parquet")
    os.makedirs(f"{newest}/day=11")
    os.makedirs(f"{stored}/year=2025/month=1/day=1")
    assert high_watermark(spark, folder) == day("2024-02-10")
    assert partition_years(spark, folder) == [2023, 2024, 2025]


def test_watermark_by_region(spark, folder):
    weather = spark.createDataFrame(
        [(11, ts("2024-01-01 00:00"), 1.0, 0.0), (11, ts("2024-03-01 00:00"), 1.0, 0.0), (44, ts("2023-12-31 23:00"), 1.0, 0.0)],
        "region_code int, time timestamp_ntz, temperature_2m double, precipitation double",
    )
    overwrite_table(bronze_weather(weather), BRONZE_WEATHER, folder)
    marks = high_watermarks(spark, folder, BRONZE_WEATHER)
    assert rows(marks) == [(11, day("2024-03-01")), (44, day("2023-12-31"))]


def test_watermark_of_an_empty_table_fails(spark, folder):
    with pytest.raises(ValueError, match="backfill"):
        high_watermark(spark, f"{folder}/none")
    with pytest.raises(ValueError, match="backfill"):
        high_watermarks(spark, f"{folder}/none", BRONZE_WEATHER)
    assert read_table_or_empty(spark, HOLIDAYS, f"{folder}/none").count() == 0


def test_years(spark):
    times = spark.createDataFrame([(ts("2012-12-31 23:00"),), (ts("2014-06-01 00:00"),)], "t timestamp_ntz")
    years = available_years(times, "t")
    assert rows(years) == [(2013,), (2014,)]
    assert available_years(times.limit(1), "t").count() == 0
    ranged = year_ranges(years, "2014-03-10")
    assert rows(ranged) == [
        (2013, day("2013-01-01"), day("2013-12-31")),
        (2014, day("2014-01-01"), day("2014-03-09")),
    ]


def test_year_slice_leaves_out_today(spark, folder):
    times = [(ts(t),) for t in ["2023-12-31 23:59", "2024-01-01 00:00", "2024-05-01 23:00", "2024-05-02 00:00"]]
    spark.createDataFrame(times, "t timestamp_ntz").write.parquet(f"{folder}/t")
    sliced = slices.year_slice(spark.read.parquet(f"{folder}/t"), "t", 2024, "2024-05-02")
    assert rows(sliced) == [(ts("2024-01-01 00:00"),), (ts("2024-05-01 23:00"),)]
    assert "LessThan(t" in plan_of(sliced) and "GreaterThanOrEqual(t" in plan_of(sliced)


def test_increment_by_series_uses_each_watermark(spark):
    times = [(11, ts("2024-01-01 00:00")), (11, ts("2024-01-05 00:00")), (44, ts("2024-01-01 00:00")), (44, ts("2024-01-09 00:00"))]
    landed = spark.createDataFrame(times, "region_code int, time timestamp_ntz")
    marks = spark.createDataFrame([(11, day("2024-01-05")), (44, day("2024-01-01"))], "region_code int, watermark date")
    picked = slices.increment_slice_by_series(landed, marks, ["region_code"], "time", "2024-01-09")
    assert rows(picked) == [(11, ts("2024-01-05 00:00")), (44, ts("2024-01-01 00:00"))]
    assert rows(slices.unknown_series(landed, marks.filter("region_code = 11"), ["region_code"])) == [(44,)]
    assert slices.unknown_series(landed, marks, ["region_code"]).count() == 0


def test_increment_by_series_reads_nothing_older_than_the_oldest_watermark(spark, folder):
    spark.createDataFrame([(11, ts("2024-01-05 00:00"))], "region_code int, time timestamp_ntz").write.parquet(f"{folder}/l")
    marks = spark.createDataFrame([(11, day("2024-01-05"))], "region_code int, watermark date")
    picked = slices.increment_slice_by_series(spark.read.parquet(f"{folder}/l"), marks, ["region_code"], "time", "2024-01-09")
    assert "GreaterThanOrEqual(time" in plan_of(picked) or "time#" in plan_of(picked).split("DataFilters:")[1].split("]")[0]
    assert picked.count() == 1


@pytest.mark.parametrize("text", ["2024-1-5", "2024", "2024-01-5 ", "2024-13-01", "x"])
def test_days_are_parsed_strictly(spark, text):
    good = spark.createDataFrame([("2024-02-29",), (None,)], "d string")
    assert {r[0] for r in good.select(parse_day("d")).collect()} == {None, day("2024-02-29")}
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT|UPGRADE"):
        spark.createDataFrame([(text,)], "d string").select(parse_day("d")).collect()


def test_resolve_start():
    assert slices.resolve_start(day("2024-01-03")) == "2023-12-27"
    assert slices.resolve_start(ts("2024-01-03 05:00"), days=1) == "2024-01-02"
    assert slices.resolve_start(day("2024-01-03"), target="2020-02-02") == "2020-02-02"
