import json
import os
from datetime import datetime, timedelta

import pytest
from conftest import day, rows, ts

from wattloom.operators.quality import DataQualityError, key_violations, orphan_keys
from wattloom.plans import jobs
from wattloom.plans.gold import build_fact
from wattloom.plans.silver import build_silver
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, DIM_DATE, DIM_REGION, HOLIDAYS
from wattloom.sources.calendars import holiday_calendar
from wattloom.sources.tables import read_table, since

RAW = "date_heure timestamp_ntz, date string, code_insee_region string, libelle_region string, nature string, consommation double"
REGIONS = (11, 44)


def hours(start, end):
    at = datetime.fromisoformat(start)
    while at < datetime.fromisoformat(end):
        yield at
        at += timedelta(hours=1)


def value(at, region, version=0):
    return float((at.toordinal() * 24 + at.hour) * 7 % 1000 + region + version)


def land_consumption(spark, path, start, end, version=0):
    data = []
    for at in hours(start, end):
        local_day = (at + timedelta(hours=1)).date().isoformat()
        for region in REGIONS:
            data.append((at, local_day, str(region), f"r{region}", "d", value(at, region, version)))
            if at.hour == 5:
                # one instant delivered twice with different values
                data.append((at, local_day, str(region), f"r{region}", "d", value(at, region, version) + 10))
    spark.createDataFrame(data, RAW).write.mode("append").parquet(path)


def land_weather(folder, start, end, label):
    os.makedirs(folder, exist_ok=True)
    for region in (11,):
        times = list(hours(start, end))
        document = {
            "hourly": {
                "time": [at.strftime("%Y-%m-%dT%H:%M") for at in times],
                "temperature_2m": [value(at, region) / 10 for at in times],
                "precipitation": [0.0 for _ in times],
            }
        }
        with open(f"{folder}/openmeteo-{region}-{label}.json", "w") as file:
            json.dump(document, file)


@pytest.fixture
def lake(spark, folder):
    """Bronze from 2023-12-20 to 2024-01-03 (exclusive), with holidays and dimensions."""
    lake = jobs.Lake(f"{folder}/lake")
    land_consumption(spark, f"{folder}/yearly", "2023-12-20", "2024-01-03")
    land_weather(f"{folder}/weather", "2023-12-20", "2024-01-03", "2023")
    jobs.backfill_consumption(spark, lake, f"{folder}/yearly", flat_path=f"{folder}/flat")
    jobs.backfill_weather(spark, lake, f"{folder}/weather/openmeteo-*.json")
    jobs.build_holidays(spark, lake)
    jobs.build_dimensions(spark, lake)
    return lake


def bronze(spark, lake):
    return rows(read_table(spark, BRONZE_CONSUMPTION, lake.consumption))


def test_backfill(spark, lake, folder):
    stored = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    assert stored.count() == 14 * 2 * 25
    assert rows(stored.filter("date_heure = '2024-01-02 23:00'"), "day", "code_insee_region") == [(3, "11"), (3, "44")]
    assert spark.read.parquet(f"{folder}/flat").count() == stored.count()
    before = bronze(spark, lake)
    jobs.backfill_consumption(spark, lake, f"{folder}/yearly", day_ordered=True)
    assert bronze(spark, lake) == before
    assert read_table(spark, BRONZE_WEATHER, lake.weather).count() == 14 * 24
    assert read_table(spark, HOLIDAYS, lake.holidays).count() == 2412
    assert read_table(spark, DIM_DATE, lake.dates).count() == 7000
    assert read_table(spark, DIM_REGION, lake.regions).count() == 12


def test_day_by_day_increments_equal_one_backfill(spark, lake, folder):
    for end in ("2024-01-04", "2024-01-05", "2024-01-06"):
        start = (datetime.fromisoformat(end) - timedelta(days=2)).date().isoformat()
        # files overlap, and hold the unfinished day as well
        land_consumption(spark, f"{folder}/daily-{end}", start, f"{end} 05:00")
        touched = jobs.increment_consumption(spark, lake, f"{folder}/daily-{end}", as_of=end)
        assert touched.count() <= 3
    jobs.increment_consumption(spark, lake, f"{folder}/daily-2024-01-06", as_of="2024-01-06")
    whole = jobs.Lake(f"{folder}/whole")
    land_consumption(spark, f"{folder}/all", "2023-12-20", "2024-01-06")
    jobs.backfill_consumption(spark, whole, f"{folder}/all")
    assert bronze(spark, lake) == bronze(spark, whole)


def test_increment_keeps_the_first_hours_of_the_newest_day(spark, lake, folder):
    # the newest partition is the local day 2024-01-03, whose first hour is 23:00 UTC
    # of the day before; a feed that starts at midnight UTC must not lose it
    land_consumption(spark, f"{folder}/daily", "2024-01-03", "2024-01-04")
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-04")
    stored = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    assert stored.filter("date_heure = '2024-01-02 23:00'").count() == 2
    assert stored.count() == 15 * 2 * 25


def test_increment_needs_a_backfill(spark, folder):
    land_consumption(spark, f"{folder}/daily", "2024-01-03", "2024-01-04")
    with pytest.raises(ValueError, match="run the backfill"):
        jobs.increment_consumption(spark, jobs.Lake(f"{folder}/none"), f"{folder}/daily", as_of="2024-01-04")


def test_weather_increment(spark, lake, folder):
    raw = f"{folder}/weather/openmeteo-*.json"
    land_weather(f"{folder}/weather", "2024-01-02", "2024-01-05", "daily")
    touched = jobs.increment_weather(spark, lake, raw, as_of="2024-01-04", flat_path=f"{folder}/flat-weather")
    assert rows(touched) == [(11, 2024, 1, 2), (11, 2024, 1, 3)]
    jobs.increment_weather(spark, lake, raw, as_of="2024-01-04")
    stored = read_table(spark, BRONZE_WEATHER, lake.weather)
    assert stored.count() == stored.select("time", "region_code").distinct().count() == 15 * 24
    assert spark.read.parquet(f"{folder}/flat-weather").count() == 48


def test_rebuild(spark, lake):
    jobs.rebuild(spark, lake, now="2024-01-03")
    silver = {(r["date_heure"], r["region_code"]): r for r in jobs.read_silver(spark, lake).collect()}
    assert len(silver) == 14 * 24 * 2
    five = ts("2024-01-01 05:00")
    assert silver[(five, 11)]["consommation"] == value(five, 11) + 5
    assert silver[(five, 11)]["temperature_2m"] == value(five, 11) / 10
    # a region without weather, and holidays by UTC day
    assert silver[(five, 44)]["temperature_2m"] is None
    flagged = {key for key, row in silver.items() if row["is_holiday"]}
    assert flagged == {(at, 11) for d in ("2023-12-25", "2024-01-01") for at in hours(d, f"{d} 23:30")} | {
        (at, 44) for d in ("2023-12-25", "2023-12-26", "2024-01-01") for at in hours(d, f"{d} 23:30")
    }
    fact = jobs.read_fact(spark, lake)
    assert fact.count() == len(silver)
    at = ts("2024-01-02 12:00")
    week = [value(h, 11) + (5 if h.hour == 5 else 0) for h in hours("2023-12-26 12:00", "2024-01-02 13:00")]
    row = fact.filter(f"date_heure = '{at}' and region_code = 11").first()
    assert row["conso_j_moins_7"] == value(at - timedelta(days=7), 11)
    assert row["conso_moyenne_mobile_7j"] == pytest.approx(sum(week) / 169, rel=1e-12)
    assert row["date_key"] == day("2024-01-02")
    assert key_violations(fact, ["date_heure", "region_code"]).count() == 0
    for key, path, dataset in (("date_key", lake.dates, DIM_DATE), ("region_code", lake.regions, DIM_REGION)):
        assert orphan_keys(fact, key, read_table(spark, dataset, path), key).count() == 0


def test_rolling_run_equals_a_rebuild_and_keeps_earlier_rows(spark, lake, folder):
    jobs.rebuild(spark, lake, now="2024-01-03")
    # two new days arrive, and the last week is delivered again with other values
    land_consumption(spark, f"{folder}/daily", "2024-01-01", "2024-01-05", version=3)
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-05")
    jobs.rolling_run(spark, lake, as_of=day("2024-01-05"), now="2024-01-05", flat_path=f"{folder}/flat-silver")
    # from 29 December on: the last week up to the day before
    assert spark.read.parquet(f"{folder}/flat-silver").count() == 7 * 24 * 2
    rolled = rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))
    assert len(rolled[0]) == 16 * 24 * 2
    jobs.rolling_run(spark, lake, as_of=day("2024-01-05"), now="2024-01-05", target="2023-12-30")
    assert (rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))) == rolled
    jobs.rebuild(spark, lake, now="2024-01-05", flat_path=f"{folder}/flat-silver")
    assert rows(spark.read.parquet(f"{folder}/flat-silver")) == rolled[0]
    assert (rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))) == rolled


def test_failed_gate_leaves_gold_alone(spark, lake, folder):
    jobs.rebuild(spark, lake, now="2024-01-03")
    before = rows(jobs.read_fact(spark, lake))
    land_consumption(spark, f"{folder}/daily", "2024-01-03 12:00", "2024-01-05")
    jobs.increment_consumption(spark, lake, f"{folder}/daily", as_of="2024-01-05")
    with pytest.raises(DataQualityError, match=r"gaps: 2 row\(s\)$"):
        jobs.rolling_run(spark, lake, as_of=day("2024-01-05"), now="2024-01-05")
    assert rows(jobs.read_fact(spark, lake)) == before
    with pytest.raises(DataQualityError, match="freshness"):
        jobs.rebuild(spark, lake)


@pytest.mark.parametrize("start", ["2023-12-27", "2024-01-01"])
def test_scoped_plans_equal_the_full_plans_on_their_scope(spark, lake, start):
    consumption = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    weather = read_table(spark, BRONZE_WEATHER, lake.weather)
    holidays = read_table(spark, HOLIDAYS, lake.holidays)
    for zone in (None, "Europe/Paris", "America/New_York"):
        full = build_silver(consumption, weather, holidays, calendar_tz=zone)
        scoped = build_silver(consumption, weather, holidays, since=start, calendar_tz=zone)
        assert rows(scoped) == rows(since(full, "date_heure", start))
    assert rows(build_fact(full, since=start)) == rows(since(build_fact(full), "date_heure", start))


def test_local_day_calendar(spark, lake):
    consumption = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    weather = read_table(spark, BRONZE_WEATHER, lake.weather)
    local = build_silver(consumption, weather, holiday_calendar(spark), calendar_tz="Europe/Paris")
    flagged = rows(local.filter("is_holiday = 1 and region_code = 11 and year(date_heure) = 2023"), "date_heure")
    assert flagged[0] == (ts("2023-12-24 23:00"),) and (ts("2023-12-25 23:00"),) not in flagged
    # midnight of New Year's Day in Paris is still last year in UTC
    assert flagged[-1] == (ts("2023-12-31 23:00"),)


def test_a_holiday_listed_twice_repeats_no_hour(spark, lake):
    consumption = read_table(spark, BRONZE_CONSUMPTION, lake.consumption)
    weather = read_table(spark, BRONZE_WEATHER, lake.weather)
    holidays = holiday_calendar(spark, 2023, 2024)
    once = build_silver(consumption, weather, holidays)
    assert rows(build_silver(consumption, weather, holidays.unionByName(holidays))) == rows(once)
    assert rows(build_silver(consumption, weather).agg({"is_holiday": "max"})) == [(0,)]


def test_a_run_needs_the_calendar_of_its_years(spark, lake, folder):
    jobs.rebuild(spark, lake, now="2024-01-03")
    before = rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))
    jobs.build_holidays(spark, lake, 2024, 2030)
    with pytest.raises(ValueError, match=r"lacks the years \[2023\]"):
        jobs.rebuild(spark, lake, now="2024-01-03")
    bare = jobs.Lake(f"{folder}/bare")
    jobs.backfill_consumption(spark, bare, f"{folder}/yearly")
    jobs.backfill_weather(spark, bare, f"{folder}/weather/openmeteo-*.json")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.rebuild(spark, bare, now="2024-01-03")
    jobs.rebuild(spark, bare, now="2024-01-03", holidays=False)
    assert rows(jobs.read_silver(spark, bare).agg({"is_holiday": "max"})) == [(0,)]
    with pytest.raises(ValueError, match="lacks"):
        jobs.rolling_run(spark, lake, as_of=day("2024-01-03"), now="2024-01-03")
    assert (rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))) == before


def test_an_empty_bronze_replaces_nothing(spark, lake, folder):
    jobs.rebuild(spark, lake, now="2024-01-03")
    before = rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))
    spark.createDataFrame([], RAW).write.parquet(f"{folder}/empty")
    jobs.backfill_consumption(spark, lake, f"{folder}/empty")
    with pytest.raises(DataQualityError, match="empty"):
        jobs.rebuild(spark, lake, now="2024-01-03")
    assert (rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))) == before


def test_a_merging_full_run_equals_a_rebuild_and_deletes_nothing(spark, lake, folder):
    jobs.rebuild(spark, lake, now="2024-01-03")
    before = rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))
    jobs.merge_run(spark, lake, now="2024-01-03")
    assert (rows(jobs.read_silver(spark, lake)), rows(jobs.read_fact(spark, lake))) == before
    land_consumption(spark, f"{folder}/fewer", "2024-01-01", "2024-01-03")
    jobs.backfill_consumption(spark, lake, f"{folder}/fewer")
    jobs.merge_run(spark, lake, now="2024-01-03")
    assert jobs.read_silver(spark, lake).count() == len(before[0])


def test_freshness_goes_by_the_clock(spark, lake):
    # the newest hour is 2024-01-02 23:00
    jobs.rebuild(spark, lake, now="2024-01-04 23:00:00")
    with pytest.raises(DataQualityError, match="freshness"):
        jobs.rebuild(spark, lake, now="2024-01-05 00:00:00")
    with pytest.raises(DataQualityError, match="freshness"):
        jobs.rolling_run(spark, lake, as_of=day("2024-01-03"))


def test_an_unknown_region_fails(spark, lake, folder):
    land_weather(f"{folder}/weather", "2024-01-02", "2024-01-05", "daily")
    os.rename(f"{folder}/weather/openmeteo-11-daily.json", f"{folder}/weather/openmeteo-93-daily.json")
    with pytest.raises(ValueError, match=r"regions \[93\]"):
        jobs.increment_weather(spark, lake, f"{folder}/weather/openmeteo-*.json", as_of="2024-01-04")


def test_jobs_leave_the_callers_settings_and_scratch_alone(spark, lake):
    before = dict(spark.conf.getAll)
    jobs.rebuild(spark, lake, now="2024-01-03")
    jobs.rolling_run(spark, lake, as_of=day("2024-01-03"), now="2024-01-03")
    assert dict(spark.conf.getAll) == before
    scratch = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    assert [f for f in os.listdir(scratch) if f.startswith("staged-")] == []
