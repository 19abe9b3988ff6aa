import json
import uuid


import pytest
from conftest import plan_of, rows, ts
from pyspark.sql import functions as F
from test_jobs import lake  # noqa: F401

from wattloom.operators import bucketed, tables
from wattloom.plans import jobs
from wattloom.plans.bronze import bronze_weather
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, HOLIDAYS, SILVER, Dataset
from wattloom.sources.tables import high_watermarks, partition_values, read_table
from wattloom.sources.weather import measure_rows, read_raw_weather, read_weather_documents

HOURS = Dataset("hours", type(SILVER.schema)([SILVER.schema[c] for c in ("date_heure", "region_code", "consommation")]), key=SILVER.key)


def hours_of(spark, n, first=0):
    return spark.range(first, n).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id div 3 as int))").alias("date_heure"),
        (F.col("id") % 3).cast("int").alias("region_code"),
        F.col("id").cast("double").alias("consommation"),
    )


def name(label):
    return f"{label}_{uuid.uuid4().hex}"


def test_buckets_join_without_a_shuffle(spark, folder):
    left, right = name("a"), name("b")
    bucketed.save_bucketed(hours_of(spark, 900), HOURS, left, 4, f"{folder}/a")
    bucketed.save_bucketed(hours_of(spark, 1200, 300), HOURS, right, 4, f"{folder}/b")
    sides = bucketed.read_bucketed(spark, HOURS, left), bucketed.read_bucketed(spark, HOURS, right).withColumnRenamed("consommation", "other")
    joined = bucketed.join_bucketed(*sides, HOURS.key)
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    expected = hours_of(spark, 900).join(hours_of(spark, 1200, 300).withColumnRenamed("consommation", "other"), list(HOURS.key), "left")
    assert rows(joined) == rows(expected)


def test_a_merge_shuffles_its_source_alone(spark, folder):
    first, second = name("a"), name("b")
    target, source = hours_of(spark, 600), hours_of(spark, 900, 450).withColumn("consommation", F.when(F.col("region_code") > 0, F.col("consommation") + 1))
    bucketed.save_bucketed(target, HOURS, first, 4, f"{folder}/a")
    bucketed.merge_bucketed(spark, source, HOURS, first, second, ["consommation"], 4, f"{folder}/b")
    merged = bucketed.read_bucketed(spark, HOURS, second)
    assert rows(merged) == rows(tables.merged(target, source, HOURS.key, ["consommation"]))
    # buckets stay whole: the merged table joins without a shuffle again
    again = bucketed.join_bucketed(merged, bucketed.read_bucketed(spark, HOURS, first).drop("consommation"), HOURS.key)
    assert "Exchange" not in plan_of(again) and again.count() == 900
    twice = source.union(source.limit(1))
    with pytest.raises(Exception, match="more than once"):
        bucketed.merge_bucketed(spark, twice, HOURS, first, name("c"), ["consommation"], 4, f"{folder}/c")


def scanned_rows(frame):
    """Rows that the scan handed on, which leaves out skipped pages and row groups."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def readings(spark, n):
    """A day of readings of twelve regions, as they arrive: by instant."""
    return spark.range(n).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 86400 / 600000)").alias("date_heure"),
        F.lit("2024-01-01").cast("date").alias("date"),
        (F.col("id") % 12 + 11).cast("string").alias("code_insee_region"),
        F.lit(None).cast("string").alias("libelle_region"),
        F.lit("n").alias("nature"),
        F.col("id").cast("double").alias("consommation"),
        F.lit(2024).alias("year"),
        F.lit(1).alias("month"),
        F.lit(1).alias("day"),
    )


def test_a_lookup_of_one_region_skips_the_others(spark, folder):
    n = 600_000
    tables.overwrite_table(readings(spark, n), BRONZE_CONSUMPTION, f"{folder}/t")
    stored = read_table(spark, BRONZE_CONSUMPTION, f"{folder}/t")
    found = stored.filter("day = 1 and code_insee_region = '13'")
    assert found.count() == n // 12
    # pages of 20,000 rows: the region's own, and what shares them
    assert scanned_rows(found) <= n // 12 + 2 * 20_000
    # a region that no row group holds is known from the Bloom filters, though it lies inside the range
    assert scanned_rows(stored.filter("code_insee_region = '135'")) == 0
    unsorted = f"{folder}/plain"
    readings(spark, n).write.partitionBy("year", "month", "day").parquet(unsorted)
    assert scanned_rows(read_table(spark, BRONZE_CONSUMPTION, unsorted).filter("day = 1 and code_insee_region = '13'")) == n


def document(folder, file, hourly):
    with open(f"{folder}/{file}", "w") as out:
        json.dump({"hourly": hourly, "units": {"time": "iso"}}, out)


def test_documents_of_any_arrays(spark, folder):
    times = ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"]
    document(folder, "openmeteo-11-2024.json", {"time": times, "temperature_2m": [1, None, 3.5], "wind": [7, 8, 9], "code": ["a", "b"]})
    document(folder, "openmeteo-44-2024.json", {"time": times[:1], "precipitation": [0.5], "none": None})
    document(folder, "openmeteo-93-2024.json", {"time": [], "wind": []})
    found = measure_rows(read_weather_documents(spark, f"{folder}/*.json"))
    zero, one = ts("2024-01-01 00:00"), ts("2024-01-01 01:00")
    assert rows(found, "region_code", "time", "measure", "value", "number") == sorted(
        [
            (11, zero, "temperature_2m", "1", 1.0),
            (11, one, "temperature_2m", None, None),
            (11, zero, "wind", "7", 7.0),
            (11, one, "wind", "8", 8.0),
            (11, zero, "code", "a", None),
            (11, one, "code", "b", None),
            (44, zero, "precipitation", "0.5", 0.5),
            (44, zero, "none", None, None),
        ],
        key=repr,
    )
    # the declared measures are cut by arrays that nobody declared, too
    wide = read_raw_weather(spark, f"{folder}/*.json")
    assert rows(wide, "region_code", "time", "temperature_2m", "precipitation") == [(11, zero, 1.0, None), (11, one, None, None), (44, zero, None, 0.5)]


def test_text_in_a_declared_measure_fails(spark, folder):
    document(folder, "openmeteo-11-2024.json", {"time": ["2024-01-01T00:00"], "temperature_2m": ["warm"]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_raw_weather(spark, folder).collect()


def test_a_calendar_without_a_region_fails(spark, lake):  # noqa: F811
    kept = read_table(spark, HOLIDAYS, lake.holidays).filter("not (region_code = 44 and year(date) = 2023)")
    tables.overwrite_table(kept, HOLIDAYS, lake.holidays)
    with pytest.raises(ValueError, match=r"lacks the regions \[44\]"):
        jobs.rebuild(spark, lake, now="2024-01-03")


def test_a_day_of_weather_is_one_folder(spark, folder):
    # a folder for each region's 24 rows made backfills of long histories time out
    hours = hours_of(spark, 3 * 24 * 2).selectExpr("date_heure time", "consommation temperature_2m", "0.5D precipitation", "region_code")
    tables.overwrite_table(bronze_weather(hours), BRONZE_WEATHER, folder)
    stored = read_table(spark, BRONZE_WEATHER, folder)
    assert len(partition_values(spark, folder, BRONZE_WEATHER.partition_by)) == len(set(stored.inputFiles())) == 2
    assert rows(high_watermarks(spark, folder, BRONZE_WEATHER)) == [(region, ts("2024-01-02").date()) for region in range(3)]
    late = bronze_weather(hours.filter("region_code = 1 and time >= '2024-01-02'").withColumn("precipitation", F.lit(7.0)))
    assert rows(tables.replace_by_key(late, BRONZE_WEATHER, folder)) == [(1, 2024, 1, 2)]
    after = read_table(spark, BRONZE_WEATHER, folder)
    assert after.count() == 144 and after.filter("precipitation = 7").count() == 24


def test_staged_rows_have_no_folders(spark, folder, monkeypatch):
    written, write = [], tables._write
    monkeypatch.setattr(tables, "_write", lambda df, dataset, path, *more, **named: (written.append((path, dataset.partition_by)), write(df, dataset, path, *more, **named))[1])
    tables.replace_by_key(readings(spark, 24), BRONZE_CONSUMPTION, folder)
    assert [by for path, by in written if "/staged-" in path] == [()]
    assert read_table(spark, BRONZE_CONSUMPTION, folder).count() == 24


def test_documents_over_several_lines_keep_their_text(spark, folder):
    with open(f"{folder}/openmeteo-11-2024.json", "w") as out:
        out.write('{\n  "hourly": {\r\n "time": ["2024-01-01T00:00",\n"2024-01-01T01:00"],\n "gusts": [1.50, 1e2]\n }\n}\n')
    found = measure_rows(read_weather_documents(spark, f"{folder}/*.json"))
    assert rows(found, "value", "number") == [("1.50", 1.5), ("1e2", 100.0)]
    # every file is one record in memory, and not a stream that is read again for each number
    assert "multiLine" not in plan_of(found) and read_weather_documents(spark, folder).count() == 1
