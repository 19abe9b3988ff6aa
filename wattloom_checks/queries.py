"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom_checks.standins import (
    half_hour,
    order_readings,
    order_weather,
    readings,
    meter,
    region_of,
    rounded_mean,
    session,
    table,
    weather,
    whole,
)
from wattloom.operators import bucketed, presence, quality, series, slices, summaries, tables
from wattloom.plans.bronze import bronze_consumption, bronze_weather
from wattloom.plans.gold import FACT_COLUMNS, build_fact
from wattloom.plans.silver import SILVER_COLUMNS, build_silver, demand_by_hour, weather_by_instant
from wattloom.schemas import ANY_WEATHER, BRONZE_CONSUMPTION, BRONZE_WEATHER, DIM_DATE, DIM_REGION, FACT, FACT_UPDATES, HOLIDAYS, RAW_WEATHER, SILVER, SILVER_UPDATES, Dataset
from wattloom.plans import jobs
from wattloom.session import hadoop_path, scratch_path
from wattloom.sources import calendars
from wattloom.sources.tables import available_years, high_watermark, high_watermarks, read_table, year_ranges
from wattloom.sources.weather import measure_rows, select_documents, weather_rows

SINCE = "2024-01-20"
UPSERT_FROM, UPSERT_UNTIL = "2024-01-21", "2024-01-26"
REPLACE_FROM, REPLACE_UNTIL = "2024-01-20", "2024-01-25"


# --- bronze and time buckets -------------------------------------------------------


def bronze_calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_consumption(readings(spark, sf_dir))


def _valued_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "ts", whole("value").alias("value"))


def time_bucket_hour(spark, sf_dir):
    return series.time_bucket(_valued_events(spark, sf_dir), ["event_type"], F.avg("value").alias("mean_value"), time="ts")


def time_bucket_day(spark, sf_dir):
    events = _valued_events(spark, sf_dir)
    return series.time_bucket(events, ["event_type"], F.max("value").alias("max_value"), time="ts", unit="day")


def dedupe_then_hourly(spark, sf_dir):
    return demand_by_hour(readings(spark, sf_dir), mean=rounded_mean)


def weather_dedupe(spark, sf_dir):
    return weather_by_instant(weather(spark, sf_dir), mean=rounded_mean)


# --- silver ------------------------------------------------------------------------


def _silver(spark, sf_dir, **options):
    return build_silver(readings(spark, sf_dir), weather(spark, sf_dir), mean=rounded_mean, **options)


def silver_join(spark, sf_dir):
    return _silver(spark, sf_dir)


def silver_since(spark, sf_dir):
    return _silver(spark, sf_dir, holidays=_event_holidays(spark, sf_dir), since=SINCE)


def _event_holidays(spark, sf_dir):
    """The calendar of the years that events fall in."""
    events = table(spark, sf_dir, "events")
    years = events.select(F.year("ts").alias("year")).distinct()
    return calendars.holidays_of(years, calendars.dim_region(spark))


def _order_holidays(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    years = orders.select(F.year("o_orderdate").alias("year")).distinct()
    regions = orders.select(region_of("o_custkey").alias("region_code")).distinct()
    return calendars.holidays_of(years, regions)


def silver_holidays(spark, sf_dir):
    holidays = _order_holidays(spark, sf_dir)
    return build_silver(order_readings(spark, sf_dir), order_weather(spark, sf_dir), holidays, mean=rounded_mean)


def _keyed(name: str, *measures: str) -> Dataset:
    """A table of some of silver's columns."""
    columns = ("date_heure", "region_code", *measures)
    return Dataset(name, type(SILVER.schema)([SILVER.schema[c] for c in columns]), key=SILVER.key)


def silver_join_bucketed(spark, sf_dir):
    """Silver from both sides stored in buckets of its key, the readings in two parts of
    which the second is merged in."""
    own, mark = session(spark), uuid.uuid4().hex
    hours, measured = _keyed("hours", "consommation"), _keyed("weather_hours", "temperature_2m", "precipitation")
    rows = _hours(spark, sf_dir)
    wrong = rows.withColumn("consommation", F.lit(-1.0)).filter(F.col("date_heure") < UPSERT_UNTIL)
    names = [f"{name}_{mark}" for name in ("first", "hours", "weather")]
    bucketed.save_bucketed(wrong, hours, names[0], 8, scratch_path(own, "bucketed"))
    bucketed.merge_bucketed(own, rows, hours, names[0], names[1], ["consommation"], 8, scratch_path(own, "bucketed"))
    bucketed.save_bucketed(weather_by_instant(weather(spark, sf_dir), mean=rounded_mean), measured, names[2], 8, scratch_path(own, "bucketed"))
    sides = bucketed.read_bucketed(own, hours, names[1]), bucketed.read_bucketed(own, measured, names[2])
    joined = bucketed.join_bucketed(*sides, SILVER.key)
    return joined.withColumns({"is_holiday": F.lit(0), "year": F.year("date_heure")}).select(*SILVER_COLUMNS)


# --- gold --------------------------------------------------------------------------


def _hours(spark, sf_dir):
    return demand_by_hour(readings(spark, sf_dir), mean=rounded_mean)


def gold_rolling_7d(spark, sf_dir):
    return series.with_trailing_features(_hours(spark, sf_dir), ["region_code"], "consommation", lag_as=None)


def gold_lag_7d(spark, sf_dir):
    return series.with_trailing_features(_hours(spark, sf_dir), ["region_code"], "consommation", mean_as=None)


def gold_lag_7d_join(spark, sf_dir):
    return series.lag_by_join(_hours(spark, sf_dir), ["region_code"], "consommation")


def gold_fact(spark, sf_dir):
    return build_fact(_silver(spark, sf_dir, holidays=_event_holidays(spark, sf_dir)))


def gold_fact_since(spark, sf_dir):
    return build_fact(_silver(spark, sf_dir, holidays=_event_holidays(spark, sf_dir)), since=SINCE)


# --- stored tables -----------------------------------------------------------------


def _upsert_sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows up to a day, and a later overlapping delivery with changed and lost values."""
    changed = F.when(F.col("consommation") > 2_000_000, F.lit(None)).otherwise(F.col("consommation") + 1)
    target = rows.filter(F.col("date_heure") < UPSERT_UNTIL)
    source = rows.filter(F.col("date_heure") >= UPSERT_FROM).withColumn("consommation", changed)
    return target, source


def upsert_silver(spark, sf_dir):
    target, source = _upsert_sides(_silver(spark, sf_dir))
    return tables.merged(target, source, SILVER.key, SILVER_UPDATES)


def upsert_silver_stored(spark, sf_dir):
    target, source = _upsert_sides(_silver(spark, sf_dir))
    path = scratch_path(session(spark), "upsert-silver")
    tables.overwrite_table(target, SILVER, path)
    tables.upsert_table(source, SILVER, path, SILVER_UPDATES)
    return read_table(spark, SILVER, path)


def upsert_gold_stored(spark, sf_dir):
    fact = gold_fact(spark, sf_dir).withColumn("year", F.year("date_heure"))
    target, source = _upsert_sides(fact)
    path = scratch_path(session(spark), "upsert-gold")
    tables.overwrite_table(target, FACT, path)
    tables.upsert_table(source, FACT, path, FACT_UPDATES)
    return read_table(spark, FACT, path).select(*FACT_COLUMNS)


def upsert_gold(spark, sf_dir):
    target, source = _upsert_sides(gold_fact(spark, sf_dir))
    return tables.merged(target, source, SILVER.key, FACT_UPDATES)


def upsert_empty_source(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    path = scratch_path(session(spark), "upsert-empty")
    tables.overwrite_table(silver, SILVER, path)
    tables.upsert_table(silver.filter(F.col("region_code").isNull()), SILVER, path, SILVER_UPDATES)
    return read_table(spark, SILVER, path)


def _bronze_weather(spark, sf_dir):
    hours = weather_by_instant(weather(spark, sf_dir), mean=rounded_mean)
    return bronze_weather(hours.withColumnRenamed("date_heure", "time"))


def append_by_name(spark, sf_dir):
    rows = _bronze_weather(spark, sf_dir)
    path = scratch_path(session(spark), "append")
    tables.overwrite_table(rows.filter(F.col("time") < SINCE), BRONZE_WEATHER, path)
    delivered = rows.filter(F.col("time") >= SINCE).select(
        F.col("day").alias("DAY"),
        F.col("month").alias("Month"),
        F.col("year").alias("YEAR"),
        F.col("region_code").cast("string").alias("REGION_CODE"),
        F.lit("not a table column").alias("comment"),
        F.col("temperature_2m").alias("Temperature_2M"),
        F.col("time").alias("TIME"),
    )
    tables.append_by_name(delivered, BRONZE_WEATHER, path)
    return read_table(spark, BRONZE_WEATHER, path)


def _local_time():
    return F.expr("date_heure + INTERVAL 1 HOUR")


def _bronze_consumption(hours: DataFrame) -> DataFrame:
    """Hourly values as bronze rows, dated by the local day."""
    raw = hours.select(
        "date_heure",
        F.date_format(_local_time(), "yyyy-MM-dd").alias("date"),
        F.col("region_code").cast("string").alias("code_insee_region"),
        F.lit(None).cast("string").alias("libelle_region"),
        F.lit("hourly").alias("nature"),
        "consommation",
    )
    return bronze_consumption(raw)


def partition_replace(spark, sf_dir):
    """Days up to one, then the last days, overlapping and complete, with other values."""
    hours = _hours(spark, sf_dir)
    stored = _bronze_consumption(hours.filter(_local_time() < REPLACE_UNTIL))
    replacement = _bronze_consumption(hours.filter(_local_time() >= REPLACE_FROM))
    path = scratch_path(session(spark), "replace")
    tables.overwrite_table(stored, BRONZE_CONSUMPTION, path)
    tables.replace_partitions(
        replacement.withColumn("consommation", F.col("consommation") * 2), BRONZE_CONSUMPTION, path
    )
    return read_table(spark, BRONZE_CONSUMPTION, path)


def touched_partitions(spark, sf_dir):
    return tables.touched_partitions(_bronze_weather(spark, sf_dir), BRONZE_WEATHER.parts)


def replace_keys(spark, sf_dir):
    """A delivery with repeated instants over the rows already stored."""
    rows = readings(spark, sf_dir).select("date_heure", "code_insee_region", "consommation")
    target = rows.filter(F.col("date_heure") < UPSERT_UNTIL)
    source = rows.filter(F.col("date_heure") >= UPSERT_FROM)
    source = source.withColumn("consommation", F.col("consommation") + 1)
    return tables.keys_replaced(target, source, ["date_heure", "code_insee_region"])


def flat_copy(spark, sf_dir):
    path = scratch_path(session(spark), "flat")
    tables.flat_copy(_bronze_weather(spark, sf_dir), path)
    return spark.read.schema(BRONZE_WEATHER.schema).parquet(path)


def region_day_lookup(spark, sf_dir):
    """One region's readings of one day, of a table whose files are sorted by region."""
    path = _stored_consumption(spark, sf_dir, readings(spark, sf_dir))
    stored = read_table(session(spark), BRONZE_CONSUMPTION, path)
    return stored.filter("year = 2024 AND month = 1 AND day = 17 AND code_insee_region = '44'")


# --- watermarks and increments -----------------------------------------------------


def _stored_consumption(spark, sf_dir, rows):
    path = scratch_path(session(spark), "consumption")
    tables.overwrite_table(bronze_consumption(rows), BRONZE_CONSUMPTION, path)
    return path


def _stored_weather(spark, sf_dir, rows):
    path = scratch_path(session(spark), "weather")
    tables.overwrite_table(bronze_weather(rows), BRONZE_WEATHER, path)
    return path


def newest_partition(spark, sf_dir):
    newest = high_watermark(spark, _stored_consumption(spark, sf_dir, readings(spark, sf_dir)))
    return spark.createDataFrame([(newest,)], "watermark date")


def newest_partition_by_region(spark, sf_dir):
    return high_watermarks(spark, _stored_weather(spark, sf_dir, weather(spark, sf_dir)), BRONZE_WEATHER)


def year_bounds(spark, sf_dir):
    return available_years(table(spark, sf_dir, "orders"), "o_orderdate")


def year_range(spark, sf_dir):
    return year_ranges(year_bounds(spark, sf_dir), "2001-07-15")


def year_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return slices.year_slice(orders, "o_orderdate", 1998, "1998-09-02")


def increment_slice(spark, sf_dir):
    landed = readings(spark, sf_dir)
    ingested = _stored_consumption(spark, sf_dir, landed.filter(F.col("date") < "2024-01-21"))
    return slices.increment_slice(landed, "date_heure", high_watermark(spark, ingested), "2024-01-29")


def increment_slice_by_region(spark, sf_dir):
    landed = weather(spark, sf_dir)
    ingested = landed.filter(F.col("time") < F.expr("date_add(date '2024-01-10', cast(region_code div 10 as int))"))
    marks = high_watermarks(session(spark), _stored_weather(spark, sf_dir, ingested), BRONZE_WEATHER)
    return slices.increment_slice_by_series(landed, marks, ["region_code"], "time", "2024-01-29")


def weather_json_rows(spark, sf_dir):
    """Hours rendered as JSON documents of one region and day, then read back."""
    hours = weather_by_instant(weather(spark, sf_dir), mean=rounded_mean)
    name = F.when(F.col("day") < "2024-01-28", F.date_format("day", "yyyyMMdd")).otherwise(F.lit("daily"))
    hour = F.struct(
        F.date_format("date_heure", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature_2m", "precipitation"
    )
    arrays = [F.col(f"hours.{field}").alias(field) for field in ("time", "temperature_2m", "precipitation")]
    by_day = (
        hours.groupBy("region_code", F.to_date("date_heure").alias("day"))
        .agg(F.array_sort(F.collect_list(hour)).alias("hours"))
        .select(
            F.concat(F.lit("openmeteo-"), "region_code", F.lit("-"), name, F.lit(".json")).alias("file_name"),
            F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("text"),
        )
    )
    parsed = F.from_json("text", RAW_WEATHER, {"mode": "FAILFAST"})
    documents = by_day.select("file_name", parsed["hourly"].alias("hourly"))
    return weather_rows(select_documents(documents, daily=False))


def weather_any_arrays(spark, sf_dir):
    """Documents of one region and day with an array nobody declared and one that is an
    hour short, as rows of measures: all arrays are cut to the shortest."""
    hours = weather_by_instant(weather(spark, sf_dir), mean=rounded_mean).withColumn("wind", F.hour("date_heure").cast("double"))
    hour = F.struct(F.date_format("date_heure", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature_2m", "precipitation", "wind")
    by_day = hours.groupBy("region_code", F.to_date("date_heure").alias("day")).agg(F.array_sort(F.collect_list(hour)).alias("hours"))
    arrays = [F.col(f"hours.{field}").alias(field) for field in ("time", "temperature_2m", "precipitation", "wind")]
    short = F.slice(F.col("hours.wind"), F.lit(1), F.size("hours") - 1).alias("gusts")
    name = F.concat(F.lit("openmeteo-"), "region_code", F.lit("-"), F.date_format("day", "yyyyMMdd"), F.lit(".json"))
    texts = by_day.select(name.alias("file_name"), F.to_json(F.struct(F.struct(*arrays, short).alias("hourly"))).alias("text"))
    documents = texts.select("file_name", F.from_json("text", ANY_WEATHER, {"mode": "FAILFAST"})["hourly"].alias("hourly"))
    return measure_rows(documents).drop("value")


# --- dimensions --------------------------------------------------------------------


def holiday_calendar(spark, sf_dir):
    """Holidays of the ordered years in the ordering regions, with their orders."""
    orders = table(spark, sf_dir, "orders")
    ordered = orders.groupBy(
        region_of("o_custkey").alias("region_code"), F.to_date("o_orderdate").alias("date")
    ).agg(F.count(F.lit(1)).alias("nb_orders"))
    counted = _order_holidays(spark, sf_dir).join(ordered, ["region_code", "date"], "left")
    return counted.fillna({"nb_orders": 0})


def dim_date(spark, sf_dir):
    """Every day of the dimension with the events of that day."""
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date_key")).agg(F.count(F.lit(1)).alias("nb"))
    return calendars.dim_date(spark).join(days, "date_key", "left").fillna({"nb": 0})


def dim_region(spark, sf_dir):
    """Every region with the customers assigned to it."""
    customers = table(spark, sf_dir, "customer").groupBy(region_of("c_custkey").alias("region_code"))
    counted = customers.agg(F.count(F.lit(1)).alias("nb_customers"))
    return calendars.dim_region(spark).join(counted, "region_code", "left").fillna({"nb_customers": 0})


# --- data quality ------------------------------------------------------------------


def _instants(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        half_hour("ts").alias("date_heure"), region_of("user_id").alias("region_code"), "event_type", "value"
    )


def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(_instants(spark, sf_dir), ["date_heure", "region_code"])


def dq_gaps(spark, sf_dir):
    return series.series_gaps(table(spark, sf_dir, "events"), ["user_id"], "ts")


def dq_freshness(spark, sf_dir):
    return quality.stale_series(table(spark, sf_dir, "events"), ["user_id"], "ts", as_of="2024-01-31 00:00:00", max_hours=24)


def dq_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return quality.outliers(events, "value", low=0.1, high=300)


def dq_keys(spark, sf_dir):
    rows = _instants(spark, sf_dir)
    known = F.when(F.col("event_type") != "error", F.col("region_code"))
    return quality.key_violations(rows.withColumn("region_code", known), ["date_heure", "region_code"])


def _whole_hours(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select(region_of("user_id").alias("region_code"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_heure"), "event_type")
    return hours


def gap_bitmaps(spark, sf_dir):
    """Gaps and repeated rows of every region and event type, from bitmaps of two halves
    of the table that are merged."""
    hours, by = _whole_hours(spark, sf_dir), ["region_code", "event_type"]
    halves = [presence.presence(hours.filter(F.hour("date_heure") % 2 == n), by) for n in range(2)]
    merged = presence.merged_presence(halves[0].unionByName(halves[1]), by)
    gaps = presence.presence_gaps(merged, by).withColumn("kind", F.lit("gap"))
    repeats = presence.presence_counts(merged, by).filter("repeats > 0")
    told = repeats.select(*by, F.lit(None).cast("timestamp_ntz").alias("date_heure"), F.col("repeats").alias("ecart_h"), F.lit("repeats").alias("kind"))
    return gaps.unionByName(told)


def gate_from_summaries(spark, sf_dir):
    """Silver in three upserts that overlap, judged by the summaries of its partitions,
    of which only the touched ones are made anew."""
    lake = _lake(spark)
    silver = _silver(spark, sf_dir)
    day = F.dayofmonth("date_heure")
    for part in (silver.filter(day <= 12), silver.filter(day >= 20), silver.filter(day.between(10, 21))):
        tables.upsert_table(part, SILVER, lake.silver, SILVER_UPDATES, touching=jobs.forget_summaries(session(spark), lake))
        stored = jobs.silver_summaries(spark, lake)
    return summaries.gate_summary(stored, jobs.SERIES, jobs.PART, as_of="2024-02-02 00:00:00")


def observed_counts(spark, sf_dir):
    """What the write of silver counted on its way: rows and values out of range."""
    path = scratch_path(session(spark), "observed")
    counts = quality.write_counts(["date_heure", "region_code"], "consommation", low=500_000, high=2_000_000)
    found = tables.overwrite_table(_silver(spark, sf_dir), SILVER, path, counts=counts)
    return session(spark).createDataFrame([(found["nb"], found["null_keys"], found["outliers"])], "nb long, null_keys long, outliers long")


def exact_hourly_mean(spark, sf_dir):
    """Unrounded means of unrounded values, equal to the last bit however rows are dealt."""
    raw = table(spark, sf_dir, "events").select(
        half_hour("ts").alias("date_heure"), region_of("user_id").cast("string").alias("code_insee_region"), (F.col("value") / 7).alias("consommation")
    )
    return demand_by_hour(raw.repartition(13, "consommation"))


def dq_foreign_keys(spark, sf_dir):
    """Orders, every seventh of which names a customer that does not exist."""
    lost = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey") + 1_000_000_000).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").withColumn("o_custkey", lost)
    return quality.orphan_keys(orders, "o_custkey", table(spark, sf_dir, "customer"), "c_custkey")


def dq_summary(spark, sf_dir):
    return quality.series_summary(
        _instants(spark, sf_dir), ["region_code"], as_of="2024-02-02 00:00:00", value="value", low=0.1, high=300
    )


# --- jobs --------------------------------------------------------------------------


def _lake(spark: SparkSession) -> jobs.Lake:
    return jobs.Lake(scratch_path(session(spark), "lake"))


def _raw_consumption(hours: DataFrame) -> DataFrame:
    """Hours as they land, with zone-aware instants as some feeds have them."""
    return hours.select(
        F.col("date_heure").cast("timestamp").alias("date_heure"),
        F.date_format(_local_time(), "yyyy-MM-dd").alias("date"),
        F.col("region_code").cast("string").alias("code_insee_region"),
        F.concat(F.lit("region "), "region_code").alias("libelle_region"),
        F.lit("hourly").alias("nature"),
        "consommation",
    )


def _land_consumption(hours: DataFrame, folder: str) -> str:
    """Hours as landed files."""
    _raw_consumption(hours).write.parquet(folder)
    return folder


def _land_weather(spark: SparkSession, hours: DataFrame, folder: str, label: str | None = None) -> str:
    """Hours as one JSON document per region and year, or per region under a label, which
    is for a few days; returns their glob. A document is made and read as a whole."""
    hour = F.struct(F.date_format("date_heure", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature_2m", "precipitation")
    arrays = [F.col(f"hours.{field}").alias(field) for field in ("time", "temperature_2m", "precipitation")]
    name = F.concat(F.lit("openmeteo-"), "region_code", F.lit("-"), F.lit(label) if label else F.year("date_heure"), F.lit(".json"))
    documents = (
        hours.groupBy(name.alias("name"))
        .agg(F.array_sort(F.collect_list(hour)).alias("hours"))
        .select("name", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("value"))
    )
    written = f"{folder}/{label or 'years'}"
    documents.repartition("name").write.partitionBy("name").text(written)
    # Spark names its files itself: give each document the name that says its region
    fs, parts = hadoop_path(spark, f"{written}/name=*/part-*")
    for status in fs.globStatus(parts):
        file = status.getPath()
        target = file.getParent().getName().partition("=")[2]
        fs.rename(file, hadoop_path(spark, f"{folder}/{target}")[1])
    return f"{folder}/openmeteo-*.json"


def _days(spark, sf_dir):
    """The meter's hours, its last day, and the day before."""
    hours = meter(spark, sf_dir)
    last = hours.agg(F.to_date(F.max("date_heure"))).first()[0]
    return hours, last, last - timedelta(days=1)


def job_backfill_consumption(spark, sf_dir):
    lake = _lake(spark)
    raw = _land_consumption(meter(spark, sf_dir), lake.path("landed"))
    jobs.backfill_consumption(spark, lake, raw)
    return read_table(session(spark), BRONZE_CONSUMPTION, lake.consumption)


def job_backfill_weather(spark, sf_dir):
    lake = _lake(spark)
    raw = _land_weather(spark, meter(spark, sf_dir), lake.path("landed"))
    jobs.backfill_weather(spark, lake, raw)
    return read_table(session(spark), BRONZE_WEATHER, lake.weather)


def _filled(spark, sf_dir):
    """A lake with all but the last days, and then with those as increments."""
    lake = _lake(spark)
    hours, last, middle = _days(spark, sf_dir)
    early, late = hours.filter(F.col("date_heure") < F.lit(middle)), hours.filter(F.col("date_heure") >= F.lit(middle - timedelta(days=1)))
    jobs.backfill_consumption(spark, lake, _land_consumption(early, lake.path("landed")))
    jobs.backfill_weather(spark, lake, _land_weather(spark, early, lake.path("documents")))

    def increments():
        after = last + timedelta(days=1)
        jobs.increment_consumption(spark, lake, _land_consumption(late, lake.path("landed-late")), as_of=after)
        jobs.increment_weather(spark, lake, _land_weather(spark, late, lake.path("documents"), "daily"), as_of=after)

    return lake, last, increments


def job_increment_consumption(spark, sf_dir):
    lake, _, increments = _filled(spark, sf_dir)
    increments()
    return read_table(session(spark), BRONZE_CONSUMPTION, lake.consumption)


def job_increment_weather(spark, sf_dir):
    lake, _, increments = _filled(spark, sf_dir)
    increments()
    return read_table(session(spark), BRONZE_WEATHER, lake.weather)


def job_holidays(spark, sf_dir):
    """Stored holidays with the orders of their day and region, by day and month."""
    lake = _lake(spark)
    jobs.build_holidays(spark, lake, 1995, 2001)
    orders = table(spark, sf_dir, "orders").groupBy(region_of("o_custkey").alias("region_code"), F.to_date("o_orderdate").alias("date"))
    stored = read_table(session(spark), HOLIDAYS, lake.holidays)
    return stored.join(orders.agg(F.count(F.lit(1)).alias("nb_orders")), ["region_code", "date"], "left").fillna({"nb_orders": 0})


def job_dimensions(spark, sf_dir):
    """Events by the stored dimensions."""
    lake = _lake(spark)
    jobs.build_dimensions(spark, lake)
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date_key"), region_of("user_id").alias("region_code"))
    dates = read_table(session(spark), DIM_DATE, lake.dates)
    regions = read_table(session(spark), DIM_REGION, lake.regions)
    joined = events.join(dates, "date_key").join(regions, "region_code")
    return joined.groupBy("region_nom", "jour_semaine", "annee", "mois").agg(F.count(F.lit(1)).alias("nb"))


def holidays_in_order(spark, sf_dir):
    """Where a holiday stands in the calendar, with the orders of that day."""
    placed = calendars.holiday_calendar(session(spark), 1995, 2001).withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_at"))
    orders = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("nb_orders"))
    counted = placed.select("region_code", "date", position.alias("position")).join(orders, "date", "left")
    return counted.fillna({"nb_orders": 0})


def dates_in_order(spark, sf_dir):
    """Where a day stands in the files of the stored dimension, with the events of that day."""
    lake = _lake(spark)
    jobs.build_dimensions(spark, lake)
    stored = read_table(session(spark), DIM_DATE, lake.dates)
    position = F.row_number().over(Window.orderBy("_metadata.file_name", "_metadata.row_index"))
    events = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date_key")).agg(F.count(F.lit(1)).alias("nb"))
    return stored.select("date_key", position.alias("position")).join(events, "date_key", "left").fillna({"nb": 0})


def _clock(last):
    return f"{last.isoformat()} 23:00:00"


def _build_holidays(spark, lake, last):
    """A calendar that holds the meter's years, which go on with its rows."""
    jobs.build_holidays(spark, lake, last_year=max(calendars.HOLIDAY_YEARS[1], last.year))


def job_rebuild(spark, sf_dir):
    lake, last, increments = _filled(spark, sf_dir)
    increments()
    _build_holidays(spark, lake, last)
    jobs.rebuild(spark, lake, now=_clock(last))
    return jobs.read_fact(session(spark), lake)


def job_rolling_run(spark, sf_dir):
    """Rebuilt without the last days, which then arrive and are rolled in."""
    lake, last, increments = _filled(spark, sf_dir)
    _build_holidays(spark, lake, last)
    jobs.rebuild(spark, lake, now=_clock(last))
    increments()
    jobs.rolling_run(spark, lake, as_of=last + timedelta(days=1), days=5, now=_clock(last))
    return jobs.read_fact(session(spark), lake)


def job_merge_run(spark, sf_dir):
    """As the rolling run, but with all of bronze."""
    lake, last, increments = _filled(spark, sf_dir)
    _build_holidays(spark, lake, last)
    jobs.rebuild(spark, lake, now=_clock(last))
    increments()
    jobs.merge_run(spark, lake, now=_clock(last))
    return jobs.read_fact(session(spark), lake)


def _land_delivery(spark: SparkSession, hours: DataFrame, landed: str, name: str) -> None:
    """Landed files of one year each, written by as many tasks as there are years, under
    names of their own, in the place of older ones. Without rows it is one empty file."""
    written = f"{landed}/{name}.written"
    raw = _raw_consumption(hours).withColumn("_year", F.year("date_heure"))
    raw.repartition("_year").write.partitionBy("_year").parquet(written)
    fs, folder = hadoop_path(spark, written)
    files = {f"{name}-{s.getPath().getName().partition('=')[2]}": s.getPath() for s in fs.listStatus(folder) if s.isDirectory()}
    if not files:
        _, files[name] = hadoop_path(spark, _land_consumption(hours.limit(0), f"{written}/empty"))
    for label, below in files.items():
        [part] = [s.getPath() for s in fs.listStatus(below) if s.getPath().getName().startswith("part-")]
        _, place = hadoop_path(spark, f"{landed}/{label}.parquet")
        fs.delete(place, False)
        fs.rename(part, place)
    fs.delete(folder, True)


def _wrong(hours: DataFrame) -> DataFrame:
    return hours.withColumn("consommation", F.col("consommation") + 1)


def increment_by_ledger(spark, sf_dir):
    """Three deliveries into one folder, of which the last replaces files of the first
    under their names; only new files are read."""
    lake = _lake(spark)
    hours = meter(spark, sf_dir).withColumn("part", F.hour("date_heure") % 3)
    landed = lake.path("landed")
    first, second, third = [hours.filter(F.col("part") == n).drop("part") for n in range(3)]
    for delivery in ({"a": _wrong(first), "b": second}, {"c": third}, {"a": first}):
        for name, rows in delivery.items():
            _land_delivery(spark, rows, landed, name)
        jobs.ingest_consumption(spark, lake, f"{landed}/*.parquet")
    return read_table(session(spark), BRONZE_CONSUMPTION, lake.consumption)


def _lateness() -> Column:
    """7 for hours that are missing at first, 8 for wrong ones. Only every other hour may
    be missing: the gate refuses a table with gaps, and long histories would have some."""
    drawn = F.pmod(F.xxhash64("date_heure", "region_code"), F.lit(89))
    return F.when((drawn == 7) & (F.hour("date_heure") % 2 == 1), F.lit(0)).otherwise(drawn)


def propagate_late_rows(spark, sf_dir):
    """Built with readings missing and wrong all over the history, which then arrive and
    are propagated instead of built again."""
    lake = _lake(spark)
    hours, last, _ = _days(spark, sf_dir)
    late = _lateness()
    early = hours.filter(late != 7).withColumn("consommation", F.when(late == 8, F.lit(1.0)).otherwise(F.col("consommation")))
    jobs.backfill_consumption(spark, lake, _land_consumption(early, lake.path("landed")))
    jobs.backfill_weather(spark, lake, _land_weather(spark, hours, lake.path("documents")))
    _build_holidays(spark, lake, last)
    jobs.rebuild(spark, lake, now=_clock(last))
    jobs.ingest_consumption(spark, lake, _land_consumption(hours.filter(late.isin(7, 8)), lake.path("landed-late")))
    jobs.propagate(spark, lake, now=_clock(last))
    return jobs.read_fact(session(spark), lake)


QUERIES = {
    "bronze_calendar_parts": bronze_calendar_parts,
    "time_bucket_hour": time_bucket_hour,
    "time_bucket_day": time_bucket_day,
    "dedupe_then_hourly": dedupe_then_hourly,
    "weather_dedupe": weather_dedupe,
    "silver_join": silver_join,
    "silver_holidays": silver_holidays,
    "silver_since": silver_since,
    "gold_rolling_7d": gold_rolling_7d,
    "gold_lag_7d": gold_lag_7d,
    "gold_lag_7d_join": gold_lag_7d_join,
    "gold_fact": gold_fact,
    "gold_fact_since": gold_fact_since,
    "upsert_silver": upsert_silver,
    "upsert_silver_stored": upsert_silver_stored,
    "upsert_gold": upsert_gold,
    "upsert_gold_stored": upsert_gold_stored,
    "upsert_empty_source": upsert_empty_source,
    "append_by_name": append_by_name,
    "partition_replace": partition_replace,
    "touched_partitions": touched_partitions,
    "replace_keys": replace_keys,
    "flat_copy": flat_copy,
    "high_watermark": newest_partition,
    "high_watermark_by_region": newest_partition_by_region,
    "year_bounds": year_bounds,
    "year_range": year_range,
    "year_slice": year_slice,
    "increment_slice": increment_slice,
    "increment_slice_by_region": increment_slice_by_region,
    "weather_json_rows": weather_json_rows,
    "holiday_calendar": holiday_calendar,
    "dim_date": dim_date,
    "dim_region": dim_region,
    "dq_duplicates": dq_duplicates,
    "dq_gaps": dq_gaps,
    "dq_freshness": dq_freshness,
    "dq_outliers": dq_outliers,
    "dq_keys": dq_keys,
    "dq_foreign_keys": dq_foreign_keys,
    "dq_summary": dq_summary,
    "job_backfill_consumption": job_backfill_consumption,
    "job_backfill_weather": job_backfill_weather,
    "job_increment_consumption": job_increment_consumption,
    "job_increment_weather": job_increment_weather,
    "job_holidays": job_holidays,
    "job_dimensions": job_dimensions,
    "holidays_in_order": holidays_in_order,
    "dates_in_order": dates_in_order,
    "job_rebuild": job_rebuild,
    "job_rolling_run": job_rolling_run,
    "job_merge_run": job_merge_run,
    "weather_any_arrays": weather_any_arrays,
    "silver_join_bucketed": silver_join_bucketed,
    "region_day_lookup": region_day_lookup,
    "gap_bitmaps": gap_bitmaps,
    "gate_from_summaries": gate_from_summaries,
    "observed_counts": observed_counts,
    "exact_hourly_mean": exact_hourly_mean,
    "increment_by_ledger": increment_by_ledger,
    "propagate_late_rows": propagate_late_rows,
}
