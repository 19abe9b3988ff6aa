"""One row per (hour, region): consumption with weather and a holiday flag."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.exact import exact_mean
from wattloom.functions.regions import parse_region_code
from wattloom.functions.timeparts import instant
from wattloom.operators.series import per_instant, time_bucket
from wattloom.sources.tables import since as rows_since

SILVER_COLUMNS = ["date_heure", "region_code", "consommation", "temperature_2m", "precipitation", "is_holiday", "year"]

Mean = Callable[[str], Column]


def demand_by_hour(readings: DataFrame, on_bad_code: str = "fail", mean: Mean = exact_mean) -> DataFrame:
    """Hourly consumption as a mean of per-instant means: an instant that was delivered
    twice weighs as much as any other."""
    coded = readings.withColumn("region_code", parse_region_code("code_insee_region", on_bad_code))
    measure = mean("consommation").alias("consommation")
    return time_bucket(per_instant(coded, ["region_code"], [measure]), ["region_code"], measure)


def weather_by_instant(rows: DataFrame, mean: Mean = exact_mean) -> DataFrame:
    """Both measures per (region, instant); instants are not truncated."""
    measures = [mean(name).alias(name) for name in ("temperature_2m", "precipitation")]
    return per_instant(rows.withColumnRenamed("time", "date_heure"), ["region_code"], measures)


def holiday_days(calendar: DataFrame) -> DataFrame:
    """One flag per (region, day), without names. A day listed twice stays one row."""
    region = F.col("region_code").cast("int").alias("region_code")
    return calendar.groupBy(region, "date").agg(F.max("is_holiday").alias("is_holiday"))


def add_holidays(df: DataFrame, holidays: DataFrame, calendar_tz: str | None = None) -> DataFrame:
    """Flag every hour of a holiday. Days are UTC days, or days in ``calendar_tz``.

    No broadcast hint: Spark broadcasts the calendar where its size is known to be
    below the threshold, and joins by shuffle otherwise.
    """
    clock = F.convert_timezone(F.lit("UTC"), F.lit(calendar_tz), "date_heure") if calendar_tz else F.col("date_heure")
    flags = holiday_days(holidays).withColumnsRenamed({"region_code": "_region", "date": "_day"})
    of_the_day = (F.col("region_code") == F.col("_region")) & (F.to_date(clock) == F.col("_day"))
    return df.join(flags, of_the_day, "left").drop("_region", "_day")


def build_silver(
    consumption: DataFrame,
    weather: DataFrame,
    holidays: DataFrame | None = None,
    since: str | date | None = None,
    calendar_tz: str | None = None,
    on_bad_code: str = "fail",
    mean: Mean = exact_mean,
) -> DataFrame:
    """Consumption hours with the weather of the same hour and region, where known.

    ``since`` is a day; the result equals the full result from that day on. The join
    follows the aggregations' own partitioning and adds no shuffle.
    """
    hours = demand_by_hour(rows_since(consumption, "date_heure", since), on_bad_code, mean)
    measured = weather_by_instant(rows_since(weather, "time", since), mean)
    joined = hours.join(measured, ["date_heure", "region_code"], "left")
    if holidays is None:
        flagged = joined.withColumn("is_holiday", F.lit(0))
    else:
        if since is not None:
            # a day of slack: calendar_tz may place the first hours on the day before
            holidays = holidays.filter(F.col("date") >= F.date_sub(F.to_date(instant(since)), 1))
        flagged = add_holidays(joined, holidays, calendar_tz)
    return flagged.fillna({"is_holiday": 0}).withColumn("year", F.year("date_heure")).select(*SILVER_COLUMNS)
