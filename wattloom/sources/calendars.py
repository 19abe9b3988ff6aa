"""Generated dimensions: regions, dates and public holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.holidays import holiday_rules, with_easter
from wattloom.functions.regions import REGIONS, holiday_zones
from wattloom.schemas import DIM_REGION

# Extent of the date dimension and of the stored holiday table.
DIM_DATE_START = "2013-01-01"
DIM_DATE_ROWS = 7000
HOLIDAY_YEARS = (2013, 2030)


def dim_region(spark: SparkSession) -> DataFrame:
    # literals, whose size Spark knows: a local list would count as unbounded in joins
    rows = [F.struct(*[F.lit(value) for value in row]) for row in REGIONS]
    return spark.range(1).select(F.inline(F.array(*rows)).alias(*DIM_REGION.columns))


def dim_date(spark: SparkSession, start: str = DIM_DATE_START, days: int = DIM_DATE_ROWS) -> DataFrame:
    """Consecutive days with calendar attributes and abbreviated weekday names."""
    day = F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int"))
    return (
        spark.range(days)
        .select(day.alias("date_key"))
        .select(
            "date_key",
            F.year("date_key").alias("annee"),
            F.month("date_key").alias("mois"),
            F.dayofmonth("date_key").alias("jour"),
            F.dayname("date_key").alias("jour_semaine"),
        )
    )


def holidays_of(years: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per (region, holiday) for the given ``year`` and ``region_code`` rows.

    Two holidays on one day share a row with both names, so that joining by day
    never repeats an hour.
    """
    days = with_easter(years.select("year")).select(F.inline(holiday_rules()))
    observed = regions.select("region_code", F.explode(holiday_zones("region_code")).alias("zone"))
    return (
        observed.join(days, "zone")
        .groupBy("region_code", "date")
        .agg(F.array_join(F.array_sort(F.collect_set("jour_ferie")), ", ").alias("jour_ferie"))
        .withColumn("is_holiday", F.lit(1))
    )


def holiday_calendar(spark: SparkSession, first_year: int = HOLIDAY_YEARS[0], last_year: int = HOLIDAY_YEARS[1]) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return holidays_of(years, dim_region(spark)).orderBy("region_code", "date")
