"""The driver's tables in the shape of the library's inputs.

Events stand in for readings, all of them: each is a consumption, and one of the two
weather measures by its type; orders stand in for a day-grain series. Values become whole numbers
(ten-thousandths) and means are rounded to whole numbers, so that sums of doubles are
exact in any order and two engines must agree to the last bit.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import PINNED, job_session, scratch_base

# The twelve region codes, stated here and not taken from the library under test.
CODES = [11, 24, 27, 28, 32, 44, 52, 53, 75, 76, 84, 93]
# Types whose values are temperatures; those of all other types are precipitation.
WARM = ("view", "signup", "purchase")


def session(spark: SparkSession) -> SparkSession:
    """Where the caller's session names no scratch folder, a local one gets its own."""
    if not scratch_base(spark):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="wattloom-checks-"))
    return job_session(spark, PINNED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def region_of(id_column: str) -> Column:
    """Spread ids over the twelve region codes."""
    codes = F.array(*[F.lit(code) for code in CODES])
    return F.element_at(codes, (F.col(id_column) % len(CODES)).cast("int") + 1)


def whole(value: str, scale: int = 10_000) -> Column:
    return F.floor(F.col(value) * float(scale) + 0.5).cast("double")


def rounded_mean(value: str) -> Column:
    return F.floor(F.avg(value) + 0.5).cast("double")


def half_hour(time: str) -> Column:
    return F.window(time, "30 minutes")["start"]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw consumption rows; half-hour instants, so that instants repeat. The local day
    is one hour ahead of the UTC day, as in winter."""
    return table(spark, sf_dir, "events").select(
        half_hour("ts").alias("date_heure"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd").alias("date"),
        region_of("user_id").cast("string").alias("code_insee_region"),
        F.concat(F.lit("region "), region_of("user_id")).alias("libelle_region"),
        F.col("event_type").alias("nature"),
        whole("value").alias("consommation"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather rows: one measure each, several per hour."""
    warm = F.col("event_type").isin(*WARM)
    return table(spark, sf_dir, "events").select(
        region_of("user_id").alias("region_code"),
        F.window("ts", "1 hour")["start"].alias("time"),
        F.when(warm, whole("value")).alias("temperature_2m"),
        F.when(~warm, whole("value")).alias("precipitation"),
    )


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("date_heure"),
        region_of("o_custkey").cast("string").alias("code_insee_region"),
        whole("o_totalprice", 100).alias("consommation"),
    )


def order_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        region_of("o_custkey").alias("region_code"),
        F.col("o_orderdate").alias("time"),
        F.when(F.col("o_orderstatus") == "O", whole("o_totalprice", 100)).alias("temperature_2m"),
        F.when(F.col("o_orderstatus") == "F", whole("o_totalprice", 100)).alias("precipitation"),
    )


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per region and hour without a gap, as the jobs' gate demands: events in
    order of their number, twelve to an hour."""
    warm = F.col("event_type").isin(*WARM)
    hour = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(event_id div 12 as int))")
    return table(spark, sf_dir, "events").select(
        hour.alias("date_heure"),
        region_of("event_id").alias("region_code"),
        whole("value").alias("consommation"),
        F.when(warm, whole("value")).alias("temperature_2m"),
        F.when(~warm, whole("value")).alias("precipitation"),
    )
