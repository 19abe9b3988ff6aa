"""Landed weather documents: one JSON object of parallel hourly arrays per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.regions import is_daily_file, parse_region_code, region_from_file_name
from wattloom.functions.timeparts import parse_instant
from wattloom.schemas import ANY_WEATHER

MEASURES = ("temperature_2m", "precipitation")

# JSON text cannot hold this character unescaped, so each file is one record, parsed in
# memory. With ``multiLine`` Spark goes back to the file for every number it returns as text.
RECORD_SEPARATOR = "\x1e"


def read_weather_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_name, file, hourly) per file, ``hourly`` a map of whatever arrays the document
    has, their values as text. A file holds one region and one year at most, so reading it
    whole is bounded; files are spread over tasks. Broken JSON fails."""
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read.schema(ANY_WEATHER).option("lineSep", RECORD_SEPARATOR).option("mode", "FAILFAST")
    return reader.json(paths).select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file"), "hourly")


def select_documents(documents: DataFrame, daily: bool) -> DataFrame:
    """Increments read only the daily files, backfills everything else."""
    marked = is_daily_file("file_name")
    return documents.filter(marked if daily else ~marked)


def _checked(documents: DataFrame, time: Column) -> DataFrame:
    message = F.concat(F.lit("no hourly values in "), F.col("file_name"))
    return documents.filter(F.when(time.isNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def _shortest() -> Column:
    """Length of the shortest array of a document; an array that is NULL has none."""
    return F.array_min(F.transform(F.map_values("hourly"), lambda a: F.size(a)))


def declared(documents: DataFrame) -> DataFrame:
    """``documents`` of any arrays with ``hourly`` as the instants and the declared
    measures, cut to the shortest of all arrays, declared or not. Other arrays are left
    out, and a measure that is text but no number fails."""
    shortest = _shortest()

    def numbers(name: str) -> Column:
        return F.transform(F.slice(F.col("hourly")[name], F.lit(1), shortest), lambda v: v.cast("double")).alias(name)

    time = F.slice(F.col("hourly")["time"], F.lit(1), shortest).alias("time")
    return documents.withColumn("hourly", F.struct(time, *[numbers(name) for name in MEASURES]))


def measure_rows(documents: DataFrame) -> DataFrame:
    """One row per hour and array of documents of any arrays: ``region_code``, ``time``,
    ``measure``, ``value`` (as text) and ``number`` (NULL where the text is none).

    All arrays of a document are cut to the shortest of them; one that is NULL gives
    NULL values and cuts nothing. A document without instants fails.
    """
    time = F.col("hourly")["time"]
    told = _checked(documents, time).select(
        parse_region_code(region_from_file_name("file_name")).alias("region_code"),
        F.slice(time, F.lit(1), _shortest()).alias("_time"),
        F.explode(F.map_filter("hourly", lambda name, _: name != "time")).alias("measure", "_values"),
    )
    values = F.coalesce(F.slice("_values", F.lit(1), F.size("_time")), F.array_repeat(F.lit(None).cast("string"), F.size("_time")))
    hours = told.select("region_code", "measure", F.inline(F.arrays_zip("_time", values.alias("_value"))).alias("time", "value"))
    return hours.select("region_code", parse_instant("time").alias("time"), "measure", "value", F.col("value").try_cast("double").alias("number"))


def weather_rows(documents: DataFrame, file_as: str | None = None) -> DataFrame:
    """One row per hour of ``declared`` documents: region_code, time, temperature_2m,
    precipitation, and the
    ``file`` of ``documents`` under the name ``file_as``, if that is given.

    Arrays of unequal length are cut to the shortest; a measure that is missing
    from the document is NULL; a document without ``hourly`` fails.
    """
    time = F.col("hourly.time")
    arrays = {"time": time}
    for name in MEASURES:
        no_values = F.array_repeat(F.lit(None).cast("double"), F.size(time))
        arrays[name] = F.coalesce(F.col(f"hourly.{name}"), no_values)
    shortest = F.least(*[F.size(a) for a in arrays.values()])
    cut = [F.slice(a, F.lit(1), shortest).alias(name) for name, a in arrays.items()]
    hours = _checked(documents, time).select(
        parse_region_code(region_from_file_name("file_name")).alias("region_code"),
        *([F.col("file").alias(file_as)] if file_as else []),
        F.inline(F.arrays_zip(*cut)).alias("time", *MEASURES),
    )
    return hours.withColumn("time", parse_instant("time"))


def read_raw_weather(spark: SparkSession, paths: str | list[str], daily: bool = False, file_as: str | None = None) -> DataFrame:
    return weather_rows(declared(select_documents(read_weather_documents(spark, paths), daily)), file_as)
