"""Landed consumption files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.timeparts import naive_utc
from wattloom.schemas import RAW_CONSUMPTION


def read_raw_consumption(spark: SparkSession, paths: str | list[str], file_schema=None, file_as: str | None = None) -> DataFrame:
    """The six consumption columns of every file the paths or globs match.

    Files may hold zone-aware or zone-less instants; both come back zone-less UTC.
    Give ``file_schema`` where the files store other types (a long for the value, say).
    Keep yearly and daily files in separate folders, so that one glob cannot match both.
    ``file_as`` adds a column with each row's file.
    """
    paths = [paths] if isinstance(paths, str) else paths
    raw = spark.read.schema(file_schema or RAW_CONSUMPTION).parquet(*paths)
    return raw.select(
        naive_utc("date_heure").alias("date_heure"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_CONSUMPTION.fields if f.name != "date_heure"],
        *([F.col("_metadata.file_path").alias(file_as)] if file_as else []),
    )
