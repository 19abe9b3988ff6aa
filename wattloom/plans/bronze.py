"""Typed, dated rows per source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattloom.functions.timeparts import parse_day, with_date_parts
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER


def bronze_consumption(raw: DataFrame) -> DataFrame:
    """Dated by the source's local ``date``, which differs from the UTC day for an
    hour or two around midnight."""
    return with_date_parts(raw.withColumn("date", parse_day("date")), "date").select(*BRONZE_CONSUMPTION.columns)


def bronze_weather(rows: DataFrame) -> DataFrame:
    return with_date_parts(rows, "time").select(*BRONZE_WEATHER.columns)
