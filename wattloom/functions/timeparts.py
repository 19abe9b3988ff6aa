"""Parsing, truncating and comparing instants and days."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def parse_day(col: Column | str) -> Column:
    """Strict ``2024-07-01`` text. A plain cast reads well-formed text several times
    faster than a format does; anything else goes to the format, which rejects it."""
    col = F.col(col) if isinstance(col, str) else col
    well_formed = col.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return F.when(well_formed, col.cast("date")).otherwise(F.to_date(col, "yyyy-MM-dd"))


def parse_instant(col: Column | str) -> Column:
    """Zone-less ``2024-07-01T13:00`` text, taken as UTC."""
    return F.to_timestamp_ntz(col, F.lit("yyyy-MM-dd'T'HH:mm"))


def naive_utc(col: Column | str) -> Column:
    """Drop the zone of an instant; the session zone is UTC, so nothing shifts."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("timestamp_ntz")


def with_date_parts(df: DataFrame, day: Column | str) -> DataFrame:
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def truncated(df: DataFrame, time: str, granularity: str) -> Column:
    """``date_trunc`` that keeps the column's own timestamp type."""
    cut = F.date_trunc(granularity, F.col(time))
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        return cut.cast("timestamp_ntz")
    return cut


def day_index(col: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(F.to_date(col))


def hour_index(col: Column | str) -> Column:
    """Clock hours since 1970-01-01 00:00."""
    return day_index(col) * 24 + F.hour(col)


def hours_between(earlier: Column | str, later: Column | str) -> Column:
    """Hour boundaries crossed, not elapsed hours: 00:59 to 02:01 is 2."""
    return hour_index(later) - hour_index(earlier)


def instant(value: Column | str | date | datetime) -> Column:
    """A bound given as text, date, datetime or column, as a zone-less timestamp.

    A zone-aware datetime is first brought to UTC.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime) and value.tzinfo is not None:
        offset = value.utcoffset()
        value = value.replace(tzinfo=None) - offset
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def has_columns(df: DataFrame, names: Iterable[str]) -> bool:
    return set(names) <= set(df.columns)
