"""Which rows a backfill or an increment takes from landed data."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timeparts import instant
from wattloom.sources.tables import since


def between(df: DataFrame, time: str, start: str | date | Column, end: str | date | Column) -> DataFrame:
    """Half-open ``[start, end)``, which reaches the parquet scan."""
    return df.filter((F.col(time) >= instant(start)) & (F.col(time) < instant(end)))


def year_slice(df: DataFrame, time: str, year: int, as_of: str | date | Column) -> DataFrame:
    """One calendar year, without the unfinished day ``as_of``."""
    end = F.least(instant(f"{year + 1}-01-01"), instant(as_of))
    return between(df, time, f"{year}-01-01", end)


def increment_slice(df: DataFrame, time: str, watermark: date, as_of: str | date | Column) -> DataFrame:
    """Rows from the day before the watermark up to, not including, ``as_of``.

    The watermark is a local day, whose first hours belong to the UTC day before;
    starting there re-reads rows instead of missing them, and writing by key
    (``tables.replace_by_key``) makes that harmless.
    """
    rows = since(df, time, watermark - timedelta(days=1))
    return rows.filter(F.col(time) < instant(as_of))


def increment_slice_by_series(
    df: DataFrame, watermarks: DataFrame, by: list[str], time: str, as_of: str | date | Column
) -> DataFrame:
    """Rows from each series' own watermark day up to yesterday, both days inclusive.

    ``watermarks`` holds ``by`` and ``watermark``, one row per series. Nothing older than
    the oldest watermark is read. Rows of a series without one are left out:
    ``unknown_series`` finds those.
    """
    marks = watermarks.select(*by, "watermark")
    oldest = marks.agg(F.min("watermark").cast("timestamp_ntz")).scalar()
    rows = df.filter((F.col(time) < instant(as_of)) & (F.col(time) >= oldest))
    return rows.join(marks, by).filter(F.to_date(time) >= F.col("watermark")).select(*df.columns)


def unknown_series(df: DataFrame, watermarks: DataFrame, by: list[str]) -> DataFrame:
    """Series of ``df`` without a watermark, that is, never backfilled."""
    return df.select(*by).distinct().join(watermarks.select(*by), by, "left_anti")


def resolve_start(as_of: date | datetime, days: int = 7, target: str | None = None) -> str:
    """The given target day, else the day ``days`` days before ``as_of``."""
    if target:
        return target
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    return (day - timedelta(days=days)).isoformat()
