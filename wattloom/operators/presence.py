"""Presence bitmaps of hourly series: which clock hours hold a row.

A bitmap covers 32,768 hours, three years and nine months, of one series in 4 KB, so what
is shuffled is a few bitmaps per series and task instead of a row per hour. Bitmaps of
different parts of a table merge, in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timeparts import hour_index

# Fixed by Spark's bitmap functions.
BITMAP_BITS = 32_768


def presence(df: DataFrame, by: list[str], time: str = "date_heure", also: Sequence[Column] = ()) -> DataFrame:
    """``by``, ``bucket``, ``bitmap`` of the hours with a row, ``nb``, the rows with an
    instant, and the aggregates ``also``. Rows without an instant are left out."""
    hour = hour_index(time)
    bucket = F.floor(hour / BITMAP_BITS)
    placed = df.withColumns({"bucket": bucket, "_bit": (hour - bucket * BITMAP_BITS).cast("long")}).filter("_bit IS NOT NULL")
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"), F.count(F.lit(1)).alias("nb"), *also)


def merged_presence(parts: DataFrame, by: list[str]) -> DataFrame:
    """``presence`` of several parts of a table, as of the whole."""
    return parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("nb").alias("nb"))


def _bits(bitmap: str) -> Column:
    """Places of the set bits, ascending: byte by byte, and in a byte from the lowest."""
    values = F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP_BITS // 8 - 1)),
        lambda at: F.struct(at.alias("at"), F.conv(F.hex(F.substring(F.col(bitmap), at + 1, F.lit(1))), 16, 10).cast("int").alias("byte")),
    )
    present = F.filter(values, lambda v: v["byte"] != 0)
    each = F.transform(
        present,
        lambda v: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(7)), lambda bit: F.call_function("getbit", v["byte"], bit) == 1), lambda bit: v["at"] * 8 + bit
        ),
    )
    return F.flatten(each)


def present_hours(parts: DataFrame, by: list[str], also: Sequence[Column] = ()) -> DataFrame:
    """``by`` and ``hours``, the ascending clock hours since 1970 that hold a row: one row
    per series, of a few bitmaps each; and the aggregates ``also`` of its parts."""
    hours = F.transform(_bits("bitmap"), lambda bit: F.col("bucket") * BITMAP_BITS + bit)
    told = parts.withColumn("_hours", hours)
    gathered = told.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("bucket", "_hours"))).alias("_parts"), *also)
    return gathered.withColumn("hours", F.flatten(F.col("_parts._hours"))).drop("_parts")


def gaps_in(hours: str, max_hours: int) -> Column:
    """(``hour``, ``ecart_h``) of each hour that comes more than ``max_hours`` after the
    one before it in an ascending array."""
    later = F.slice(hours, F.lit(2), F.greatest(F.size(hours) - 1, F.lit(0)))
    earlier = F.slice(hours, F.lit(1), F.greatest(F.size(hours) - 1, F.lit(0)))
    steps = F.zip_with(later, earlier, lambda a, b: F.struct(a.alias("hour"), (a - b).alias("ecart_h")))
    return F.filter(steps, lambda step: step["ecart_h"] > max_hours)


def presence_gaps(parts: DataFrame, by: list[str], time: str = "date_heure", max_hours: int = 2) -> DataFrame:
    """``by``, ``time`` and ``ecart_h``: hours after a gap of more than ``max_hours`` hour
    boundaries, as ``series.series_gaps`` finds them in rows on the hour. Nothing is
    ordered but the bitmaps of a series."""
    found = present_hours(parts, by).select(*by, F.inline(gaps_in("hours", max_hours)))
    start = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, cast(hour as int))")
    return found.select(*by, start.alias(time), F.col("ecart_h").cast("long"))


def presence_counts(parts: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``nb`` rows, ``hours`` that hold one, and ``repeats``: rows beyond the
    first of their hour."""
    counted = parts.groupBy(*by).agg(F.sum("nb").alias("nb"), F.sum(F.bitmap_count("bitmap")).alias("hours"))
    return counted.withColumn("repeats", F.col("nb") - F.col("hours"))
