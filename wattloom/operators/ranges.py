"""Ranges of hours per series: from changed rows to what has to be computed again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timeparts import has_columns, hour_index, with_date_parts


def _hour_start(hour: str):
    return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, cast(`{hour}` as int))")


def affected_ranges(changed: DataFrame, by: list[str], time: str = "date_heure", reach_hours: int = 0) -> DataFrame:
    """``by``, ``start`` and ``end`` (exclusive): the hours that rows at ``time`` reach,
    their own and ``reach_hours`` after it, as ranges that neither overlap nor touch.

    Rows are reduced to clock hours before the shuffle, so a series is ordered by at most
    one row an hour, however many rows changed. Rows without an instant or a series
    reach nothing.
    """
    named = changed.select(*by, hour_index(time).alias("_hour")).dropna()
    hours = named.distinct()
    ordered = Window.partitionBy(*by).orderBy("_hour")
    apart = F.coalesce(F.col("_hour") - F.lag("_hour").over(ordered) > reach_hours + 1, F.lit(True))
    islands = hours.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(ordered))
    bounds = islands.groupBy(*by, "_island").agg(F.min("_hour").alias("_first"), (F.max("_hour") + reach_hours + 1).alias("_after"))
    return bounds.select(*by, _hour_start("_first").alias("start"), _hour_start("_after").alias("end"))


def widened(ranges: DataFrame, before_hours: int) -> DataFrame:
    """The ranges with ``before_hours`` more at their start; they may overlap then."""
    return ranges.withColumn("start", F.col("start") - F.expr(f"make_dt_interval(0, {int(before_hours)})"))


def _days(ranges: DataFrame) -> DataFrame:
    """One row per range and day it has a part of, which makes a range join an equi join."""
    last = F.to_date(F.col("end") - F.expr("INTERVAL 1 MICROSECOND"))
    return ranges.withColumn("_day", F.explode(F.sequence(F.to_date("start"), last)))


def in_ranges(
    df: DataFrame, ranges: DataFrame, by: list[str], time: str = "date_heure", partition_by: Sequence[str] = (), slack_days: int = 1
) -> DataFrame:
    """Rows of ``df`` inside a range of their series. Read ``ranges`` from a stored table.

    ``partition_by`` names the partition columns of a stored ``df``. Those among ``by``,
    ``year``, ``month`` and ``day`` are compared with the values that the ranges touch, of
    which there are no more than folders, and only such folders are read. ``slack_days``
    covers folders named after a local day; undated folders are read as well.
    """
    days = _days(ranges)
    folders = [c for c in partition_by if c in by or c in ("year", "month", "day")]
    if folders and has_columns(df, folders):
        near = days.withColumn("_day", F.explode(F.array(*[F.date_add("_day", n) for n in range(-slack_days, slack_days + 1)])))
        near = with_date_parts(near, "_day")
        touched = [list(row) for row in near.select(*folders).distinct().collect()]
        undated = F.col("year").isNull() if "year" in folders else F.lit(False)
        named = F.concat_ws("/", *[F.col(c).cast("string") for c in folders])
        df = df.filter(undated | named.isin(["/".join(map(str, row)) for row in touched]))
    pieces = days.select(*[F.col(c).alias(f"_range_{c}") for c in by], "_day", F.col("start").alias("_start"), F.col("end").alias("_end"))
    condition = (F.to_date(time) == F.col("_day")) & (F.col(time) >= F.col("_start")) & (F.col(time) < F.col("_end"))
    for c in by:
        condition = condition & (F.col(c) == F.col(f"_range_{c}"))
    return df.join(pieces, condition, "left_semi")
