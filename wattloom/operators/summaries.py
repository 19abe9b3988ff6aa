"""The gate's checks from small summaries, one per partition of a stored series table.

A summary holds the first and last hour of a partition, the gaps between them, and
counts. Summaries of following partitions combine: gaps add up, and there is one more
where the first hour of a partition is too far from the last one before it. So a table
is judged by its summaries, and a write makes those of its own partitions anew.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timeparts import hours_between, instant
from wattloom.operators.presence import gaps_in, presence, present_hours
from wattloom.operators.quality import HIGHEST, LOWEST, MAX_AGE_HOURS, MAX_GAP_HOURS, check_rows, is_outlier

SUMMARY_COLUMNS = ["first_hour", "last_hour", "newest", "nb", "repeats", "gaps", "outliers"]


def partition_summary(
    df: DataFrame,
    by: list[str],
    part: list[str],
    time: str = "date_heure",
    value: str | None = None,
    max_gap: int = MAX_GAP_HOURS,
    low: float = LOWEST,
    high: float = HIGHEST,
) -> DataFrame:
    """One row per ``by`` and ``part``: ``first_hour``, ``last_hour`` (clock hours since
    1970), ``newest``, ``nb`` rows, ``repeats`` (rows beyond the first of their hour),
    ``gaps`` inside, and ``outliers`` of ``value``, 0 without one.

    For tables with rows on the hour. What is shuffled is bitmaps, not rows.
    """
    bad = F.count_if(is_outlier(value, low, high)) if value else F.lit(0).cast("long")
    keys = [*by, *part]
    parts = presence(df, keys, time, also=[F.max(time).alias("newest"), bad.alias("outliers")])
    sums = [F.max("newest").alias("newest"), F.sum("nb").alias("nb"), F.sum("outliers").alias("outliers")]
    told = present_hours(parts, keys, also=sums)
    return told.select(
        *keys,
        F.get("hours", F.lit(0)).cast("long").alias("first_hour"),
        F.element_at("hours", -1).cast("long").alias("last_hour"),
        "newest",
        "nb",
        (F.col("nb") - F.size("hours")).alias("repeats"),
        F.size(gaps_in("hours", max_gap)).cast("long").alias("gaps"),
        "outliers",
    )


def combined(summaries: DataFrame, by: list[str], part: list[str], max_gap: int = MAX_GAP_HOURS) -> DataFrame:
    """One summary per series from those of its partitions, which follow each other in
    time in the order of ``part``."""
    fields = F.struct(*part, *SUMMARY_COLUMNS)
    gathered = summaries.groupBy(*by).agg(F.sort_array(F.collect_list(fields)).alias("_parts"))
    rest = F.greatest(F.size("_parts") - 1, F.lit(0))
    apart = F.zip_with(
        F.slice("_parts", F.lit(2), rest), F.slice("_parts", F.lit(1), rest), lambda after, before: after["first_hour"] - before["last_hour"]
    )
    between = F.size(F.filter(apart, lambda gap: gap > max_gap))

    def total(name: str) -> Column:
        return F.aggregate(F.col(f"_parts.{name}"), F.lit(0).cast("long"), lambda a, b: a + b).alias(name)

    return gathered.select(
        *by,
        F.array_min(F.col("_parts.first_hour")).alias("first_hour"),
        F.array_max(F.col("_parts.last_hour")).alias("last_hour"),
        F.array_max(F.col("_parts.newest")).alias("newest"),
        total("nb"),
        total("repeats"),
        (total("gaps") + between).alias("gaps"),
        total("outliers"),
    )


def gate_summary(
    summaries: DataFrame,
    by: list[str],
    part: list[str],
    as_of: str | date | datetime | Column | None = None,
    value: str | None = None,
    max_gap: int = MAX_GAP_HOURS,
    max_age: int = MAX_AGE_HOURS,
) -> DataFrame:
    """As ``quality.series_summary`` of the whole table: (check, violations).

    Duplicates are rows beyond the first of their hour, so a key that occurs three times
    counts twice here and once there.
    """
    now = instant(F.current_timestamp() if as_of is None else as_of)
    totals = combined(summaries, by, part, max_gap).agg(
        F.sum("repeats").alias("duplicates"),
        F.sum("gaps").alias("gaps"),
        F.count_if(hours_between("newest", now) > max_age).alias("freshness"),
        F.sum("outliers").alias("outliers"),
        (F.count(F.lit(1)) == 0).cast("long").alias("empty"),
    )
    return check_rows(totals, ["duplicates", "gaps", "freshness", "empty"] + (["outliers"] if value else []))
