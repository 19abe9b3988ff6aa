"""Data-quality checks. Each check returns its violating rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timeparts import hour_index, hours_between, instant
from wattloom.operators.series import series_gaps

# Hour boundaries a gap or an age may span, and plausible megawatts.
MAX_GAP_HOURS = 2
MAX_AGE_HOURS = 48
LOWEST, HIGHEST = 0, 50000


class DataQualityError(Exception):
    """Raised by ``enforce``; lists every failed check with its row count."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb")).filter(F.col("nb") > 1)


def stale_series(
    df: DataFrame,
    by: list[str],
    time: str = "date_heure",
    as_of: str | date | datetime | Column | None = None,
    max_hours: int = MAX_AGE_HOURS,
) -> DataFrame:
    """Series whose newest row is more than ``max_hours`` hour boundaries old."""
    now = instant(F.current_timestamp() if as_of is None else as_of)
    newest = df.groupBy(*by).agg(F.max(time).alias("derniere_donnee"))
    return newest.filter(hours_between("derniere_donnee", now) > max_hours)


def is_outlier(value: str, low: float = LOWEST, high: float = HIGHEST) -> Column:
    column = F.col(value)
    return column.isNull() | (column < low) | (column > high)


def outliers(df: DataFrame, value: str = "consommation", low: float = LOWEST, high: float = HIGHEST) -> DataFrame:
    return df.filter(is_outlier(value, low, high))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Declared keys that are NULL or repeated, with their number of rows."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    problem = F.when(has_null, "null").otherwise("duplicate")
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb"))
    return counted.filter(has_null | (F.col("nb") > 1)).withColumn("problem", problem)


def orphan_keys(fact: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Foreign-key values the dimension lacks, with their number of fact rows.

    Fact rows are counted per value before the join, so a value that most rows share
    costs no more than any other. A NULL key refers to nothing and is not an orphan.
    """
    used = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("nb"))
    known = dimension.select(F.col(dimension_key).alias("_known"))
    return used.join(known, F.col(fact_key) == F.col("_known"), "left_anti")


def violation_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) with one row per named check."""
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, rows in checks.items()
    ]
    summary = counted[0]
    for more in counted[1:]:
        summary = summary.unionByName(more)
    return summary


def series_checks(
    df: DataFrame, by: list[str], time: str = "date_heure", as_of=None, value: str | None = None
) -> dict[str, DataFrame]:
    """The checks of an hourly table by name; outliers only where ``value`` is given."""
    checks = {
        "duplicates": duplicate_keys(df, [time, *by]),
        "gaps": series_gaps(df, by, time, MAX_GAP_HOURS),
        "freshness": stale_series(df, by, time, as_of),
    }
    if value:
        checks["outliers"] = outliers(df, value)
    return checks


def series_summary(
    df: DataFrame,
    by: list[str],
    time: str = "date_heure",
    as_of: str | date | datetime | Column | None = None,
    value: str | None = None,
    max_gap: int = MAX_GAP_HOURS,
    max_age: int = MAX_AGE_HOURS,
    low: float = LOWEST,
    high: float = HIGHEST,
) -> DataFrame:
    """``violation_counts(series_checks(...))`` from a single scan, and ``empty``, which
    counts one violation where there are no rows at all.

    Rows are reduced to instants, then to clock hours, then to series, each before its
    shuffle, and every check is a count on the way.
    """
    now = instant(F.current_timestamp() if as_of is None else as_of)
    bad = F.count_if(is_outlier(value, low, high)) if value else F.lit(0).cast("long")
    instants = df.groupBy(*by, time).agg(F.count(F.lit(1)).alias("nb"), bad.alias("bad"))
    hours = instants.groupBy(*by, hour_index(time).alias("_hour")).agg(
        F.max(time).alias("newest"), F.count_if(F.col("nb") > 1).alias("repeated"), F.sum("bad").alias("bad")
    )
    previous = F.lag("_hour").over(Window.partitionBy(*by).orderBy("_hour"))
    series = (
        hours.withColumn("gap", F.col("_hour") - previous)
        .groupBy(*by)
        .agg(
            F.max("newest").alias("newest"),
            F.count_if(F.col("gap") > max_gap).alias("gaps"),
            F.sum("repeated").alias("duplicates"),
            F.sum("bad").alias("outliers"),
        )
        .withColumn("stale", hours_between("newest", now) > max_age)
    )
    totals = series.agg(
        F.sum("duplicates").alias("duplicates"),
        F.sum("gaps").alias("gaps"),
        F.count_if("stale").alias("freshness"),
        F.sum("outliers").alias("outliers"),
        (F.count(F.lit(1)) == 0).cast("long").alias("empty"),
    )
    return check_rows(totals, ["duplicates", "gaps", "freshness", "empty"] + (["outliers"] if value else []))


def check_rows(totals: DataFrame, names: list[str]) -> DataFrame:
    """(check, violations) from one row with a column per check; NULL counts as none."""
    pairs = [F.struct(F.lit(name).alias("check"), F.coalesce(name, F.lit(0).cast("long")).alias("violations")) for name in names]
    return totals.select(F.inline(F.array(*pairs)))


def write_counts(keys: list[str], value: str, low: float = LOWEST, high: float = HIGHEST) -> list[Column]:
    """Aggregates for ``tables.overwrite_table`` to count while it writes: ``nb`` rows,
    ``null_keys`` and ``outliers``. They need no second look at the table."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = {"nb": F.count(F.lit(1)), "null_keys": F.count_if(has_null), "outliers": F.count_if(is_outlier(value, low, high))}
    return [count.alias(name) for name, count in counts.items()]


def enforce(summary: DataFrame) -> None:
    """Fail with all checks that found rows. The summary has one row per check."""
    failed = [row for row in summary.collect() if row["violations"]]
    if failed:
        details = ", ".join(f"{row['check']}: {row['violations']} row(s)" for row in failed)
        raise DataQualityError(f"data quality checks failed: {details}")
