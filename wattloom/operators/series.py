"""Time-series operators on rows keyed by (series columns, instant)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timeparts import day_index, hour_index, truncated

# Length of the stretches a series is cut into before windowing. Eight weeks keep the
# copied week at an eighth of the rows and a stretch of hourly rows at 1,344.
BUCKET_DAYS = 56


def time_bucket(df: DataFrame, by: list[str], measure: Column, *, time: str = "date_heure", unit: str = "hour") -> DataFrame:
    """``measure``, a named aggregate such as ``F.avg("x").alias("x")``, per series and
    per ``unit`` of ``time``."""
    return df.groupBy(*by, truncated(df, time, unit).alias(time)).agg(measure)


def per_instant(df: DataFrame, by: list[str], measures: list[Column], *, time: str = "date_heure") -> DataFrame:
    """Repeated readings of one series at one instant as one row of named aggregates."""
    return df.groupBy(*by, time).agg(*measures)


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def _range_window(by: list[str], time: str, frame: str) -> str:
    # Interval bounds exist only in SQL text: Window.rangeBetween takes plain numbers.
    return f"OVER (PARTITION BY {_quoted(by)} ORDER BY `{time}` RANGE BETWEEN {frame})"


def trailing_mean(by: list[str], value: str, time: str, days: int) -> Column:
    """Mean over the last ``days`` days up to and including the row, both ends inclusive.

    The frame is a span of time, so a missing hour does not stretch it.
    """
    frame = f"INTERVAL '{int(days)}' DAY PRECEDING AND CURRENT ROW"
    return F.expr(f"avg(`{value}`) {_range_window(by, time, frame)}")


def value_before(by: list[str], value: str, time: str, days: int) -> Column:
    """The value exactly ``days`` days earlier, NULL where that instant is absent."""
    frame = f"INTERVAL '{int(days)}' DAY PRECEDING AND INTERVAL '{int(days)}' DAY PRECEDING"
    return F.expr(f"max(`{value}`) {_range_window(by, time, frame)}")


def with_trailing_features(
    df: DataFrame,
    by: list[str],
    value: str,
    time: str = "date_heure",
    mean_as: str | None = "conso_moyenne_mobile_7j",
    lag_as: str | None = "conso_j_moins_7",
    days: int = 7,
    bucket_days: int | None = BUCKET_DAYS,
) -> DataFrame:
    """Add the trailing mean and the exact lag with one shuffle and one sort.

    With ``bucket_days`` each series is cut into stretches that are windowed apart, so
    a dozen long series use the whole cluster. A row that a later stretch reaches back
    to is copied there, and the copies are dropped after the window; the reach is
    exactly ``days``, so the result is the same as with ``bucket_days=None``. The lag
    expects one row per series and instant (see ``quality.duplicate_keys``).
    """
    wanted = {}
    columns = df.columns
    if bucket_days is None:
        keys = list(by)
    else:
        day = day_index(time)
        home = F.floor(day / bucket_days)
        last_reached = F.floor((day + days) / bucket_days)
        df = df.withColumn("_home", home)
        # explode_outer keeps rows without an instant, in a stretch of their own
        df = df.withColumn("_stretch", F.explode_outer(F.sequence(F.col("_home"), last_reached)))
        keys = [*by, "_stretch"]
    if mean_as:
        wanted[mean_as] = trailing_mean(keys, value, time, days)
    if lag_as:
        wanted[lag_as] = value_before(keys, value, time, days)
    df = df.select("*", *[column.alias(name) for name, column in wanted.items()])
    if bucket_days is not None:
        df = df.filter(F.col("_stretch").eqNullSafe(F.col("_home")))
    return df.select(*columns, *wanted)


def lag_by_join(
    df: DataFrame, by: list[str], value: str, time: str = "date_heure", alias: str = "conso_j_moins_7", days: int = 7
) -> DataFrame:
    """The exact lag as a left self-join: where an earlier instant is repeated, each
    of its rows is returned, as SQL does."""
    earlier = df.select(
        *by, (F.col(time) + F.expr(f"INTERVAL '{int(days)}' DAY")).alias(time), F.col(value).alias(alias)
    )
    return df.join(earlier, [*by, time], "left").select(*df.columns, alias)


def series_gaps(df: DataFrame, by: list[str], time: str = "date_heure", max_hours: int = 2) -> DataFrame:
    """First rows after a gap of more than ``max_hours`` hour boundaries.

    Rows within one clock hour are never apart, so each series is first reduced to its
    hours, before the shuffle; what is ordered per series is one row per clock hour.
    """
    hours = df.groupBy(*by, hour_index(time).alias("_hour")).agg(F.min(time).alias(time))
    previous = F.lag("_hour").over(Window.partitionBy(*by).orderBy("_hour"))
    return (
        hours.filter(F.col("_hour").isNotNull())
        .withColumn("ecart_h", (F.col("_hour") - previous).cast("long"))
        .filter(F.col("ecart_h") > max_hours)
        .select(*by, time, "ecart_h")
    )
