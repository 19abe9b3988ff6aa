"""Stored tables: typed reads, scoped reads and partition watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from wattloom.functions.timeparts import has_columns, instant
from wattloom.schemas import Dataset
from wattloom.session import hadoop_path
from wattloom.sources.generations import located


def read_table(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    """The table under its declared schema; partition columns come from directories,
    whichever of them have some."""
    stored = spark.read.schema(dataset.schema).parquet(located(spark, path))
    return stored if stored.columns == dataset.columns else stored.select(*dataset.columns)


def read_table_or_empty(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    """As ``read_table``, but a table that was never written reads as empty."""
    try:
        return read_table(spark, dataset, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], dataset.schema)


def since(df: DataFrame, time: str, start: str | date | Column | None, slack_days: int = 1) -> DataFrame:
    """Rows at or after ``start``.

    Spark pushes the timestamp filter to row groups but cannot derive a partition
    filter from it, so tables laid out by year/month/day, year/month or year get one too.
    ``slack_days`` covers partitions named after a local day that differs from the
    UTC day, and undated rows are read as well; the timestamp filter alone decides which
    rows are returned.
    """
    if start is None:
        return df
    bound = instant(start)
    first_day = F.date_sub(F.to_date(bound), slack_days)
    if has_columns(df, ["year"]):
        if has_columns(df, ["month", "day"]):
            # months apart, as days may have no folders
            recent = [F.make_date("year", "month", F.lit(1)) >= F.trunc(first_day, "month"), F.make_date("year", "month", "day") >= first_day]
        else:
            recent = [F.col("year") >= F.year(first_day)]
        for bounded in recent:
            df = df.filter(F.col("year").isNull() | bounded)
    return df.filter(F.col(time) >= bound)


NO_PARTITIONS = "no partitions found: run the backfill of this table before an increment"


UNDATED = "__HIVE_DEFAULT_PARTITION__"


def _subfolders(spark: SparkSession, path: str, column: str, undated: bool = False) -> list[tuple[str, str]]:
    """Values of a partition column and their folders; those without a value only if
    ``undated`` asks for them."""
    fs, place = hadoop_path(spark, path)
    if not fs.exists(place):
        return []
    names = [(status.getPath().getName(), status.getPath().toString()) for status in fs.listStatus(place) if status.isDirectory()]
    values = [(name.partition("=")[2], folder) for name, folder in names if name.startswith(f"{column}=")]
    return [pair for pair in values if undated or pair[0] != UNDATED]


def _holds_files(spark: SparkSession, path: str) -> bool:
    fs, place = hadoop_path(spark, path)
    return any(status.isFile() and status.getPath().getName()[0] not in "._" for status in fs.listStatus(place))


def _newest_day(spark: SparkSession, path: str, columns: tuple[str, ...] = ("year", "month", "day")) -> list[int] | None:
    if not columns:
        return [] if _holds_files(spark, path) else None
    if columns == ("day",) and not _subfolders(spark, path, "day", undated=True):
        # a month in one folder: its newest day is in the files
        if not _holds_files(spark, path):
            return None
        newest = spark.read.schema("day int").parquet(path).agg(F.max("day")).first()[0]
        return None if newest is None else [newest]
    for value, folder in sorted(((int(v), f) for v, f in _subfolders(spark, path, columns[0])), reverse=True):
        found = _newest_day(spark, folder, columns[1:])
        if found is not None:
            return [value, *found]
    return None


def stored_layout(spark: SparkSession, dataset: Dataset, path: str, otherwise: Dataset) -> Dataset:
    """``dataset``, which has a folder per day, if the stored table has them, else with a
    folder per month; ``otherwise`` where nothing is stored.

    Listings down to the first month that holds anything; no file is opened.
    """
    for _, year in _subfolders(spark, located(spark, path), "year", undated=True):
        for _, month in _subfolders(spark, year, "month", undated=True):
            if _subfolders(spark, month, "day", undated=True):
                return dataset
            if _holds_files(spark, month):
                return dataset.by_month()
    return otherwise


def partition_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Folders of a table's first partition column; none if the table does not exist."""
    return [folder for _, folder in _subfolders(spark, located(spark, path), column)]


def partition_values(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[tuple[str, ...], str]:
    """The values of a table's partition columns and their folders, by listing alone."""
    found: dict[tuple[str, ...], str] = {(): located(spark, path)}
    for column in columns:
        found = {(*values, value): below for values, folder in found.items() for value, below in _subfolders(spark, folder, column)}
    return found


def partition_years(spark: SparkSession, path: str) -> list[int]:
    """Years with a folder in a table laid out by year first."""
    return sorted(int(value) for value, _ in _subfolders(spark, located(spark, path), "year"))


def high_watermark(spark: SparkSession, path: str) -> date:
    """The newest day of a table laid out by year, month and day, or by year and month.

    Three listings of folder names, however long the history. No file is opened where
    days have folders, else one column of the newest month's. A table without partitions
    fails: backfill it first.
    """
    newest = _newest_day(spark, located(spark, path))
    if newest is None:
        raise ValueError(NO_PARTITIONS)
    return date(*newest)


def high_watermarks(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """``watermark``, the newest day, per series of a table laid out by year, month and
    day: from folder names where the series is the first partition column, else from one
    column of the files. A table without partitions fails."""
    if dataset.series:
        try:
            stored = read_table(spark, dataset, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise ValueError(NO_PARTITIONS) from None
        newest_day = F.max(F.make_date("year", "month", "day")).alias("watermark")
        # one short row per series, read once
        found = stored.groupBy(*dataset.series).agg(newest_day).filter("watermark IS NOT NULL").collect()
        if not found:
            raise ValueError(NO_PARTITIONS)
        fields = [dataset.schema[name] for name in dataset.series]
        return spark.createDataFrame(found, StructType([*fields, StructField("watermark", DateType())]))
    by = dataset.schema[dataset.partition_by[0]]
    kind = int if by.dataType.typeName() in ("integer", "long") else str
    newest = [(kind(value), _newest_day(spark, folder)) for value, folder in _subfolders(spark, located(spark, path), by.name)]
    rows = [(value, date(*day)) for value, day in newest if day is not None]
    if not rows:
        raise ValueError(NO_PARTITIONS)
    return spark.createDataFrame(rows, f"`{by.name}` {by.dataType.simpleString()}, watermark date")


def available_years(df: DataFrame, time: str) -> DataFrame:
    """One row per year from the second to the last; the first year holds no values."""
    bounds = df.agg(F.year(F.min(time)).alias("first"), F.year(F.max(time)).alias("last"))
    # sequence() would run backwards where there is a single year
    spread = bounds.filter("first < last")
    return spread.select(F.explode(F.sequence(F.col("first") + 1, F.col("last"))).alias("year"))


def year_ranges(years: DataFrame, as_of: str | date | Column) -> DataFrame:
    """First and last day of each ``year``; the running year ends the day before ``as_of``."""
    today = F.to_date(instant(as_of))
    year = F.col("year")
    return years.select(
        year,
        F.make_date(year, F.lit(1), F.lit(1)).alias("start_date"),
        F.when(year == F.year(today), F.date_sub(today, 1))
        .otherwise(F.make_date(year, F.lit(12), F.lit(31)))
        .alias("end_date"),
    )
