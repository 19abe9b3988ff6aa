"""Jobs over a lake of stored layers: backfills, increments, rebuild and rolling run.

A job works in a session of its own beside the caller's (``session.job_session``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.regions import REGIONS, is_daily_file, parse_region_code, region_from_file_name
from wattloom.functions.timeparts import instant, truncated
from wattloom.operators.quality import DataQualityError, enforce, write_counts
from wattloom.operators.ranges import affected_ranges, in_ranges, widened
from wattloom.operators.slices import increment_slice, increment_slice_by_series, resolve_start, unknown_series
from wattloom.operators.summaries import gate_summary, partition_summary
from wattloom.operators.tables import append_by_name, flat_copy, overwrite_table, replace_by_key, upsert_table, write_table
from wattloom.plans.bronze import bronze_consumption, bronze_weather
from wattloom.plans.gold import FACT_COLUMNS, REACH_DAYS, build_fact
from wattloom.plans.silver import SILVER_COLUMNS, build_silver
from wattloom.schemas import (
    BRONZE_CONSUMPTION,
    BRONZE_WEATHER,
    CHANGES,
    DIM_DATE,
    DIM_REGION,
    FACT,
    FACT_UPDATES,
    HOLIDAYS,
    SILVER,
    SILVER_SUMMARIES,
    SILVER_UPDATES,
    Dataset,
)
from wattloom.session import delete_path, job_session, scratch
from wattloom.sources.calendars import HOLIDAY_YEARS, dim_date, dim_region, holiday_calendar
from wattloom.sources.consumption import read_raw_consumption
from wattloom.sources.generations import publishing
from wattloom.sources.ledger import add_to_ledger, landed_files, of_newest_file, read_ledger, unread
from wattloom.sources.tables import high_watermark, high_watermarks, partition_folders, partition_values, partition_years, read_table, read_table_or_empty, stored_layout
from wattloom.sources.tables import since as rows_since
from wattloom.sources.weather import read_raw_weather


@dataclass(frozen=True)
class Lake:
    """Where the layers are stored, below one root folder.

    Bronze has a folder per month: a day of twelve regions is a few hundred rows, and its
    folder costs more than they do. With ``day_folders`` backfills give each day one, for
    days of many rows; increments keep what they find.
    """

    root: str
    day_folders: bool = False

    def bronze(self, dataset: Dataset) -> Dataset:
        return dataset if self.day_folders else dataset.by_month()

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def consumption(self) -> str:
        return self.path("bronze/consumption")

    @property
    def weather(self) -> str:
        return self.path("bronze/weather")

    @property
    def holidays(self) -> str:
        return self.path("bronze/public_holidays")

    @property
    def files_read(self) -> str:
        return self.path("ingested/files")

    @property
    def changes(self) -> str:
        return self.path("ingested/changed_hours")

    @property
    def silver(self) -> str:
        return self.path("silver/hourly")

    @property
    def summaries(self) -> str:
        return self.path("silver/summaries")

    @property
    def fact(self) -> str:
        return self.path("gold/fact_consommation_horaire")

    @property
    def dates(self) -> str:
        return self.path("gold/dim_date")

    @property
    def regions(self) -> str:
        return self.path("gold/dim_region")


def _consumption(spark: SparkSession, lake: Lake) -> Dataset:
    """Bronze consumption in the folders it has, or will have where nothing is stored."""
    return stored_layout(spark, BRONZE_CONSUMPTION, lake.consumption, lake.bronze(BRONZE_CONSUMPTION))


def _weather(spark: SparkSession, lake: Lake) -> Dataset:
    return stored_layout(spark, BRONZE_WEATHER, lake.weather, lake.bronze(BRONZE_WEATHER))


def backfill_consumption(
    spark: SparkSession, lake: Lake, raw: str | list[str], flat_path: str | None = None, day_ordered: bool = False
) -> None:
    """Rebuild bronze consumption from all landed files; without a shuffle where the
    files are known to be ``day_ordered``."""
    spark = job_session(spark)
    rows = bronze_consumption(read_raw_consumption(spark, raw))
    overwrite_table(rows, lake.bronze(BRONZE_CONSUMPTION), lake.consumption, gather=not day_ordered)
    if flat_path:
        flat_copy(read_table(spark, BRONZE_CONSUMPTION, lake.consumption), flat_path)


def backfill_weather(spark: SparkSession, lake: Lake, raw: str | list[str], flat_path: str | None = None) -> None:
    """Rebuild bronze weather from all landed documents but the daily ones."""
    spark = job_session(spark)
    overwrite_table(bronze_weather(read_raw_weather(spark, raw)), lake.bronze(BRONZE_WEATHER), lake.weather)
    if flat_path:
        flat_copy(read_table(spark, BRONZE_WEATHER, lake.weather), flat_path)


def increment_consumption(spark: SparkSession, lake: Lake, raw: str | list[str], as_of: str | date) -> DataFrame:
    """Bring bronze consumption up to the day before ``as_of``; returns the partitions
    it touched. Re-running it, or landing overlapping files, changes nothing."""
    spark = job_session(spark)
    watermark = high_watermark(spark, lake.consumption)
    landed = increment_slice(read_raw_consumption(spark, raw), "date_heure", watermark, as_of)
    return replace_by_key(bronze_consumption(landed), _consumption(spark, lake), lake.consumption)


def increment_weather(
    spark: SparkSession, lake: Lake, raw: str | list[str], as_of: str | date, flat_path: str | None = None
) -> DataFrame:
    """Bring bronze weather up to the day before ``as_of`` from the daily documents,
    each region from its own newest day on; returns the partitions it touched. A region
    that was never backfilled fails."""
    spark = job_session(spark)
    marks = high_watermarks(spark, lake.weather, BRONZE_WEATHER)
    # the names say the regions, so no document is opened for them
    named = landed_files(spark, raw).filter(is_daily_file("file_name"))
    regions = named.select(parse_region_code(region_from_file_name("file_name")).alias("region_code"))
    unknown = [row[0] for row in unknown_series(regions, marks, ["region_code"]).limit(20).collect()]
    if unknown:
        raise ValueError(f"no partitions found for regions {unknown}: run the backfill of this table first")
    landed = increment_slice_by_series(read_raw_weather(spark, raw, daily=True), marks, ["region_code"], "time", as_of)
    return replace_by_key(bronze_weather(landed), _weather(spark, lake), lake.weather, flat_path)


def _note_changes(lake: Lake, region: str, time: str) -> Callable[[DataFrame], None]:
    """Store the hours of changed bronze keys, for ``propagate``. Called before bronze is
    written, so that a run which fails between the two notes too much, never too little."""

    def note(changed: DataFrame) -> None:
        hours = changed.select(parse_region_code(region).alias("region_code"), truncated(changed, time, "hour").alias("date_heure"))
        noted = hours.distinct().withColumn("batch", F.lit(uuid.uuid4().hex))
        noted.write.mode("append").partitionBy(*CHANGES.partition_by).parquet(lake.changes)

    return note


def _finished(rows: DataFrame, files: list[Row], time: str, as_of: str | date | None) -> list[Row]:
    """The files without rows that ``as_of`` holds back."""
    if as_of is None:
        return files
    waiting = {row[0] for row in rows.filter(F.col(time) >= instant(as_of)).select("_file").distinct().collect()}
    return [file for file in files if file["file"] not in waiting]


def _until(rows: DataFrame, time: str, as_of: str | date | None) -> DataFrame:
    return rows if as_of is None else rows.filter(F.col(time) < instant(as_of))


def ingest_consumption(spark: SparkSession, lake: Lake, raw: str | list[str], as_of: str | date | None = None) -> DataFrame:
    """Bring the rows of landed files that no earlier run has read into bronze, however
    old the rows are; returns the partitions it touched.

    A key takes the rows of the newest file that holds it. Files are noted as read once
    their rows are stored; with ``as_of``, rows of that day and later wait, and so does
    their file. The hours whose readings changed are noted for ``propagate``. A file that
    is replaced under its name is read again. No new file changes nothing.
    """
    spark = job_session(spark)
    files = unread(landed_files(spark, raw), read_ledger(spark, lake.files_read))
    if not files:
        return read_empty(spark, BRONZE_CONSUMPTION)
    rows = read_raw_consumption(spark, [file["path"] for file in files], file_as="_file")
    newest = of_newest_file(_until(rows, "date_heure", as_of), files, list(BRONZE_CONSUMPTION.key), "_file")
    note = _note_changes(lake, "code_insee_region", "date_heure")
    touched = replace_by_key(bronze_consumption(newest), _consumption(spark, lake), lake.consumption, changed=note)
    add_to_ledger(spark, lake.files_read, _finished(rows, files, "date_heure", as_of))
    return touched


def ingest_weather(
    spark: SparkSession, lake: Lake, raw: str | list[str], as_of: str | date | None = None, daily: bool = True
) -> DataFrame:
    """As ``ingest_consumption``, from the daily weather documents, or all others."""
    spark = job_session(spark)
    wanted = is_daily_file("file_name") if daily else ~is_daily_file("file_name")
    files = unread(landed_files(spark, raw).filter(wanted), read_ledger(spark, lake.files_read))
    if not files:
        return read_empty(spark, BRONZE_WEATHER)
    rows = read_raw_weather(spark, [file["path"] for file in files], daily=daily, file_as="_file")
    newest = of_newest_file(_until(rows, "time", as_of), files, list(BRONZE_WEATHER.key), "_file")
    touched = replace_by_key(bronze_weather(newest), _weather(spark, lake), lake.weather, changed=_note_changes(lake, "region_code", "time"))
    add_to_ledger(spark, lake.files_read, _finished(rows, files, "time", as_of))
    return touched


def read_empty(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """No touched partition."""
    return spark.createDataFrame([], dataset.schema).select(*dataset.parts)


def build_holidays(spark: SparkSession, lake: Lake, first_year: int = HOLIDAY_YEARS[0], last_year: int = HOLIDAY_YEARS[1]) -> None:
    """Replace the holiday table; 134 short rows a year fit one file."""
    overwrite_table(holiday_calendar(job_session(spark), first_year, last_year), HOLIDAYS, lake.holidays)


def build_dimensions(spark: SparkSession, lake: Lake) -> None:
    """Replace both dimensions, so a re-run repeats no row."""
    spark = job_session(spark)
    overwrite_table(dim_date(spark).orderBy("date_key"), DIM_DATE, lake.dates)
    overwrite_table(dim_region(spark), DIM_REGION, lake.regions)


def _calendar(spark: SparkSession, lake: Lake, since: str | None) -> DataFrame:
    """The stored holidays, which must hold every year that silver will, for each region."""
    holidays = read_table(spark, HOLIDAYS, lake.holidays)
    held = {tuple(row) for row in holidays.select(F.year("date"), "region_code").distinct().collect()}
    first = int(since[:4]) if since else 0
    wanted = [year for year in partition_years(spark, lake.consumption) if year >= first]
    missing = [year for year in wanted if not any(year == held_year for held_year, _ in held)]
    if missing:
        raise ValueError(f"the holiday calendar lacks the years {missing}: run build_holidays for them")
    regions = sorted({region[0] for region in REGIONS for year in wanted if (year, region[0]) not in held})
    if regions:
        raise ValueError(f"the holiday calendar lacks the regions {regions} in some years: run build_holidays for them")
    return holidays


def _silver_plan(spark: SparkSession, lake: Lake, since: str | None, calendar_tz: str | None, holidays: bool) -> DataFrame:
    return build_silver(
        read_table(spark, BRONZE_CONSUMPTION, lake.consumption),
        read_table(spark, BRONZE_WEATHER, lake.weather),
        _calendar(spark, lake, since) if holidays else None,
        since=since,
        calendar_tz=calendar_tz,
    )


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, SILVER, lake.silver).select(*SILVER_COLUMNS)


def read_fact(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, FACT, lake.fact).select(*FACT_COLUMNS)


def _stored_fact(fact: DataFrame) -> DataFrame:
    return fact.withColumn("year", F.year("date_heure"))


SERIES, PART = ["region_code"], ["year"]


def _summarised(silver: DataFrame) -> DataFrame:
    return partition_summary(silver, SERIES, PART)


def silver_summaries(spark: SparkSession, lake: Lake) -> DataFrame:
    """One summary per (region, year) of silver. Those that no run has made since their
    partition was written are made now, from these partitions alone."""
    spark = job_session(spark)
    stored = partition_values(spark, lake.silver, SILVER.partition_by)
    known = partition_values(spark, lake.summaries, SILVER.partition_by)
    missing = ["/".join(values) for values in stored if values not in known]
    if missing:
        named = F.concat_ws("/", *[F.col(c).cast("string") for c in SILVER.partition_by])
        rows = read_table(spark, SILVER, lake.silver).filter(named.isin(missing))
        append_by_name(_summarised(rows), SILVER_SUMMARIES, lake.summaries)
    return read_table_or_empty(spark, SILVER_SUMMARIES, lake.summaries)


def _gate(spark: SparkSession, lake: Lake, now) -> None:
    enforce(gate_summary(silver_summaries(spark, lake), SERIES, PART, as_of=now))


def forget_summaries(spark: SparkSession, lake: Lake) -> Callable[[list], None]:
    """Delete the summaries of partitions that are about to be written, so that a run
    which fails on the way leaves none that is out of date."""

    def forget(touched: list) -> None:
        known = partition_values(spark, lake.summaries, SILVER.partition_by)
        for row in touched:
            folder = known.get(tuple(str(row[c]) for c in SILVER.partition_by))
            if folder:
                delete_path(spark, folder)

    return forget


def rebuild(
    spark: SparkSession,
    lake: Lake,
    now: str | datetime | None = None,
    calendar_tz: str | None = None,
    flat_path: str | None = None,
    holidays: bool = True,
) -> None:
    """Silver and gold anew from all of bronze.

    The new silver takes the place of the old one only if it passes the gate, an empty
    one never does, and gold follows it; a run that fails leaves the table it was at as
    it was. ``now`` is the clock of the freshness check, by default the current time.
    """
    spark = job_session(spark)
    noted = partition_folders(spark, lake.changes, "batch")
    with scratch(spark, "silver-summaries") as folder:
        with publishing(spark, lake.silver) as new:
            plan = _silver_plan(spark, lake, None, calendar_tz, holidays)
            counts = write_table(plan, SILVER, new, counts=write_counts(list(SILVER.key), "consommation"))
            if not counts["nb"]:
                raise DataQualityError("data quality checks failed: empty: 1 row(s)")
            overwrite_table(_summarised(read_table(spark, SILVER, new)), SILVER_SUMMARIES, folder)
            enforce(gate_summary(read_table(spark, SILVER_SUMMARIES, folder), SERIES, PART, as_of=now))
            delete_path(spark, lake.summaries)
        overwrite_table(read_table(spark, SILVER_SUMMARIES, folder), SILVER_SUMMARIES, lake.summaries)
    silver = read_silver(spark, lake)
    if flat_path:
        flat_copy(silver, flat_path)
    overwrite_table(_stored_fact(build_fact(silver)), FACT, lake.fact)
    _forget(spark, noted)


def _forget(spark: SparkSession, noted: list[str]) -> None:
    """Delete changes that silver and gold now hold; later ones stay."""
    for folder in noted:
        delete_path(spark, folder)


def _upsert_layers(
    spark: SparkSession, lake: Lake, start: str | None, now, calendar_tz: str | None, flat_path: str | None, holidays: bool
) -> None:
    plan = _silver_plan(spark, lake, start, calendar_tz, holidays)
    upsert_table(plan, SILVER, lake.silver, SILVER_UPDATES, touching=forget_summaries(spark, lake))
    silver = read_silver(spark, lake)
    if flat_path:
        flat_copy(silver if start is None else rows_since(silver, "date_heure", start), flat_path)
    _gate(spark, lake, now)
    upsert_table(_stored_fact(build_fact(silver, since=start)), FACT, lake.fact, FACT_UPDATES)


def rolling_run(
    spark: SparkSession,
    lake: Lake,
    as_of: date | datetime,
    target: str | None = None,
    days: int = 7,
    calendar_tz: str | None = None,
    flat_path: str | None = None,
    now: str | datetime | None = None,
    holidays: bool = True,
) -> None:
    """Reprocess the last ``days`` days, or from ``target`` on, and upsert both layers.

    Earlier rows stay as they are. Gold reads the stored silver, which holds the week
    before the window that its first rows need. A flat copy holds the stored rows of the
    window. ``as_of`` places the window only; the freshness check goes by ``now``, by
    default the current time.
    """
    _upsert_layers(job_session(spark), lake, resolve_start(as_of, days, target), now, calendar_tz, flat_path, holidays)


def merge_run(
    spark: SparkSession,
    lake: Lake,
    now: str | datetime | None = None,
    calendar_tz: str | None = None,
    flat_path: str | None = None,
    holidays: bool = True,
) -> None:
    """Reprocess all of bronze and upsert both layers: a full run that deletes no row.

    Equals ``rebuild`` where bronze holds everything that silver does.
    """
    spark = job_session(spark)
    noted = partition_folders(spark, lake.changes, "batch")
    _upsert_layers(spark, lake, None, now, calendar_tz, flat_path, holidays)
    _forget(spark, noted)


def propagate(
    spark: SparkSession,
    lake: Lake,
    now: str | datetime | None = None,
    calendar_tz: str | None = None,
    flat_path: str | None = None,
    holidays: bool = True,
) -> DataFrame:
    """Bring changed bronze rows of any age into silver and gold; returns ``region_code``,
    ``start`` and ``end`` (exclusive) of the gold ranges that were computed again.

    Silver is computed for the hours that ``ingest_consumption`` and ``ingest_weather``
    noted, gold for these and the seven days after them, from the silver of seven more
    days before. Overlapping ranges are merged first. Only folders that hold such hours
    are read, and only their (region, year) folders are rewritten. Without changes
    nothing happens. The result equals ``merge_run``. Changes are forgotten at the end,
    so a run that fails is repeated whole. A flat copy holds the silver rows computed.
    """
    spark = job_session(spark)
    noted = partition_folders(spark, lake.changes, "batch")
    series, reach = SERIES, 24 * REACH_DAYS
    if not noted:
        return affected_ranges(spark.createDataFrame([], CHANGES.schema), series)
    changed = spark.read.schema(CHANGES.schema).option("basePath", lake.changes).parquet(*noted)
    with scratch(spark, "changed-ranges") as folder:
        affected_ranges(changed, series).write.parquet(f"{folder}/hours")
        affected_ranges(changed, series, reach_hours=reach).write.parquet(f"{folder}/reached")
        hours, reached = spark.read.parquet(f"{folder}/hours"), spark.read.parquet(f"{folder}/reached")
        found = spark.createDataFrame(reached.collect(), reached.schema)
        readings = read_table(spark, BRONZE_CONSUMPTION, lake.consumption).withColumn("region_code", parse_region_code("code_insee_region"))
        plan = build_silver(
            in_ranges(readings, hours, series, "date_heure", _consumption(spark, lake).partition_by),
            in_ranges(read_table(spark, BRONZE_WEATHER, lake.weather), hours, series, "time", _weather(spark, lake).partition_by),
            _calendar(spark, lake, None) if holidays else None,
            calendar_tz=calendar_tz,
        )
        upsert_table(plan, SILVER, lake.silver, SILVER_UPDATES, flat_path, touching=forget_summaries(spark, lake))
        _gate(spark, lake, now)
        read_from = widened(reached, reach)
        silver = in_ranges(read_table(spark, SILVER, lake.silver), read_from, series, "date_heure", SILVER.partition_by, slack_days=0)
        fact = in_ranges(build_fact(silver), reached, series)
        upsert_table(_stored_fact(fact), FACT, lake.fact, FACT_UPDATES)
    _forget(spark, noted)
    return found
