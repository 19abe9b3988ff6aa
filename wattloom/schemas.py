"""One explicit schema per dataset: columns, key and storage partitions.

Nothing is inferred from files, so a region code in a directory name or a column
that is empty in one year cannot change type between runs.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_STRING, _INT, _DOUBLE = StringType(), IntegerType(), DoubleType()
_DATE, _INSTANT = DateType(), TimestampNTZType()


def _schema(*fields: tuple) -> StructType:
    """Fields are (name, type) or (name, type, "required")."""
    return StructType([StructField(field[0], field[1], nullable=len(field) < 3) for field in fields])


@dataclass(frozen=True)
class Dataset:
    """A stored table. ``partition_by`` columns are part of ``schema``, come last,
    and must be functions of ``key`` so that one key never spans two partitions. Files
    are sorted by ``sort_by``, whose values then lie close together, and hold a Bloom
    filter for each column of ``bloom``. ``series`` are columns that tell touched
    partitions and watermarks apart, but have no folders of their own."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    series: tuple[str, ...] = ()

    @property
    def parts(self) -> list[str]:
        return [name for name in self.columns if name in (*self.series, *self.partition_by)]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def by_month(self) -> Dataset:
        """The table with a folder per month. ``day`` is a column of the files then, and
        tells touched partitions apart as before."""
        return replace(self, partition_by=tuple(c for c in self.partition_by if c != "day"), series=(*self.series, "day"))


RAW_CONSUMPTION = _schema(
    ("date_heure", _INSTANT),
    ("date", _STRING),
    ("code_insee_region", _STRING),
    ("libelle_region", _STRING),
    ("nature", _STRING),
    ("consommation", _DOUBLE),
)

RAW_WEATHER = StructType(
    [
        StructField(
            "hourly",
            _schema(
                ("time", ArrayType(_STRING)),
                ("temperature_2m", ArrayType(_DOUBLE)),
                ("precipitation", ArrayType(_DOUBLE)),
            ),
        )
    ]
)

# The same documents, whatever arrays they have.
ANY_WEATHER = StructType([StructField("hourly", MapType(_STRING, ArrayType(_STRING)))])

# Partitioned by the source's own local day (`date`), not by the UTC day.
BRONZE_CONSUMPTION = Dataset(
    "bronze_consumption",
    _schema(
        ("date_heure", _INSTANT, "required"),
        ("date", _DATE),
        ("code_insee_region", _STRING, "required"),
        ("libelle_region", _STRING),
        ("nature", _STRING),
        ("consommation", _DOUBLE),
        ("year", _INT),
        ("month", _INT),
        ("day", _INT),
    ),
    key=("date_heure", "code_insee_region"),
    partition_by=("year", "month", "day"),
    sort_by=("code_insee_region", "date_heure"),
    bloom=("code_insee_region",),
)

# A day of all regions is one folder: a folder and a file for each region's 24 rows would
# cost more than its rows, and twelve times as many steps at every write and listing.
BRONZE_WEATHER = Dataset(
    "bronze_weather",
    _schema(
        ("time", _INSTANT, "required"),
        ("temperature_2m", _DOUBLE),
        ("precipitation", _DOUBLE),
        ("region_code", _INT, "required"),
        ("year", _INT),
        ("month", _INT),
        ("day", _INT),
    ),
    key=("time", "region_code"),
    partition_by=("year", "month", "day"),
    sort_by=("region_code", "time"),
    series=("region_code",),
)

HOLIDAYS = Dataset(
    "public_holidays",
    _schema(
        ("region_code", _INT, "required"),
        ("date", _DATE, "required"),
        ("jour_ferie", _STRING),
        ("is_holiday", _INT),
    ),
    key=("date", "region_code"),
)

SILVER = Dataset(
    "silver",
    _schema(
        ("date_heure", _INSTANT, "required"),
        ("consommation", _DOUBLE),
        ("temperature_2m", _DOUBLE),
        ("precipitation", _DOUBLE),
        ("is_holiday", _INT),
        ("region_code", _INT, "required"),
        ("year", _INT),
    ),
    key=("date_heure", "region_code"),
    partition_by=("region_code", "year"),
    sort_by=("date_heure",),
)

# `year` exists in storage only, to prune and replace partitions.
FACT = Dataset(
    "fact_consommation_horaire",
    _schema(
        ("date_heure", _INSTANT, "required"),
        ("date_key", _DATE, "required"),
        ("consommation", _DOUBLE),
        ("temperature_2m", _DOUBLE),
        ("precipitation", _DOUBLE),
        ("is_holiday", _INT),
        ("conso_moyenne_mobile_7j", _DOUBLE),
        ("conso_j_moins_7", _DOUBLE),
        ("region_code", _INT, "required"),
        ("year", _INT),
    ),
    key=("date_heure", "region_code"),
    partition_by=("region_code", "year"),
    sort_by=("date_heure",),
)

DIM_DATE = Dataset(
    "dim_date",
    _schema(
        ("date_key", _DATE, "required"),
        ("annee", _INT),
        ("mois", _INT),
        ("jour", _INT),
        ("jour_semaine", _STRING),
    ),
    key=("date_key",),
)

DIM_REGION = Dataset(
    "dim_region",
    _schema(("region_code", _INT, "required"), ("region_nom", _STRING), ("latitude", _DOUBLE), ("longitude", _DOUBLE)),
    key=("region_code",),
)

# Landed files that increments have read.
LEDGER = Dataset(
    "landed_files",
    _schema(("file", _STRING, "required"), ("length", LongType(), "required"), ("modified", TimestampType(), "required")),
    key=("file", "length", "modified"),
)

# Hours whose bronze rows changed and that silver and gold have not seen.
CHANGES = Dataset(
    "changed_hours",
    _schema(("region_code", _INT, "required"), ("date_heure", _INSTANT, "required"), ("batch", _STRING)),
    key=("region_code", "date_heure", "batch"),
    partition_by=("batch",),
)

# What the gate knows of each partition of silver.
SILVER_SUMMARIES = Dataset(
    "silver_summaries",
    _schema(
        ("first_hour", LongType()),
        ("last_hour", LongType()),
        ("newest", _INSTANT),
        ("nb", LongType()),
        ("repeats", LongType()),
        ("gaps", LongType()),
        ("outliers", LongType()),
        ("region_code", _INT, "required"),
        ("year", _INT),
    ),
    key=("region_code", "year"),
    partition_by=("region_code", "year"),
)

# Measures a matched row takes from the source (also when NULL); the rest stays.
SILVER_UPDATES = ("consommation", "temperature_2m", "precipitation", "is_holiday")
FACT_UPDATES = SILVER_UPDATES + ("conso_moyenne_mobile_7j", "conso_j_moins_7")
