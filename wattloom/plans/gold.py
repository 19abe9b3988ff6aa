"""The hourly fact with its trailing mean and its value of a week before."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.timeparts import instant
from wattloom.operators.series import BUCKET_DAYS, with_trailing_features
from wattloom.sources.tables import since as rows_since

REACH_DAYS = 7

FACT_COLUMNS = [
    "date_heure",
    "date_key",
    "region_code",
    "consommation",
    "temperature_2m",
    "precipitation",
    "is_holiday",
    "conso_moyenne_mobile_7j",
    "conso_j_moins_7",
]


def build_fact(silver: DataFrame, since: str | date | None = None, bucket_days: int | None = BUCKET_DAYS) -> DataFrame:
    """All of silver, or the rows from ``since`` on, with both features.

    A scoped build reads seven days more than it returns, which is all that the window
    reaches back to, so it equals the full build on its scope. Catalyst cannot move a
    filter on the ordering column below a window, hence the explicit read scope.
    """
    read_from = None if since is None else instant(since) - F.expr(f"INTERVAL '{REACH_DAYS}' DAY")
    rows = rows_since(silver, "date_heure", read_from)
    featured = with_trailing_features(rows, ["region_code"], "consommation", days=REACH_DAYS, bucket_days=bucket_days)
    if since is not None:
        featured = featured.filter(F.col("date_heure") >= instant(since))
    return featured.withColumn("date_key", F.to_date("date_heure")).select(*FACT_COLUMNS)
