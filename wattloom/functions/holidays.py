"""French public-holiday rules as date arithmetic on year rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.regions import ALSACE_MOSELLE, METROPOLE

# Fixed values: (name, month, day) and (name, days after Easter Sunday), each with
# the zone that adds it; METROPOLE days apply everywhere.
FIXED_DAYS = [
    ("Jour de l'an", 1, 1, METROPOLE),
    ("Fête du Travail", 5, 1, METROPOLE),
    ("Victoire 1945", 5, 8, METROPOLE),
    ("Fête nationale", 7, 14, METROPOLE),
    ("Assomption", 8, 15, METROPOLE),
    ("Toussaint", 11, 1, METROPOLE),
    ("Armistice 1918", 11, 11, METROPOLE),
    ("Noël", 12, 25, METROPOLE),
    ("Saint-Étienne", 12, 26, ALSACE_MOSELLE),
]
EASTER_DAYS = [
    ("Vendredi saint", -2, ALSACE_MOSELLE),
    ("Lundi de Pâques", 1, METROPOLE),
    ("Ascension", 39, METROPOLE),
    ("Lundi de Pentecôte", 50, METROPOLE),
]


def with_easter(years: DataFrame) -> DataFrame:
    """Add ``easter`` to ``year`` rows by the published Meeus/Jones/Butcher congruences.

    Step by step, so that each intermediate value is computed once.
    """
    terms = years.withColumns({"_golden": F.expr("year % 19"), "_century": F.expr("year div 100"), "_short": F.expr("year % 100")})
    moon = terms.withColumn(
        "_moon",
        F.expr("(19 * _golden + _century - _century div 4 - (_century - (_century + 8) div 25 + 1) div 3 + 15) % 30"),
    )
    week = moon.withColumn("_week", F.expr("(32 + 2 * (_century % 4) + 2 * (_short div 4) - _moon - _short % 4) % 7"))
    offset = week.withColumn("_offset", F.expr("_moon + _week - 7 * ((_golden + 11 * _moon + 22 * _week) div 451) + 114"))
    easter = F.expr("make_date(year, cast(_offset div 31 as int), cast(_offset % 31 + 1 as int))")
    return offset.select(*years.columns, easter.alias("easter"))


def holiday_rules() -> Column:
    """Array of (jour_ferie, date, zone) for ``year`` and ``easter``; 11 everywhere, 2 local."""
    year, easter = F.col("year"), F.col("easter")
    days = [(name, F.make_date(year, F.lit(m), F.lit(d)), zone) for name, m, d, zone in FIXED_DAYS]
    days += [(name, F.date_add(easter, offset), zone) for name, offset, zone in EASTER_DAYS]
    return F.array(
        *[F.struct(F.lit(name).alias("jour_ferie"), day.alias("date"), F.lit(zone).alias("zone")) for name, day, zone in days]
    )
