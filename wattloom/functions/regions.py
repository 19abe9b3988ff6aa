"""Region codes and the holiday zone of a region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region code, name, latitude and longitude of its weather point.
REGIONS = [
    (11, "Île-de-France", 48.8566, 2.3522),
    (24, "Centre-Val de Loire", 47.3941, 0.6848),
    (27, "Bourgogne-Franche-Comté", 47.3220, 5.0415),
    (28, "Normandie", 49.4944, 0.1079),
    (32, "Hauts-de-France", 50.6292, 3.0573),
    (44, "Grand Est", 48.5734, 7.7521),
    (52, "Pays de la Loire", 47.2184, -1.5536),
    (53, "Bretagne", 48.1173, -1.6778),
    (75, "Nouvelle-Aquitaine", 44.8378, -0.5792),
    (76, "Occitanie", 43.6047, 1.4442),
    (84, "Auvergne-Rhône-Alpes", 45.7640, 4.8357),
    (93, "Provence-Alpes-Côte d'Azur", 43.2965, 5.3698),
]

# The one region under the Alsace-Moselle calendar, and zone names.
ALSACE_MOSELLE_REGION = 44
ALSACE_MOSELLE = "Alsace-Moselle"
METROPOLE = "Métropole"


def holiday_zones(region_code: Column | str) -> Column:
    """Calendars a region observes: the common one, plus the local one for region 44."""
    region_code = F.col(region_code) if isinstance(region_code, str) else region_code
    both = F.array(F.lit(METROPOLE), F.lit(ALSACE_MOSELLE))
    return F.when(region_code == ALSACE_MOSELLE_REGION, both).otherwise(F.array(F.lit(METROPOLE)))


def parse_region_code(col: Column | str, on_bad: str = "fail") -> Column:
    """Text to int. A code such as ``2A`` fails the job, or becomes NULL on request."""
    col = F.col(col) if isinstance(col, str) else col
    if on_bad == "fail":
        return col.cast("int")
    if on_bad == "null":
        return col.try_cast("int")
    raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")


def region_from_file_name(file_name: Column | str) -> Column:
    """``openmeteo-<region>-<year>.json`` to the region text; the last dash splits."""
    return F.regexp_extract(file_name, r"^openmeteo-(.+)-[^-]+\.json$", 1)


def is_daily_file(file_name: Column | str) -> Column:
    file_name = F.col(file_name) if isinstance(file_name, str) else file_name
    return file_name.endswith("-daily.json")
