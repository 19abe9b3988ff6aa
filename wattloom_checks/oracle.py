"""The SQL each registered query must equal, over the same tables."""

from __future__ import annotations

from wattloom_checks.queries import REPLACE_FROM, SINCE, UPSERT_FROM, UPSERT_UNTIL

# Stated here rather than taken from the code under test.
CODES = [11, 24, 27, 28, 32, 44, 52, 53, 75, 76, 84, 93]
LOCAL_CALENDAR = 44
DIM_DATE_START, DIM_DATE_ROWS = "2013-01-01", 7000
# Region, name, latitude, longitude.
PLACES = """
  (11, 'Île-de-France', 48.8566, 2.3522), (24, 'Centre-Val de Loire', 47.3941, 0.6848),
  (27, 'Bourgogne-Franche-Comté', 47.3220, 5.0415), (28, 'Normandie', 49.4944, 0.1079),
  (32, 'Hauts-de-France', 50.6292, 3.0573), (44, 'Grand Est', 48.5734, 7.7521),
  (52, 'Pays de la Loire', 47.2184, -1.5536), (53, 'Bretagne', 48.1173, -1.6778),
  (75, 'Nouvelle-Aquitaine', 44.8378, -0.5792), (76, 'Occitanie', 43.6047, 1.4442),
  (84, 'Auvergne-Rhône-Alpes', 45.7640, 4.8357), (93, 'Provence-Alpes-Côte d''Azur', 43.2965, 5.3698)"""
# Published dates of Easter Sunday.
EASTER_SUNDAYS = [
    "1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15",
    "2013-03-31", "2014-04-20", "2015-04-05", "2016-03-27", "2017-04-16", "2018-04-01", "2019-04-21",
    "2020-04-12", "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20", "2026-04-05",
    "2027-03-28", "2028-04-16", "2029-04-01", "2030-04-21",
]


def _region(column: str) -> str:
    return f"([{', '.join(map(str, CODES))}])[CAST({column} % {len(CODES)} AS INTEGER) + 1]"


def _whole(column: str, scale: int = 10_000) -> str:
    return f"floor({column} * CAST({scale} AS DOUBLE) + 0.5)"


def _mean(column: str) -> str:
    return f"floor(avg({column}) + 0.5)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


HALF_HOUR = "time_bucket(INTERVAL '30 minutes', ts)"


READINGS = f"""readings AS (
  SELECT {HALF_HOUR} AS date_heure,
         strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS local_day,
         {_region("user_id")} AS region_code,
         event_type AS nature,
         {_whole("value")} AS consommation
  FROM events)"""

WARM = "event_type IN ('view', 'signup', 'purchase')"

WEATHER = f"""weather AS (
  SELECT {_region("user_id")} AS region_code,
         date_trunc('hour', ts) AS date_heure,
         CASE WHEN {WARM} THEN {_whole("value")} END AS temperature_2m,
         CASE WHEN NOT {WARM} THEN {_whole("value")} END AS precipitation
  FROM events)"""

HOURS = f"""instants AS (
  SELECT region_code, date_heure, {_mean("consommation")} AS consommation FROM readings GROUP BY ALL),
hours AS (
  SELECT region_code, date_trunc('hour', date_heure) AS date_heure, {_mean("consommation")} AS consommation
  FROM instants GROUP BY ALL)"""

WEATHER_HOURS = f"""weather_hours AS (
  SELECT region_code, date_heure, {_mean("temperature_2m")} AS temperature_2m, {_mean("precipitation")} AS precipitation
  FROM weather GROUP BY ALL)"""

# Reads `years` (year) and `regions` (region_code). Rules: name, month and day or days
# after Easter, and whether only the one region has it.
HOLIDAYS = f"""easter AS (
  SELECT CAST(sunday AS DATE) AS sunday, year(CAST(sunday AS DATE)) AS year
  FROM (VALUES {", ".join(f"('{sunday}')" for sunday in EASTER_SUNDAYS)}) AS t(sunday)),
rules(name, month, day, shift, local) AS (VALUES
  ('Jour de l''an', 1, 1, NULL, FALSE), ('Fête du Travail', 5, 1, NULL, FALSE), ('Victoire 1945', 5, 8, NULL, FALSE),
  ('Fête nationale', 7, 14, NULL, FALSE), ('Assomption', 8, 15, NULL, FALSE), ('Toussaint', 11, 1, NULL, FALSE),
  ('Armistice 1918', 11, 11, NULL, FALSE), ('Noël', 12, 25, NULL, FALSE), ('Saint-Étienne', 12, 26, NULL, TRUE),
  ('Vendredi saint', NULL, NULL, -2, TRUE), ('Lundi de Pâques', NULL, NULL, 1, FALSE),
  ('Ascension', NULL, NULL, 39, FALSE), ('Lundi de Pentecôte', NULL, NULL, 50, FALSE)),
named_days AS (
  SELECT name, local,
         CASE WHEN shift IS NULL THEN make_date(CAST(e.year AS BIGINT), CAST(month AS BIGINT), CAST(day AS BIGINT))
              ELSE sunday + CAST(shift AS INTEGER) END AS date
  FROM easter e JOIN years USING (year), rules),
holidays AS (
  SELECT region_code, CAST(date AS DATE) AS date, string_agg(name, ', ' ORDER BY name) AS jour_ferie, CAST(1 AS INTEGER) AS is_holiday
  FROM named_days, regions WHERE NOT local OR region_code = {LOCAL_CALENDAR} GROUP BY 1, 2)"""

EVENT_YEARS = f"""years AS (SELECT DISTINCT year(ts) AS year FROM events),
regions(region_code) AS (VALUES {", ".join(f"({code})" for code in CODES)})"""

ORDER_YEARS = f"""years AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders),
regions AS (SELECT DISTINCT {_region("o_custkey")} AS region_code FROM orders)"""


def _silver(holidays: bool, condition: str = "TRUE") -> str:
    flag = "CAST(coalesce(d.is_holiday, 0) AS INTEGER)" if holidays else "CAST(0 AS INTEGER)"
    join = "LEFT JOIN holidays d ON d.region_code = c.region_code AND d.date = CAST(c.date_heure AS DATE)" if holidays else ""
    return f"""silver AS (
  SELECT c.date_heure, c.region_code, c.consommation, w.temperature_2m, w.precipitation,
         {flag} AS is_holiday, CAST(year(c.date_heure) AS INTEGER) AS year
  FROM hours c
  LEFT JOIN weather_hours w ON w.region_code = c.region_code AND w.date_heure = c.date_heure
  {join}
  WHERE {condition})"""


PLAIN_SILVER = _with(READINGS, WEATHER, HOURS, WEATHER_HOURS, _silver(False))
HOLIDAY_SILVER = _with(READINGS, WEATHER, HOURS, WEATHER_HOURS, EVENT_YEARS, HOLIDAYS, _silver(True))

FACT = f"""{HOLIDAY_SILVER},
means AS (
  SELECT *, avg(consommation) OVER (
      PARTITION BY region_code ORDER BY date_heure
      RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS conso_moyenne_mobile_7j
  FROM silver),
fact AS (
  SELECT m.*, CAST(m.date_heure AS DATE) AS date_key, e.consommation AS conso_j_moins_7
  FROM means m
  LEFT JOIN silver e ON e.region_code = m.region_code AND e.date_heure = m.date_heure - INTERVAL 7 DAY)"""

LAG = f"""{_with(READINGS, HOURS)}
SELECT h.region_code, h.date_heure, h.consommation, e.consommation AS conso_j_moins_7
FROM hours h LEFT JOIN hours e ON e.region_code = h.region_code AND e.date_heure = h.date_heure - INTERVAL 7 DAY"""


def _merged(prelude: str, table: str, columns: list[str], updates: list[str]) -> str:
    chosen = [
        f"CASE WHEN s.date_heure IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
        if c in updates
        else f"coalesce(t.{c}, s.{c}) AS {c}"
        for c in columns
    ]
    return f"""{prelude},
target AS (SELECT * FROM {table} WHERE date_heure < '{UPSERT_UNTIL}'),
source AS (
  SELECT * REPLACE (CASE WHEN consommation > 2000000 THEN NULL ELSE consommation + 1 END AS consommation)
  FROM {table} WHERE date_heure >= '{UPSERT_FROM}')
SELECT {", ".join(chosen)}
FROM target t FULL JOIN source s ON t.date_heure = s.date_heure AND t.region_code = s.region_code"""


SILVER_COLUMNS = ["date_heure", "region_code", "consommation", "temperature_2m", "precipitation", "is_holiday", "year"]
FACT_COLUMNS = [
    "date_heure", "date_key", "region_code", "consommation", "temperature_2m", "precipitation", "is_holiday",
    "conso_moyenne_mobile_7j", "conso_j_moins_7",
]
MEASURES = ["consommation", "temperature_2m", "precipitation", "is_holiday"]
UPSERT_SILVER = _merged(PLAIN_SILVER, "silver", SILVER_COLUMNS, MEASURES)
UPSERT_GOLD = _merged(FACT, "fact", FACT_COLUMNS, MEASURES + ["conso_moyenne_mobile_7j", "conso_j_moins_7"])

BRONZE_WEATHER = _with(WEATHER, WEATHER_HOURS) + """,
bronze AS (
  SELECT date_heure AS time, temperature_2m, precipitation, region_code,
         CAST(year(date_heure) AS INTEGER) AS year, CAST(month(date_heure) AS INTEGER) AS month,
         CAST(day(date_heure) AS INTEGER) AS day
  FROM weather_hours)"""

YEARS = "SELECT unnest(range(min(year(o_orderdate)) + 1, max(year(o_orderdate)) + 1)) AS y FROM orders"

INSTANTS = f"""instants AS (
  SELECT {HALF_HOUR} AS date_heure, {_region("user_id")} AS region_code, event_type, value FROM events)"""


METER = f"""meter AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(event_id // 12 AS INTEGER)) AS date_heure, {_region("event_id")} AS region_code,
         {_whole("value")} AS consommation,
         CASE WHEN {WARM} THEN {_whole("value")} END AS temperature_2m,
         CASE WHEN NOT {WARM} THEN {_whole("value")} END AS precipitation
  FROM events)"""

JOB_CONSUMPTION = f"""{_with(METER)},
dated AS (SELECT *, CAST(date_heure + INTERVAL 1 HOUR AS DATE) AS date FROM meter)
SELECT date_heure, date, CAST(region_code AS VARCHAR) AS code_insee_region, 'region ' || region_code AS libelle_region,
       'hourly' AS nature, consommation, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day
FROM dated"""

JOB_WEATHER = f"""{_with(METER)}
SELECT date_heure AS time, temperature_2m, precipitation, region_code, CAST(year(date_heure) AS INTEGER) AS year,
       CAST(month(date_heure) AS INTEGER) AS month, CAST(day(date_heure) AS INTEGER) AS day
FROM meter"""

ALL_REGIONS = f"""regions(region_code) AS (VALUES {", ".join(f"({code})" for code in CODES)})"""
STORED_YEARS = f"years AS (SELECT unnest(range(1995, 2002)) AS year), {ALL_REGIONS}"

JOB_FACT = f"""{_with(METER)},
years AS (SELECT DISTINCT year(date_heure) AS year FROM meter), {ALL_REGIONS}, {HOLIDAYS},
silver AS (
  SELECT m.*, CAST(coalesce(d.is_holiday, 0) AS INTEGER) AS is_holiday
  FROM meter m LEFT JOIN holidays d ON d.region_code = m.region_code AND d.date = CAST(m.date_heure AS DATE))
SELECT s.date_heure, CAST(s.date_heure AS DATE) AS date_key, s.region_code, s.consommation, s.temperature_2m, s.precipitation, s.is_holiday,
       avg(s.consommation) OVER (PARTITION BY s.region_code ORDER BY s.date_heure
           RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS conso_moyenne_mobile_7j,
       e.consommation AS conso_j_moins_7
FROM silver s LEFT JOIN silver e ON e.region_code = s.region_code AND e.date_heure = s.date_heure - INTERVAL 7 DAY"""


def _gaps(table: str, series: str, time: str) -> str:
    return f"""SELECT * FROM (
  SELECT {series}, {time}, date_diff('hour', lag({time}) OVER (PARTITION BY {series} ORDER BY {time}), {time}) AS ecart_h
  FROM {table}) WHERE ecart_h > 2"""


def _exact(column: str) -> str:
    """The mean by whole numbers: parts before the point, and 2**62ths after it."""
    places = 1 << 62
    whole = f"sum(CAST(floor({column}) AS HUGEINT))"
    part = f"sum(CAST(floor(({column} - floor({column})) * {places}::DOUBLE + 0.5::DOUBLE) AS HUGEINT))"
    carried = f"CAST(CAST({whole} + {part} // {places} AS BIGINT) AS DOUBLE)"
    rest = f"CAST(CAST({part} % {places} AS BIGINT) AS DOUBLE) / {places}::DOUBLE"
    return f"({carried} + {rest}) / count({column})"


ORACLE = {
    "bronze_calendar_parts": f"""{_with(READINGS)}
SELECT date_heure, CAST(local_day AS DATE) AS date, CAST(region_code AS VARCHAR) AS code_insee_region,
       'region ' || region_code AS libelle_region, nature, consommation,
       CAST(year(CAST(local_day AS DATE)) AS INTEGER) AS year, CAST(month(CAST(local_day AS DATE)) AS INTEGER) AS month,
       CAST(day(CAST(local_day AS DATE)) AS INTEGER) AS day
FROM readings""",
    "time_bucket_hour": f"""SELECT event_type, date_trunc('hour', ts) AS ts, avg({_whole("value")}) AS mean_value
FROM events GROUP BY ALL""",
    "time_bucket_day": f"""SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, max({_whole("value")}) AS max_value
FROM events GROUP BY ALL""",
    "dedupe_then_hourly": f"{_with(READINGS, HOURS)} SELECT * FROM hours",
    "weather_dedupe": f"{_with(WEATHER, WEATHER_HOURS)} SELECT * FROM weather_hours",
    "silver_join": f"{PLAIN_SILVER} SELECT * FROM silver",
    "silver_holidays": f"""WITH readings AS (
  SELECT o_orderdate AS date_heure, {_region("o_custkey")} AS region_code, {_whole("o_totalprice", 100)} AS consommation FROM orders),
weather AS (
  SELECT {_region("o_custkey")} AS region_code, o_orderdate AS date_heure,
         CASE WHEN o_orderstatus = 'O' THEN {_whole("o_totalprice", 100)} END AS temperature_2m,
         CASE WHEN o_orderstatus = 'F' THEN {_whole("o_totalprice", 100)} END AS precipitation
  FROM orders),
{HOURS}, {WEATHER_HOURS}, {ORDER_YEARS}, {HOLIDAYS}, {_silver(True)}
SELECT * FROM silver""",
    "silver_since": f"{HOLIDAY_SILVER} SELECT * FROM silver WHERE date_heure >= '{SINCE}'",
    "gold_rolling_7d": f"""{_with(READINGS, HOURS)}
SELECT *, avg(consommation) OVER (
    PARTITION BY region_code ORDER BY date_heure
    RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS conso_moyenne_mobile_7j
FROM hours""",
    "gold_lag_7d": LAG,
    "gold_lag_7d_join": LAG,
    "gold_fact": f"{FACT} SELECT * EXCLUDE (year) FROM fact",
    "gold_fact_since": f"{FACT} SELECT * EXCLUDE (year) FROM fact WHERE date_heure >= '{SINCE}'",
    "upsert_silver": UPSERT_SILVER,
    "upsert_silver_stored": UPSERT_SILVER,
    "upsert_gold": UPSERT_GOLD,
    "upsert_empty_source": f"{PLAIN_SILVER} SELECT * FROM silver",
    "append_by_name": f"""{BRONZE_WEATHER}
SELECT * FROM bronze WHERE time < '{SINCE}'
UNION ALL
SELECT time, temperature_2m, NULL, region_code, year, month, day FROM bronze WHERE time >= '{SINCE}'""",
    "partition_replace": f"""{_with(READINGS, HOURS)},
dated AS (
  SELECT date_heure, CAST(date_heure + INTERVAL 1 HOUR AS DATE) AS date, CAST(region_code AS VARCHAR) AS code_insee_region,
         CAST(NULL AS VARCHAR) AS libelle_region, 'hourly' AS nature, consommation FROM hours),
stored AS (
  SELECT * FROM dated WHERE date < '{REPLACE_FROM}'
  UNION ALL
  SELECT * REPLACE (consommation * 2 AS consommation) FROM dated WHERE date >= '{REPLACE_FROM}')
SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day
FROM stored""",
    "touched_partitions": f"""{BRONZE_WEATHER}
SELECT DISTINCT region_code, year, month, day FROM bronze""",
    "replace_keys": f"""{_with(READINGS)},
target AS (SELECT date_heure, region_code, consommation FROM readings WHERE date_heure < '{UPSERT_UNTIL}'),
source AS (
  SELECT date_heure, region_code, consommation + 1 AS consommation FROM readings
  WHERE date_heure >= '{UPSERT_FROM}'),
stored AS (
  SELECT * FROM target t WHERE NOT EXISTS (
    SELECT 1 FROM source s WHERE s.date_heure = t.date_heure AND s.region_code = t.region_code)
  UNION ALL SELECT * FROM source)
SELECT date_heure, CAST(region_code AS VARCHAR) AS code_insee_region, consommation FROM stored""",
    "flat_copy": f"{BRONZE_WEATHER} SELECT * FROM bronze",
    "high_watermark": f"{_with(READINGS)} SELECT max(CAST(local_day AS DATE)) AS watermark FROM readings",
    "high_watermark_by_region": f"""{_with(WEATHER)}
SELECT region_code, CAST(max(date_heure) AS DATE) AS watermark FROM weather GROUP BY ALL""",
    "year_bounds": f"SELECT CAST(y AS INTEGER) AS year FROM ({YEARS})",
    "year_range": f"""SELECT CAST(y AS INTEGER) AS year, make_date(y, 1, 1) AS start_date,
       CASE WHEN y = 2001 THEN DATE '2001-07-14' ELSE make_date(y, 12, 31) END AS end_date
FROM ({YEARS})""",
    "year_slice": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE year(o_orderdate) = 1998 AND o_orderdate < '1998-09-02'""",
    "increment_slice": f"""{_with(READINGS)}
SELECT date_heure, local_day AS date, CAST(region_code AS VARCHAR) AS code_insee_region,
       'region ' || region_code AS libelle_region, nature, consommation
FROM readings
WHERE date_heure < '2024-01-29'
  AND date_heure >= (SELECT max(CAST(local_day AS DATE)) FROM readings WHERE local_day < '2024-01-21') - INTERVAL 1 DAY""",
    "increment_slice_by_region": f"""{_with(WEATHER)},
marks AS (
  SELECT region_code, max(CAST(date_heure AS DATE)) AS newest FROM weather
  WHERE date_heure < DATE '2024-01-10' + CAST(region_code // 10 AS INTEGER) GROUP BY ALL)
SELECT w.region_code, w.date_heure AS time, w.temperature_2m, w.precipitation
FROM weather w JOIN marks m USING (region_code)
WHERE CAST(w.date_heure AS DATE) >= m.newest AND w.date_heure < '2024-01-29'""",
    "weather_json_rows": f"""{_with(WEATHER, WEATHER_HOURS)}
SELECT region_code, date_heure AS time, temperature_2m, precipitation FROM weather_hours WHERE date_heure < '2024-01-28'""",
    "holiday_calendar": f"""WITH {ORDER_YEARS}, {HOLIDAYS}
SELECT h.region_code, h.date, h.jour_ferie, h.is_holiday, count(o.o_orderkey) AS nb_orders
FROM holidays h
LEFT JOIN orders o ON {_region("o.o_custkey")} = h.region_code AND CAST(o.o_orderdate AS DATE) = h.date
GROUP BY ALL""",
    "dim_date": f"""WITH days AS (
  SELECT CAST(DATE '{DIM_DATE_START}' + CAST(i AS INTEGER) AS DATE) AS date_key FROM range({DIM_DATE_ROWS}) t(i)),
counted AS (SELECT CAST(ts AS DATE) AS date_key, count(*) AS nb FROM events GROUP BY ALL)
SELECT date_key, CAST(year(date_key) AS INTEGER) AS annee, CAST(month(date_key) AS INTEGER) AS mois,
       CAST(day(date_key) AS INTEGER) AS jour, left(dayname(date_key), 3) AS jour_semaine, coalesce(nb, 0) AS nb
FROM days LEFT JOIN counted USING (date_key)""",
    "dim_region": f"""WITH regions AS (
  SELECT region_code, region_nom, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude
  FROM (VALUES {PLACES}) AS t(region_code, region_nom, lat, lon))
SELECT region_code, region_nom, latitude, longitude, count(c_custkey) AS nb_customers
FROM regions LEFT JOIN customer ON {_region("c_custkey")} = region_code
GROUP BY ALL""",
    "dq_duplicates": f"""{_with(INSTANTS)}
SELECT date_heure, region_code, count(*) AS nb FROM instants GROUP BY ALL HAVING count(*) > 1""",
    "dq_gaps": _gaps("events", "user_id", "ts"),
    "dq_freshness": """SELECT user_id, max(ts) AS derniere_donnee FROM events GROUP BY user_id
HAVING date_diff('hour', max(ts), TIMESTAMP '2024-01-31 00:00:00') > 24""",
    "dq_outliers": """SELECT event_id, ts, user_id, value FROM events
WHERE value IS NULL OR value < 0.1 OR value > 300""",
    "dq_keys": f"""{_with(INSTANTS)},
keyed AS (SELECT date_heure, CASE WHEN event_type <> 'error' THEN region_code END AS region_code FROM instants)
SELECT date_heure, region_code, count(*) AS nb,
       CASE WHEN region_code IS NULL THEN 'null' ELSE 'duplicate' END AS problem
FROM keyed GROUP BY date_heure, region_code HAVING region_code IS NULL OR count(*) > 1""",
    "dq_foreign_keys": """WITH named AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey FROM orders)
SELECT o_custkey, count(*) AS nb FROM named WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL""",
    "dq_summary": f"""{_with(INSTANTS)}
SELECT 'duplicates' AS "check", count(*) AS violations FROM (
  SELECT 1 FROM instants GROUP BY date_heure, region_code HAVING count(*) > 1)
UNION ALL SELECT 'gaps', count(*) FROM ({_gaps("instants", "region_code", "date_heure")})
UNION ALL SELECT 'freshness', count(*) FROM (
  SELECT 1 FROM instants GROUP BY region_code
  HAVING date_diff('hour', max(date_heure), TIMESTAMP '2024-02-02 00:00:00') > 48)
UNION ALL SELECT 'empty', CAST(count(*) = 0 AS BIGINT) FROM instants
UNION ALL SELECT 'outliers', count(*) FROM instants WHERE value IS NULL OR value < 0.1 OR value > 300""",
    "upsert_gold_stored": UPSERT_GOLD,
    "job_backfill_consumption": JOB_CONSUMPTION,
    "job_increment_consumption": JOB_CONSUMPTION,
    "job_backfill_weather": JOB_WEATHER,
    "job_increment_weather": JOB_WEATHER,
    "job_holidays": f"""WITH {STORED_YEARS}, {HOLIDAYS}
SELECT h.region_code, h.date, h.jour_ferie, h.is_holiday, count(o.o_orderkey) AS nb_orders
FROM holidays h
LEFT JOIN orders o ON {_region("o.o_custkey")} = h.region_code AND CAST(o.o_orderdate AS DATE) = h.date
GROUP BY ALL""",
    "holidays_in_order": f"""WITH {STORED_YEARS}, {HOLIDAYS},
placed AS (SELECT region_code, date, CAST(row_number() OVER (ORDER BY region_code, date) AS INTEGER) AS position FROM holidays)
SELECT p.region_code, p.date, p.position, count(o.o_orderkey) AS nb_orders
FROM placed p LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = p.date GROUP BY ALL""",
    "job_dimensions": f"""WITH regions AS (SELECT region_code, region_nom FROM (VALUES {PLACES}) AS t(region_code, region_nom, lat, lon))
SELECT region_nom, left(dayname(ts), 3) AS jour_semaine, CAST(year(ts) AS INTEGER) AS annee, CAST(month(ts) AS INTEGER) AS mois, count(*) AS nb
FROM events JOIN regions ON {_region("user_id")} = region_code
WHERE CAST(ts AS DATE) BETWEEN DATE '{DIM_DATE_START}' AND DATE '{DIM_DATE_START}' + {DIM_DATE_ROWS - 1}
GROUP BY ALL""",
    "dates_in_order": f"""WITH days AS (
  SELECT CAST(DATE '{DIM_DATE_START}' + CAST(i AS INTEGER) AS DATE) AS date_key, CAST(i + 1 AS INTEGER) AS position FROM range({DIM_DATE_ROWS}) t(i)),
counted AS (SELECT CAST(ts AS DATE) AS date_key, count(*) AS nb FROM events GROUP BY ALL)
SELECT date_key, position, coalesce(nb, 0) AS nb FROM days LEFT JOIN counted USING (date_key)""",
    "job_rebuild": JOB_FACT,
    "job_rolling_run": JOB_FACT,
    "job_merge_run": JOB_FACT,
    "weather_any_arrays": f"""{_with(WEATHER, WEATHER_HOURS)},
placed AS (
  SELECT *, CAST(hour(date_heure) AS DOUBLE) AS wind,
         row_number() OVER (PARTITION BY region_code, CAST(date_heure AS DATE) ORDER BY date_heure DESC) AS from_last
  FROM weather_hours),
hours AS (SELECT * FROM placed WHERE from_last > 1)
SELECT region_code, date_heure AS time, 'temperature_2m' AS measure, temperature_2m AS number FROM hours
UNION ALL SELECT region_code, date_heure, 'precipitation', precipitation FROM hours
UNION ALL SELECT region_code, date_heure, 'wind', wind FROM hours
UNION ALL SELECT region_code, date_heure, 'gusts', wind FROM hours""",
    "silver_join_bucketed": f"{PLAIN_SILVER} SELECT * FROM silver",
    "region_day_lookup": f"""{_with(READINGS)}
SELECT date_heure, CAST(local_day AS DATE) AS date, CAST(region_code AS VARCHAR) AS code_insee_region,
       'region ' || region_code AS libelle_region, nature, consommation, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month,
       CAST(17 AS INTEGER) AS day
FROM readings WHERE local_day = '2024-01-17' AND region_code = 44""",
    "gap_bitmaps": f"""WITH rows AS (
  SELECT {_region("user_id")} AS region_code, event_type, date_trunc('hour', ts) AS date_heure FROM events),
hours AS (SELECT DISTINCT * FROM rows),
steps AS (
  SELECT *, date_diff('hour', lag(date_heure) OVER (PARTITION BY region_code, event_type ORDER BY date_heure), date_heure) AS ecart_h FROM hours)
SELECT region_code, event_type, date_heure, ecart_h, 'gap' AS kind FROM steps WHERE ecart_h > 2
UNION ALL
SELECT region_code, event_type, NULL, count(*) - count(DISTINCT date_heure), 'repeats' FROM rows
GROUP BY region_code, event_type HAVING count(*) > count(DISTINCT date_heure)""",
    "gate_from_summaries": f"""{PLAIN_SILVER}
SELECT 'duplicates' AS "check", count(*) AS violations FROM (SELECT 1 FROM silver GROUP BY date_heure, region_code HAVING count(*) > 1)
UNION ALL SELECT 'gaps', count(*) FROM ({_gaps("silver", "region_code", "date_heure")})
UNION ALL SELECT 'freshness', count(*) FROM (
  SELECT 1 FROM silver GROUP BY region_code HAVING date_diff('hour', max(date_heure), TIMESTAMP '2024-02-02 00:00:00') > 48)
UNION ALL SELECT 'empty', CAST(count(*) = 0 AS BIGINT) FROM silver""",
    "observed_counts": f"""{PLAIN_SILVER}
SELECT count(*) AS nb, CAST(0 AS BIGINT) AS null_keys,
       count(*) FILTER (consommation IS NULL OR consommation < 500000 OR consommation > 2000000) AS outliers FROM silver""",
    "exact_hourly_mean": f"""WITH readings AS (
  SELECT {HALF_HOUR} AS date_heure, {_region("user_id")} AS region_code, value / 7 AS consommation FROM events),
instants AS (SELECT region_code, date_heure, {_exact("consommation")} AS consommation FROM readings GROUP BY ALL)
SELECT region_code, date_trunc('hour', date_heure) AS date_heure, {_exact("consommation")} AS consommation FROM instants GROUP BY 1, 2""",
    "increment_by_ledger": JOB_CONSUMPTION,
    "propagate_late_rows": JOB_FACT,
}
