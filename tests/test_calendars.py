from datetime import timedelta

from conftest import day, rows
from pyspark.sql import functions as F

from wattloom.functions.holidays import with_easter
from wattloom.sources.calendars import dim_date, dim_region, holiday_calendar, holidays_of

# Published Easter Sundays.
EASTER = {
    1997: "1997-03-30", 2000: "2000-04-23", 2013: "2013-03-31", 2014: "2014-04-20", 2015: "2015-04-05",
    2016: "2016-03-27", 2017: "2017-04-16", 2018: "2018-04-01", 2019: "2019-04-21", 2020: "2020-04-12",
    2021: "2021-04-04", 2022: "2022-04-17", 2023: "2023-04-09", 2024: "2024-03-31", 2025: "2025-04-20",
    2026: "2026-04-05", 2027: "2027-03-28", 2028: "2028-04-16", 2029: "2029-04-01", 2030: "2030-04-21",
}


def test_easter(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "year int")
    found = {r["year"]: r["easter"].isoformat() for r in with_easter(years).collect()}
    assert found == EASTER


def test_calendar_size_and_order(spark):
    calendar = holiday_calendar(spark)
    collected = [tuple(r) for r in calendar.select("region_code", "date").collect()]
    assert len(collected) == 18 * (11 * 11 + 13) == 2412
    assert collected == sorted(set(collected))
    assert calendar.filter("is_holiday <> 1").count() == 0


def test_local_days_only_in_region_44(spark):
    calendar = holiday_calendar(spark, 2024, 2024)
    good_friday = day(EASTER[2024]) - timedelta(days=2)
    assert rows(calendar.filter(F.col("date") == good_friday), "region_code") == [(44,)]
    assert rows(calendar.filter("date = '2024-12-26'"), "region_code") == [(44,)]
    assert calendar.filter("region_code = 44").count() == 13
    assert calendar.filter("region_code = 11").count() == 11


def test_two_holidays_on_one_day_are_one_row(spark):
    calendar = holiday_calendar(spark, 1995, 2001)
    assert calendar.count() == 926
    shared = rows(calendar.filter("date = '1997-05-08' and region_code = 11"), "jour_ferie")
    assert shared == [("Ascension, Victoire 1945",)]


def test_holidays_of_given_regions(spark):
    years = spark.createDataFrame([(2023,)], "year int")
    regions = spark.createDataFrame([(44,), (11,)], "region_code int")
    assert holidays_of(years, regions).count() == 24


def test_dim_date(spark):
    dates = dim_date(spark)
    assert dates.count() == dates.distinct().count() == 7000
    assert rows(dates.agg(F.min("date_key"), F.max("date_key"))) == [(day("2013-01-01"), day("2032-03-01"))]
    assert rows(dates.filter("date_key = '2024-02-29'")) == [(day("2024-02-29"), 2024, 2, 29, "Thu")]
    assert rows(dates.filter("date_key = '2013-01-01'"), "jour_semaine") == [("Tue",)]


def test_dim_region(spark):
    regions = dim_region(spark)
    assert [r[0] for r in rows(regions, "region_code")] == [11, 24, 27, 28, 32, 44, 52, 53, 75, 76, 84, 93]
    assert rows(regions.filter("region_code = 44")) == [(44, "Grand Est", 48.5734, 7.7521)]
