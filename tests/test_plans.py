"""Physical plans: shuffles, pushed filters and columns read."""

import pytest
from conftest import plan_of, ts

from wattloom.operators.tables import overwrite_table
from wattloom.plans.bronze import bronze_consumption, bronze_weather
from wattloom.plans.gold import build_fact
from wattloom.plans.silver import build_silver
from wattloom.schemas import BRONZE_CONSUMPTION, BRONZE_WEATHER, HOLIDAYS, SILVER
from wattloom.sources.calendars import holiday_calendar
from wattloom.sources.tables import read_table


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    raw = spark.createDataFrame(
        [(ts("2024-01-01 00:00"), "2024-01-01", "11", "r", "n", 1.0)],
        "date_heure timestamp_ntz, date string, code_insee_region string, libelle_region string, nature string, consommation double",
    )
    weather = spark.createDataFrame(
        [(11, ts("2024-01-01 00:00"), 1.0, 0.0)],
        "region_code int, time timestamp_ntz, temperature_2m double, precipitation double",
    )
    overwrite_table(bronze_consumption(raw), BRONZE_CONSUMPTION, f"{root}/c")
    overwrite_table(bronze_weather(weather), BRONZE_WEATHER, f"{root}/w")
    overwrite_table(holiday_calendar(spark, 2024, 2024), HOLIDAYS, f"{root}/h")
    c, w, h = (read_table(spark, d, f"{root}/{n}") for d, n in [(BRONZE_CONSUMPTION, "c"), (BRONZE_WEATHER, "w"), (HOLIDAYS, "h")])
    overwrite_table(build_silver(c, w, h), SILVER, f"{root}/s")
    return c, w, h, read_table(spark, SILVER, f"{root}/s")


def test_silver_join_adds_no_shuffle(spark, layers):
    c, w, _, _ = layers
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(build_silver(c, w))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # instants, hours, weather; each behind a partial aggregate
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("partial_avg") >= 3
    assert "SortMergeJoin" in plan


def test_small_holiday_table_is_broadcast_by_its_size(layers):
    c, w, h, _ = layers
    assert "BroadcastHashJoin" in plan_of(build_silver(c, w, h))


def test_silver_reads_only_its_columns(layers):
    c, w, h, _ = layers
    plan = plan_of(build_silver(c, w, h, since="2024-01-01"))
    assert "libelle_region" not in plan and "nature" not in plan and "jour_ferie" not in plan
    assert "GreaterThanOrEqual(date_heure,2024-01-01T00:00)" in plan
    assert "GreaterThanOrEqual(time,2024-01-01T00:00)" in plan
    assert plan.count("PartitionFilters: []") <= 1


def test_gold_is_one_shuffle_and_reads_a_week_more(layers):
    silver = layers[3]
    plan = plan_of(build_fact(silver, since="2024-01-20"))
    assert plan.count("Exchange") == 1
    assert "GreaterThanOrEqual(date_heure,2024-01-13T00:00)" in plan
    assert "(year" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_no_python_runs_in_tasks(layers):
    c, w, h, silver = layers
    for frame in (build_silver(c, w, h), build_fact(silver)):
        assert "Python" not in plan_of(frame) and "Pandas" not in plan_of(frame)
