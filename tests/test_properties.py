"""Operators against plain Python on random small inputs."""

from datetime import timedelta

from conftest import rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattloom.operators import quality, tables
from wattloom.operators.series import series_gaps

START = ts("2024-01-01 00:00")
SCHEMA = "date_heure timestamp_ntz, region_code int, consommation double, year int"
KEYS = ["date_heure", "region_code"]
random_inputs = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
values = st.one_of(st.none(), st.integers(0, 9).map(float))
readings = st.lists(st.tuples(st.integers(0, 12), st.sampled_from([11, 44]), values), max_size=25)
keyed = st.dictionaries(st.tuples(st.integers(0, 12), st.sampled_from([11, 44])), values, max_size=15)


def frame(spark, data, year):
    return spark.createDataFrame([(START + timedelta(hours=h), r, v, year) for h, r, v in data], SCHEMA)


def table(spark, mapping, year):
    return frame(spark, [(h, r, v) for (h, r), v in mapping.items()], year)


@random_inputs
@given(keyed, keyed)
def test_merged(spark, target, source):
    merged = tables.merged(table(spark, target, 1), table(spark, source, 2), KEYS, ["consommation"])
    expected = {**target, **source}
    found = {(r[0], r[1]): (r[2], r[3]) for r in merged.collect()}
    assert merged.count() == len(expected)
    assert found == {
        (START + timedelta(hours=h), r): (v, 1 if (h, r) in target else 2) for (h, r), v in expected.items()
    }
    again = tables.merged(merged, table(spark, source, 2), KEYS, ["consommation"])
    assert rows(again) == rows(merged)


@random_inputs
@given(readings, readings)
def test_keys_replaced(spark, target, source):
    delivered = {(h, r) for h, r, _ in source}
    expected = frame(spark, [row for row in target if row[:2] not in delivered] + source, 1)
    assert rows(tables.keys_replaced(frame(spark, target, 1), frame(spark, source, 1), KEYS)) == rows(expected)


half_hours = st.lists(st.tuples(st.integers(0, 400), st.sampled_from([11, 44]), values), max_size=40)


@random_inputs
@given(half_hours, st.integers(1, 6))
def test_gaps_and_summary(spark, points, most):
    data = [(h / 2, r, v) for h, r, v in points]
    df = frame(spark, data, 1)
    gaps, stale = [], 0
    for region in (11, 44):
        times = sorted(START + timedelta(hours=h) for h, r, _ in data if r == region)
        for earlier, later in zip(times, times[1:]):
            crossed = (later.replace(minute=0) - earlier.replace(minute=0)) // timedelta(hours=1)
            if crossed > most:
                gaps.append((region, later, crossed))
        stale += bool(times) and ts("2024-01-09 00:00") - times[-1].replace(minute=0) > timedelta(hours=48)
    assert rows(series_gaps(df, ["region_code"], max_hours=most)) == sorted(gaps, key=repr)
    counts = {}
    for h, r, _ in points:
        counts[h, r] = counts.get((h, r), 0) + 1
    summary = quality.series_summary(
        df, ["region_code"], as_of="2024-01-09 00:00:00", value="consommation", max_gap=most, low=1, high=8
    )
    assert dict(rows(summary)) == {
        "duplicates": sum(n > 1 for n in counts.values()),
        "gaps": len(gaps),
        "freshness": stale,
        "empty": int(not points),
        "outliers": sum(v is None or v < 1 or v > 8 for _, _, v in points),
    }
