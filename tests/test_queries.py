import pytest

import __spark_entry__ as spark_entry
from wattloom_checks.compare import connect, same
from wattloom_checks.oracle import ORACLE
from wattloom_checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= spark_entry.queries().keys() and ORACLE.keys() <= spark_entry.oracle_sql().keys()


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, connection, name):
    equal, detail = same(spark_entry.queries()[name](spark, SF_DIR), connection.sql(spark_entry.oracle_sql()[name]))
    assert equal, detail


@pytest.mark.parametrize("name", ["gold_fact", "weather_json_rows", "dq_gaps", "time_bucket_day"])
def test_queries_in_a_session_of_another_zone(spark, connection, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    other.conf.set("spark.sql.ansi.enabled", "false")
    equal, detail = same(spark_entry.queries()[name](other, SF_DIR), connection.sql(spark_entry.oracle_sql()[name]))
    assert equal, detail
