"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from checks import REGISTRY
from tests.compare import assert_same, duckdb_over

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", REGISTRY)
def test_query_matches_sql(spark, connection, name):
    assert_same(driver.queries()[name](spark, SF_DIR), connection, driver.oracle_sql()[name])


def test_entry_gives_ten_rows_per_season(spark):
    result = driver.entry(spark)
    assert result.columns == ["entity_id", "entity", "team", "season", "value", "rank"]
    assert {row["count"] for row in result.groupBy("season").count().collect()} == {10}
