"""Every registered query equals its DuckDB oracle (names, rows, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from fleetlens.plans.catalog import QUERIES
from helpers import canon, spark_rows

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    con = duck(SF_SMALL)
    cols, rows = spark_rows(entry.queries()[name](spark, SF_SMALL))
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    assert canon(cols, rows) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["app_id", "name", "requested", "completed", "failed",
                          "final_status", "progress"]
    assert df.count() > 0
