"""Every registered query against its SQL check, or for rows where there is none."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect

from conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    result = compare(spark, duck, SF_DIR, name)
    assert result.startswith("ok"), result


def test_entry_returns_conditions(spark):
    rows = entry(spark).collect()
    assert rows and sum(row.day_count for row in rows) == 30


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
