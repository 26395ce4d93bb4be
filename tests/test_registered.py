"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import checks
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(checks.QUERIES))
def test_query(spark, con, sf_dir, name):
    result, _ = compare(spark, con, name, sf_dir)
    assert result.startswith(("ok", "rows only")), result


def test_every_sql_has_a_query():
    assert set(checks.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(entry.oracle_sql().values())


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row["count"] > 0 and row["min"] <= row["median"] <= row["max"]
