"""Every registered query runs; those with SQL give the same rows as the SQL."""

import pytest

import __spark_entry__ as spark_entry
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, con, sf_dir, name):
    verdict, _ = check.compare(spark, con, name, sf_dir)
    assert verdict in ("exact", "rows")


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 5
