"""Every registered query against its SQL, row by row."""

import compare
import pytest

from tenurelake.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.database(sf_dir)


ESTIMATES = {"salary_box_sketch"}  # see test_rollups.py


def test_every_query_has_an_oracle():
    assert set(QUERIES) - ESTIMATES == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, db, name):
    got = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert compare.difference(got, compare.oracle_rows(db, ORACLES[name])) is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
