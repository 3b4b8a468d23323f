import compare
import pytest

from tenurelake.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = compare.database(SF)
    for t in ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, db, name):
    got = compare.spark_rows(catalog.QUERIES[name](spark, SF))
    assert compare.difference(got, compare.oracle_rows(db, catalog.ORACLES[name])) is None


def test_all_operators_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
