"""Every query of the catalogue against its reference SQL on the smallest given tables."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as contract
from catalog import all_queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())
QUERIES = {name: contract.queries()[name] for name in NAMES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def results(spark):
    """All comparisons, several queries at a time."""
    con = connect(SF)
    pool = ThreadPoolExecutor(8)

    def run(name):
        df = QUERIES[name](spark, SF)
        result = compare(df, con.cursor(), SQL[name])
        result["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return result

    yield {name: pool.submit(run, name) for name in sorted(QUERIES)}
    pool.shutdown(cancel_futures=True)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_reference(results, name):
    result = results[name].result()
    assert result["columns"]
    assert not result["extra"] and not result["lost"], result["rows"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(results, name):
    plan = results[name].result()["plan"]
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
