"""Every registered query with an oracle agrees with DuckDB at sf0.001; the rest run."""

import duckdb
import pytest

import __spark_entry__ as E
from astroframe.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import digest, type_diffs

SQLS = E.oracle_sql()
QUERIES = E.queries()
#: chains of other checked queries, and 200 rounds of boosting: run by tools/oracle_check.py, tests/test_runs.py and tests/test_boosting.py
CHAINS = {"run_all", "run_classification", "boosted_classify"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_contract_keys():
    assert set(SQLS) <= set(QUERIES)
    assert len(QUERIES) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["object_type", "count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(set(SQLS) - CHAINS))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    res = con.execute(SQLS[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in dcols)
    assert len(srows) == len(drows)
    assert type_diffs(sdf.dtypes, dcols, con.sql(SQLS[name]).types) == []
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_of_the_catalogue_has_an_oracle():
    """Only corpus operators (a subpackage of its own, tested there) may lack one."""
    assert all(n == "pipeline" or n.startswith("op") for n in set(QUERIES) - set(SQLS))
