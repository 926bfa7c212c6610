"""Every registered query against its SQL counterpart, over whole tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle import compare

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", [name for name in QUERIES if name in SQL])
def test_same_rows_as_sql(spark, name):
    rows, problems = compare(spark, SF_DIR, QUERIES[name], SQL[name])
    assert not problems, "\n".join(problems)
    assert rows > 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_the_price_model_has_sql():
    """The training-data operators, which may be absent, have brute-force tests instead."""
    from tillmark.registered.queries import QUERIES as OWN

    assert set(OWN) <= set(SQL) <= set(QUERIES)
    assert all(name.startswith("op") or name == "pipeline" for name in set(QUERIES) - set(SQL))
