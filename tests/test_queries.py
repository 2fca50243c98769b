"""Every registered query against its SQL counterpart."""

import pytest
from compare import database, difference

import __spark_entry__ as entry
from skyframes.catalog.queries import QUERIES

TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, sf_dir, con, name):
    sql = entry.oracle_sql()[name]
    df = entry.queries()[name](spark, sf_dir)
    want = {row[0]: TYPES.get(row[1], row[1]) for row in con.execute(f"describe {sql}").fetchall()}
    assert dict(df.dtypes) == want
    assert difference(df, sql, con) is None
