"""Every registered query against its DuckDB oracle on sf0.001 (the driver
checks the same at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_sql_or_is_learning():
    missing = {k for k in KEYS if k.startswith("q")} - set(SQL)
    assert missing == {"q41_als_recommend", "q45_elastic_net"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["item_id", "name", "n"]
    assert 0 < len(rows) <= 10


@pytest.mark.parametrize("key", [k for k in KEYS if k in SQL])
def test_matches_oracle(spark, con, key):
    info = compare(spark, con, SF_SMALL, key, E.queries()[key], SQL[key])
    assert info["ok"], info
