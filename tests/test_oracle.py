"""Every registered query equals its DuckDB SQL on the sf0.01 tables."""

import pytest

from compare import assert_same, duck
from conftest import SF_CHECK

import __spark_entry__ as entry_mod

NAMES = sorted(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_CHECK)
    assert_same(df, con, entry_mod.oracle_sql()[name])


def test_every_query_has_oracle_or_is_listed():
    missing = set(entry_mod.queries()) - set(entry_mod.oracle_sql())
    assert missing <= set(getattr(entry_mod, "NO_SQL_ORACLE", ())), missing


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "odl_id" in df.columns
