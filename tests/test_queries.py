"""Every registered query against its SQL on DuckDB."""

import pytest

from tapelake.plans import all_queries, all_sql
from tests.conftest import SMALL
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(all_sql()) == set(all_queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_rows(spark, con, name):
    result = compare(spark, con, SMALL, name)
    assert result.startswith(("ok", "rows")), result


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert "vwap" in df.columns
