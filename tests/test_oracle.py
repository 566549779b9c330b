"""Every registered query against its SQL on the same tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as con:
        yield con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], duck) is None


def test_only_the_size_report_lacks_sql():
    own = {name for name in set(QUERIES) - set(SQL) if not (name.startswith("op") and name[2].isdigit()) and name != "pipeline"}
    assert own == {"table_size"}
    assert set(SQL) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
