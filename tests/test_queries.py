from __future__ import annotations

import pytest

from factloom.plans import registry
from tests.compare import same

NAMES = sorted(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, name):
    df = registry.queries()[name](spark, data)
    sql = registry.oracle_sql().get(name)
    if sql:
        same(df, sql, data)
    else:
        assert df.count() > 0
        assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
