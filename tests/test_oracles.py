"""Every registered query against its oracle, on whole tables."""

import re

import pytest

from tests.compare import duck, entry_module, run


def no_unpartitioned_window_or_cross_join(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line):
            # The partition list is the second bracket of the operator.
            assert not re.search(r"\], \[\](,|$)", line), line


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, con, sf, name):
    ok, text = run(spark, con, name, sf, no_unpartitioned_window_or_cross_join)
    assert ok is not False, text


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "endpoint" in df.columns
