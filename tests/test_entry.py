"""Driver contract and oracle parity on the smallest scale factor."""
import __spark_entry__ as E
from plenum.plans.parity import compare

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year", "region", "nation", "urgent_qty", "high_qty", "max_order_qty", "other_qty"] or \
        set(df.columns) == {"year", "region", "nation", "urgent_qty", "high_qty", "other_qty", "max_order_qty"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def test_all_queries_match_oracle(spark):
    failures = [(n, d) for n, s, d in compare(spark, SF_SMALL, E.queries(), E.oracle_sql()) if s == "FAIL"]
    assert failures == []
