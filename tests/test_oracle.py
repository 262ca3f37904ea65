"""Every catalog query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from conftest import SF001, SF01
from oracle import compare
from strata.plans.catalog import oracle_sql, queries

Q = queries()
SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck01, name):
    r = compare(Q[name](spark, SF01), duck01, SQL[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(set(Q) - set(SQL)))
def test_rows_only(spark, name):
    assert Q[name](spark, SF01).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["word", "frequency"]


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(Q) - set(SQL)
    assert not missing, missing


def test_smoke_scale_runs(spark):
    """All queries also run on the smallest scale (no data-size assumptions)."""
    for name in ("velocity", "near_events_1h", "longest_run", "topic_frequency"):
        assert Q[name](spark, SF001).count() >= 0
