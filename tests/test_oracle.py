"""Every registered query against its DuckDB oracle (or rows-only when it has none)."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.harness import compare, duck

QUERIES = queries()
ORACLES = oracle_sql()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        ok, msg = compare(df, con, ORACLES[name])
        assert ok, msg
    else:
        assert df.count() > 0


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["rxnorm_id", "snomed_code", "n_events", "n_high_bp", "n_masked"]
