"""Every registered key against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from oracle_harness import compare

KEYS = list(E._QUERIES)  # the training-data queries have tests of their own


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, key):
    r = compare(spark, key, E.queries()[key], E.oracle_sql()[key], SF_MID)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["origin_country", "n_flights"]
    assert len(rows) >= 0
    # sf0.001 oracle agrees too
    r = compare(spark, "top_countries", E.queries()["top_countries"], E.oracle_sql()["top_countries"], SF_SMALL)
    assert r["ok"], r
