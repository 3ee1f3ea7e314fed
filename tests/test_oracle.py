"""Driver contract: every registered query against its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 6
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle(spark):
    from oracle_check import compare

    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v.get("values_match") is False or v.get("cols_match") is False}
    assert not bad, bad
    # rows-only queries (no SQL) must at least produce rows
    assert all(v["spark_rows"] > 0 for v in res.values() if "oracle_rows" not in v)
