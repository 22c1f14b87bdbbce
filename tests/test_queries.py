"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL


def test_all_queries_match_oracle(spark):
    import oracle_check

    from rivulet.plans import registry

    res = oracle_check.check(spark, SF_SMALL, list(registry.queries()), verbose=False, strict_types=True)
    bad = {k: v for k, v in res.items() if v not in ("ok", "rows")}
    assert not bad, bad
    assert len(res) >= 90


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
