import importlib


def test_entry_and_oracles(spark, data):
    e = importlib.import_module("__spark_entry__")
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert e.entry(spark).count() > 0
    for name in ("affects_edges", "canonical_claims", "p2_found", "p5_report"):
        assert q[name](spark, data).count() > 0
