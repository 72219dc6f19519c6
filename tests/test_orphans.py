import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from quillstone.operators.orphans import Reference, bloom_blocks, find_orphans, orphan_report, tidy_key

REF = Reference("maps", "parent", "key")
CHILD = "claim_key string, parent string, created_at timestamp, is_active string, reason int, _key int"
PARENT = "key string, created_at timestamp, is_active boolean, claim_key int, ref_value int"
T = [dt.datetime(2024, m, 1) for m in range(1, 13)]


def run(spark, child, parent, **kw):
    a = spark.createDataFrame([(*c, None, None, None) for c in child], CHILD)
    b = spark.createDataFrame([(*p, None, None) for p in parent], PARENT)
    return sorted((r.claim_key, r.ref_value, r.period_month, r.reason) for r in find_orphans(a, b, REF, **kw).collect())


def test_reasons(spark):
    child = [("A ", " k1", T[2]), ("b", "K2", T[2]), ("c", "k3", T[2]), ("d", "zz", T[2]), ("e", None, T[2]), (None, "zz", T[2]), ("f", " ", T[2]), ("d", "zz", T[2])]
    parent = [("k1", T[0], True), ("k2", T[0], True), ("k2", T[1], False), ("k3", T[5], True), (None, T[0], True)]
    assert run(spark, child, parent) == [("b", "k2", "2024-03", "deleted"), ("c", "k3", "2024-03", "late"), ("d", "zz", "2024-03", "missing")]


def test_late_shows_once_a_month_and_ties(spark):
    child = [("a", "k", T[0]), ("a", "k", T[8]), ("a", "k", dt.datetime(2024, 1, 20))]
    assert run(spark, child, [("k", dt.datetime(2024, 1, 10), True), ("k", dt.datetime(2024, 1, 10), False)]) == [("a", "k", "2024-01", "late")]


def test_nulls_and_empty_tables(spark):
    assert run(spark, [], [("k", T[0], True)]) == []
    assert run(spark, [("a", "k", None)], []) == [("a", "k", None, "missing")]
    assert run(spark, [("a", "k", T[0])], [("k", None, None)]) == []
    assert run(spark, [("a", "k", None)], [("k", T[0], True)]) == []


def test_hot_key_and_saturated_filter_agree(spark):
    child = [("hot", "k1", T[i % 12]) for i in range(3000)] + [(f"c{i}", f"k{i}", T[3]) for i in range(900)]
    parent = [(f"k{i}", T[4], i % 3 > 0) for i in range(0, 900, 2)]
    exact = run(spark, child, parent, max_blocks=1)  # no filter
    assert exact == run(spark, child, parent) == run(spark, child, parent, bits_per_key=8)
    want = set()
    known = {p[0]: p for p in parent}
    for c, k, t in child:
        p = known.get(k)
        reason = "missing" if p is None else "deleted" if not p[2] else "late" if p[1] > t else None
        if reason:
            want.add((c, k, t.strftime("%Y-%m"), reason))
    assert set(exact) == want


def test_filter_holds_every_key(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(2000)], "key string")
    blocks, n = bloom_blocks(keys, "key", 2000)
    assert blocks.count() <= n and n & (n - 1) == 0


def test_report_counts(spark):
    rows = spark.createDataFrame([("m", "f", "c1", "x", "2024-01", "missing"), ("m", "f", "c2", "x", "2024-01", "missing")], "map_table string, field_name string, claim_key string, ref_value string, period_month string, reason string")
    assert [tuple(r) for r in orphan_report(rows).collect()] == [("m", "f", "2024-01", "missing", 2)]


def test_tidy_key(spark):
    got = spark.createDataFrame([("  Ab\t",), (None,)], "k string").select(tidy_key(F.col("k")).alias("k")).collect()
    assert Counter(r.k for r in got) == Counter(["ab", None])


def test_filter_beyond_a_broadcast_and_hot_orphan(spark):
    """A filter of more than 2^20 words that is shuffled, and a missing key that most rows name."""
    n = 3_600_000
    parent = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(T[0]).alias("created_at"), F.lit(True).alias("is_active"))
    hot = spark.range(20_000).select(F.concat(F.lit("c"), "id").alias("claim_key"), F.lit("gone").alias("parent"), F.lit(T[1]).alias("created_at"))
    cold = spark.range(6_000).select(F.concat(F.lit("d"), "id").alias("claim_key"), F.concat(F.lit("k"), F.col("id") + n - 3_000).alias("parent"), F.lit(T[2]).alias("created_at"))
    got = find_orphans(hot.unionByName(cold), parent, REF, max_blocks=1 << 20, broadcast_rows=10)
    _, words = bloom_blocks(parent.limit(0), "key", n)
    assert words > 1 << 20
    counts = {(r.period_month, r.reason): r.n_references for r in orphan_report(got).collect()}
    assert counts == {("2024-02", "missing"): 20_000, ("2024-03", "missing"): 3_000}


def test_both_ways_back_to_the_rows_agree(spark):
    child = [("h%d" % i, "gone" if i % 2 else "k1", T[i % 12]) for i in range(4000)] + [(f"c{i}", f"k{i}", T[3]) for i in range(300)]
    parent = [(f"k{i}", T[4], i % 3 > 0) for i in range(0, 300, 2)] + [("k1", T[6], True)]
    assert run(spark, child, parent, broadcast_rows=0, max_blocks=1) == run(spark, child, parent)
