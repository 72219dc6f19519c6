from pyspark.sql import functions as F

from quillstone.operators.dictionary import find_entries, subject_of
from quillstone.plans import evidence as E

ENTRIES = [("urea", "Urea"), ("zinc", "Zinc"), ("zinc pca", "Zinc PCA"), ("pca salt", "PCA"), ("hollow®", "Hollow"), ("β-glucan", "Beta"), ("urea", "A"), (" ", "none"), (None, "none")]
TEXTS = {"Zinc PCA salt and urea.": ["Zinc PCA", "Urea"], "ureas and zincs": [], "Hollow® β-GLUCAN": ["Hollow", "Beta"], "zinc\nurea\nzinc": ["Zinc", "Urea", "Zinc"], "과연 zinc이": [], "": [], None: []}


def test_both_ways_find_the_same(spark):
    rows = spark.createDataFrame([(t, 1, "x") for t in TEXTS], "t string, found int, _low string")
    entries = spark.createDataFrame(ENTRIES, "alias string, name string")
    for ways in ({}, {"pattern_entries": 0}, {"pattern_entries": 0, "automaton_entries": 2}):
        got = find_entries(rows, "t", entries, **ways)
        assert got.columns == ["t", "found"] and {r.t: [x.name for x in r.found] for r in got.collect()} == TEXTS
        assert find_entries(rows, "t", entries.limit(0), **ways).where(F.size("found") > 0).count() == 0
    assert find_entries(rows.limit(0), "t", entries, pattern_entries=0).count() == 0


def test_both_ways_agree_on_the_data(spark, data):
    s = E._claim_sentences(spark, data).select("claim_key", "source_sentence")
    entries = E._ingredients(spark, data)
    by = [sorted((r.claim_key, r.source_sentence, tuple(x.alias for x in r.found)) for r in find_entries(s, "source_sentence", entries, **w).collect()) for w in ({}, {"pattern_entries": 0, "automaton_entries": 50})]
    assert by[0] == by[1] and any(f for _, _, f in by[0])


def test_subject(spark):
    rows = spark.createDataFrame([("Results: topical urea with zinc pca",), ("The zinc pca and urea",), ("RESULTS: Zinc fell",), ("none",), (None,)], "t string")
    found = find_entries(rows, "t", spark.createDataFrame(ENTRIES, "alias string, name string"))
    assert [r.s for r in found.select(subject_of(F.col("t"), F.col("found")).alias("s")).collect()] == ["Urea", "Zinc PCA", "Zinc", None, None]
