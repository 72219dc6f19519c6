import json
import math

import pytest
from pyspark.sql import functions as F

from quillstone.operators import aggregate as A
from quillstone.operators import graph as G
from quillstone.operators import labels as B
from quillstone.operators import quality as Q
from quillstone.operators import upsert as U
from quillstone.operators.extract import claims_of, extract_cached


def test_first_and_last_win(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), (None, 1, "n"), (None, 2, "m")], "k string, o int, v string")
    assert sorted((r.k or "", r.v) for r in A.first_wins(rows, ["k"], ["o"]).collect()) == [("", "n"), ("a", None)]
    assert sorted((r.k or "", r.v) for r in A.last_wins(rows, ["k"], ["o"]).collect()) == [("", "m"), ("a", "x")]


def test_paper_support(spark):
    rows = spark.createDataFrame([("e", "1", 1.0), ("e", "1", 0.5), ("e", "2", 0.28), ("e", "3", float("nan")), ("e", "4", None)], "edge string, pmid string, w double")
    r = A.paper_support(rows, ["edge"], "pmid", "w").head()
    assert r.graph_score == round(math.log(2.28), 6) and r.paper_count == 4


def test_canonical(spark):
    rows = spark.createDataFrame(
        [("k", "1", 1.0, "strict_graph", "x", None, 1, "first"), ("k", "2", 0.28, "recommendation_only", "y", "animal", 2, "second"), ("k", "1", 0.1, "strict_graph", "z", "", 3, "third")],
        "key string, pmid string, w double, tier string, label string, ctx string, o int, name string",
    )
    r = A.canonical(rows, "key", "pmid", "w", "tier", {"evidence_only": 0, "recommendation_only": 1, "soft_graph": 2, "strict_graph": 3}, ("strict_graph", "soft_graph"), ("strict_graph", "soft_graph", "recommendation_only"), "label", "ctx", ["o"], ["name"]).head()
    assert (r.graph_score, r.recommendation_score_base, r.paper_count_distinct, r.evidence_count_raw) == (0.693147, 0.824175, 2, 3)
    assert (r.top_eligibility_tier, r.top_attribution_label, r.name, r.study_count_distinct) == ("strict_graph", "x", "first", 2)


def test_function_edges(spark):
    owners = spark.createDataFrame([("o", ["HUMECTANT", "TONIC", "HUMECTANT"])], "owner string, f array<string>")
    mapping = spark.createDataFrame([("HUMECTANT", ["HYDRATING", "MOISTURE"], "improves", 0.1)], "function string, effects array<string>, relation string, confidence double")
    assert sorted((r.effect, r.score) for r in A.function_edges(owners, "owner", "f", mapping).collect()) == [("HYDRATING", 0.1), ("MOISTURE", 0.06)]
    seen = spark.createDataFrame([("o", "HYDRATING", "improves")], "owner string, effect string, relation string")
    assert A.function_edges(owners, "owner", "f", mapping, seen).count() == 1


def test_graph(spark):
    nodes = spark.createDataFrame([("a",), ("a",), (" ",), (None,), ("b",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("zz", "b"), (None, "b")], "s string, e string")
    got = {r.problem: r.n for r in G.integrity(nodes, "id", edges, ["s", "e"]).collect()}
    assert got == {"blank_node": 2, "repeated_node": 1, "dangling_s": 2, "dangling_e": 0}
    new = spark.createDataFrame([("a", "b", "t")], "s string, e string, t string")
    old = spark.createDataFrame([("a", "b", "t"), ("a", "b", "u"), ("gone", "b", "u")], "s string, e string, t string")
    kept = G.retain(old, new, ["s", "e", "t"], nodes, "s", nodes, "e")
    assert sorted(r.t for r in kept.collect()) == ["t", "u"]
    assert [r.v for r in G.union_first([spark.createDataFrame([("a", 1)], "id string, v int"), spark.createDataFrame([("a", 2)], "id string, v int")], "id").collect()] == [1]


def test_upsert(spark):
    table = spark.createDataFrame([("1", "old", "d1", 5), (None, "n", None, 1)], "id string, title string, doi string, keep int")
    incoming = spark.createDataFrame([("1", "mid", "d2", 1), ("1", None, None, 2), ("2", "new", None, 1), (None, "m", None, 1)], "id string, title string, doi string, o int")
    got = sorted(((r.id or "", r.title, r.doi, r.keep) for r in U.upsert(table, incoming, "id", ["o"], ["title"], ["doi"]).collect()), key=str)
    assert got == sorted([("", "m", None, None), ("", "n", None, 1), ("1", None, "d2", 5), ("2", "new", None, None)], key=str)
    new = U.insert_new(table, incoming, ["id"], ["o"])
    assert sorted((r.id or "") for r in new.collect()) == ["", "2"]


def test_labels(spark):
    def label(text, f, *more):
        return spark.createDataFrame([(text,)], "s string").select(f(F.col("s"), *more).alias("y")).head().y

    assert label("RESULTS: Urea improved skin hydration.", B.candidate_sentence) is True
    assert label("The vehicle improved skin hydration.", B.candidate_sentence) is True
    assert label("Vehicle improved skin hydration.", B.candidate_sentence) is False
    assert label("no significant adverse events", B.significance, F.lit(""), F.lit("safety"), F.lit("x")) == "not_significant"
    assert label("It may improve skin", B.strength, F.lit("unclear")) == "weak"
    assert label("It improved skin", B.strength, F.lit("unclear")) == "moderate"
    assert label("To prevent wrinkles", B.modality, F.lit("efficacy"), F.lit("improves")) == "prevention"
    assert label("urea after laser in a cream", B.attribution, F.lit("urea"), F.array(F.lit("urea"))) == "post_procedure_recovery_formulation"
    assert label("urea worked", B.attribution, F.lit("urea"), F.array(F.lit("urea"))) == "single_active"
    assert label(None, B.worthy_section) is True


def test_extract_asks_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(questions):
        calls.add(len(questions))
        return [json.dumps({"claims": [{"ingredient": q, "target": "skin"}, {"ingredient": q, "target": "tumor size"}]}) for q in questions]

    q = spark.createDataFrame([("s",), ("s",), ("t",), (None,)], "question string")
    cache = spark.createDataFrame([], "cache_key string, response string")
    out, fresh = extract_cached(q, cache, model, question="question", model="m", prompt="p")
    assert out.where("response is not null").count() == 3 and calls.value == 2
    assert extract_cached(q, fresh, model, question="question", model="m", prompt="p")[1].count() == 0
    assert out.select(F.sum(F.size(claims_of(F.col("response")))).alias("n")).where("n is not null").head().n == 3
    assert spark.range(1).select(F.size(claims_of(F.lit("not json"))).alias("n")).head().n == 0


def test_invariants(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "g double, r double")
    with pytest.raises(ValueError, match="order"):
        Q.require(rows, {"order": Q.at_least(F.col("r"), F.col("g"))})
