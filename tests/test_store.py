import glob
import os

import pytest
from pyspark.sql import functions as F

from quillstone.__main__ import parser
from quillstone.config import Settings
from quillstone.operators import aggregate as A
from quillstone.operators import graph as G
from quillstone.operators import quality as Q
from quillstone.operators import upsert as U
from quillstone.plans import claims, store
from quillstone.sources import readers as R
from quillstone.sources import writers as W


@pytest.mark.parametrize("name", [*claims.SQL, *store.SQL])
def test_queries_as_sql(spark, data, name):
    import duckdb

    db = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        db.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = ({**claims.QUERIES, **store.QUERIES})[name](spark, data)
    want = db.sql({**claims.SQL, **store.SQL}[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    tidy = lambda v: round(v, 6) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(tidy(r[c]) for c in columns) for r in got.collect()), key=repr) == sorted((tuple(tidy(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_files(spark, tmp_path):
    (tmp_path / "b1").mkdir()
    (tmp_path / "b1" / "silver_current.csv").write_text("﻿a,b\n1,x\n2,\"y\nz\"\n", encoding="utf-8")
    (tmp_path / "b2.csv").write_text("a,b\n3,w\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "broken.csv").write_text("<html>no table</html>\n")
    (tmp_path / "old_silver_current_error.csv").write_text("a,b\n")
    got = R.read_many(spark, f"{tmp_path}/*.csv", "a int, b string").unionByName(R.read_many(spark, f"{tmp_path}/b1", "a int, b string"))
    assert sorted((r.a, r.b) for r in got.collect()) == [(1, "x"), (2, "y\nz"), (3, "w")]
    assert R.read_many(spark, f"{tmp_path}/none*", "a int").count() == 0 and R.read_many(spark, f"{tmp_path}/empty.csv", "a int").count() == 0
    os.utime(tmp_path / "b2.csv", (1, 1))
    assert R.latest_file(spark, str(tmp_path), "silver_current").endswith("b1/silver_current.csv")
    with pytest.raises(FileNotFoundError):
        R.latest_file(spark, str(tmp_path), "nothing")
    with pytest.raises(FileNotFoundError):
        R.read_batch(spark, str(tmp_path), "2024", "a int")
    (tmp_path / "batch=2024").mkdir()
    (tmp_path / "batch=2024" / "x.csv").write_text("a\n7\n")
    assert R.read_batch(spark, str(tmp_path), "2024", "a int").head().a == 7


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", 1.5), (None, None)], "id string, w double")
    assert W.write_csv(df, f"{tmp_path}/out", {"id": ":START_ID(X)", "w": "w:float"}, single=True, mark=True) == 2
    (file,) = glob.glob(f"{tmp_path}/out/part*")
    assert open(file, encoding="utf-8").read().startswith("﻿:START_ID(X),w:float\nk,1.5")
    back = R.untyped(spark.read.csv(f"{tmp_path}/out", header=True))
    assert back.columns == ["start", "w"] and back.head().w == 1.5
    assert W.write_csv(df.limit(0), f"{tmp_path}/none", single=True, bare_if_empty=True) == 0
    assert "".join(open(f).read() for f in glob.glob(f"{tmp_path}/none/part*")) == ""
    done = W.publish(spark, {"nodes/x": f"{tmp_path}/out", "edges/y": f"{tmp_path}/missing"}, f"{tmp_path}/store", "t1")
    assert done == {"nodes/x": f"{tmp_path}/store/batch_job=t1/nodes/x"} and glob.glob(f"{tmp_path}/store/batch_job=t1/nodes/x/part*")
    assert W.import_files({"X": "x.csv"}, {"E": "e.csv"}) == ["--overwrite-destination", "--nodes=X=x.csv", "--relationships=E=e.csv"]


def test_fallback_sees_errors_of_the_read(spark):
    late = lambda: spark.range(10).select(F.assert_true(F.col("id") < 5))
    with pytest.warns(UserWarning, match="stands in"):
        assert R.with_fallback(late, lambda: spark.range(3)).count() == 3
    assert R.with_fallback(lambda: spark.range(2), late).count() == 2


def test_fetches_without_keys(spark):
    def never(keys):
        raise AssertionError

    assert R.fetch_pages(spark.createDataFrame([(None,)], "k string"), "k", never).count() == 0
    got = spark.createDataFrame([('{"esearchresult": {"idlist": ["1", "2"]}}',), ("{}",), ("<html>",), (None,)], "b string").select(R.search_ids(F.col("b")).alias("x"))
    assert [r.x for r in got.collect()] == [["1", "2"], [], [], []]


def test_batches_and_winners(spark):
    rows = spark.createDataFrame([("2024", "a", 1), ("2025", "b", 2), ("2025", "b", 3), (None, "c", 4)], "batch_id string, k string, v int")
    assert {r.v for r in R.chosen_batch(rows, env={}).collect()} == {2, 3} and {r.v for r in R.chosen_batch(rows, env={"SILVER_BATCH_ID": "2024"}).collect()} == {1}
    assert {r.v for r in R.chosen_batch(rows, explicit="2025", env={"SILVER_BATCH_ID": "2024"}).collect()} == {2, 3}
    assert [(r.k, r.v) for r in R.latest_job(rows, "k", ["v"], "batch_id").collect()] == [("b", 2)]
    assert {(r.k, r.v) for r in R.highest_wins(rows, "k", "v").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert [r.v for r in R.ordered(rows, [F.desc("v")], 2).collect()] == [4, 3] and R.ordered(rows, ["v"]).count() == 4


def test_merges(spark):
    old = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0)], "s string, e string, w double")
    new = spark.createDataFrame([("a", "x", 2.0), ("a", "x", 3.0), ("a", "z", 1.0), (None, "x", 1.0), ("b", "x", 5.0)], "s string, e string, w double")
    merged, skipped = G.merge_edges(old, new, ["s", "e"], ["w"], spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("x",), ("y",)], "id string"))
    assert sorted(map(tuple, merged.collect())) == [("a", "x", 3.0), ("b", "x", 5.0), ("b", "y", 1.0)] and sorted(map(tuple, skipped.collect()), key=str) == [("a", "z"), (None, "x")]
    nodes = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "k string, v string")
    assert tuple(G.corrections(nodes, spark.createDataFrame([("a", "2"), ("b", "9"), ("c", "3"), ("d", "1")], "k string, v string"), "k", "v").head()) == (3, 1)
    claims_ = spark.createDataFrame([("k1", "Urea", 0.5), ("k1", "Urea", 0.5), ("k2", "None", 0.5), (None, "Urea", 0.1), ("k3", "Urea", 0.2)], "claim_key string, ingredient_name string, confidence_score double")
    ids = spark.createDataFrame([(7, "Urea"), (3, "Urea"), (None, "Urea")], "ingredient_id int, ingredient_name string")
    maps = spark.createDataFrame([("k1", 1, 0.1), ("k1", 1, 0.3), ("k1", None, 0.3), ("k2", 1, 0.3), (None, 1, 0.1)], "claim_key string, effect_id int, confidence_score double")
    added, owners, effects, concerns = U.insert_claims(claims_, ids, maps, maps.withColumnRenamed("effect_id", "concern_id"), known=spark.createDataFrame([("k3",)], "claim_key string"))
    assert [r.claim_key for r in added.collect()] == ["k1"] and [tuple(r) for r in owners.collect()] == [("k1", 3, "primary", 0.5)] and [tuple(r) for r in effects.collect()] == [("k1", 1, 0.3)] == [tuple(r) for r in concerns.collect()]
    cache = spark.createDataFrame([("a", "1"), ("b", "1")], "cache_key string, response string")
    assert sorted(map(tuple, U.replace_cached(cache, spark.createDataFrame([("a", "3"), ("a", "2")], "cache_key string, response string")).collect())) == [("a", "3"), ("b", "1")]


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 9), (2, None, None)], "id int, k string, p int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    got = {r["check"]: r.n_bad for r in Q.constraints(rows, not_null=["k"], unique=[["id"], ["id", "k"]], foreign={"p": (parent, "id")}).collect()}
    assert got == {"not_null(k)": 1, "unique(id)": 1, "unique(id, k)": 1, "foreign(p)": 1}
    assert {r["check"]: r.n_bad for r in Q.compare(rows, rows.limit(0), ["id"]).collect()} == {"part_of_whole": 0, "as_many": 3}
    tiers = spark.createDataFrame([("strict_graph", 1, False), ("strict_graph", 2, True), ("other", 2, True), (None, 1, False)], "tier string, n int, b boolean")
    assert {r["check"]: r.n_bad for r in Q.violations(tiers, Q.graph_rows(F.col("tier"), F.col("n"), F.col("b"), F.lit(False))).collect()} == {"graph_tier": 2, "strict_one_unit": 1, "strict_not_blocked": 1}


def test_aggregates(spark):
    rows = spark.createDataFrame([("a", [2, 1]), ("a", [2, None]), ("b", None), ("c", []), (None, [9])], "k string, ids array<int>")
    assert {r.k: r.ids for r in A.union_ids(rows, "k", {"ids": "ids"}).collect()} == {"a": "1|2", "b": "", "c": ""}
    cases = spark.createDataFrame([("n", [1, 2], "p", 0.5, "causes", "supports", "ok"), ("n", [1], "p", 0.7, "causes", "supports", "ok"), (None, [1], "p", 0.7, "causes", "supports", "ok"), ("n", [1], "p", 9.0, "causes", "supports", None), ("n", [3], "p", 9.0, "causes", "supports", "ok"), ("n", None, "p", 9.0, "causes", "supports", "ok"), ("n", [1], "p", 9.0, None, "supports", "ok")], "node string, ids array<int>, pmid string, w double, rel string, dir string, att string")
    concerns = spark.createDataFrame([(1, "ONE"), (2, "TWO")], "concern_id int, concern_code string")
    edges, funnel = A.caution(cases, node="node", concern_ids="ids", paper="pmid", weight="w", relation="rel", direction="dir", attribution="att", concerns=concerns, attributions=["ok"])
    assert {r.concern_code: r.graph_score for r in edges.collect()} == {"ONE": 0.530628, "TWO": 0.405465} and tuple(funnel.head()) == (7, 4, 1, 1, 2)


def test_settings_and_flags():
    s = Settings.from_env({"SEARCH_LIMIT": "7", "ENABLE_DB_UPSERT": "False", "NCBI_EMAIL": "a@b", "REQUEST_SLEEP": "0.5"})
    assert (s.search_limit, s.enable_db_upsert, s.request_sleep, s.chunk_max_chars) == (7, False, 0.5, 1000)
    assert s.request(term="x") == {"tool": "quillstone", "email": "a@b", "term": "x"} and s.folder("gold", "/d/") == "/d/gold/claim"
    with pytest.raises(ValueError):
        Settings.from_env({"SEARCH_LIMIT": "many"})
    a = parser().parse_args(["affects_edges", "in", "out", "--format", "csv", "--since", "2025", "--order", "a,b", "--limit", "3"])
    assert (a.format, a.since, a.limit, a.dry_run) == ("csv", "2025", 3, False)
