import pytest
from pyspark.sql import functions as F

from quillstone.sources import readers as R
from quillstone.sources import writers as W

XML = """<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T &amp; U</ArticleTitle><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>1999 Spring</MedlineDate></PubDate></JournalIssue></Journal>
<Abstract><AbstractText Label="AIM">a</AbstractText><AbstractText>b</AbstractText></Abstract><AuthorList><Author><LastName>Roe</LastName><ForeName>Jo</ForeName></Author><Author><CollectiveName>Group</CollectiveName></Author><Author><LastName>Solo</LastName></Author></AuthorList>
<ELocationID EIdType="pii">x</ELocationID><ELocationID EIdType="doi">10.1/x</ELocationID></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pmc">PMC1</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""


def test_articles(spark):
    r = spark.createDataFrame([(XML,), ("<PubmedArticle/>",)], "x string").select(R.parse_articles(F.col("x")).alias("p")).collect()
    p = r[0].p
    assert (p.pmid, p.title, p.abstract_text, p.publication_year, p.authors, p.doi, p.pmcid) == ("7", "T & U", "AIM: a\nb", 1999, "Jo Roe; Group; Solo", "10.1/x", "PMC1")
    assert r[1].p.pmid is None and r[1].p.abstract_text is None


def test_batches(spark, tmp_path):
    df = spark.createDataFrame([("2024", 1), ("2025", 2)], "batch string, v int")
    W.write_batch(df, str(tmp_path / "t"))
    assert [r.v for r in R.read_batches(spark, str(tmp_path / "t"), since="2025").collect()] == [2]
    assert [r.v for r in R.latest(df, "batch").collect()] == [2]
    with pytest.raises(ValueError):
        R.batches(df, "batch", since="a", exactly="b")
    assert R.read_or_empty(spark, str(tmp_path / "none"), "v int").count() == 0


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "q", y\nz'), ("b", None)], "id string, t string")
    W.write_csv(df, str(tmp_path / "c"), {"id": "id:ID(Node)"}, single=True)
    assert sorted(map(tuple, R.read_csv(spark, str(tmp_path / "c"), "id string, t string").collect())) == [("a", 'x "q", y\nz'), ("b", None)]


def test_batch_numbers(spark):
    n = W.batch_numbers(spark.range(0, 1001, numPartitions=3), "id", 500).groupBy("batch_no").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("m")).orderBy("batch_no").collect()
    assert [(r.batch_no, r.c, r.m) for r in n] == [(0, 500, 0), (1, 500, 500), (2, 1, 1000)]


def test_seed_rows(spark):
    sql = "INSERT INTO t VALUES\n('A', 'it''s', 1),\n('B', 'two', 2);"
    assert spark.createDataFrame([(sql,)], "s string").select(R.seed_rows(F.col("s"), 2).alias("r")).head().r == [["A", "it's"], ["B", "two"]]


def test_stream(spark, tmp_path):
    from quillstone.streaming.incremental import arriving, dedup_arriving, run_available

    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-01"), ("b", "2024-01-02")], "k string, t string").withColumn("t", F.to_timestamp("t"))
    df.write.parquet(str(tmp_path / "in"))
    got = []
    run_available(dedup_arriving(arriving(spark, str(tmp_path / "in"), df.schema), ["k"], "t"), lambda b, i: got.extend(r.k for r in b.collect()), str(tmp_path / "ck"))
    assert sorted(got) == ["a", "b"]


def test_fetch_pages(spark):
    keys = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    assert sorted(map(tuple, R.fetch_pages(keys, "k", lambda ks: [k * 2 for k in ks], 1, 0.0).collect())) == [("1", "11"), ("2", "22")]
