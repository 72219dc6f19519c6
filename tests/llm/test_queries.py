from quillstone.llm import queries as Q


def test_run(spark, data):
    for name, f in Q.queries().items():
        assert f(spark, data).count() > 0, name


def test_found_sql(spark, data):
    import duckdb

    con = duckdb.connect()
    for t in ("silver_chunk", "bronze_paper", "size_limits", "documents", "gold_claim", "canonical_terms", "mix_targets"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in Q.oracle_sql().items():
        assert sorted(map(tuple, Q.queries()[name](spark, data).collect())) == sorted(con.execute(sql).fetchall()), name
