"""Queries of scans, lookups, merges, checks and reports, each with the SQL it is held against."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import aggregate as A
from quillstone.operators import graph as G
from quillstone.operators import labels as B
from quillstone.operators import quality as Q
from quillstone.operators import upsert as U
from quillstone.plans import claims as P
from quillstone.plans import evidence as E
from quillstone.plans.rules_sql import pick, pick_sql
from quillstone.runtime import read_table, scratch
from quillstone.sources import readers as R
from quillstone.sources import writers as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- scans ------------------------------------------------------------------------------------------------------


@query("""SELECT 'q' || CAST(t.ingredient_code AS VARCHAR) AS "key", CAST(i AS INTEGER) AS pos, CAST(t.ingredient_code AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS id FROM (SELECT DISTINCT ingredient_code FROM issue26_sebum_targets WHERE ingredient_code IS NOT NULL) t, range(0, 7) r(i) WHERE i < least(t.ingredient_code % 9, 5)""")
def searched_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids found for each target by a stand-in for the search service, at most five each."""

    def service(questions: list[str]) -> list[str]:
        return [json.dumps({"esearchresult": {"idlist": [f"{q[1:]}-{i}" for i in range(int(q[1:]) % 9)]}}) if int(q[1:]) % 9 else "no JSON" for q in questions]

    t = read_table(spark, d, "issue26_sebum_targets").where("ingredient_code is not null").select(F.concat(F.lit("q"), "ingredient_code").alias("q"))
    return R.search(t, "q", service, limit=5, pause=0.0)


@query("""SELECT pmid, title, source FROM (SELECT pmid, title, source, row_number() OVER (PARTITION BY pmid ORDER BY collected_at DESC NULLS LAST, coalesce(source, '') DESC, coalesce(searched_ingredient, '') DESC) AS rn FROM bronze_paper WHERE pmid IS NOT NULL AND trim(abstract_text, ' ') <> '') WHERE rn = 1""")
def fetched_papers(spark: SparkSession, d: str) -> DataFrame:
    """Ids with the last record fetched for them that has an abstract."""
    b = R.corpus(read_table(spark, d, "bronze_paper")).select("pmid", "title", "source", "collected_at", F.coalesce("source", F.lit("")).alias("s"), F.coalesce("searched_ingredient", F.lit("")).alias("i"))
    return A.last_wins(b, ["pmid"], ["collected_at", "s", "i"]).select("pmid", "title", "source")


@query("SELECT DISTINCT pmid, chunk_index FROM silver_chunk WHERE batch_id = (SELECT max(batch_id) FROM silver_chunk WHERE batch_id < '2025-01')")
def chosen_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the batch that the environment names: here the last of the years before."""
    c = read_table(spark, d, "silver_chunk")
    name = c.where("batch_id < '2025-01'").agg(F.max("batch_id")).head()[0]
    return R.chosen_batch(c, env={"SILVER_BATCH_ID": name} if name else {}).select("pmid", "chunk_index").distinct()


@query("""SELECT effect_name, effect_code FROM (SELECT lower(trim(effect_name_en)) AS effect_name, effect_code, row_number() OVER (PARTITION BY lower(trim(effect_name_en)) ORDER BY effect_code) AS rn FROM gold_claim_effect_map WHERE batch_id = (SELECT max(batch_id) FROM gold_claim_effect_map) AND effect_code IS NOT NULL AND effect_name_en IS NOT NULL) WHERE rn = 1""")
def latest_names(spark: SparkSession, d: str) -> DataFrame:
    """Effect names of the latest job, the first code of each."""
    m = read_table(spark, d, "gold_claim_effect_map").where("effect_code is not null and effect_name_en is not null").select(F.col("batch_id").alias("batch_job"), F.lower(F.trim("effect_name_en")).alias("effect_name"), "effect_code")
    return R.latest_job(m, "effect_name", ["effect_code"]).select("effect_name", "effect_code")


@query("SELECT lower(trim(query_name)) AS name, max(ingredient_code) AS ingredient_code FROM issue26_sebum_targets WHERE query_name IS NOT NULL GROUP BY 1")
def highest_codes(spark: SparkSession, d: str) -> DataFrame:
    """The highest code of each name."""
    t = read_table(spark, d, "issue26_sebum_targets").select(F.lower(F.trim("query_name")).alias("name"), "ingredient_code").distinct()
    return R.highest_wins(t, "name", "ingredient_code").select("name", "ingredient_code")


@query("SELECT effect_code, effect_name_en, CAST(row_number() OVER (ORDER BY effect_id) AS INTEGER) AS seed_id FROM effect_taxonomy WHERE effect_code IS NOT NULL AND effect_name_en IS NOT NULL")
def seed_effects(spark: SparkSession, d: str) -> DataFrame:
    """The taxonomy written as a seed script and read back, with ids by position."""
    e = read_table(spark, d, "effect_taxonomy").where("effect_code is not null and effect_name_en is not null").select("effect_id", F.concat(F.lit("('"), F.replace("effect_code", F.lit("'"), F.lit("''")), F.lit("', '"), F.replace("effect_name_en", F.lit("'"), F.lit("''")), F.lit("', TRUE)")).alias("row"))
    script = e.agg(F.concat(F.lit("INSERT INTO effect_taxonomy VALUES\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("effect_id", "row"))), lambda x: x["row"]), ",\n"), F.lit(";")).alias("sql"))
    return script.select(F.explode(R.seed_ids(F.col("sql"))).alias("s")).select(F.col("s.cells")[0].alias("effect_code"), F.col("s.cells")[1].alias("effect_name_en"), F.col("s.id").cast("int").alias("seed_id"))


@query("""SELECT product_id, product_url, goods_no FROM (SELECT DISTINCT 'p' || CAST(doc_id AS VARCHAR) AS product_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'https://shop.example/goods?goodsNo=' ELSE 'https://shop.example/goods?goodsNo=A' || CAST(doc_id AS VARCHAR) || '&x=1' END AS product_url, CASE WHEN doc_id % 5 > 1 THEN 'A' || CAST(doc_id AS VARCHAR) END AS goods_no FROM documents WHERE doc_id % 7 > 0) WHERE goods_no IS NOT NULL""")
def product_links(spark: SparkSession, d: str) -> DataFrame:
    """Products with an address that holds their number, over rows that lack one or the other at times."""
    return R.product_links(_products(spark, d)).distinct()


def _products(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    url = F.when(n % 5 == 0, "").when(n % 5 == 1, "https://shop.example/goods?goodsNo=").otherwise(F.concat(F.lit(" https://shop.example/goods?goodsNo=A"), n, F.lit("&x=1")))
    stats = F.concat(F.lit("{'skin': '"), pick(("None", "oily", "True grit"), n), F.lit("', 'tone': None, 'dry': "), (n % 3).cast("string"), F.lit(", 'mild': True}"))
    return read_table(spark, d, "documents").select(
        F.when(n % 7 > 0, F.concat(F.lit(" p"), n)).alias("product_id"), url.alias("product_url"),
        pick(("4.5", " 3 ", "", "good", "5e-1"), n).alias("rating"), pick(("12", "7.9", "", "many", "-3"), F.floor(n / 2)).alias("review_count"), F.when(n % 4 > 0, stats).otherwise(pick(("", "{}", "{'a': None}"), n)).alias("review_stats"),
    )


@query(f"""SELECT DISTINCT 'p' || CAST(doc_id AS VARCHAR) AS product_id, TRY_CAST(trim(r, ' ') AS DOUBLE) AS rating, coalesce(CAST(trunc(TRY_CAST(trim(c, ' ') AS DOUBLE)) AS INTEGER), 0) AS review_count,
    CASE WHEN doc_id % 4 > 0 THEN '{{"skin":"' || {pick_sql(("None", "oily", "True grit"), 'doc_id')} || '"' || CASE WHEN doc_id % 3 > 0 THEN ',"dry":"' || CAST(doc_id % 3 AS VARCHAR) || '"' ELSE '' END || ',"mild":"true"}}' END AS review_stats
    FROM (SELECT doc_id, {pick_sql(("4.5", " 3 ", "", "good", "5e-1"), 'doc_id')} AS r, {pick_sql(("12", "7.9", "", "many", "-3"), 'doc_id // 2')} AS c FROM documents WHERE doc_id % 7 > 0) WHERE TRY_CAST(trim(r, ' ') AS DOUBLE) IS NOT NULL""")
def product_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Products with a rating, their count and stats."""
    return R.product_reviews(_products(spark, d)).distinct()


@query("""SELECT ingredient_name AS "start", target AS "end", round(max(confidence_score), 4) AS graph_score, CAST(count(DISTINCT pmid) AS INTEGER) AS paper_count FROM gold_claim WHERE ingredient_name IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2""")
def edges_read_back(spark: SparkSession, d: str) -> DataFrame:
    """Edges under the headers of a loader, as text, read back under plain names."""
    g = read_table(spark, d, "gold_claim").where("ingredient_name is not null and target is not null").groupBy("ingredient_name", "target").agg(F.round(F.max("confidence_score"), 4).alias("s"), F.countDistinct("pmid").alias("p"))
    return R.untyped(g.select(F.col("ingredient_name").alias(":START_ID(Ingredient)"), F.col("target").alias(":END_ID(Effect)"), F.col("s").cast("string").alias("graph_score:float"), F.col("p").cast("string").alias("paper_count:int")))


@query("SELECT normalized_summary, count(*) AS cnt, CAST(row_number() OVER (ORDER BY count(*) DESC, normalized_summary) AS INTEGER) AS place FROM gold_claim WHERE normalized_summary IS NOT NULL GROUP BY 1 ORDER BY cnt DESC, normalized_summary LIMIT 25")
def top_summaries(spark: SparkSession, d: str) -> DataFrame:
    """The 25 summaries with the most claims, in order."""
    from pyspark.sql.window import Window

    n = read_table(spark, d, "gold_claim").where("normalized_summary is not null").groupBy("normalized_summary").agg(F.count(F.lit(1)).alias("cnt"))
    top = R.ordered(n, [F.desc("cnt"), "normalized_summary"], 25)
    return top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("cnt"), "normalized_summary")))  # 25 rows


@query("SELECT effect_id, effect_code FROM effect_taxonomy WHERE is_active")
def taxonomy_or_seed(spark: SparkSession, d: str) -> DataFrame:
    """The active taxonomy, from the second source where the first breaks while it is read."""
    broken = lambda: spark.range(100).select(F.assert_true(F.col("id") < 50).alias("x"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return R.with_fallback(broken, lambda: read_table(spark, d, "effect_taxonomy").where("is_active").select("effect_id", "effect_code"))


@query("SELECT DISTINCT canonical_name AS id FROM canonical_terms WHERE kind = 'ingredient'")
def nodes_so_far(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of the listed ingredients and of a graph that is not there yet, which counts as empty."""
    there = R.read_or_empty(spark, f"{d}/no_such_graph.parquet", "id string")
    return G.union_first([there, read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select(F.col("canonical_name").alias("id"))], "id").select("id")


@query("SELECT ingredient_code, CAST((row_number() OVER (ORDER BY ingredient_code) - 1) // 40 AS INTEGER) AS batch_no FROM (SELECT DISTINCT ingredient_code FROM issue26_sebum_targets WHERE lower(trim(is_target)) = 'true')")
def target_batches(spark: SparkSession, d: str) -> DataFrame:
    """Active targets in batches of forty."""
    from quillstone.sources.writers import batch_numbers

    return batch_numbers(R.targets(read_table(spark, d, "issue26_sebum_targets")).select("ingredient_code").distinct(), "ingredient_code", 40)


_CHUNK = "pmid string, chunk_index int, section_type string, char_count int"


def _export(spark: SparkSession, d: str) -> tuple[str, int]:
    """Chunks written as CSV batches beside an empty and a broken file: the folder, and the rows written."""
    chunks = read_table(spark, d, "silver_chunk").select("pmid", "chunk_index", F.nullif("section_type", F.lit("")).alias("section_type"), "char_count").distinct()
    root = scratch(spark)
    rows = W.write_csv(chunks.where("coalesce(chunk_index, 0) % 2 = 0"), f"{root}/batch=2024", mark=True) + W.write_csv(chunks.where("coalesce(chunk_index, 0) % 2 = 1"), f"{root}/batch=2025", single=True)
    jvm = spark.sparkContext._jvm
    for name, text in (("empty.csv", ""), ("broken_error.csv", "<html>not found</html>")):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(text, "utf-8"))
        out.close()
    return root, rows


@query("SELECT DISTINCT pmid, chunk_index, nullif(section_type, '') AS section_type, char_count FROM silver_chunk")
def chunks_from_files(spark: SparkSession, d: str) -> DataFrame:
    """Chunks written as CSV in two batches and read back as one table, past an empty and a broken file."""
    return R.read_many(spark, f"{_export(spark, d)[0]}/*", _CHUNK)


@query("SELECT DISTINCT pmid, chunk_index, nullif(section_type, '') AS section_type, char_count FROM silver_chunk WHERE chunk_index % 2 = 1")
def published_batch(spark: SparkSession, d: str) -> DataFrame:
    """The batch published under a tag, read back from its latest file; what is not there was not published."""
    root, _ = _export(spark, d)
    done = W.publish(spark, {"chunks": f"{root}/batch=2025", "nothing": f"{root}/none"}, f"{root}/store", "now")
    return R.read_csv(spark, R.latest_file(spark, done["chunks"], "part-"), _CHUNK)


@query("SELECT count(*) AS n_rows, 2 AS n_batches FROM (SELECT DISTINCT pmid, chunk_index, nullif(section_type, ''), char_count FROM silver_chunk)")
def export_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The counters of an export, written as metadata beside it and read back."""
    root, rows = _export(spark, d)
    W.write_metadata(spark.createDataFrame([(rows, 2)], "n_rows long, n_batches int"), f"{root}/metadata")
    return spark.read.schema("n_rows long, n_batches int").json(f"{root}/metadata")


# ---- lookups and merges -----------------------------------------------------------------------------------------

_VALID_SQL = "(SELECT DISTINCT canonical_name AS id FROM canonical_terms WHERE kind = 'ingredient')"


@query(f"""WITH v AS {_VALID_SQL}, k AS (SELECT lower(trim(canonical_name)) AS spelling, trim(query_name) AS ident, ingredient_code FROM issue26_sebum_targets UNION ALL SELECT lower(trim(query_name)), trim(query_name), ingredient_code FROM issue26_sebum_targets),
    r AS (SELECT spelling, arg_min(ident, struct_pack(a := ingredient_code, b := ident)) AS ident FROM k WHERE spelling <> '' AND ingredient_code IS NOT NULL AND ident IN (SELECT id FROM v) GROUP BY 1), o AS (SELECT 'alpha arbutin' AS spelling, min(id) AS ident FROM v)
    SELECT * FROM r WHERE spelling NOT IN (SELECT spelling FROM o) UNION ALL SELECT * FROM o""")
def name_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Spellings of the nodes that exist, the lowest code first, with an entry that overrides."""
    valid = read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select("canonical_name")
    t = read_table(spark, d, "issue26_sebum_targets").where("ingredient_code is not null").select(F.trim("query_name").alias("ident"), F.col("canonical_name").alias("a"), F.col("query_name").alias("b"), "ingredient_code")
    first = valid.agg(F.min("canonical_name")).head()[0]
    return G.name_lookup(t, "ident", ["a", "b"], "ingredient_code", valid, {"Alpha arbutin": first, "azelaic acid": "NO SUCH NODE"})


@query("""WITH t AS (SELECT ingredient_code, canonical_name, query_name, list_filter(list_transform(string_split(coalesce(alias_list, ''), '|'), lambda x: trim(x, ' ')), lambda x: x <> '') AS aliases FROM issue26_sebum_targets),
    k AS (SELECT ingredient_code, coalesce(aliases[1], trim(query_name)) AS node, lower(trim(unnest(list_concat([canonical_name, query_name], aliases)))) AS spelling FROM t)
    SELECT spelling, arg_max(node, struct_pack(a := ingredient_code, b := node)) AS node FROM k WHERE spelling <> '' AND node <> '' GROUP BY 1""")
def offline_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every name, query name and alias to the node of its target: its first alias, else its query name; of several targets the last."""
    none = F.array().cast("array<string>")
    t = read_table(spark, d, "issue26_sebum_targets").withColumn("aliases", F.coalesce(T.pipe_split(F.col("alias_list")), none))
    node = F.coalesce(F.try_element_at("aliases", F.lit(1)), F.trim("query_name"))
    k = t.select("ingredient_code", node.alias("node"), F.explode(F.concat(F.array("canonical_name", "query_name"), "aliases")).alias("spelling")).withColumn("spelling", F.lower(F.trim("spelling")))
    return A.last_wins(k.where("spelling <> '' and node <> ''"), ["spelling"], ["ingredient_code", "node"]).select("spelling", "node")


@query("SELECT g.claim_key, min(t.ingredient_code) AS ingredient_code FROM (SELECT DISTINCT claim_key, ingredient_name FROM gold_claim WHERE claim_key IS NOT NULL) g LEFT JOIN issue26_sebum_targets t ON t.query_name = g.ingredient_name GROUP BY 1")
def ingredient_ids(spark: SparkSession, d: str) -> DataFrame:
    """The one id of the ingredient of each claim, the lowest of several, null for none."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", F.col("ingredient_name").alias("query_name")).distinct()
    return G.first_match(g, "query_name", read_table(spark, d, "issue26_sebum_targets").select("query_name", "ingredient_code"), "ingredient_code").groupBy("claim_key").agg(F.min("ingredient_code").alias("ingredient_code"))


_OLD_EDGES, _NEW_EDGES = ("(SELECT ingredient_name, target, relation, max(confidence_score) AS score FROM gold_claim WHERE batch_id {} '2025-01' AND ingredient_name IS NOT NULL AND target IS NOT NULL AND relation IS NOT NULL GROUP BY ALL)".format(c) for c in ("<", ">="))
_ENDS = "ingredient_name IN (SELECT canonical_name FROM canonical_terms WHERE kind = 'ingredient') AND target IN (SELECT canonical_name FROM canonical_terms WHERE kind = 'target')"


def _edge_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    g = read_table(spark, d, "gold_claim").where("ingredient_name is not null and target is not null and relation is not null")
    return tuple(g.where(c).groupBy("ingredient_name", "target", "relation").agg(F.max("confidence_score").alias("score")) for c in ("batch_id < '2025-01'", "batch_id >= '2025-01'"))


def _merged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    old, new = _edge_tables(spark, d)
    terms = read_table(spark, d, "canonical_terms")
    return G.merge_edges(old, new, ["ingredient_name", "target", "relation"], ["score"], terms.where("kind = 'ingredient'").select("canonical_name"), terms.where("kind = 'target'").select("canonical_name"))


@query(f"""WITH n AS (SELECT * FROM {_NEW_EDGES} WHERE {_ENDS}) SELECT * FROM n UNION ALL SELECT o.* FROM {_OLD_EDGES} o ANTI JOIN n USING (ingredient_name, target, relation)""")
def merged_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges after later ones, both ends of which exist, replaced or joined them."""
    return _merged(spark, d)[0]


@query(f"SELECT ingredient_name, target, relation FROM {_NEW_EDGES} WHERE NOT ({_ENDS})")
def skipped_edges(spark: SparkSession, d: str) -> DataFrame:
    """Later edges of which an end does not exist."""
    return _merged(spark, d)[1]


@query("""WITH n AS (SELECT query_name AS k, min(category) AS v FROM issue26_sebum_targets WHERE query_name IS NOT NULL GROUP BY 1), i AS (SELECT query_name AS k, max(category) AS v FROM issue26_sebum_targets WHERE query_name IS NOT NULL AND ingredient_code % 2 = 0 GROUP BY 1)
    SELECT count(DISTINCT k) AS matched, count(*) FILTER (n.v <> i.v) AS corrected FROM n JOIN i USING (k)""")
def corrections(spark: SparkSession, d: str) -> DataFrame:
    """How many nodes get another value; a null is not another."""
    t = read_table(spark, d, "issue26_sebum_targets").where("query_name is not null")
    nodes = t.groupBy(F.col("query_name").alias("k")).agg(F.min("category").alias("v"))
    return G.corrections(nodes, t.where("ingredient_code % 2 = 0").groupBy(F.col("query_name").alias("k")).agg(F.max("category").alias("v")), "k", "v")


# Codes of the seeds in the SQL.
_S_CONCERN_CODES = "ACNE COMEDONES OILY_SKIN SENSITIVE_SKIN REDNESS IRRITATED_SKIN DRY_SKIN DEHYDRATED_SKIN BARRIER_DAMAGE HYPERPIGMENTATION DULLNESS AGING_SIGNS ATOPIC_PRONE ROSACEA_PRONE POST_ACNE_MARKS".split()
_S_EFFECT_CODES = "ANTI_INFLAMMATORY SOOTHING BARRIER_REPAIR HYDRATING MOISTURE_RETENTION SEBUM_REGULATION KERATOLYTIC COMEDOLYTIC ANTIMICROBIAL DEPIGMENTING BRIGHTENING ANTIOXIDANT WOUND_HEALING ANTI_AGING PHOTOPROTECTIVE".split()


def _coded_sql(codes: list[str], table: str, name: str) -> str:
    return f"(SELECT i AS id, c AS code FROM (VALUES {', '.join(f'({i}, {c!r})' for i, c in enumerate(codes, 1))}) v(i, c) UNION ALL SELECT 1000 + {name}_id, {name}_code FROM {table} WHERE {name}_code IS NOT NULL)"


@query(f"""SELECT c.id AS concern_id, e.id AS effect_id, 1.0::DOUBLE AS priority_score FROM {_coded_sql(_S_CONCERN_CODES, 'concern_taxonomy', 'concern')} c JOIN {_coded_sql(_S_EFFECT_CODES, 'effect_taxonomy', 'effect')} e ON (c.code = 'ACNE' AND e.code IN ('ANTI_INFLAMMATORY', 'SEBUM_REGULATION', 'KERATOLYTIC', 'COMEDOLYTIC', 'ANTIMICROBIAL'))
    OR (c.code = 'SENSITIVE_SKIN' AND e.code IN ('SOOTHING', 'ANTI_INFLAMMATORY', 'BARRIER_REPAIR', 'HYDRATING')) OR (c.code = 'BARRIER_DAMAGE' AND e.code IN ('BARRIER_REPAIR', 'HYDRATING', 'MOISTURE_RETENTION', 'SOOTHING')) OR (c.code = 'HYPERPIGMENTATION' AND e.code IN ('DEPIGMENTING', 'BRIGHTENING', 'ANTI_INFLAMMATORY'))
    OR (c.code = 'DRY_SKIN' AND e.code IN ('HYDRATING', 'MOISTURE_RETENTION', 'BARRIER_REPAIR')) OR (c.code = 'OILY_SKIN' AND e.code IN ('SEBUM_REGULATION', 'ANTI_INFLAMMATORY')) OR (c.code = 'POST_ACNE_MARKS' AND e.code IN ('DEPIGMENTING', 'BRIGHTENING', 'ANTI_INFLAMMATORY'))""")
def concern_effects(spark: SparkSession, d: str) -> DataFrame:
    """Concerns and the effects that meet them, over the codes of the seeds and of the taxonomies."""

    def coded(codes, table: str, name: str) -> DataFrame:
        own = spark.createDataFrame(list(enumerate(codes, 1)), f"{name}_id int, {name}_code string")
        return own.unionByName(read_table(spark, d, table).where(f"{name}_code is not null").select((F.col(f"{name}_id") + 1000).alias(f"{name}_id"), f"{name}_code"))

    return G.meeting(coded(L.CONCERN_SYNONYMS, "concern_taxonomy", "concern"), coded(L.EFFECT_SYNONYMS, "effect_taxonomy", "effect"), C.CONCERN_EFFECTS)


def _inserts(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    g = read_table(spark, d, "gold_claim").select("claim_key", "ingredient_name", "claim_text", "confidence_score")
    t = read_table(spark, d, "issue26_sebum_targets").select(F.col("ingredient_code").alias("ingredient_id"), F.col("query_name").alias("ingredient_name"))
    maps = [read_table(spark, d, f"gold_claim_{k}_map").select("claim_key", f"{k}_id", "confidence_score") for k in ("effect", "concern")]
    return U.insert_claims(g, t, *maps, known=read_table(spark, d, "gold_claim").where("batch_id < '2024-06'"))


_INSERTED = """WITH t AS (SELECT query_name, min(ingredient_code) AS ingredient_id FROM issue26_sebum_targets WHERE ingredient_code IS NOT NULL GROUP BY 1), g AS (SELECT DISTINCT claim_key, ingredient_name, confidence_score FROM gold_claim WHERE claim_key IS NOT NULL AND claim_key NOT IN (SELECT claim_key FROM gold_claim WHERE batch_id < '2024-06' AND claim_key IS NOT NULL)),
    n AS (SELECT g.claim_key, t.ingredient_id, g.confidence_score FROM g JOIN t ON t.query_name = g.ingredient_name)"""


@query(f"{_INSERTED} SELECT claim_key, min(ingredient_id) AS ingredient_id, 'primary' AS role, min(confidence_score) AS confidence_score FROM n GROUP BY 1")
def inserted_ingredients(spark: SparkSession, d: str) -> DataFrame:
    """Ingredient map rows of new claims whose ingredient is known."""
    return _inserts(spark, d)[1]


@query(f"{_INSERTED} SELECT 'effect' AS kind, claim_key, effect_id AS id, max(confidence_score) AS confidence_score FROM gold_claim_effect_map WHERE effect_id IS NOT NULL AND claim_key IN (SELECT claim_key FROM n) GROUP BY 2, 3 UNION ALL SELECT 'concern', claim_key, concern_id, max(confidence_score) FROM gold_claim_concern_map WHERE concern_id IS NOT NULL AND claim_key IN (SELECT claim_key FROM n) GROUP BY 2, 3")
def inserted_maps(spark: SparkSession, d: str) -> DataFrame:
    """Effect and concern map rows of new claims."""
    _, _, effects, concerns = _inserts(spark, d)
    return effects.select(F.lit("effect").alias("kind"), "claim_key", F.col("effect_id").alias("id"), "confidence_score").unionByName(concerns.select(F.lit("concern").alias("kind"), "claim_key", F.col("concern_id").alias("id"), "confidence_score"))


@query("SELECT claim_key, max(validator_version || claim_text) AS answer FROM gold_claim WHERE claim_key IS NOT NULL AND batch_id >= '2025-01' GROUP BY 1 UNION ALL SELECT claim_key, max(claim_text) FROM gold_claim WHERE claim_key IS NOT NULL AND batch_id < '2025-01' AND claim_key NOT IN (SELECT claim_key FROM gold_claim WHERE batch_id >= '2025-01' AND claim_key IS NOT NULL) GROUP BY 1")
def cached_answers(spark: SparkSession, d: str) -> DataFrame:
    """A cache after answers came in: the last of each key, the old ones where none came."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null")
    cache = g.where("batch_id < '2025-01'").groupBy(F.col("claim_key")).agg(F.max("claim_text").alias("answer"))
    return U.replace_cached(cache, g.where("batch_id >= '2025-01'").select("claim_key", F.concat("validator_version", "claim_text").alias("answer")), "claim_key")


# ---- reports and checks -----------------------------------------------------------------------------------------

_TIERED = "CASE WHEN chunk_index % 5 = 0 THEN 'strict_graph' WHEN chunk_index % 5 < 3 THEN 'soft_graph' WHEN chunk_index % 5 = 3 THEN 'recommendation_only' ELSE 'evidence_only' END"


def _tiered(n: Column) -> Column:
    return L.first_label([(n % 5 == 0, "strict_graph"), (n % 5 < 3, "soft_graph"), (n % 5 == 3, "recommendation_only")], "evidence_only")


@query(f"""WITH l AS ({P.SQL['attribution_labels']}), t AS (SELECT DISTINCT claim_key, {_TIERED} AS tier FROM gold_claim WHERE claim_key IS NOT NULL), j AS (SELECT * FROM l JOIN t USING (claim_key) WHERE tier <> 'evidence_only')
    SELECT 'graph_tier' AS "check", count(*) FILTER (tier NOT IN ('strict_graph', 'soft_graph')) AS n_bad FROM j UNION ALL SELECT 'strict_one_unit', count(*) FILTER (tier = 'strict_graph' AND n_units <> 1) FROM j UNION ALL SELECT 'strict_not_blocked', count(*) FILTER (tier = 'strict_graph' AND (lists OR suspect)) FROM j""")
def graph_row_checks(spark: SparkSession, d: str) -> DataFrame:
    """Rows that go into a graph against what they must be."""
    t = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", _tiered(F.col("chunk_index")).alias("tier")).distinct()
    rows = P.attribution_labels(spark, d).join(t, "claim_key").where("tier <> 'evidence_only'")
    return Q.violations(rows, Q.graph_rows(F.col("tier"), F.col("n_units"), F.col("lists"), F.col("suspect")))


@query(f"""WITH w AS (SELECT claim_key FROM gold_claim WHERE {_TIERED} <> 'evidence_only'), p AS (SELECT claim_key FROM gold_claim WHERE {_TIERED} IN ('strict_graph', 'soft_graph') OR chunk_index = 4)
    SELECT 'part_of_whole' AS "check", count(*) AS n_bad FROM p WHERE claim_key IS NULL OR claim_key NOT IN (SELECT claim_key FROM w WHERE claim_key IS NOT NULL) UNION ALL SELECT 'as_many', abs((SELECT count(*) FROM w) - (SELECT count(*) FROM p))""")
def count_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether one set of rows holds another, and whether they are as many."""
    g = read_table(spark, d, "gold_claim").withColumn("tier", _tiered(F.col("chunk_index"))).select("claim_key", "tier", "chunk_index")
    return Q.compare(g.where("tier <> 'evidence_only'"), g.where("tier in ('strict_graph', 'soft_graph') or chunk_index = 4"), ["claim_key"])


_FK = "SELECT 'foreign({c})' AS \"check\", count(*) AS n_bad FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p} WHERE {k} IS NOT NULL)"


@query(f"""SELECT 'not_null(claim_key)' AS "check", count(*) FILTER (claim_key IS NULL) AS n_bad FROM gold_claim_effect_map UNION ALL SELECT 'not_null(effect_code)', count(*) FILTER (effect_code IS NULL) FROM gold_claim_effect_map UNION ALL SELECT 'unique(claim_key, effect_id)', count(*) FROM (SELECT 1 FROM gold_claim_effect_map WHERE claim_key IS NOT NULL AND effect_id IS NOT NULL GROUP BY claim_key, effect_id HAVING count(*) > 1)
    UNION ALL {_FK.format(t='gold_claim_effect_map', c='claim_key', k='claim_key', p='gold_claim')} UNION ALL {_FK.format(t='gold_claim_effect_map', c='effect_id', k='effect_id', p='effect_taxonomy')}""")
def table_constraints(spark: SparkSession, d: str) -> DataFrame:
    """The constraints of the effect map as a warehouse would hold it to."""
    m = read_table(spark, d, "gold_claim_effect_map")
    return Q.constraints(m, not_null=["claim_key", "effect_code"], unique=[["claim_key", "effect_id"]], foreign={"claim_key": (read_table(spark, d, "gold_claim"), "claim_key"), "effect_id": (read_table(spark, d, "effect_taxonomy"), "effect_id")})


@query(f"""SELECT 'affects' AS edge, * FROM ({_FK.format(t='gold_claim', c='ingredient_name', k='canonical_name', p="(SELECT canonical_name FROM canonical_terms WHERE kind = 'ingredient')")}) UNION ALL SELECT 'affects', * FROM ({_FK.format(t='gold_claim', c='target', k='canonical_name', p="(SELECT canonical_name FROM canonical_terms WHERE kind = 'target')")})
    UNION ALL SELECT 'relates', * FROM ({_FK.format(t='gold_claim_effect_map', c='effect_id', k='effect_id', p='effect_taxonomy')}) UNION ALL SELECT 'causes', * FROM ({_FK.format(t='gold_claim_concern_map', c='concern_id', k='concern_id', p='concern_taxonomy')})""")
def edge_ends(spark: SparkSession, d: str) -> DataFrame:
    """Ends of three kinds of edges that are no nodes."""
    terms = read_table(spark, d, "canonical_terms")
    kinds = {
        "affects": (read_table(spark, d, "gold_claim"), {"ingredient_name": (terms.where("kind = 'ingredient'"), "canonical_name"), "target": (terms.where("kind = 'target'"), "canonical_name")}),
        "relates": (read_table(spark, d, "gold_claim_effect_map"), {"effect_id": (read_table(spark, d, "effect_taxonomy"), "effect_id")}),
        "causes": (read_table(spark, d, "gold_claim_concern_map"), {"concern_id": (read_table(spark, d, "concern_taxonomy"), "concern_id")}),
    }
    parts = [Q.constraints(rows, foreign=ends).withColumn("edge", F.lit(kind)) for kind, (rows, ends) in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""SELECT 'score_order' AS "check", count(*) FILTER (recommendation_score_base + 1e-9 < graph_score) AS n_bad FROM ({E.SQL['canonical_claims']})""")
def score_order(spark: SparkSession, d: str) -> DataFrame:
    """Canonical claims whose recommendation score is below their graph score."""
    return Q.violations(E.canonical_claims(spark, d), {"score_order": Q.at_least(F.col("recommendation_score_base"), F.col("graph_score"))})


@query(f"SELECT f.* FROM ({E.SQL['function_edges']}) f WHERE NOT EXISTS (SELECT 1 FROM ({E.SQL['function_edges']}) s WHERE s.owner = f.owner AND s.effect = f.effect AND s.relation = f.relation AND s.score < 0.09)")
def new_function_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges from functions that are not among those seen already."""
    owners = read_table(spark, d, "issue26_sebum_targets").where("category is not null").select("canonical_name", T.function_names(F.col("category")).alias("functions"))
    mapping = spark.createDataFrame(E._FUN, "function string, effects array<string>, relation string, confidence double")
    return A.function_edges(owners, "canonical_name", "functions", mapping, E.function_edges(spark, d).where("score < 0.09"))


_MAPPED = "(SELECT lower(trim(claim_key)) AS ck, list(DISTINCT {0}_id) AS ids FROM gold_claim_{0}_map WHERE claim_key IS NOT NULL AND {0}_id IS NOT NULL GROUP BY 1)"


def _ids(spark: SparkSession, d: str, kind: str) -> DataFrame:
    m = read_table(spark, d, f"gold_claim_{kind}_map").where(f"claim_key is not null and {kind}_id is not null")
    return m.groupBy(F.lower(F.trim("claim_key")).alias("claim_key")).agg(F.collect_set(f"{kind}_id").alias(f"{kind}_ids"))


@query(f"""WITH g AS (SELECT DISTINCT claim_key, concat_ws('|', ingredient_name, relation, target) AS claim FROM gold_claim WHERE claim_key IS NOT NULL), e AS {_MAPPED.format('effect')}, c AS {_MAPPED.format('concern')},
    x AS (SELECT claim, list_sort(list_distinct(flatten(list(coalesce(e.ids, []))))) AS a, list_sort(list_distinct(flatten(list(coalesce(c.ids, []))))) AS b FROM g LEFT JOIN e ON e.ck = g.claim_key LEFT JOIN c ON c.ck = g.claim_key GROUP BY 1)
    SELECT claim, array_to_string(a, '|') AS effect_ids, array_to_string(b, '|') AS concern_ids FROM x""")
def claim_ids(spark: SparkSession, d: str) -> DataFrame:
    """All effects and concerns of each claim over the rows that say it."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", F.concat_ws("|", "ingredient_name", "relation", "target").alias("claim")).distinct()
    rows = g.join(_ids(spark, d, "effect"), "claim_key", "left").join(_ids(spark, d, "concern"), "claim_key", "left")
    return A.union_ids(rows, "claim", {"effect_ids": "effect_ids", "concern_ids": "concern_ids"})


_ATTRIBUTED = ("single_active", "single_formulation", "multi_active_combination", "ambiguous")
_CAUSED = f"""SELECT claim_key, trim(ingredient_name) AS node, coalesce(pmid, '') AS pmid, confidence_score AS w, CASE WHEN chunk_index % 3 = 0 THEN 'causes' ELSE relation END AS relation, evidence_direction, {pick_sql(_ATTRIBUTED, 'chunk_index')} AS att FROM (SELECT DISTINCT claim_key, ingredient_name, pmid, confidence_score, chunk_index, relation, evidence_direction FROM gold_claim)"""
_WANTED = "(SELECT concern_id, max(concern_code) AS concern_code FROM concern_taxonomy WHERE concern_id % 3 = 0 AND concern_code IS NOT NULL GROUP BY 1)"
_HITS = f"""WITH r AS ({_CAUSED}), h AS (SELECT r.*, list_intersect(coalesce(m.ids, []), (SELECT list(concern_id) FROM {_WANTED})) AS hit FROM r LEFT JOIN {_MAPPED.format('concern')} m ON m.ck = r.claim_key), k AS (SELECT *, relation = 'causes' AND evidence_direction = 'supports' AND len(hit) > 0 AS causes, att IN ('single_active', 'single_formulation') AS owed FROM h)"""


def _caution(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    g = read_table(spark, d, "gold_claim").select("claim_key", "ingredient_name", "pmid", "confidence_score", "chunk_index", "relation", "evidence_direction").distinct()
    rows = g.join(_ids(spark, d, "concern"), "claim_key", "left").withColumns({"node": F.nullif(F.trim("ingredient_name"), F.lit("")), "relation": F.when(F.col("chunk_index") % 3 == 0, "causes").otherwise(F.col("relation")), "att": pick(_ATTRIBUTED, F.col("chunk_index"))})
    concerns = read_table(spark, d, "concern_taxonomy").where("concern_id % 3 = 0 and concern_code is not null").groupBy("concern_id").agg(F.max("concern_code").alias("concern_code"))
    return A.caution(rows, node="node", concern_ids="concern_ids", paper="pmid", weight="confidence_score", relation="relation", direction="evidence_direction", attribution="att", concerns=concerns, attributions=C.SURE_ATTRIBUTIONS)


@query(f"{_HITS} SELECT node, concern_code, round(ln(1 + sum(w)), 6) AS graph_score, CAST(count(*) AS INTEGER) AS paper_count FROM (SELECT node, concern_code, pmid, max(w) AS w FROM (SELECT node, pmid, w, unnest(hit) AS concern_id FROM k WHERE causes AND owed AND node <> '') JOIN {_WANTED} USING (concern_id) GROUP BY 1, 2, 3) GROUP BY 1, 2")
def caution_by_concern(spark: SparkSession, d: str) -> DataFrame:
    """Ingredients and the concerns they cause, of the concerns asked for and by sure attributions only."""
    return _caution(spark, d)[0]


@query(f"{_HITS} SELECT count(*) AS scanned, count(*) FILTER (causes) AS causes_supports, count(*) FILTER (causes AND NOT owed) AS dropped_attribution, count(*) FILTER (causes AND owed AND coalesce(node, '') = '') AS unmapped, count(*) FILTER (causes AND owed AND node <> '') AS selected FROM k")
def caution_funnel(spark: SparkSession, d: str) -> DataFrame:
    """How many rows each condition of a caution leaves."""
    return _caution(spark, d)[1]


@query(f"""WITH l AS ({P.SQL['attribution_labels']}), t AS (SELECT DISTINCT claim_key, {_TIERED} AS tier FROM gold_claim WHERE claim_key IS NOT NULL), e AS {_MAPPED.format('effect')}, c AS {_MAPPED.format('concern')}, j AS (SELECT l.*, tier, e.ck IS NULL AND c.ck IS NULL AS bare FROM l JOIN t USING (claim_key) LEFT JOIN e ON e.ck = l.claim_key LEFT JOIN c ON c.ck = l.claim_key)
    SELECT count(*) AS claims, count(*) FILTER (tier = 'strict_graph') AS strict_graph, count(*) FILTER (tier = 'soft_graph') AS soft_graph, count(*) FILTER (tier = 'recommendation_only') AS recommendation_only, count(*) FILTER (tier = 'evidence_only') AS evidence_only, count(*) FILTER (bare) AS unmapped, count(*) FILTER (lists) AS lists, count(*) FILTER (suspect) AS suspect,
    {', '.join(f"count(*) FILTER (attribution = '{a}') AS {a}" for a in B.ATTRIBUTION_WEIGHT)} FROM j""")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a run: tiers, attributions, unmapped and suspect rows, in one pass."""
    from quillstone.sources.writers import metrics

    t = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", _tiered(F.col("chunk_index")).alias("tier")).distinct()
    rows = P.attribution_labels(spark, d).join(t, "claim_key").join(_ids(spark, d, "effect"), "claim_key", "left").join(_ids(spark, d, "concern"), "claim_key", "left")
    counts = {"claims": F.count(F.lit(1))} | {x: F.count_if(F.col("tier") == x) for x in ("strict_graph", "soft_graph", "recommendation_only", "evidence_only")}
    counts |= {"unmapped": F.count_if(F.col("effect_ids").isNull() & F.col("concern_ids").isNull()), "lists": F.count_if("lists"), "suspect": F.count_if("suspect")} | {a: F.count_if(F.col("attribution") == a) for a in B.ATTRIBUTION_WEIGHT}
    return metrics(rows, counts)


@query("""SELECT ingredient_code, coalesce(c.canonical_name, array_to_string(list_transform(regexp_extract_all(lower(t.query_name), '\\p{L}+|[^\\p{L}]+'), lambda p: upper(p[1]) || p[2:]), '')) AS name, array_to_string(list_distinct_in_order, '|') AS aliases FROM (SELECT *, list_filter(a, lambda x, i: list_position(list_transform(a, lambda y: lower(y)), lower(x)) = i) AS list_distinct_in_order FROM
    (SELECT DISTINCT ingredient_code, query_name, list_filter([trim(query_name), trim(canonical_name)], lambda x: x <> '') AS a FROM issue26_sebum_targets)) t LEFT JOIN (SELECT DISTINCT canonical_name FROM canonical_terms WHERE kind = 'ingredient' AND term_id % 2 = 0) c ON c.canonical_name = t.query_name""")
def target_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of built targets: the listed one, else the id with capitals; aliases without repeats."""
    t = read_table(spark, d, "issue26_sebum_targets").select("ingredient_code", "query_name", "canonical_name").distinct()
    c = read_table(spark, d, "canonical_terms").where("kind = 'ingredient' and term_id % 2 = 0").select(F.col("canonical_name").alias("_name")).distinct()
    return t.join(c, F.col("query_name") == F.col("_name"), "left").select("ingredient_code", F.coalesce("_name", T.title_case(F.col("query_name"))).alias("name"), F.array_join(T.dedup_ci(F.array("query_name", "canonical_name")), "|").alias("aliases")).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
