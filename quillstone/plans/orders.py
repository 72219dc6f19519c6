"""The evidence aggregates over the order tables, as a stand-in for evidence at volume: orders are papers, brands are
ingredients, part types are targets, and order attributes are the labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import aggregate as A
from quillstone.operators import labels as B
from quillstone.runtime import read_table

_RELATION = {"A": "improves", "N": "increases", "R": "reduces"}
_STRENGTH = {"1-URGENT": "strong", "2-HIGH": "strong", "3-MEDIUM": "moderate"}
_SIGNIFICANCE = {"F": "significant", "O": "unclear", "P": "not_significant"}
_SEGMENT = {"BUILDING": "single_active", "AUTOMOBILE": "single_formulation", "FURNITURE": "multi_active_combination", "HOUSEHOLD": "procedure_adjunct_combination", "MACHINERY": "ambiguous"}


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """One row of evidence per line item."""
    line = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    customer = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    part = read_table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size", T.slug(F.col("p_brand")).alias("brand_key"), T.slug(F.col("p_type")).alias("type_key"))
    rows = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    look = lambda table, c, other: F.coalesce(T.lit_map(table)[F.col(c)], F.lit(other))
    labelled = rows.select(
        F.col("l_orderkey").cast("string").alias("pmid"), "l_linenumber", "l_partkey", "l_extendedprice", F.col("p_brand").alias("ingredient_name"), F.col("p_type").alias("target"), "brand_key", "type_key", F.col("l_linestatus").alias("target_category"), F.col("p_size"),
        look(_RELATION, "l_returnflag", "reduces").alias("relation"), look(_STRENGTH, "o_orderpriority", "weak").alias("strength"), look(_SIGNIFICANCE, "o_orderstatus", "unclear").alias("significance"), look(_SEGMENT, "c_mktsegment", "ambiguous").alias("attribution"),
    )
    weight = B.weight((F.col("strength"), B.STRENGTH_WEIGHT, 0.35), (F.col("significance"), B.SIGNIFICANCE_WEIGHT, 0.8), (F.col("attribution"), B.ATTRIBUTION_WEIGHT, 0.2))
    ids = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<int>")).otherwise(F.array((F.col("p_size") % 15 + 1).cast("int"), (F.col("p_size") * 7 % 15 + 1).cast("int")))
    return labelled.withColumns({"row_weight": weight, "effect_ids": ids, "usable": (F.col("significance") != "not_significant") & (F.col("attribution") != "ambiguous") & (F.col("strength") != "weak")})


_EVIDENCE = """(SELECT CAST(l_orderkey AS VARCHAR) AS pmid, p_brand AS ingredient_name, p_type AS target, l_linestatus AS target_category, relation, usable, row_weight, CASE WHEN p_size % 5 = 0 THEN [] ELSE [CAST(p_size % 15 + 1 AS INTEGER), CAST(p_size * 7 % 15 + 1 AS INTEGER)] END AS effect_ids FROM (
    SELECT *, round(CASE st WHEN 'strong' THEN 1.0::DOUBLE WHEN 'moderate' THEN 0.75::DOUBLE ELSE 0.35::DOUBLE END * CASE sg WHEN 'significant' THEN 1.0::DOUBLE WHEN 'not_significant' THEN 0.05::DOUBLE ELSE 0.8::DOUBLE END * CASE att WHEN 'single_active' THEN 1.0::DOUBLE WHEN 'single_formulation' THEN 0.8::DOUBLE WHEN 'multi_active_combination' THEN 0.45::DOUBLE WHEN 'procedure_adjunct_combination' THEN 0.35::DOUBLE ELSE 0.2::DOUBLE END, 6) AS row_weight, sg <> 'not_significant' AND att <> 'ambiguous' AND st <> 'weak' AS usable FROM (
    SELECT l_orderkey, p_brand, p_type, l_linestatus, p_size, CASE l_returnflag WHEN 'A' THEN 'improves' WHEN 'N' THEN 'increases' ELSE 'reduces' END AS relation, CASE o_orderpriority WHEN '1-URGENT' THEN 'strong' WHEN '2-HIGH' THEN 'strong' WHEN '3-MEDIUM' THEN 'moderate' ELSE 'weak' END AS st, CASE o_orderstatus WHEN 'F' THEN 'significant' WHEN 'P' THEN 'not_significant' ELSE 'unclear' END AS sg,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'single_active' WHEN 'AUTOMOBILE' THEN 'single_formulation' WHEN 'FURNITURE' THEN 'multi_active_combination' WHEN 'HOUSEHOLD' THEN 'procedure_adjunct_combination' ELSE 'ambiguous' END AS att
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)))"""


def order_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges (brand, effect, relation) over usable evidence."""
    e = evidence(spark, d).where("usable").select("pmid", "ingredient_name", "relation", "row_weight", F.explode("effect_ids").alias("effect_id"))
    return A.paper_support(e, ["ingredient_name", "effect_id", "relation"], "pmid", "row_weight")


def order_support(spark: SparkSession, d: str) -> DataFrame:
    """Canonical claims (brand, relation, type, status) with their support."""
    # the parts of the key are made where they are few, and put together after the aggregate
    parts = [F.col("brand_key"), T.canonical_relation(F.col("relation")), F.col("type_key"), F.lower("target_category")]
    e = evidence(spark, d).select(*(p.alias(f"k{i}") for i, p in enumerate(parts)), "pmid", "row_weight")
    support = A.paper_support(e, [f"k{i}" for i in range(4)], "pmid", "row_weight", "evidence_score", "paper_count_distinct")
    return support.select(F.concat_ws("|", *(f"k{i}" for i in range(4))).alias("canonical_claim_key"), "evidence_score", "paper_count_distinct")


def order_labels(spark: SparkSession, d: str) -> DataFrame:
    """Rows of evidence by attribution and strength, with the mean weight."""
    e = evidence(spark, d)
    return e.groupBy("relation", L.first_label([(F.col("usable"), "usable")], "held_back").alias("use")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("row_weight"), 6).alias("mean_weight"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (order_edges, order_support, order_labels)}


def oracle_sql() -> dict[str, str]:
    slug = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"
    key = f"concat_ws('|', {slug.format('ingredient_name')}, CASE relation WHEN 'increases' THEN 'improves' ELSE relation END, {slug.format('target')}, {slug.format('target_category')})"
    return {
        "order_edges": f"SELECT ingredient_name, effect_id, relation, round(ln(1 + sum(w)), 6) AS graph_score, CAST(count(*) AS INTEGER) AS paper_count FROM (SELECT ingredient_name, effect_id, relation, pmid, max(row_weight) AS w FROM (SELECT ingredient_name, relation, pmid, row_weight, unnest(effect_ids) AS effect_id FROM {_EVIDENCE} WHERE usable) GROUP BY ALL) GROUP BY 1, 2, 3",
        "order_support": f"SELECT canonical_claim_key, round(ln(1 + sum(w)), 6) AS evidence_score, CAST(count(*) AS INTEGER) AS paper_count_distinct FROM (SELECT {key} AS canonical_claim_key, pmid, max(row_weight) AS w FROM {_EVIDENCE} GROUP BY 1, 2) GROUP BY 1",
        "order_labels": f"SELECT relation, CASE WHEN usable THEN 'usable' ELSE 'held_back' END AS use, count(*) AS n, round(avg(row_weight), 6) AS mean_weight FROM {_EVIDENCE} GROUP BY 1, 2",
    }
