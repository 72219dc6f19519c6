"""Queries of the general training-data operators over the whole tables, with their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.orphans import Reference, find_orphans, orphan_report
from quillstone.operators.packed import unpack
from quillstone.runtime import read_table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    targets = read_table(spark, d, "issue26_sebum_targets").where("ingredient_code is not null")
    parts = []
    for field in ("alias_list", "concern_keywords"):
        rows = targets.select(F.lit(field).alias("field_name"), F.col("ingredient_code").cast("string").alias("record_key"), field).distinct()
        parts.append(unpack(rows, field=field))
    papers = read_table(spark, d, "bronze_paper").where("pmid is not null")
    rows = papers.select(F.lit("authors").alias("field_name"), F.col("pmid").alias("record_key"), "authors").distinct()
    parts.append(unpack(rows, field="authors", people=True))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("field_name", "record_key", "pos", "item_value").distinct()


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Values per field and the longest list."""
    return p2_found(spark, d).groupBy("field_name").agg(F.count(F.lit(1)).alias("n_values"), F.countDistinct("record_key").alias("n_records"), F.max("pos").alias("longest"))


#: Fields of one plain style: parts between bars, or of persons between semicolons, and no other mark that could part or hold.
_PLAIN, _PLAIN_PEOPLE = r'^[^";/,、，；·&()\[\]\t\r\n]*$', r'^[^"|/,、，；·&()\[\]\t\r\n]*$'


def p2_plain(spark: SparkSession, d: str) -> DataFrame:
    """The values of the fields written in a style that a plain split can take apart."""
    t = read_table(spark, d, "issue26_sebum_targets").where("ingredient_code is not null")
    plain = [t.select(F.lit(f).alias("field_name"), F.col("ingredient_code").cast("string").alias("record_key"), F.col(f).alias("field")).where(F.col(f).rlike(_PLAIN) & F.contains(f, F.lit("|"))) for f in ("alias_list", "concern_keywords")]
    b = read_table(spark, d, "bronze_paper").where("pmid is not null").select(F.lit("authors").alias("field_name"), F.col("pmid").alias("record_key"), F.col("authors").alias("field"))
    keys = plain[0].unionByName(plain[1]).unionByName(b.where(F.col("field").rlike(_PLAIN_PEOPLE) & F.contains("field", F.lit(";")))).select("field_name", "record_key").distinct()
    return p2_found(spark, d).join(keys, ["field_name", "record_key"], "left_semi")


def _plain_sql() -> str:
    cells = "list_filter(list_transform(string_split(f, '{0}'), lambda x: trim(x, ' ')), lambda x: x <> '')"
    one = "SELECT DISTINCT '{n}' AS field_name, CAST({k} AS VARCHAR) AS record_key, {c} AS v FROM (SELECT {k}, {n} AS f FROM {t} WHERE {k} IS NOT NULL) WHERE regexp_matches(f, '{p}') AND contains(f, '{d}')"
    parts = [one.format(n=n, k="ingredient_code", t="issue26_sebum_targets", c=cells.format("|"), p=_PLAIN, d="|") for n in ("alias_list", "concern_keywords")]
    parts.append(one.format(n="authors", k="pmid", t="bronze_paper", c=cells.format(";"), p=_PLAIN_PEOPLE, d=";"))
    return f"SELECT DISTINCT field_name, record_key, CAST(i AS INTEGER) AS pos, v[i] AS item_value FROM ({' UNION ALL '.join(parts)}), range(1, 100000) r(i) WHERE i <= len(v)"


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    effects, concerns = read_table(spark, d, "gold_claim_effect_map"), read_table(spark, d, "gold_claim_concern_map")
    found = find_orphans(effects, read_table(spark, d, "gold_claim"), Reference("gold_claim_effect_map", "claim_key", "claim_key"))
    found = found.unionByName(find_orphans(effects, read_table(spark, d, "effect_taxonomy"), Reference("gold_claim_effect_map", "effect_id", "effect_id")))
    return found.unionByName(find_orphans(concerns, read_table(spark, d, "concern_taxonomy"), Reference("gold_claim_concern_map", "concern_id", "concern_id")))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p5_found(spark, d))


def _orphans_sql(table: str, field: str, parent: str, parent_key: str) -> str:
    tidy = "lower(trim(CAST({} AS VARCHAR), chr(32) || chr(9) || chr(10) || chr(13) || chr(160)))"
    return f"""
        SELECT DISTINCT '{table}' AS map_table, '{field}' AS field_name, r.claim_key, r.ref_value, r.period_month,
            CASE WHEN p.k IS NULL THEN 'missing' WHEN NOT p.act THEN 'deleted' WHEN p.oldest > r.created_at THEN 'late' END AS reason
        FROM (SELECT {tidy.format('claim_key')} AS claim_key, {tidy.format(field)} AS ref_value, strftime(created_at, '%Y-%m') AS period_month, created_at FROM {table}) r
        LEFT JOIN (SELECT {tidy.format(parent_key)} AS k, arg_max(coalesce(is_active, true), struct_pack(a := created_at, b := coalesce(is_active, true))) AS act, min(created_at) AS oldest FROM {parent} WHERE {parent_key} IS NOT NULL GROUP BY 1) p ON p.k = r.ref_value
        WHERE r.claim_key <> '' AND r.ref_value <> '' AND (p.k IS NULL OR NOT p.act OR p.oldest > r.created_at)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_counts, p2_plain, p5_found, p5_report)}


def oracle_sql() -> dict[str, str]:
    found = " UNION ALL ".join(
        (
            _orphans_sql("gold_claim_effect_map", "claim_key", "gold_claim", "claim_key"),
            _orphans_sql("gold_claim_effect_map", "effect_id", "effect_taxonomy", "effect_id"),
            _orphans_sql("gold_claim_concern_map", "concern_id", "concern_taxonomy", "concern_id"),
        )
    )
    return {"p2_plain": _plain_sql(), "p5_found": found, "p5_report": f"SELECT map_table, field_name, period_month, reason, count(*) AS n_references FROM ({found}) GROUP BY ALL"}
