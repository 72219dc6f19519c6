"""Assembly and checks of node and edge tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.aggregate import first_wins


def union_first(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of several tables by key, blank keys dropped; an earlier table wins, within one the smallest row."""
    parts = [t.withColumn("_from", F.lit(i)) for i, t in enumerate(tables)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    known = both.where(F.trim(F.col(key).cast("string")) != "")
    columns = [c for c in known.columns if c not in ("_from", key)]
    return first_wins(known, [key], ["_from", *columns]).drop("_from")


def retain(old: DataFrame, new: DataFrame, keys: Sequence[str], starts: DataFrame, start: str, ends: DataFrame, end: str) -> DataFrame:
    """`new` with the edges of `old` whose ends still exist and that `new` does not have."""
    alive = old.join(starts.select(F.col(starts.columns[0]).alias(start)).distinct(), start, "left_semi").join(ends.select(F.col(ends.columns[0]).alias(end)).distinct(), end, "left_semi")
    return alive.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def name_lookup(names: DataFrame, ident: str, spellings: Sequence[str], order: str, valid: DataFrame | None = None, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """spelling (small letters), ident: of several records with a spelling the one with the lowest `order` wins. Only
    idents in the first column of `valid` count, if given; an entry of `overrides` (spelling to ident) wins over all
    records, if its ident counts."""
    if valid is not None:
        ids = valid.select(F.col(valid.columns[0]).alias(ident)).distinct()
        names = names.join(ids, ident, "left_semi")
    cells = names.where(F.col(ident).isNotNull()).select(F.col(ident).alias("ident"), F.col(order).alias("_o"), F.explode(F.array(*(F.col(s) for s in spellings))).alias("spelling"))
    flat = cells.select("ident", "_o", F.lower(F.trim("spelling")).alias("spelling")).where("spelling <> ''")
    found = flat.groupBy("spelling").agg(F.min(F.struct("_o", "ident"))["ident"].alias("ident"))
    if not overrides:
        return found
    fixed = names.sparkSession.createDataFrame([(k.lower(), v) for k, v in overrides.items()], "spelling string, ident string")
    if valid is not None:
        fixed = fixed.join(ids.select(F.col(ident).alias("_id")), F.col("ident") == F.col("_id"), "left_semi")
    return found.join(fixed, "spelling", "left_anti").unionByName(fixed)


def first_match(keys: DataFrame, key: str, lookup: DataFrame, ident: str) -> DataFrame:
    """`keys` with the one `ident` that `lookup` has for the key, the lowest of several, null for none."""
    one = lookup.groupBy(F.col(key)).agg(F.min(ident).alias(ident))
    return keys.join(one, key, "left")


def map_names(rows: DataFrame, name: str, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their `ident`, and the distinct names without one."""
    keyed = rows.withColumn("_name", F.lower(F.trim(name)))
    look = lookup.withColumnRenamed("spelling", "_name")
    return keyed.join(look, "_name").drop("_name"), keyed.join(look, "_name", "left_anti").select(F.col(name).alias("unmapped_name")).distinct()


def code_pairs(left: DataFrame, right: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pairs of `wanted` (left code, right code) of which both codes exist."""
    a, b = wanted.columns[:2]
    return wanted.join(left.select(F.col(left.columns[0]).alias(a)), a, "left_semi").join(right.select(F.col(right.columns[0]).alias(b)), b, "left_semi").select(a, b).distinct()


def integrity(nodes: DataFrame, node: str, edges: DataFrame, ends: Sequence[str]) -> DataFrame:
    """problem, n: blank node ids, repeated ones, and edge ends without a node."""
    ids = nodes.select(F.trim(F.col(node).cast("string")).alias("id"))
    out = ids.agg(F.count_if(F.coalesce(F.col("id") == "", F.lit(True))).alias("n")).select(F.lit("blank_node").alias("problem"), "n")
    repeated = ids.where("id <> ''").groupBy("id").count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("repeated_node").alias("problem"), "n")
    out = out.unionByName(repeated)
    for end in ends:
        loose = edges.select(F.col(end).cast("string").alias("id")).join(ids.distinct(), "id", "left_anti").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(loose.select(F.lit(f"dangling_{end}").alias("problem"), "n"))
    return out


def edge_merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Edges after a merge: those of `incoming` replace or join those of `existing`."""
    kept = existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*keys, *values).unionByName(incoming.select(*keys, *values))


def merge_edges(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], values: Sequence[str], starts: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges after a merge, incoming edges that were skipped). An incoming edge whose two ends exist replaces or joins
    those there; one without is skipped. `keys` begins with start and end; `starts` and `ends` have ids in their first
    column. Of incoming edges with equal keys the last by its values counts."""
    start, end = keys[:2]
    named = lambda df, c: df.select(F.col(df.columns[0]).alias(c)).distinct()
    known = incoming.join(named(starts, start), start, "left_semi").join(named(ends, end), end, "left_semi")
    skipped = incoming.select(*keys).exceptAll(known.select(*keys))
    once = known.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_v")).select(*keys, "_v.*")
    return edge_merge(existing, once, keys, values), skipped


def corrections(nodes: DataFrame, incoming: DataFrame, key: str, value: str) -> DataFrame:
    """matched: incoming keys that are nodes; corrected: those whose value differs from one the node has."""
    both = nodes.select(key, F.col(value).alias("_old")).join(incoming.select(key, F.col(value).alias("_new")), key)
    return both.agg(F.countDistinct(key).alias("matched"), F.count_if(F.col("_old") != F.col("_new")).alias("corrected"))


def meeting(left: DataFrame, right: DataFrame, pairs: Mapping[str, Sequence[str]], score: float = 1.0) -> DataFrame:
    """(left id, right id, score) of the rows whose codes are one of `pairs`. `left` and `right` are (id, code)."""
    spark = left.sparkSession
    (lid, lcode), (rid, rcode) = left.columns[:2], right.columns[:2]
    wanted = spark.createDataFrame([(a, b) for a, many in pairs.items() for b in many], f"{lcode} string, {rcode} string")
    return left.join(wanted, lcode).join(right, rcode).select(lid, rid, F.lit(score).alias("priority_score"))
