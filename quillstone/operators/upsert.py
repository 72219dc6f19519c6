"""Writes into keyed tables as joins: upsert, insert-if-new, property updates, last-wins caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(table: DataFrame, incoming: DataFrame, key: str, order: Sequence[str], overwrite: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """`table` after rows of `incoming` arrived one by one in the given order.

    `overwrite` columns take the last value, null too; `fill` columns take the last value that is not null, else what
    the table had. A null key never meets another: such rows are appended. `order` must be total.
    """
    packed = F.struct(*order)
    folded = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(
        *(F.max(F.struct(packed.alias("o"), F.col(c).alias("v")))["v"].alias(c) for c in overwrite),
        *(F.max(F.when(F.col(c).isNotNull(), F.struct(packed.alias("o"), F.col(c).alias("v"))))["v"].alias(c) for c in fill),
    )
    new, old = folded.withColumn("_new", F.lit(True)).alias("n"), table.where(F.col(key).isNotNull()).alias("o")
    joined = old.join(new, key, "full_outer")
    take = [F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in overwrite]
    keep = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in fill]
    rest = [F.col(f"o.{c}").alias(c) for c in table.columns if c not in (key, *overwrite, *fill)]
    merged = joined.select(key, *take, *keep, *rest)
    nulls = table.where(F.col(key).isNull()).unionByName(incoming.where(F.col(key).isNull()).select(*(c for c in table.columns if c in incoming.columns)), allowMissingColumns=True)
    return merged.unionByName(nulls.select(*merged.columns))


def insert_new(table: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of `incoming` whose key the table does not have, the first of each key; a null in a key is always new."""
    whole = incoming.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    first = whole.groupBy(*keys).agg(F.min(F.struct(*order, F.struct(*(c for c in incoming.columns if c not in keys)).alias("_r")))["_r"].alias("_r"))
    fresh = first.join(table.select(*keys).distinct(), list(keys), "left_anti").select(*keys, "_r.*").select(*incoming.columns)
    return fresh.unionByName(incoming.where(" OR ".join(f"`{k}` IS NULL" for k in keys)))


def not_processed(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a counterpart in `done`: what an incremental run still has to do."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def set_properties(nodes: DataFrame, values: DataFrame, key: str, properties: Sequence[str]) -> DataFrame:
    """Nodes with new values of the properties where there are any."""
    joined = nodes.alias("n").join(values.select(key, *properties).alias("v"), key, "left")
    return joined.select(key, *(F.coalesce(F.col(f"v.{c}"), F.col(f"n.{c}")).alias(c) if c in properties else F.col(f"n.{c}").alias(c) for c in nodes.columns if c != key))


def insert_claims(claims: DataFrame, ingredients: DataFrame, effects: DataFrame, concerns: DataFrame, *, key: str = "claim_key", name: str = "ingredient_name", known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(claims, ingredient map, effect map, concern map) to add to a warehouse.

    A claim whose name has no ingredient is left out, and so are its map rows. `ingredients` is (ingredient_id, name);
    of several ids of a name the lowest counts. Map rows are (key, id, role or score): a repeated pair is added once,
    with its greatest score. Claims whose key is in `known` are there already; a null key is never added.
    """
    ids = ingredients.where("ingredient_id is not null").groupBy(F.col(name)).agg(F.min("ingredient_id").alias("ingredient_id"))
    once = claims.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*(c for c in claims.columns if c != key))).alias("_c")).select(key, "_c.*")
    if known is not None:
        once = once.join(known.select(key).distinct(), key, "left_anti")
    new = once.join(ids, name)
    owners = new.select(key)
    scored = lambda rows, ident: rows.where(F.col(ident).isNotNull()).groupBy(key, ident).agg(F.max("confidence_score").alias("confidence_score")).join(owners, key, "left_semi")
    return new.drop("ingredient_id"), new.select(key, "ingredient_id", F.lit("primary").alias("role"), "confidence_score"), scored(effects, "effect_id"), scored(concerns, "concern_id")


def replace_cached(cache: DataFrame, answers: DataFrame, key: str = "cache_key") -> DataFrame:
    """The cache after answers came in: an answer replaces the one there; of several the last by its columns."""
    from quillstone.operators.aggregate import last_wins

    fresh = last_wins(answers, [key], [c for c in answers.columns if c != key])
    return cache.join(fresh.select(key), key, "left_anti").unionByName(fresh)
