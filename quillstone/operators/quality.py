"""Invariants of evidence tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """check, n_bad: rows for which a check does not hold (null counts as not), all in one pass."""
    counted = rows.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()))
    return counted.select(F.explode(F.map_from_arrays(F.array(*(F.lit(n) for n in checks)), F.array(*(F.col(n) for n in checks)))).alias("check", "n_bad"))


def require(rows: DataFrame, checks: Mapping[str, Column]) -> None:
    """Raises if any check fails on any row."""
    bad = [(r["check"], r["n_bad"]) for r in violations(rows, checks).toLocalIterator() if r["n_bad"]]
    if bad:
        raise ValueError(f"invariants broken: {bad}")


def in_list(value: Column, allowed: Sequence[str]) -> Column:
    return value.isin(list(allowed))


def at_least(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    return a + tolerance >= b


def counts_agree(a: DataFrame, b: DataFrame) -> Column:
    return F.lit(a.count() == b.count())


def graph_rows(tier: Column, units: Column, blocked: Column, suspect: Column, graph_tiers: Sequence[str] = ("strict_graph", "soft_graph"), strict: str = "strict_graph") -> dict[str, Column]:
    """Checks of rows that go into a graph: their tier, and for the strict one exactly one unit, not blocked nor suspect."""
    return {"graph_tier": tier.isin(list(graph_tiers)), "strict_one_unit": (tier != strict) | (units == 1), "strict_not_blocked": (tier != strict) | (~blocked & ~suspect)}


def compare(whole: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """check, n_bad: keys of `part` that `whole` lacks, and the difference in rows."""
    lost = part.select(*keys).join(whole.select(*keys).distinct(), list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit("part_of_whole").alias("check"), "n_bad")
    sizes = whole.select(F.lit(1).alias("w")).unionByName(part.select(F.lit(-1).alias("w"))).agg(F.abs(F.coalesce(F.sum("w"), F.lit(0))).alias("n_bad")).select(F.lit("as_many").alias("check"), F.col("n_bad").cast("long").alias("n_bad"))
    return lost.unionByName(sizes)


def constraints(rows: DataFrame, *, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), foreign: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """check, n_bad of the constraints of a table: null cells, keys that come more than once (a null in a key repeats
    nothing), and references (column to (parent, its key)) that lead nowhere; null references are none."""
    parts = []
    if not_null:
        parts.append(violations(rows, {f"not_null({c})": F.col(c).isNotNull() for c in not_null}))
    for keys in unique:
        twice = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        parts.append(twice.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(f"unique({', '.join(keys)})").alias("check"), "n_bad"))
    for column, (parent, key) in (foreign or {}).items():
        # one row per value referred to, so that a hot one is a row per task
        named = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        loose = named.join(parent.select(F.col(key).alias("_v")).distinct(), "_v", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_bad"))
        parts.append(loose.select(F.lit(f"foreign({column})").alias("check"), "n_bad"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
