"""First-wins dedup and the two-level aggregates: the best of each paper, then the sum over papers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order. A null key is a key like any other.

    The order must be total for a rerun to choose alike. The winner is found by a partial aggregate on the order alone,
    not by a window, so a key that holds a third of all rows does not gather in one task.
    """
    names = [f"_o{i}" for i in range(len(order))]
    ranked = rows.withColumns({n: (F.col(o) if isinstance(o, str) else o) for n, o in zip(names, order, strict=True)})
    packed = F.struct(*(F.struct(F.col(n).isNotNull().alias("k"), F.col(n).alias("v")).alias(n) for n in names), F.struct(*rows.columns).alias("row"))
    return ranked.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min(packed)["row"].alias("row")).select("row.*")


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; among equals the one with the largest columns."""
    packed = F.struct(*order, F.struct(*rows.columns).alias("_row"))
    return rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.max(packed)["_row"].alias("_row")).select("_row.*")


def paper_support(rows: DataFrame, keys: Sequence[str], paper: str, weight: str, score: str = "graph_score", papers: str = "paper_count") -> DataFrame:
    """Per key: ln(1 + sum over papers of the paper's best weight), to six places, and the number of papers.

    A NaN or null weight counts as 0, its paper still counts; a null paper is one paper.
    """
    known = F.nanvl(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(0.0))
    best = rows.groupBy(*keys, F.coalesce(F.col(paper), F.lit("")).alias("_paper")).agg(F.greatest(F.max(known), F.lit(0.0)).alias("_best"))
    return best.groupBy(*keys).agg(F.round(F.log1p(F.sum("_best")), 6).alias(score), F.count(F.lit(1)).cast("int").alias(papers))


def canonical(rows: DataFrame, key: str, paper: str, weight: str, tier: str, ranks: dict[str, int], graph_tiers: Sequence[str], reco_tiers: Sequence[str], label: str, context: str, ordinal: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per canonical key: support and scores over all, graph and recommendation tiers, counts, the best tier,
    the most frequent label among the rows of the best tier (ties go to the one seen first) and the first row's names.
    """
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))[F.col(tier)], F.lit(0))
    first = F.struct(*ordinal)
    base = rows.withColumns({"_w": F.nanvl(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(0.0)), "_rank": rank, "_graph": F.coalesce(F.col(tier).isin(list(graph_tiers)), F.lit(False)), "_reco": F.coalesce(F.col(tier).isin(list(reco_tiers)), F.lit(False))})
    per_paper = base.groupBy(key, paper).agg(
        F.max("_w").alias("a"),
        F.max(F.when(F.col("_graph"), F.col("_w"))).alias("g"),
        F.max(F.when(F.col("_reco"), F.col("_w"))).alias("r"),
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.coalesce(F.nullif(F.trim(context), F.lit("")), F.lit("unknown"))).alias("c"),
        F.min(F.struct(first.alias("o"), F.struct(*names).alias("v"))).alias("f"),
        F.max("_rank").alias("t"),
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    whole = per_paper.groupBy(key).agg(
        F.sum("n").cast("int").alias("evidence_count_raw"),
        F.count(F.lit(1)).cast("int").alias("paper_count_distinct"),
        F.size(F.array_distinct(F.flatten(F.collect_set("c")))).alias("study_count_distinct"),
        F.round(zero("a"), 6).alias("paper_support_sum"),
        F.round(zero("g"), 6).alias("paper_support_sum_graph"),
        F.round(zero("r"), 6).alias("paper_support_sum_reco"),
        F.count("g").cast("int").alias("paper_count_graph"),
        F.count("r").cast("int").alias("paper_count_reco"),
        F.round(F.log1p(zero("a")), 6).alias("evidence_score"),
        F.round(F.log1p(zero("g")), 6).alias("graph_score"),
        F.round(F.log1p(zero("r")), 6).alias("recommendation_score_base"),
        F.max("t").alias("_top"),
        F.min("f")["v"].alias("_names"),
    )
    by_label = base.groupBy(key, "_rank", F.coalesce(F.col(label), F.lit("")).alias("_label")).agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_o"))
    top_count = by_label.groupBy(key, "_rank").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_o"), F.col("_label"))).alias("_m")).groupBy(key).agg(F.max_by(F.col("_m._label"), F.col("_rank")).alias("top_attribution_label"))
    by_rank = F.create_map(*(x for t, r in ranks.items() for x in (F.lit(r), F.lit(t))))
    return whole.join(top_count, key).select(key, *(F.col(f"_names.{n}").alias(n) for n in names), *(c for c in whole.columns if not c.startswith("_") and c != key), by_rank[F.col("_top")].alias("top_eligibility_tier"), "top_attribution_label", (F.col("graph_score") > 0).alias("is_graph_eligible"))


def inverted_index(rows: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """Per key the sorted distinct values of each column, joined by its separator; null and blank values go."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.array_join(F.array_sort(F.filter(F.collect_set(F.trim(c)), lambda v: v != "")), sep).alias(c) for c, sep in values.items()))


def function_edges(owners: DataFrame, owner: str, functions: str, mapping: DataFrame, seen: DataFrame | None = None, secondary: float = 0.6) -> DataFrame:
    """Edges (owner, effect, relation, score) from the functions in an array column and `mapping` (function, effects,
    relation, confidence). The first effect of a function scores its confidence, later ones less; of an edge found
    again the first stays, and edges already in `seen` go. `mapping` is a list of functions, broadcast after a count.
    """
    from quillstone.runtime import broadcast_if_small

    cells = owners.select(F.col(owner).alias("owner"), F.posexplode(functions).alias("_f", "function"))
    effects = cells.join(broadcast_if_small(mapping), "function").select("owner", "_f", "relation", "confidence", F.posexplode("effects").alias("_e", "effect"))
    score = F.when(F.col("_e") == 0, F.col("confidence")).otherwise(F.round(F.col("confidence") * secondary, 6))
    edges = effects.groupBy("owner", "effect", "relation").agg(F.min(F.struct("_f", "_e", score.alias("s")))["s"].alias("score"))
    return edges if seen is None else edges.join(seen.select("owner", "effect", "relation"), ["owner", "effect", "relation"], "left_anti")


def build_targets(rows: DataFrame, functions: str, keywords: dict[str, str], categories: dict[str, str], inactive: Sequence[str], other: str = "other") -> DataFrame:
    """Rows with `category` (of the first function that has one) and `keywords` (of all functions, in order, without
    repeats whatever the case, joined by '|'). Rows whose functions are all inactive go; rows without any stay."""
    from quillstone.functions.text import dedup_ci, function_names, lit_map, pipe_split

    names = F.coalesce(function_names(F.col(functions)), F.array().cast("array<string>"))
    words = F.flatten(F.transform(names, lambda f: F.coalesce(pipe_split(lit_map(keywords)[f]), F.array().cast("array<string>"))))
    kinds = F.filter(F.transform(names, lambda f: lit_map(categories)[f]), lambda c: c.isNotNull())
    active = (F.size(names) == 0) | F.exists(names, lambda f: ~f.isin(list(inactive)))
    return rows.where(active).withColumns({"category": F.coalesce(F.try_element_at(kinds, F.lit(1)), F.lit(other)), "keywords": F.array_join(dedup_ci(words), "|")})


def union_ids(rows: DataFrame, key: str, ids: dict[str, str]) -> DataFrame:
    """Per key the sorted distinct numbers in each array column, joined by '|' under the name given; first within a row
    of the key's parts, so that no part carries more than it adds."""
    none = F.array().cast("array<int>")
    cells = [rows.where(F.col(key).isNotNull()).select(F.col(key), F.lit(i).alias("_i"), F.explode(F.coalesce(F.col(c), none)).alias("_v")).distinct() for i, c in enumerate(ids)]
    flat = cells[0]
    for c in cells[1:]:
        flat = flat.unionByName(c)
    lists = [F.array_join(F.array_sort(F.collect_list(F.when(F.col("_i") == i, F.col("_v")))), "|").alias(name) for i, name in enumerate(ids.values())]
    found = flat.groupBy(key).agg(*lists)
    every = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return every.join(found, key, "left").select(key, *(F.coalesce(n, F.lit("")).alias(n) for n in ids.values()))


def caution(rows: DataFrame, *, node: str, concern_ids: str, paper: str, weight: str, relation: str, direction: str, attribution: str, concerns: DataFrame, attributions: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(edges, funnel) of what causes a concern.

    Rows count if they say 'causes' and 'supports', name one of `concerns` (concern_id, concern_code), their attribution
    is one of `attributions` and their node is known (not null). Edges are (node, concern_code, graph_score,
    paper_count); the funnel is one row: scanned, causes_supports, dropped_attribution, unmapped, selected.
    """
    from quillstone.runtime import broadcast_if_small

    ids = sorted({r["concern_id"] for r in concerns.select("concern_id").distinct().toLocalIterator()})  # of a taxonomy: some dozen
    seen = rows.withColumn("_hit", F.array_intersect(F.coalesce(F.col(concern_ids), F.array().cast("array<int>")), F.array(*map(F.lit, ids)).cast("array<int>")))
    causes = F.coalesce((F.col(relation) == "causes") & (F.col(direction) == "supports") & (F.size("_hit") > 0), F.lit(False))
    owed = F.coalesce(F.col(attribution).isin(list(attributions)), F.lit(False))
    mapped = F.col(node).isNotNull()
    funnel = seen.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(causes).alias("causes_supports"), F.count_if(causes & ~owed).alias("dropped_attribution"), F.count_if(causes & owed & ~mapped).alias("unmapped"), F.count_if(causes & owed & mapped).alias("selected"))
    chosen = seen.where(causes & owed & mapped).select(node, paper, weight, F.explode("_hit").alias("concern_id")).join(broadcast_if_small(concerns), "concern_id")
    return paper_support(chosen, [node, "concern_code"], paper, weight), funnel
