"""Mixing sources to target shares by balanced sampling (the cube method).

Each document of a source starts with the same expected number of uses. Its whole part is used as it is; the fraction
is an inclusion probability. The flight phase moves three probabilities at a time along the null space of the balancing
equations (tokens, documents) until one of them is 0 or 1, so both totals stay what they were. Blocks of documents fly
independently; the two that each leaves undecided fly again together, level by level, until one block per source is
left. The landing decides its last two by the smallest error in tokens and makes that good by exchanges.
"""

from __future__ import annotations

import bisect
import random
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.tokens import RANKS, TOKENIZERS, spread, with_tokens
from quillstone.runtime import broadcast_if_small, cut

#: Documents that fly together.
BLOCK_DOCS = 20_000
#: Exchanges at most that make good what the landing is off by.
EXCHANGES = 64
#: Tasks in which blocks fly at once; more blocks share them.
MOST_TASKS = 10_000
_EDGE = 1e-9


def fly(sizes: list[float], chances: list[float], lot: random.Random | None = None) -> list[float]:
    """The flight phase: probabilities with all but at most two at 0 or 1 and the same totals of p and p * size. Each
    step is drawn by lot so that the expected value of every probability stays what it was."""
    lot = lot or random.Random(0)
    p = list(chances)
    live: list[int] = []
    rest = iter(i for i, x in enumerate(p) if _EDGE < x < 1 - _EDGE)
    while True:
        while len(live) < 3:
            nxt = next(rest, None)
            if nxt is None:
                return p
            live.append(nxt)
        a, b, c = live
        # null space of (1, 1, 1) and (size_a, size_b, size_c): their cross product
        u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(live, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if lot.random() * (up + down) < down else -down
        for i, d in zip(live, u, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
        live = [i for i in live if _EDGE < p[i] < 1 - _EDGE]


def land(sizes: list[float], chances: list[float]) -> list[int]:
    """Decides the few probabilities left so that the total of sizes changes least; ties go to fewer uses."""
    open_ = [i for i, x in enumerate(chances) if _EDGE < x < 1 - _EDGE]
    due = sum(chances[i] * sizes[i] for i in open_)
    best = min(product((0, 1), repeat=len(open_)), key=lambda pick: (abs(due - sum(k * sizes[i] for k, i in zip(pick, open_, strict=True))), sum(pick)), default=())
    out = [round(x) for x in chances]
    for k, i in zip(best, open_, strict=True):
        out[i] = k
    # what the last ones are off by, exchanging used documents for unused ones makes good: one, or a few where a
    # document far larger than the others was decided last
    off = due - sum(out[i] * sizes[i] for i in open_)
    for _ in range(EXCHANGES):
        ins = sorted((sizes[i], i) for i in range(len(out)) if not out[i])
        swap: tuple[float, int, int] | None = None
        for i in range(len(out)):
            if out[i]:
                at = bisect.bisect_left(ins, (sizes[i] + off, -1))
                for size, j in ins[max(0, at - 1) : at + 1]:
                    left = abs(off - (size - sizes[i]))
                    if left < abs(off) and (swap is None or (left, i, j) < swap):
                        swap = (left, i, j)
        if swap is None:
            break
        off -= sizes[swap[2]] - sizes[swap[1]]
        out[swap[1]], out[swap[2]] = 0, 1
        if abs(off) < 1:
            break
    return out


_FLOWN = "doc_id long, source string, n_tokens int, base int, chance double"


def _flight(last: bool, seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # the largest first, so that what is left undecided is small
        pdf = pdf.sort_values(["n_tokens", "doc_id"], ascending=[False, True], ignore_index=True)
        sizes = pdf["n_tokens"].astype(float).tolist()
        # the same lot for the same block, wherever and however often it is computed
        chances = fly(sizes, pdf["chance"].tolist(), random.Random(f"{seed} {key} {len(pdf)} {pdf['doc_id'].min()}"))
        if last:
            chances = [float(x) for x in land(sizes, chances)]
        return pdf[["doc_id", "source", "n_tokens", "base"]].assign(chance=chances)

    return run


def plan(totals: dict[str, tuple[int, int]], targets: dict[str, tuple[float, int]], total_tokens: int | None = None) -> dict[str, float]:
    """Expected uses per document of each source, from {source: (tokens, documents)} and {source: (share, max_repeats)}.

    Without `total_tokens` the mix is as large as exact shares allow: the scarcest source that has tokens, at
    max_repeats, sets the size. A larger `total_tokens` is kept for the sources that can give it; the others stop at
    max_repeats, which the report shows. Sources without tokens give nothing; the shares of the rest are kept in
    proportion to each other.
    """
    have = {s: t for s, (t, _) in totals.items() if t > 0 and s in targets and targets[s][0] > 0 and targets[s][1] > 0}
    if not have:
        return {}
    listed = sum(targets[s][0] for s in have)
    share = {s: targets[s][0] / listed for s in have}
    size = total_tokens if total_tokens is not None else min(have[s] * targets[s][1] / share[s] for s in have)
    return {s: min(float(targets[s][1]), size * share[s] / have[s]) for s in have}


def mix(docs: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_docs: int = BLOCK_DOCS, folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """doc_id, source, n_tokens and n_uses of every document of a source in `targets` (source, target_share, max_repeats).

    Documents of a null or unlisted source are not in the result; null and empty texts are, with 0 uses. No document
    is used more than max_repeats times. A negative or null share counts as 0. The totals of tokens and documents of
    each source are met to within the size of one document. The flight draws by lot from `seed`; the same seed and
    tables give the same mix. `targets` is read to the driver: a list of sources.
    """
    share = F.greatest(F.coalesce(F.col("target_share"), F.lit(0.0)), F.lit(0.0))
    asked = {r["source"]: (float(r["share"]), int(r["most"])) for r in targets.where("source is not null").groupBy("source").agg(F.sum(share).alias("share"), F.coalesce(F.min("max_repeats"), F.lit(0)).alias("most")).toLocalIterator()}
    names = docs.sparkSession.createDataFrame([(s,) for s in asked], "source string")
    listed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")).join(broadcast_if_small(names), "source", "left_semi")
    sized = cut(with_tokens(listed, "text", ["doc_id", "source"], "n_tokens", folder, ranks).withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0))))
    totals = {r["source"]: (int(r["tokens"]), int(r["n"])) for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).toLocalIterator()}
    rates = plan(totals, asked, total_tokens)
    rate_rows = [(s, int(rates.get(s, 0.0) + _EDGE), max(0.0, rates.get(s, 0.0) - int(rates.get(s, 0.0) + _EDGE))) for s in asked]
    rate = docs.sparkSession.createDataFrame(rate_rows, "source string, base int, chance double")
    start = sized.join(broadcast_if_small(rate), "source").withColumns({"base": F.when(F.col("n_tokens") > 0, F.col("base")).otherwise(0), "chance": F.when(F.col("n_tokens") > 0, F.col("chance")).otherwise(0.0)}).select("doc_id", "source", "n_tokens", "base", "chance")
    settled = f"chance <= {_EDGE} or chance >= {1 - _EDGE}"
    done = [start.where(settled)]
    flying = start.where(f"not ({settled})")
    largest = max((n for s, (_, n) in totals.items() if rates.get(s, 0.0) > 0), default=0)
    while True:
        blocks = max(1, -(-largest // block_docs))
        blocked = flying.withColumn("_block", spread("doc_id", blocks)).repartition(max(1, min(blocks * len(rates), MOST_TASKS)), "source", "_block")
        flown = cut(blocked.groupBy("source", "_block").applyInPandas(_flight(blocks == 1, seed), _FLOWN))
        done.append(flown.where(settled))
        if blocks == 1:
            break
        flying = flown.where(f"not ({settled})")
        largest = min(largest - 1, 2 * blocks)
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out.select("doc_id", "source", "n_tokens", (F.col("base") + F.round("chance")).cast("int").alias("n_uses"))


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source: target_share, documents used, uses, tokens and the share of all tokens reached."""
    per = mixed.groupBy("source").agg(F.count_if(F.col("n_uses") > 0).alias("n_used"), F.sum("n_uses").cast("long").alias("n_uses"), F.sum(F.col("n_uses") * F.col("n_tokens").cast("long")).alias("mix_tokens"))
    per = per.withColumn("_all", F.sum("mix_tokens").over(Window.partitionBy(F.lit(1))))  # one row per listed source
    listed = targets.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    rows = listed.join(per, "source", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        "source",
        "target_share",
        "max_repeats",
        F.coalesce("n_used", zero).alias("n_used"),
        F.coalesce("n_uses", zero).alias("n_uses"),
        F.coalesce("mix_tokens", zero).alias("mix_tokens"),
        F.round(F.coalesce(F.col("mix_tokens") / F.col("_all"), F.lit(0.0)), 6).alias("reached_share"),
    )
