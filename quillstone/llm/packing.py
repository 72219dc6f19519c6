"""Filling containers of fixed capacity with texts.

Bin completion: the largest text left opens a container and the undominated fillings around it are enumerated, least
waste and largest texts first, along the sums that the sizes left can make, so that no branch of the enumeration is a
dead end. A branch of the search is pruned as soon as its waste exceeds what a solution with so many containers may
waste. The search goes from few to many discrepancies from the first filling and keeps the states it gave up on; the
last containers are searched without a bound on discrepancies. Best fit is the first incumbent. Blocks of texts are
filled independently; what sits in containers with room is gathered and filled again until one block is left.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.tokens import RANKS, TOKENIZERS, spread, with_tokens
from quillstone.runtime import cut

#: Texts filled together; a block's work is bounded by it.
BLOCK_ITEMS = 4_000
#: Undominated fillings tried for one container, and fillings looked at to find them.
FILLINGS, LOOKED = 64, 4_000
#: Containers opened in the search for one number of containers before the block keeps its incumbent.
NODES = 4_000
#: Containers at the end that are searched whatever the number of discrepancies.
ENDGAME = 6
#: Tasks that fill blocks at once; more blocks share them.
MOST_TASKS = 10_000
#: Numbers of discrepancies allowed, in order.
_WAVES = (0, 1, 2, 3, 4, 6, 8, 12, 16)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: containers as lists of item numbers."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rooms: list[tuple[int, int]] = []  # (room, container), sorted
    bins: list[list[int]] = []
    for i in order:
        at = bisect.bisect_left(rooms, (sizes[i], -1))
        if at == len(rooms):
            bins.append([i])
            bisect.insort(rooms, (capacity - sizes[i], len(bins) - 1))
        else:
            room, b = rooms.pop(at)
            bins[b].append(i)
            bisect.insort(rooms, (room - sizes[i], b))
    return bins


class _Left:
    """Sizes to be placed, largest first, and for every suffix of them the sums it can make, as bits."""

    def __init__(self, keys: list[int], counts: dict[int, int], capacity: int):
        self.keys, self.counts = keys, counts
        mask = (1 << (capacity + 1)) - 1
        self.reach = [1] * (len(keys) + 1)
        bits = 1
        for k in range(len(keys) - 1, -1, -1):
            size = keys[k]
            copies, step = min(counts[size], capacity // size), 1
            while copies > 0:
                some = min(step, copies)
                bits |= (bits << (size * some)) & mask
                copies -= some
                step *= 2
            self.reach[k] = bits

    def sums(self, k: int, left: int) -> Iterator[tuple[int, ...]]:
        """Ways to make exactly `left` from the sizes from the k-th on, the largest first."""
        if not left:
            yield ()
            return
        for j in range(bisect.bisect_left(self.keys, -left, lo=k, key=lambda size: -size), len(self.keys)):
            if not self.reach[j] >> left & 1:
                return
            size = self.keys[j]
            for copies in range(min(self.counts[size], left // size), 0, -1):
                rest = left - copies * size
                if self.reach[j + 1] >> rest & 1:
                    for tail in self.sums(j + 1, rest):
                        yield (size,) * copies + tail


def _fillings(keys: list[int], counts: dict[int, int], capacity: int, budget: int, looked: int = LOOKED) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(waste, sizes) of the undominated fillings around the largest size that waste at most `budget`, least waste first."""
    largest = keys[0]
    rest = dict(counts)
    rest[largest] -= 1
    if not rest[largest]:
        del rest[largest]
    left = _Left(keys if largest in rest else keys[1:], rest, capacity)
    room = capacity - largest
    for waste in range(min(budget, room) + 1):
        if not left.reach[0] >> (room - waste) & 1:
            continue
        for taken in left.sums(0, room - waste):
            looked -= 1
            if looked < 0:
                return
            if not _dominated(rest, taken, waste):
                yield waste, (largest, *taken)


def _dominated(rest: dict[int, int], taken: tuple[int, ...], waste: int) -> bool:
    """Whether a size that is left would fit too, or could take the place of a smaller one in the filling."""
    if not waste:
        return False
    return any(rest.get(size + more, 0) > taken.count(size + more) for size in {0, *taken} for more in range(1, waste + 1))


def _mark(size: int) -> int:
    """A number for a size such that sums of them tell states apart."""
    return (size * 0x9E3779B97F4A7C15 ^ (size + 0x7F4A7C15) * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF


def _search(counts: dict[int, int], capacity: int, target: int, fillings: int, nodes: int) -> list[tuple[int, ...]] | None:
    """A way to place every size in `target` containers, or None if the search finds none."""
    total = sum(s * c for s, c in counts.items())
    start = (sorted(counts, reverse=True), dict(counts), sum(_mark(s) * c for s, c in counts.items()))
    given_up: dict[tuple[int, int], int] = {}
    for wave in _WAVES:
        budget, allowed = target * capacity - total, wave
        chosen: list[tuple[int, ...]] = []
        # a frame: state, fillings still to come, how many were tried, waste and discrepancies allowed
        stack = [(start, _fillings(start[0], start[1], capacity, budget), 0, budget, allowed)]
        nodes -= 1
        while stack:
            (keys, left, mark), ways, tried, budget, allowed = stack.pop()
            del chosen[len(stack) :]
            n = target - len(stack)
            way = next(ways, None) if tried < fillings else None
            cost = tried if n > ENDGAME else 0
            if way is None or cost > allowed or n < 1:
                given_up[n, mark] = allowed
                continue
            stack.append(((keys, left, mark), ways, tried + 1, budget, allowed))
            waste, taken = way
            after = dict(left)
            gone = set()
            for s in taken:
                after[s] -= 1
                if not after[s]:
                    del after[s]
                    gone.add(s)
            chosen.append(taken)
            if not after:
                return chosen
            rest = (([k for k in keys if k not in gone] if gone else keys), after, mark - sum(map(_mark, taken)))
            if n == 1 or given_up.get((n - 1, rest[2]), -1) >= allowed - cost:
                continue
            nodes -= 1
            if nodes < 0:
                return None
            stack.append((rest, _fillings(rest[0], after, capacity, budget - waste), 0, budget - waste, allowed - cost))
    return None


def complete_bins(sizes: list[int], capacity: int, fillings: int = FILLINGS, nodes: int = NODES) -> list[list[int]]:
    """Containers as lists of item numbers; no size exceeds `capacity`. At most as many containers as best fit uses.

    Among as many containers those of the search are taken if they leave their room in fewer of them.
    """
    incumbent = best_fit(sizes, capacity)
    counts: dict[int, int] = {}
    for s in sizes:
        if s:
            counts[s] = counts.get(s, 0) + 1
    if not counts:
        return incumbent
    least = max(-(-sum(sizes) // capacity), sum(c for s, c in counts.items() if 2 * s > capacity))
    used = sum(1 for b in incumbent if any(sizes[i] for i in b))
    best: list[tuple[int, ...]] | None = None
    for target in range(least, used + 1):
        best = _search(counts, capacity, target, fillings, nodes)
        if best is not None:
            break
    if best is None or len(best) == used and sum(sum(f) ** 2 for f in best) <= sum(sum(sizes[i] for i in b) ** 2 for b in incumbent):
        return incumbent
    by_size: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        by_size.setdefault(sizes[i], []).append(i)
    bins = [[by_size[s].pop() for s in f] for f in best]
    bins[0] += by_size.get(0, [])  # empty texts need no room
    return bins


_PLACED = "doc_id long, piece_no int, n_tokens int, container_id string, room_left int"


def _fill(capacity: int, prefix: str, fillings: int, nodes: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece_no"], ignore_index=True)
        sizes = pdf["n_tokens"].tolist()
        where, room = [0] * len(sizes), [0] * len(sizes)
        for b, members in enumerate(complete_bins(sizes, capacity, fillings, nodes)):
            left = capacity - sum(sizes[i] for i in members)
            for i in members:
                where[i], room[i] = b, left
        return pdf[["doc_id", "piece_no", "n_tokens"]].assign(container_id=[f"{prefix}-{key[0]}-{b}" for b in where], room_left=room)

    return run


def pack(docs: DataFrame, capacity: int, *, doc_id: str = "doc_id", text: str = "text", block_items: int = BLOCK_ITEMS, fillings: int = FILLINGS, nodes: int = NODES, folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """doc_id, piece_no, start_token, n_tokens, container_id and room_left of every text, sized in tokens.

    A text within `capacity` is one piece, numbered 1. A longer one is split into pieces that fill a container each
    and a rest, which is packed like any text. Null texts are in no container (container_id and room_left null); empty
    ones take no room in one. Every text counts by itself, repeated texts too. Which texts share a container follows
    from hashed ids, so a rerun gives the same containers.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    sized = cut(with_tokens(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"], "n_tokens", folder, ranks))
    known = sized.where(F.col("n_tokens").isNotNull())
    cap = F.lit(capacity)
    parts = known.withColumn("_full", F.when(F.col("n_tokens") > cap, F.floor(F.col("n_tokens") / cap)).otherwise(0).cast("int")).withColumn(
        "_rest", F.when(F.col("n_tokens") > cap, F.col("n_tokens") % cap).otherwise(F.col("n_tokens")).cast("int")
    )
    full = parts.where("_full > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("_full"))).alias("piece_no"))
    full = full.select("doc_id", "piece_no", cap.cast("int").alias("n_tokens"), F.concat(F.lit("f-"), "doc_id", F.lit("-"), "piece_no").alias("container_id"), F.lit(0).alias("room_left"))
    items = parts.where("_rest > 0 or n_tokens = 0").select("doc_id", (F.col("_full") + 1).cast("int").alias("piece_no"), F.col("_rest").alias("n_tokens"))
    n_items = sized.count()
    blocks = max(1, -(-n_items // block_items))

    def fill(rows: DataFrame, level: int) -> DataFrame:
        # blocks by number, so that no task gets several because their bytes are few
        blocked = rows.withColumn("_block", spread("doc_id", blocks)).repartition(min(blocks, MOST_TASKS), "_block")
        return cut(blocked.groupBy("_block").applyInPandas(_fill(capacity, f"b{level}", fillings, nodes), _PLACED))

    placed = fill(items, 0)
    done: list[DataFrame] = []
    level = 0
    while blocks > 1:
        # what a block could not place without room left
        loose = placed.where("room_left > 0")
        n_loose = loose.count()
        if not n_loose:
            break
        level += 1
        blocks = max(1, min(blocks // 2, -(-n_loose // block_items)))
        done.append(placed.where("room_left = 0"))
        placed = fill(loose, level)
    out = placed
    for df in done:
        out = out.unionByName(df)
    out = out.unionByName(full).withColumn("start_token", ((F.col("piece_no") - 1) * cap).cast("int"))
    none = sized.where(F.col("n_tokens").isNull()).select("doc_id", F.lit(1).alias("piece_no"), F.lit(0).alias("start_token"), F.lit(None).cast("int").alias("n_tokens"), F.lit(None).cast("string").alias("container_id"), F.lit(None).cast("int").alias("room_left"))
    return out.select("doc_id", "piece_no", "start_token", "n_tokens", "container_id", "room_left").unionByName(none)
