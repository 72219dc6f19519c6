import itertools
import random

import pytest

from quillstone.llm.packing import best_fit, complete_bins, pack
from quillstone.llm.tokens import encoding


def exact(sizes, capacity):
    """The fewest containers by trying partitions."""
    sizes = [s for s in sizes if s]
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


def test_valid_and_no_worse_than_best_fit():
    rng = random.Random(5)
    hits = 0
    for _ in range(300):
        cap = rng.randint(1, 40)
        sizes = [rng.randint(0, cap) for _ in range(rng.randint(0, 9))]
        bins = complete_bins(sizes, cap)
        assert sorted(itertools.chain(*bins)) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= cap for b in bins)
        used = sum(1 for b in bins if any(sizes[i] for i in b))
        assert used <= len(best_fit(sizes, cap))
        hits += used == exact(sorted(sizes, reverse=True), cap)
    assert hits >= 295


def test_texts(spark, tokens_dir):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["skin", "cream", "皮脂", "масло"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000, "word " * 900), (1001, ""), (1002, None), (1003, "same"), (1004, "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    cap = 128
    for block in (10_000, 40):
        got = pack(df, cap, block_items=block, folder=tokens_dir).collect()
        enc = encoding(tokens_dir)
        want = {i: None if t is None else len(enc.encode_ordinary(t)) for i, t in rows}
        have: dict = {}
        fill: dict = {}
        for r in got:
            have.setdefault(r.doc_id, []).append(r)
            if r.container_id:
                fill.setdefault(r.container_id, []).append(r)
        assert set(have) == set(want) and have[1002][0].container_id is None
        for i, n in want.items():
            if n is not None:
                assert sum(r.n_tokens for r in have[i]) == n
                assert len(have[i]) == 1 or n > cap
        for members in fill.values():
            used = sum(r.n_tokens for r in members)
            assert used <= cap and {r.room_left for r in members} == {cap - used}
        sizes = [r.n_tokens for r in got if r.container_id]
        assert len(fill) <= len(best_fit(sizes, cap)) * 1.02 + 2
    assert pack(df.limit(0), cap, folder=tokens_dir).count() == 0
    with pytest.raises(ValueError):
        pack(df, 0)


def planted(rng, containers, capacity, low, high):
    sizes = []
    for _ in range(containers):
        cuts = sorted(rng.sample(range(1, capacity), rng.randint(low, high) - 1))
        sizes += [b - a for a, b in zip([0, *cuts], [*cuts, capacity], strict=True)]
    rng.shuffle(sizes)
    return sizes


@pytest.mark.parametrize(("capacity", "low", "high"), [(1000, 2, 4), (1000, 3, 5), (512, 2, 6), (2048, 3, 6)])
def test_planted_perfect_packings_are_found(capacity, low, high):
    """Best fit finds hardly any of them."""
    found = greedy = 0
    for seed in range(60):
        sizes = planted(random.Random(seed), 30, capacity, low, high)
        bins = complete_bins(sizes, capacity)
        assert sorted(itertools.chain(*bins)) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= capacity for b in bins)
        found += len(bins) == 30
        greedy += len(best_fit(sizes, capacity)) == 30
    assert found >= 50 and greedy <= 5
