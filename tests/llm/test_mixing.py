import random

import pytest

from quillstone.llm.mixing import fly, land, mix, plan, share_report


def test_flight_keeps_totals():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(0, 80)
        sizes = [float(rng.randint(1, 5) if rng.random() < 0.5 else rng.randint(1, 900)) for _ in range(n)]
        p = [rng.random()] * n
        q = fly(sizes, p)
        assert sum(1e-6 < x < 1 - 1e-6 for x in q) <= 2
        assert abs(sum(q) - sum(p)) < 1e-6 and abs(sum(a * b for a, b in zip(q, sizes)) - sum(a * b for a, b in zip(p, sizes))) < 1e-4
        got = land(sizes, q)
        assert set(got) <= {0, 1} and abs(sum(got) - sum(p)) <= 2


def test_plan():
    totals = {"a": (1000, 10), "b": (100, 5), "c": (0, 3)}
    rate = plan(totals, {"a": (0.5, 1), "b": (0.5, 4), "c": (0.1, 9), "none": (0.2, 1)})
    assert rate["b"] == pytest.approx(4) and rate["a"] == pytest.approx(0.4) and "c" not in rate
    assert plan(totals, {"a": (0.5, 1), "b": (0.5, 4)}, 10_000)["a"] == 1.0
    assert plan({}, {"a": (1.0, 1)}) == {}


@pytest.mark.parametrize("block", [20_000, 150])
def test_shares(spark, tokens_dir, block):
    rng = random.Random(8)
    rows = [(i, "word " * rng.randint(1, 40), "hot" if i % 3 else "small") for i in range(900)]
    rows += [(9000, None, "hot"), (9001, "", "small"), (9002, "x", None), (9003, "x", "unlisted")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, target_share double")
    targets = spark.createDataFrame([("hot", 0.3, 1), ("small", 0.6, 2), ("empty", 0.1, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    got = mix(docs, targets, block_docs=block, folder=tokens_dir)
    uses = {r.doc_id: r for r in got.collect()}
    assert set(uses) == set(range(900)) | {9000, 9001} and uses[9000].n_uses == uses[9001].n_uses == 0
    assert max(r.n_uses for r in uses.values() if r.source == "hot") <= 1 and max(r.n_uses for r in uses.values() if r.source == "small") <= 2
    report = {r.source: r for r in share_report(got, targets).collect()}
    assert report["hot"].reached_share == pytest.approx(1 / 3, abs=0.004) and report["small"].reached_share == pytest.approx(2 / 3, abs=0.004) and report["empty"].n_uses == 0
    assert mix(docs, targets.limit(0), folder=tokens_dir).count() == 0 and mix(docs.limit(0), targets, folder=tokens_dir).count() == 0
    again = mix(docs.repartition(7), targets, block_docs=block, folder=tokens_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_chances_are_chances():
    """Over many seeds each document is used as often as its chance says."""
    rng = random.Random(9)
    sizes = [float(rng.randint(1, 400)) for _ in range(40)]
    p = [rng.random() for _ in sizes]
    runs = 4000
    mean = [0.0] * len(p)
    for seed in range(runs):
        for i, x in enumerate(fly(sizes, p, random.Random(seed))):
            mean[i] += x / runs
    assert max(abs(m - x) for m, x in zip(mean, p)) < 4.5 * 0.5 / runs**0.5


def test_seeds_differ_and_repeat(spark, tokens_dir):
    docs = spark.createDataFrame([(i, "word " * (1 + i % 17), "a" if i % 2 else "b") for i in range(300)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    used = [{r.doc_id for r in mix(docs, targets, total_tokens=800, seed=s, folder=tokens_dir).collect() if r.n_uses} for s in (1, 1, 2)]
    assert used[0] == used[1] != used[2]


def test_a_giant_decided_last_is_made_good():
    rng = random.Random(11)
    sizes = [35_000.0, *(float(rng.randint(20, 900)) for _ in range(600))]
    p = [0.7] * len(sizes)
    for seed in range(20):
        got = land(sizes, fly(sizes, p, random.Random(seed)))
        assert abs(sum(k * s for k, s in zip(got, sizes)) - 0.7 * sum(sizes)) <= 2 and abs(sum(got) - 0.7 * len(sizes)) <= 2
