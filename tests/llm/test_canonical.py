import random

import pytest

from quillstone.llm.canonical import Lexicon, deletes, distance, fold, map_to_list, misses

NAMES = {1: "Vorpladamide AP", 2: "Vorpladamide NP", 3: "Palmpezaest Peptide-3", 4: "Palmpezaest Peptide-7", 5: "Ridge Clover Leaf Extract", 6: "Zinc Golfirmate", 7: "1,3-Kemplaemdiol", 8: "Grenkiamic Acid", 9: "Zebaenic Acid", 10: "Ridge Thistle Root Extract"}
MEANT = {
    "vorpladamide ap": 1, "VorpladamideAP*": 1, "AP, Vorplaadmide": 1, "Vоrрlаdаmidе АР": 1, "Vorpladam1de AP.": 1, "5% Vorpladamide NP cream": 2, "Palmpezaest pept. 7": 4, "Peptide-3 Palmpezaest": 3,
    "Ridge Clover Leaf EXT.": 5, "Extract, Ridge Clover Leaf": 5, "Zinc Golfirmate (w/w)": 6, "GOLFIRMATE ZINC": 6, "Zinc Gol…": 6, "1,3-Kem..": 7, "1,﻿3-Kemplaemdiol 2%": 7, "Grénkiamic ac.": 8,
    "topical Grekniamic Acid": 8, "Acid Zebaenic": 9, "purifeid Zebaenic Acid": 9, "Ｚｅｂａｅｎｉｃ Ａｃｉｄ": 9, "RIDGE THI…": 10, "placebo": -1, "-": -1, "n/a": -1, "Monstontic Acid": -1, "Beet Husk Powder": -1,
}


@pytest.fixture(scope="module")
def lexicon():
    return Lexicon(NAMES, {1: 50}).build()


@pytest.mark.parametrize("typed", list(MEANT))
def test_meant(lexicon, typed):
    assert lexicon.resolve(typed)[0] == MEANT[typed]


def test_ties_go_to_the_more_frequent(lexicon):
    assert lexicon.resolve("Vorpladamide")[0] == 1
    assert Lexicon(NAMES, {2: 9}).build().resolve("Vorpladamide")[0] == 2


def test_lookup_finds_what_brute_force_finds(lexicon):
    """Every value within two edits of a name is found, as a comparison with the whole list finds it."""
    rng = random.Random(3)
    flat = {t: "".join(ch for ch in fold(n) if ch.isalnum()) for t, n in NAMES.items()}
    for _ in range(400):
        term = rng.choice(list(NAMES))
        s = list(flat[term])
        for _ in range(rng.randint(1, 2)):
            i = rng.randrange(len(s))
            kind = rng.randrange(4)
            if kind == 0:
                s[i] = rng.choice("abcxyz")
            elif kind == 1:
                s.insert(i, rng.choice("abcxyz"))
            elif kind == 2:
                del s[i]
            elif i + 1 < len(s):
                s[i], s[i + 1] = s[i + 1], s[i]
        typed = "".join(s)
        near = sorted((distance(typed, f), -lexicon.frequency.get(t, 0), t) for t, f in flat.items())
        if near[0][0] <= 2.0:
            got, cost = lexicon.resolve(typed)
            assert got >= 0 and cost <= near[0][0] + 0.11, (typed, got, near[0])


def test_distance():
    assert distance("abcd", "abcd") == 0 and distance("ab", "ba") == 0.9 and distance("prote1n", "protein") == 0.5
    assert distance("peptide3", "peptide7") == 3.0 and distance("nelplleerin", "nelplerin") == 1.2
    assert set(deletes("abc", 1)) == {"abc", "ab", "ac", "bc"}


def test_table(spark):
    terms = spark.createDataFrame([(t, "i", n) for t, n in NAMES.items()] + [(99, None, None)], "term_id int, kind string, canonical_name string")
    rows = [("a", "i", "vorpladamide ap", 1), ("a", "i", "vorpladamide ap", 1), ("b", "i", "Zinc Golfirmate", 1), ("c", "i", None, 1), ("d", "i", "  ", 1), ("e", None, "x", 1), ("f", "i", "x" * 20_000, 1), ("g", "other", "Zinc Golfirmate", None)]
    df = spark.createDataFrame(rows, "k string, kind string, v string, canonical_name int")
    want = [("a", 1), ("a", 1), ("f", -1), ("g", -1)]
    for shard in (1000, 3):
        got = map_to_list(df, terms, kind="kind", value="v", shard_terms=shard)
        assert sorted((r.k, r.term_id) for r in got.collect()) == want
    assert {(r.typed_value[:3], r.n_rows) for r in misses(got, "kind", "v").collect()} == {("xxx", 1), ("Zin", 1)}
    assert map_to_list(df, terms.limit(0), kind="kind", value="v").where("term_id >= 0").count() == 0
    clash = spark.createDataFrame([("i", "x", 5, 1.0, 2)], "kind string, v string, TERM_ID int, cost double, _n int")
    assert [tuple(r) for r in map_to_list(clash, terms, kind="kind", value="v").collect()] == [("i", "x", -1)]
    assert map_to_list(df.limit(0), terms, kind="kind", value="v").count() == 0


def test_building_again_changes_nothing():
    a = Lexicon(NAMES, {}).build()
    before = ({k: list(v) for k, v in a.exact.items()}, {k: list(v) for k, v in a.begins.items()}, dict(a.near), dict(a.begun))
    a.build()
    assert before == (a.exact, a.begins, a.near, a.begun)


def test_any_number_of_decorating_words(lexicon):
    assert lexicon.resolve("Zinc Golfirmate " + "topical purified serum cream " * 40)[0] == 6
    assert lexicon.resolve(" " * 30_000 + "Zinc Golfirmate")[0] == 6
    assert lexicon.resolve("Zinc Golfirmate " + "unrelated words " * 40)[0] == -1


def test_two_look_alike_letters_beat_one_other_edit():
    lex = Lexicon({1: "mabrum", 2: "nadrim"}, {1: 1, 2: 9}).build()
    assert distance("mabrim", "mabrum") == 1.0 and distance("mabrim", "nadrim") == 1.0
    assert lex.resolve("mabrim")[0] == 2  # as near, and used more often


def test_decoration_is_learned(spark):
    terms = spark.createDataFrame([(t, "i", n) for t, n in NAMES.items()], "term_id int, kind string, canonical_name string")
    rows = [("i", f"{n}, glorb week {k}") for k, n in enumerate(NAMES.values())] + [("i", "glorb Zinc Golfrmate"), ("i", "Golfirmate blib, Zinc"), ("i", "6 glorb acid zebaenic, week")]
    got = {r.v: r.term_id for r in map_to_list(spark.createDataFrame(rows, "kind string, v string"), terms, kind="kind", value="v").collect()}
    assert [got[v] for _, v in rows] == [*NAMES, 6, -1, 9]


def test_recall_against_every_distance(spark, data):
    """Of the free values of the test data, all that lie within the edits allowed of a name are mapped to the nearest."""
    from quillstone.llm.canonical import _reach
    from quillstone.llm.queries import _typed

    flat: dict[str, dict[str, list[int]]] = {}
    for t in spark.read.parquet(f"{data}/canonical_terms.parquet").collect():
        flat.setdefault(t.kind, {}).setdefault("".join(ch for ch in fold(t.canonical_name) if ch.isalnum()), []).append(t.term_id)
    checked = missed = 0
    for r in _typed(spark, data).select("kind", "typed", "term_id").distinct().collect():
        v = "".join(ch for ch in fold(r.typed) if ch.isalnum())
        near = sorted((distance(v, f), f) for f in flat[r.kind] if abs(len(f) - len(v)) <= 2)
        near = [(d, f) for d, f in near if d <= min(_reach(len(v)), _reach(len(f)))]
        if near:
            checked += 1
            missed += r.term_id not in {t for d, f in near if d == near[0][0] for t in flat[r.kind][f]}
    assert checked > 50 and missed <= 0.01 * checked
