import pytest

from quillstone.operators.packed import learn_tails, rule_of, skeleton, unpack

CASES = [
    ('"Oil of Ridge"|"1,4-Ridge dimer"|"C13/18 Ridge esters"', False, ["Oil of Ridge", "1,4-Ridge dimer", "C13/18 Ridge esters"]),
    ('Tosfizic complex; "Tosfizic, dried"; "Tosfizic|Polvox blend"', False, ["Tosfizic complex", "Tosfizic, dried", "Tosfizic|Polvox blend"]),
    ("Plopaermin (rac., mono);INCI 6591", False, ["Plopaermin (rac., mono)", "INCI 6591"]),
    ("Boxraeldiol (NP; AP)|Boxraeldiol, dried", False, ["Boxraeldiol (NP; AP)", "Boxraeldiol, dried"]),
    ("Ridge, dried", False, ["Ridge, dried"]),
    ("red, hot skin", False, ["red, hot skin"]),
    ('"A ""plus"""|B "gold"', False, ['A "plus"', 'B "gold"']),
    ("itch,blackheads , chin bumps", False, ["itch", "blackheads", "chin bumps"]),
    ("1,4-Sepurmdiol", False, ["1,4-Sepurmdiol"]),
    ("AHA/BHA peel / itch", False, ["AHA/BHA peel", "itch"]),
    ("a b\tc\td", False, ["a b", "c", "d"]),
    ("oil；nose，x、y", False, ["oil", "nose", "x", "y"]),
    ("; ;a; ;b;", False, ["a", "b"]),
    ("pores and plugs", False, ["pores and plugs"]),
    ("Lala Traltine; Soris G. Fultine", True, ["Lala Traltine", "Soris G. Fultine"]),
    ("Cergov, Gora", True, ["Cergov, Gora"]),
    ("Cergov, Gora; Galtel, Drosa B.", True, ["Cergov, Gora", "Galtel, Drosa B."]),
    ("Mergom P,Cuzvari PB,de la Morvix T", True, ["Mergom P", "Cuzvari PB", "de la Morvix T"]),
    ("Tromen Bembel, and Graro M. Rultari", True, ["Tromen Bembel", "Graro M. Rultari"]),
    ("A. Bee, Cee Dee & Eff Gee", True, ["A. Bee", "Cee Dee", "Eff Gee"]),
    ("Dinis S. Luzvel, Jr.; Zenis Pleskom", True, ["Dinis S. Luzvel, Jr.", "Zenis Pleskom"]),
    ("Skin & Scalp Methods Forum", True, ["Skin & Scalp Methods Forum"]),
    ("Working Party on Dry Skin and Scalp", True, ["Working Party on Dry Skin and Scalp"]),
    ("세모린·나루온·나루온", True, ["세모린", "나루온", "나루온"]),
    ("하늬솔, 모가람", True, ["하늬솔", "모가람"]),
    ('"Druzvov, Domen";"Gumi ""Stoli"" Gambov"', True, ["Druzvov, Domen", 'Gumi "Stoli" Gambov']),
    ("A Bee\r\nC Dee", True, ["A Bee", "C Dee"]),
    ("A Bee / C Dee", True, ["A Bee", "C Dee"]),
]


@pytest.mark.parametrize("people", [False, True])
def test_values(spark, people):
    cases = [(i, t) for i, (t, p, _) in enumerate(CASES) if p == people]
    got: dict[int, list] = {}
    for r in unpack(spark.createDataFrame(cases, "i int, f string"), field="f", people=people).collect():
        got.setdefault(r.i, []).append((r.pos, r.item_value))
    for i, text in cases:
        assert [v for _, v in sorted(got[i])] == CASES[i][2], text
        assert [p for p, _ in sorted(got[i])] == list(range(1, len(CASES[i][2]) + 1))


def test_nulls_repeats_and_length(spark):
    rows = [(1, None, "x"), (2, "  ", "x"), (3, "|;|", None), (4, "a|b", "k"), (4, "a|b", "k"), (5, "word;" * 5000, None)]
    got = unpack(spark.createDataFrame(rows, "i int, f string, reason string"), field="f").groupBy("i").count().collect()
    assert {r.i: r["count"] for r in got} == {4: 4, 5: 5000}
    assert unpack(spark.createDataFrame([], "i int, f string"), field="f").count() == 0
    clash = spark.createDataFrame([(1, "a|b", 7, "x", 8)], "i int, f string, POS int, item_value string, _rule int")
    assert sorted(map(tuple, unpack(clash, field="f").collect())) == [(1, 1, "a"), (1, 2, "b")]


def test_skeletons_do_not_grow_with_the_fields(spark):
    from pyspark.sql import functions as F

    rows = [(";".join(f"Name{j}x Sur{i}" for j in range(1 + i % 9)),) for i in range(200)]
    assert spark.createDataFrame(rows, "f string").select(skeleton(F.col("f"), True)).distinct().count() <= 3


def test_rules():
    assert rule_of("w,w", False) == "comma" and rule_of("w,w", True) == "one" and rule_of("", False) == "one"


def test_tails_are_learned(spark):
    """What follows a comma inside quotes or between sure delimiters, again and again, parts nothing elsewhere either."""
    rows = [(i, f'Term{i} X, sun-baked|Other {i}') for i in range(6)] + [(10, '"A, sun-baked", B'), (11, "Plain, Sun-baked, itch"), (12, "x, itch|itch|y"), (13, "itch, z")]
    df = spark.createDataFrame(rows, "i int, f string")
    assert learn_tails(df, "f") == ("sun-baked",)
    got: dict[int, list] = {}
    for r in unpack(df, field="f").collect():
        got.setdefault(r.i, []).append((r.pos, r.item_value))
    assert sorted(got[11]) == [(1, "Plain, Sun-baked"), (2, "itch")] and sorted(got[10]) == [(1, "A, sun-baked"), (2, "B")] and sorted(got[13]) == [(1, "itch"), (2, "z")]
    assert learn_tails(df.limit(0), "f") == ()
