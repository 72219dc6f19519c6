import random
import re
import unicodedata

import pytest

from quillstone.llm.lookalike import canonical_text, lookalike_members, lookalike_pairs, tables

SAME = [
    ("Naïve users", "Naïve users"), ("Naïve", "Nаїvе"), ("cream", "с​reаm"), ("a b", "a b"), ("a b", "a　b"), ("ABC 1.5", "ＡＢＣ　１．５"), ("ﬁne ﬂow", "fine flow"), ("4 ℃", "4 °C"), ("Ⅱ", "II"),
    ("한글", "한글"), ("皮脂", "⽪脂"), ("见", "⻅"), ("ガ", "ｶﾞ"), ("。", "｡"), ("Ρet", "Pet"), ("well-known", "well‑known"), ("x­y", "xy"), ("µg", "μg"), ("a…", "a..."), ("‥b", "..b"),
]
DIFFERENT = [("cm2", "cm²"), ("Naive", "Naïve"), ("abc", "Abc"), ("a.", "a!"), ("½", "1/2"), ("a b", "ab"), ("β", "b"), ("a\nb", "a b"), ("①", "1")]


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.canonical_text for r in canonical_text(df).orderBy("doc_id").collect()]


def test_same_and_different(spark):
    flat = forms(spark, [x for p in SAME + DIFFERENT for x in p])
    pairs = list(zip(flat[::2], flat[1::2]))
    for (a, b), p in zip(pairs, SAME + DIFFERENT):
        assert (a == b) == (p in SAME), p


def test_idempotent_and_keeps_plain_text(spark):
    rng = random.Random(4)
    chars = list(tables()[0])[:400] + list(tables()[1])[:200] + list("abcXYZ é２ ")
    texts = ["".join(rng.choice(chars) for _ in range(20)) for _ in range(200)] + ["plain text, 1.5!", "", None, "​"]
    once = forms(spark, texts)
    assert forms(spark, once) == once and once[-4:] == ["plain text, 1.5!", "", None, ""]


def test_agrees_with_python(spark):
    """Against the Unicode database by another way: compatibility forms of letters and blanks, then composition."""
    texts = ["Ｔｈｅ ﬀ ｆｌｏｗ", "ｱｲｳ ﾊﾟ", "㎎ ㎝", "𝐀𝐛", "É́x", "ﻻ"]
    want = [re.sub("​", "", unicodedata.normalize("NFKC", t)) for t in texts]
    assert forms(spark, texts) == want


def test_pairs(spark):
    rows = [(1, "cream"), (2, "сream"), (3, "cream"), (4, "Cream"), (5, None), (6, ""), (7, "​"), (8, "other"), (9, "other")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, class_id int")
    assert sorted(map(tuple, lookalike_pairs(df).collect())) == [(1, 2), (2, 3)]
    assert lookalike_pairs(df.limit(0)).count() == 0


def test_hot_text(spark):
    """A text that most documents share makes no pairs and is in no join."""
    rows = [(i, "the same text") for i in range(20_000)] + [(20_000, "x у"), (20_001, "x y")]
    assert sorted(map(tuple, lookalike_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == [(20_000, 20_001)]


def test_hot_text_with_another_spelling(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(3000 + i, "the sаme text") for i in range(3)] + [(4000, "тhe same text"), (4001, "ｔhe same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] != b[1] and "т" not in a[1] + b[1]}
    for hot in (100, 10_000):
        got = [tuple(r) for r in lookalike_pairs(df, hot_copies=hot).collect()]
        assert len(got) == len(want) and set(got) == want
    members = {r.doc_id: (r.class_id, r.n_links) for r in lookalike_members(df).collect()}
    assert set(members) == {i for p in want for i in p} and len({c for c, _ in members.values()}) == 1
    assert members[0][1] == 4 and members[3000][1] == 3001 and members[4001][1] == 3003
    assert lookalike_members(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [50_000])
def test_long_text(spark, n):
    assert forms(spark, ["сｒ" * n])[0] == "cr" * n
