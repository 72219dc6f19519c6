import random

import pytest

from quillstone.llm.sentences import sentence_offsets, sentence_spans, sentences

CASES = {
    "First one. Second one.": 2,
    "Dr. Y met Prof. Z at 9 a.m. on Monday. They left.": 2,
    "The mean was 12.11 ± 1.2 vs. 1.93 in the arm. Nobody asked.": 2,
    "Smith et al. (2019) saw it, cf. Fig. 7B. See Tab. 3 for more.": 2,
    "By J. K. Rowe, e.g. at wk. 12. Then it ended.": 2,
    "“Never again!” was the note left by a user.": 1,
    "“It felt cool,” said Dr. B, “but no.” Then he left.": 2,
    "He wrote, “It stung! Then it got better.” on day 3.": 1,
    "Subjects were asked: “How is it today?” surface pH was read.": 2,
    "«Al principio arde. Luego no.», dijo una voluntaria. ¿Sirve X? ¡Casi nadie!": 3,
    "Am 2. Mai 2017 begann es. Die 5. Gruppe bekam X bzw. nur Y, z. B. am Abend.": 2,
    "Hr. Dr. B fragte: „Wie fühlt sich die Haut an?“ Sechs Personen (rd. 9 %) gingen.": 2,
    "Six sujets, c.-à-d. 7 %, ont arrêté. « Ça pique ! C'est fini. », a noté M. Roux.": 2,
    "В 2002 г. опыт повторили, т. е. снова. Д-р Б спросил: «Как кожа?» См. рис. 8 и табл. 1.": 3,
    "（除外した51例は付録3に示す。）赤みは減った。「どうですか？」と学生が尋ねた。": 3,
    "“脱屑怎么样？”护士问道。报告了相同趋势……但样本很小。差异为1.5倍，显著！": 3,
    "모공이 “좋아졌다.”고 적었다. 값은 34.13이다(P = 0.1). 어떨까?": 3,
    "मी कम हुई। “पहले जलन हुई। फिर ठीक।” एक महिला ने लिखा।": 2,
    "هل يفيد حقا؟ قال د. B إن الماء بقي عند 47.35؛ ثم انخفض.": 2,
    "มี9คนถอนตัว ครีมที่มีMagnesium Groxgozateช่วยลด ผลดี": 3,
    "มี9คนถอนตัว In phase II, it was mixed. ช่วยลด": 3,
    "It works.[3] Next came B. [4,5] End": 3,
    "RESULTS:\nA fell. B rose\nslowly.": 2,
    "No end mark\n\nNew part": 2,
    "It was dry ... lip dryness fell. Lost at 9% … and came back.": 3,
    "It was done.CONCLUSION: it helps. See www.a.org/p.27 and run.2.csv v. 5.6.1.": 3,
    "1. Wash. 2. Dry": 2,
    "...": 1,
    " \n\t": 0,
    "": 0,
}


@pytest.mark.parametrize("text", list(CASES))
def test_cases(text):
    spans = sentence_spans(text)
    assert len(spans) == CASES[text], [text[a:b] for a, b in spans]


def test_spans_cover_all_but_blanks():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("aB1 .!?。“”(）「」\n…é́ก ") for _ in range(rng.randint(0, 60)))
        spans = sentence_spans(text)
        kept = "".join(text[a:b] for a, b in spans)
        assert "".join(kept.split()) == "".join(text.split())
        assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_long_text_is_linear():
    assert len(sentence_spans("He said “yes” (twice). " * 20_000)) == 20_000
    assert len(sentence_spans("(" * 50_000 + "abc. Bcd")) == 2


def test_table(spark):
    rows = [("k1", "One. Two.", "clash"), ("k1", "One. Two.", "clash"), ("k2", None, None), (None, "Three.", None), ("k3", " ", "x")]
    got = sentences(spark.createDataFrame(rows, "key string, t string, sentence_no string"), "t", ["key"]).collect()
    assert sorted((r.key or "", r.sentence_no, r.start_char, r.end_char, r.sentence) for r in got) == [("", 1, 0, 6, "Three."), ("k1", 1, 0, 4, "One."), ("k1", 2, 5, 9, "Two.")]
    assert sentences(spark.createDataFrame([], "key string, t string"), "t", ["key"]).count() == 0


def test_nothing_is_forgotten_however_far_back():
    deep = "(" * 100 + "One. Two." + ")" * 100 + " Three."
    assert sentence_spans(deep)[0][1] > 200  # the outermost bracket still holds what it opened before a hundred others
    assert len(sentence_spans("x" * 500 + " U.S. forces left. " + "A." * 300 + "B rose. It fell.")) == 3
    for text in ("a." * 100_000, "(“" * 100_000 + "x. Y”" * 100_000, "A.b" * 100_000, "1.”" * 100_000, "see www.x" + ".Ab" * 100_000):
        assert sentence_spans(text)  # in time linear in the text


def test_offsets_without_texts(spark):
    rows = [("k1", "One. Two."), ("k1", "One. Two."), ("k2", None), (None, "Three."), ("k3", " "), ("k4", "𝐀 bad. Cat dim.")]
    df = spark.createDataFrame(rows, "key string, t string")
    got = sentence_offsets(df, "t", ["key"])
    assert sorted((r.key or "", r.sentence_no, r.start_char, r.end_char) for r in got.collect()) == [("", 1, 0, 6), ("k1", 1, 0, 4), ("k1", 2, 5, 9), ("k4", 1, 0, 6), ("k4", 2, 7, 15)]
    assert {(r.key, r.sentence) for r in sentences(df, "t", ["key"]).collect() if r.key == "k4"} == {("k4", "𝐀 bad."), ("k4", "Cat dim.")}
    assert sentence_offsets(df.limit(0), "t", ["key"]).count() == 0
