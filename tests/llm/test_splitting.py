import random

import pytest

from quillstone.llm.sentences import sentence_spans
from quillstone.llm.splitting import pieces, split_oversized


def check(text, size, overlap):
    got = pieces(text, size, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(0 <= b - a <= size for a, b in got)
    for (a, b), (c, d) in zip(got, got[1:]):
        assert c == b - overlap and c >= a and d > b
    # an exact round trip: the first piece and what each later one adds
    assert text == text[: got[0][1]] + "".join(text[p[1] : q[1]] for p, q in zip(got, got[1:]))
    return got


def test_random_texts():
    rng = random.Random(2)
    for _ in range(2000):
        size = rng.randint(1, 60)
        check("".join(rng.choice("ab .\n;,。é́)") for _ in range(rng.randint(0, 300))), size, rng.randint(0, size - 1))


def test_cuts_at_sentences():
    text = " ".join(f"Sentence number {i} is here." for i in range(100))
    ends = {a for a, _ in sentence_spans(text)}
    assert all(b in ends for _, b in check(text, 300, 40)[:-1])


def test_sections_before_sentences():
    text = "One. " * 20 + "\n\n" + "Two. " * 20
    assert check(text, 130, 10)[0][1] == text.index("Two")


def test_no_boundary_at_all():
    assert len(check("x" * 1000, 100, 20)) == 13
    with pytest.raises(ValueError):
        pieces("abc", 2, 2)


def test_table(spark):
    rows = [("p", 1, "a" * 30, 100, 7), ("p", 1, "a" * 30, 100, 7), ("q", 2, "b" * 30, None, 7), ("r", 3, "short", 5, 7), ("s", 4, None, 5, 7), (None, None, "", 1, 7)]
    df = spark.createDataFrame(rows, "pmid string, n int, t string, off int, piece_no int")
    got = split_oversized(df, "t", ["pmid", "n"], 20, 5, "off").collect()
    assert sorted((r.pmid, r.piece_no, r.start_char, r.source_offset) for r in got if r.pmid == "p") == [("p", 1, 0, 100), ("p", 2, 10, 110)]
    assert {r.source_offset for r in got if r.pmid == "q"} == {None} and {r.pmid for r in got} == {"p", "q"}
    assert split_oversized(df.limit(0), "t", ["pmid"], 20, 5).count() == 0
