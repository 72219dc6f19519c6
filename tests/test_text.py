from pyspark.sql import functions as F

from quillstone.functions import lexicon as L
from quillstone.functions import text as T


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).head().y


def test_lists(spark):
    assert one(spark, " a | |1b|", T.pipe_split) == ["a", "1b"]
    assert one(spark, None, T.pipe_split) is None
    assert one(spark, [" A", "a", "b ", "", "B"], T.dedup_ci, "array<string>") == ["A", "b"]
    assert one(spark, "SKIN CONDITIONING - HUMECTANT; tonic", T.function_names) == ["SKIN CONDITIONING", "TONIC"]
    assert one(spark, "3|x|1.0|nan|3", T.pipe_ints) == [1, 3]


def test_sentences_and_offsets(spark):
    text = "First sentence. Second sentence."
    got = one(spark, text, lambda c: T.with_offsets(c, T.plain_sentences(c)))
    assert [(r.part, r.start_at, r.end_at) for r in got] == [("First sentence.", 0, 15), ("Second sentence.", 16, 32)]
    assert one(spark, "See e.g. this. Dr. Y left!", T.plain_sentences) == ["See e.g. this.", "Dr. Y left!"]
    assert one(spark, "", T.word_count) == 0


def test_keys(spark):
    assert one(spark, " Brand#2  x ", T.slug) == "brand_2_x"
    assert one(spark, None, T.slug) == "unknown"
    assert one(spark, "Increases ", T.canonical_relation) == "improves"
    assert one(spark, "results: It works", T.strip_heading) == "It works"
    assert one(spark, "1.0", T.safe_int) is None and one(spark, "12", T.safe_int) == 12 and one(spark, "1.9", T.float_int) == 1


def test_query_text(spark):
    got = one(spark, "urea", lambda c: T.boolean_query(c, F.lit("Carbamide|UREA"), F.lit(None).cast("string"), F.lit("face"), F.lit("diet|food"), ("skin",), ("barrier",)))
    assert got == '("urea"[Title/Abstract] OR "Carbamide"[Title/Abstract]) AND ("skin"[Title/Abstract]) AND ("barrier"[Title/Abstract]) AND ("face"[Title/Abstract]) AND NOT ("diet"[Title/Abstract] OR "food"[Title/Abstract])'


def test_dict_cells(spark):
    assert one(spark, "{'a': '5', 'b': None, 'c': ''}", T.dict_cell_to_json) == '{"a":"5"}'
    assert one(spark, "{'b': None}", T.dict_cell_to_json) is None


def test_dictionary(spark):
    table = L.alias_table([("acid", "Acid"), ("lactic acid", "Lactic acid"), ("AHA", "Old"), ("aha", "New")], {"urea": "Urea"})
    assert table["aha"] == "New"
    assert one(spark, "Urea and lactic acid", lambda c: L.alias_matches(c, table)) == ["urea", "lactic acid"]
    assert one(spark, "Urea and lactic acid", lambda c: L.best_alias(L.alias_matches(c, table), table)) == "lactic acid"
    assert one(spark, "topical urea beats lactic acid", lambda c: L.subject(c, table, L.PREFIX_PATTERNS)) == "Urea"
    assert one(spark, "spoiled samples", lambda c: L.words_any(c, ("oil",))) is False
    assert one(spark, "platinum liposome\npanthenol\n", lambda c: L.line_units(c, L.VERB_HINTS)) == ["[line:platinum liposome]", "[line:panthenol]"]
    assert one(spark, "one line", lambda c: L.line_units(c, L.VERB_HINTS)) == []
