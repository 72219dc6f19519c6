import pytest
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import claims as K
from quillstone.operators import labels as B

TABLE = {"urea": "Urea", "niacinamide": "Niacinamide", "ceramide np": "Ceramide NP", "ceramide": "Ceramide"}


def of(spark, f, *values):
    """f of one row of text columns a, b, ..."""
    names = "abcdef"[: len(values)]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return df.select(f(*(F.col(n) for n in names)).alias("y")).head().y


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("RESULTS: The skin was calm.", True), ("Urea improved the skin barrier.", True), ("Urea improved oily areas.", True), ("Urea improved boiling points.", False), ("Drug delivery improved on skin.", False),
        ("METHODS: urea improved skin.", False), ("purposes: urea improved skin.", False), ("Results: we developed a cream for skin.", True), ("CER5 improved skin.", False), ("Cereals improved skin.", True),
        ("Conclusions: vehicle improved skin.", False), ("Vehicles improved skin.", True), ("", False), (" ", False), (None, False),
    ],
)
def test_claim_like(spark, text, wanted):
    assert of(spark, K.claim_like, text) is wanted


def test_context_and_excludes(spark):
    allows = lambda name, s: of(spark, lambda a, b: K.context_allows(a, b), name, s)
    assert allows("Niacinamide", "topical niacinamide") is True and allows("niacinamide", "it raised NAD+ in skin") is False
    assert allows("NIACINAMIDE", "niacinamide in rats") is False and allows("Niacinamide", "niacinamide cut sebum") is True and allows("Urea", "NAD in rats") is True
    out = lambda s, *p: of(spark, lambda a: B.excluded(a, F.array(*map(F.lit, p)), C.WHOLE_WORDS), s)
    assert out("NAD+ rose", "nad") is True and out("nadir", "nad") is False and out("xcer2y", "cer2") is True and out("a (NMN) b", "(nmn)") is True and out(None, "nad") is False
    assert of(spark, lambda a, b, c: K.review_style(a, b, c), "x", "A Systematic Review", None) is True and of(spark, lambda a, b, c: K.review_style(a, b, c), None, None, " Review ") is True
    assert of(spark, lambda a, b: K.hair_or_scalp(a, b), None, "Dandruff") is True and of(spark, lambda a, b: K.hair_or_scalp(a, b), None, None) is False


def test_rules_and_names(spark):
    rows = [
        ("Niacinamide", "Nia B3", "NIACINAMIDE|vit b3| nicotinamide |", "xx| yy", "TRUE "), ("Urea", None, None, None, "true"), ("Off", "o", "o", "", "false"), (None, "n", "n", "", "true"), ("Twice", "a", "b", "", "true"), ("Twice", "a", "c", "", "true"),
    ]
    rules = K.ingredient_rules(spark.createDataFrame(rows, "canonical_name string, query_name string, alias_list string, exclude_if_contains string, is_target string"))
    got = {r.canonical_name: (r.aliases, r.excludes) for r in rules.collect()}
    assert set(got) == {"Niacinamide", "Urea", "Twice"} and got["Niacinamide"][0] == ["Niacinamide", "Nia B3", "vit b3", "nicotinamide", "nia"]
    assert got["Niacinamide"][1][:2] == ["xx", "yy"] and "nad+" in got["Niacinamide"][1] and got["Urea"] == (["Urea"], []) and got["Twice"][0] == ["Twice", "a", "c"]
    look = {r.alias: r.canonical_name for r in K.alias_map(rules).collect()}
    assert look["vit b3"] == "Niacinamide" and look["txa"] == "Tranexamic acid" and look["vitamin c"] == "Ascorbic acid"
    names = spark.createDataFrame([(" VIT b3",), ("ceramide x 9",), ("Ceramide",), ("none",), ("",), (None,)], "n string")
    assert [r.normal_name for r in K.normal_names(names, "n", K.alias_map(rules)).collect()] == ["Niacinamide", "Ceramide", "Ceramide", None, None, None]
    assert K.ingredient_rules(spark.createDataFrame([], "canonical_name string, query_name string, alias_list string, exclude_if_contains string, is_target string")).count() == 0


def test_extraction(spark):
    name = lambda s: of(spark, lambda a: K.extracted_name(a, TABLE), s)
    assert name("Results: topical urea improved skin.") == "Urea" and name("The skin improved with ceramide np.") == "Ceramide NP"
    assert name("Urea, such as niacinamide, improved skin.") is None and name("Niacinamide raised NAD+ and improved skin.") is None and name("Urea improved wood.") is None and name(None) is None


def test_validation(spark):
    good = ("Urea", "Urea improved skin.", "Skin  hydration.", "improves", "efficacy", "supports", "0.7")
    fields = "normal_name string, source_sentence string, target string, relation string, claim_type string, evidence_direction string, confidence string"
    change = lambda **kw: tuple(kw.get(f.split()[0], v) for f, v in zip(fields.split(", "), good))
    rows = [good, change(confidence="high"), change(source_sentence=None), change(normal_name=None), change(source_sentence="Niacinamide improved skin."), change(target="benefits"), change(target=" "), change(relation="causes"), change(relation=" "), change(claim_type=None), change(evidence_direction=""), change(relation=None)]
    got = K.validated(spark.createDataFrame(rows, fields), TABLE).collect()
    assert [(r.target, r.confidence, r.source_sentence) for r in got] == [("hydration", 0.7, "Urea improved skin."), ("hydration", 0.0, "Urea improved skin."), ("hydration", 0.7, "")]
    more = "normal_name string, claim_type string, relation string, target string, target_category string, evidence_direction string, study_context string, confidence string"
    ok = ("Urea", " efficacy", "improves", "x", "effect", "neutral", "review", "1.7")
    rows = [ok, ok[:3] + ("Results",) + ok[4:], ok[:7] + ("n/a",), ok[:7] + (None,), ("Urea", "other") + ok[2:], (None,) + ok[1:], ok[:6] + (None,) + ok[7:]]
    df = spark.createDataFrame(rows, more)
    assert [(r.claim_type, r.confidence) for r in K.validated_by_lists(df).collect()] == [("efficacy", 1.0)]
    assert K.validated_by_lists(df, ["Zinc"]).count() == 0


def test_mentions_and_clauses(spark):
    said = lambda name, s: of(spark, lambda a, b: B.named(a, b), name, s)
    assert said("Tranexamic acid", "TXA helped") is True and said("Retinol", "retinols helped") is False and said("a.b", "axb") is False and said("", "x") is False and said(None, "x") is False and said("-", "a - b") is False
    assert said("Palm Peptide-3", "과연 palm peptide-3이 x") is False and said("Palm Peptide-3", "(palm peptide-3)") is True
    clause = lambda name, s: of(spark, lambda a, b: B.primary_clause(b, a), name, s)
    assert clause("urea", "It fell. Urea rose! Urea ended.") == "Urea rose!" and clause("zinc", " It fell. Urea rose. ") == "It fell. Urea rose." and clause("zinc", None) == ""


def test_attribution_and_reconciliation(spark):
    def label(s, *units, clause=None):
        u = F.array(*map(F.lit, units)).cast("array<string>")
        return of(spark, lambda a: B.attribution(a, F.lit("urea"), u, None if clause is None else F.lit(clause)), s)

    assert label("urea with micro-needling") == "procedure_adjunct_combination" and label("urea combined with a fractional laser", "Urea") == "procedure_adjunct_combination"
    assert label("urea cream following laser", "Urea") == "post_procedure_recovery_formulation" and label("urea after peeling", "Urea") == "procedure_adjunct_combination"
    assert label("urea and zinc healed", "Urea", "Zinc") == "multi_active_combination" and label("urea cream", "Urea") == "single_formulation" and label("zinc healed", "Zinc") == "ambiguous"
    assert label("urea was there and much later in one long sentence of many more words zinc healed", "Urea", "Zinc", clause="urea then zinc") == "multi_active_combination"
    far = "urea one two three four five six seven eight nine ten zinc"
    assert label(far, "Urea", "Zinc") == "single_active" and label(far.replace("two", "improved"), "Urea", "Zinc") == "multi_active_combination"
    lines = F.array(F.lit("[line:a]"), F.lit("[line:b]"))
    assert of(spark, lambda a: B.several_actives(a, lines), "x") is True
    again = lambda first, s, *units: of(spark, lambda a: B.reconciled(F.lit(first), a, F.array(*map(F.lit, units)).cast("array<string>")), s)
    assert again("single_active", "urea", "Urea") == "single_active" and again("single_active", "urea", "Urea", " Zinc") == "multi_active_combination" and again("ambiguous", "urea", "a", "b") == "ambiguous"
    assert again("single_active", "such as urea, zinc, and oil") == "multi_active_combination" and again("single_active", "platinum liposome\nceramide np") == "multi_active_combination"
    assert of(spark, lambda a: B.unit_count(F.array(a, F.lit(" "), F.lit("x "), F.lit("x"))), None) == 1


def test_cells(spark):
    cell = lambda c: of(spark, T.dict_cell_to_json, c)
    assert cell("{'a': 'None or True', 'b': None, 'c': True, 'd': 0, 'e': 2}") == '{"a":"None or True","c":"true","e":"2"}' and cell("{'a': None}") is None and cell("[1") is None and cell(None) is None
    assert of(spark, T.title_case, "alpha-arbutin 2b ÉTÉ") == "Alpha-Arbutin 2B Été" and of(spark, T.title_case, None) is None
    assert of(spark, T.float_int, "NaN") is None and of(spark, T.float_int, "1e99") is None and of(spark, T.float_int, " -3.9 ") == -3
    look = L.lookup({f"k{i}": i for i in range(1000)} | {"ü": -1}, "int")
    assert of(spark, look, "k999") == 999 and of(spark, look, "ü") == -1 and of(spark, look, "none") is None and of(spark, look, None) is None and of(spark, L.lookup({}, "int"), "x") is None
