from quillstone.plans import evidence as E
from quillstone.plans import training

_PAPER = "batch_id string, pmid string, title string, abstract_text string, journal string, publication_year int, authors string, doi string, pmcid string"


def test_papers_keep_all_authors_and_sections(spark, tmp_path):
    rows = [
        ("b", "1", "T", "Aim. RESULTS: A & b fell.\nCONCLUSION: It <works>.", "J", 2020, "Tola Londux; Lendov, Drosa|Vuli", None, None),
        ("b", "2", "T", "RESULTS: one", "J", None, None, "10.1/x", "PMC1"),
        ("b", "3", "T", "Tags: none", "J", 2020, " ", None, None),
        ("b", "4", "T", "plain", "J", 2020, "Plurnith RV, Vundom B", None, None),
        ("b", "4", "T", "plain", "J", 2020, "Plurnith RV, Vundom B", None, None),
        ("b", "5", "T", "plain", "J", 2020, '; "Dana ""Zali"" Cernom"', None, None),
    ]
    spark.createDataFrame(rows, _PAPER).write.parquet(str(tmp_path / "bronze_paper.parquet"))
    got = {r.pmid: (r.abstract_text, r.authors) for r in E.papers_from_xml(spark, str(tmp_path)).collect()}
    assert got == {
        "1": ("Aim.\nRESULTS: A & b fell.\nCONCLUSION: It <works>.", "Tola Londux; Lendov, Drosa; Vuli"),
        "2": ("RESULTS: one", None),
        "3": ("Tags: none", None),
        "4": ("plain", "Plurnith RV; Vundom B"),
        "5": ("plain", 'Dana "Zali" Cernom'),
    }


def test_papers_lose_none(spark, data):
    papers = E.papers_from_xml(spark, data)
    kept = E.silver_papers(spark, data).where(r"regexp_replace(abstract_text, '\\s+', '') <> ''")
    assert papers.select("pmid").distinct().count() == kept.count()
    items = training.queries()["p2_found"](spark, data).where("field_name = 'authors'")
    want = {}
    for r in items.collect():
        want.setdefault(r.record_key, {})[r.pos] = " ".join(r.item_value.split())
    rows = papers.collect()
    assert all(r.authors == "; ".join(v for _, v in sorted(want[r.pmid].items())) for r in rows if r.authors is not None)
    assert {r.pmid for r in rows if r.authors is not None} == {r.pmid for r in rows} & set(want)


def test_targets_by_the_full_lists(spark, tmp_path):
    rows = [
        ("wrinkle", "reduces", "wrinkle depth", False, True),
        ("pore", "reduces", " Pore visibility", False, True),
        ("tone", "improves", "uneven skin tone", True, True),  # holds the pattern 'ven'
        ("eight", "reduces", "redness of the skin on both cheeks daily", False, True),
        ("nine", "reduces", "redness of the skin on both cheeks every day", True, True),
        ("cells", "stimulates", "skin cell migration", True, False),
        ("causes", "causes", "facial redness", False, True),
        ("not", "does_not_cause", "sebum output", False, False),
        ("more", "Increases ", "skin tolerance", False, True),
        ("generic", "reduces", "treatments", True, True),
        ("none", "reduces", None, True, True),
    ]
    spark.createDataFrame([r[:3] for r in rows], "claim_key string, relation string, target string").write.parquet(str(tmp_path / "gold_claim.parquet"))
    got = {r.claim_key: (r.rejected, r.compatible) for r in E.target_filters(spark, str(tmp_path)).collect()}
    assert got == {r[0]: r[3:] for r in rows}


def _mapping_tables(spark, folder):
    for kind, rows in {
        "effect": [(1, "SOOTHING", "Soothing", True), (2, "SEBUM_REGULATION", "Sebum regulation", True), (3, "FLAKE_CALMING", "Flake calming", True), (4, "ANTI_AGING", "Anti-aging", False), (5, "BARRIER_REPAIR", "Barrier repair", True)],
        "concern": [(1, "OILY_SKIN", "Oily skin", True), (2, "REDNESS", "Redness", True), (3, "PORE_MARKS", "Pore marks", True), (4, "ACNE", "Acne", False)],
    }.items():
        spark.createDataFrame(rows, f"{kind}_id int, {kind}_code string, {kind}_name_en string, is_active boolean").write.parquet(f"{folder}/{kind}_taxonomy.parquet")
    claims = [
        ("pores", "reduces", "pore visibility", None, ""),
        ("guard", "increases", "facial redness", "The barrier held.", None),
        ("both", "reduces", "facial redness", "The barrier held, less oiliness.", None),
        ("name", "supports", "x", "FLAKE CALMING was seen on pore marks.", None),
        ("off", "reduces", "wrinkle", None, "acne"),
        ("null", None, "redness", None, None),
        ("unlisted", "reduces", "comedone and xerosis", None, None),
    ]
    spark.createDataFrame(claims, "claim_key string, relation string, target string, source_sentence string, claim_text string").write.parquet(f"{folder}/gold_claim.parquet")


def test_mapping_by_taxonomy(spark, tmp_path):
    _mapping_tables(spark, tmp_path)
    codes = lambda f: {r.claim_key: r.codes for r in f(spark, str(tmp_path)).collect()}
    assert codes(E.effect_mentions) == {"pores": "SEBUM_REGULATION", "guard": "", "both": "BARRIER_REPAIR|SEBUM_REGULATION|SOOTHING", "name": "FLAKE_CALMING|SEBUM_REGULATION", "off": "", "null": "", "unlisted": "COMEDOLYTIC"}
    assert codes(E.concern_mentions) == {"pores": "", "guard": "BARRIER_DAMAGE|REDNESS", "both": "BARRIER_DAMAGE|OILY_SKIN|REDNESS", "name": "PORE_MARKS", "off": "AGING_SIGNS", "null": "REDNESS", "unlisted": "COMEDONES|DRY_SKIN"}


def test_mapping_as_sql(spark, data, tmp_path):
    import duckdb

    _mapping_tables(spark, tmp_path)
    for folder in (data, tmp_path):
        db = duckdb.connect()
        for t in ("gold_claim", "effect_taxonomy", "concern_taxonomy"):
            db.sql(f"create view {t} as select * from '{folder}/{t}.parquet{'/*.parquet' if folder == tmp_path else ''}'")
        for f, sql in ((E.effect_mentions, E._mapped_sql("effect", E.L.EFFECT_SYNONYMS, E.L.EFFECT_RELATIONS)), (E.concern_mentions, E.SQL["concern_mentions"])):
            assert sorted(map(tuple, f(spark, str(folder)).collect())) == sorted(db.sql(sql).fetchall())


def test_aliases_and_tags(spark, tmp_path):
    spark.createDataFrame([(1, "ingredient", "Solsudin"), (2, "ingredient", "Zinc Drotaentate"), (3, "target", "sebum output")], "term_id int, kind string, canonical_name string").write.parquet(str(tmp_path / "canonical_terms.parquet"))
    targets = [(1, "Solsudin grade 1", "Solsudin", 'Hollow®|"birch tar, raw"|Zinc Drotaentate', "TRUE "), (2, "Zinc Drotaentate grade 2", "Zinc Drotaentate", "ZD salts;Dusky", "true"), (3, "Merpaelin grade 3", "Merpaelin", "merpa", "false")]
    spark.createDataFrame(targets, "ingredient_code int, canonical_name string, query_name string, alias_list string, is_target string").write.parquet(str(tmp_path / "issue26_sebum_targets.parquet"))
    text = {"listed": "Zinc Drotaentate helped.", "alias": "The skin calmed with ZD salts.", "sign": "We used Hollow® daily.", "comma": "Birch tar, raw was used.", "off": "A merpa cream.", "inside": "A duskyish cream.", "tag": "Glycolic  acid and dusky oil."}
    claims = [(k, v, None, "t", "improves", "efficacy", k, 0) for k, v in text.items()]
    spark.createDataFrame(claims, "claim_key string, source_sentence string, ingredient_name string, target string, relation string, claim_type string, pmid string, chunk_index int").write.parquet(str(tmp_path / "gold_claim.parquet"))
    subjects = {r.claim_key: r.ingredient for r in E.ingredient_subjects(spark, str(tmp_path)).collect()}
    assert subjects == {"listed": "Zinc Drotaentate", "alias": "Zinc Drotaentate", "sign": "Solsudin", "comma": "Solsudin", "off": None, "inside": None, "tag": "Zinc Drotaentate"}
    units = {r.claim_key: r.units for r in E.detection_units(spark, str(tmp_path)).collect()}
    assert units["sign"] == "Solsudin" and units["off"] == "" and units["tag"] == "Zinc Drotaentate|[glycolic]"


def test_automaton_as_alternation():
    import re

    from quillstone.functions import lexicon as L

    words = ["a", "ab", "abc", "b", "abd x", "a.c", "zinc (np)", "β-zinc", "zinc"]
    text = "abc ab abd x a.c axc zinc (np) β-zinc zinc zincs b a abd"
    found = lambda p: re.findall(rf"(?<!\w)({p})(?!\w)", text)
    assert found(L.automaton(words)) == found(L.alternation(words))


def test_numbers_of_whole_cells(spark, tmp_path):
    rows = [(1, "7", "-12.7"), (2, "x", " 1e3 "), (3, None, "123456"), (4, "+5", "1,3-Kemplaemdiol grade 2"), (5, "", None)]
    spark.createDataFrame(rows, "ingredient_code int, query_name string, canonical_name string").write.parquet(str(tmp_path / "issue26_sebum_targets.parquet"))
    got = {r.ingredient_code: (r.as_int, r.as_float_int) for r in E.number_cells(spark, str(tmp_path)).collect()}
    assert got == {1: (7, -12), 2: (None, 1000), 3: (None, 123456), 4: (5, None), 5: (None, None)}
