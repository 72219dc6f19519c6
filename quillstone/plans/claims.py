"""Queries of the claim predicates and labels, each with the SQL it is held against.

The sentences of the test tables hardly use the words that the rules look for. Each query therefore reads every claim
sentence with one of a few openings and endings around it, chosen by its length, so that every branch is taken on some
rows; the SQL does the same and writes its own lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import claims as K
from quillstone.operators import labels as B
from quillstone.plans.evidence import dictionary
from quillstone.plans.rules_sql import COMPATIBLE_SQL, REJECTED_SQL, TARGET_SQL, pick, pick_sql, target_flat_sql
from quillstone.runtime import broadcast_if_small, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_OPENINGS = ("", "RESULTS: ", "Conclusion: ", "METHODS: ", "Purposes: ", "Vehicle and ", "CER5 then ", "Topical ", "Method: ", "Berberine or ", "To prevent acne, ")
_ENDINGS = (
    "", " The skin barrier improved.", " Drug delivery to the skin was shown.", " NAD+ metabolism changed with topical niacinamide and improved.", " Topical niacinamide reduced oily shine.",
    " It may reduce redness after non-ablative laser as a cream.", " There was no significant difference in acne.", " This systematic review led to more on scalp and skin.",
    " Microneedling with tranexamic acid improved melasma.", " It was combined with vitamin C, glycolic acid and retinol on facial skin.",
    " Urea was given along with lactic acid, such as allantoin, panthenol, and others, and improved skin.", " Fractional laser reduced acne.", " It was significantly improved (p<0.05) by TXA, dexpanthenol and hyaluronan on dry skin.",
    "\nplatinum liposome\nceramide np\ncentella", " The cost-effective cream was beneficial to skin.", " Nicotinamide riboside enhanced the epidermis.", " Glycolic acid then a short while later salicylic acid helped skin.",
    " Glycolic acid was there and very much later in the same long long long sentence salicylic acid reduced acne.", " Dandruff was treated with a serum containing zinc, urea, and more.", " Superior to placebo; well-tolerated.",
    " It appeared to have been restored.", " None reached statistical significance, no effect on sebum.",
)
_NAMES = ("Niacinamide", "Tranexamic acid", "Panthenol", "Hyaluronic acid", "Ascorbic acid", "Centella asiatica", "Madecassoside", "Retinol", "Coenzyme Q10", "Ceramide np c15", "")


def _probes(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Claims with their sentence `s` set between an opening and an ending, and a `name`."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null and source_sentence is not null").select("claim_key", "source_sentence", "ingredient_name", *columns).distinct()
    n = F.length("source_sentence")
    s = F.concat(pick(_OPENINGS, n), F.trim("source_sentence"), pick(_ENDINGS, F.floor(n / 3)))
    name = F.when(n % 2 == 0, pick(_NAMES, F.floor(n / 5))).otherwise(F.col("ingredient_name"))
    return g.select("claim_key", s.alias("s"), name.alias("name"), *columns)


def _probes_sql(*columns: str) -> str:
    more = "".join(f", {c}" for c in columns)
    return f"""(SELECT claim_key, {pick_sql(_OPENINGS, 'length(source_sentence)')} || trim(source_sentence, ' ') || {pick_sql(_ENDINGS, 'length(source_sentence) // 3')} AS s,
        CASE WHEN length(source_sentence) % 2 = 0 THEN {pick_sql(_NAMES, 'length(source_sentence) // 5')} ELSE ingredient_name END AS name{more} FROM (SELECT DISTINCT claim_key, source_sentence, ingredient_name{more} FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL))"""


# The lists of the rules as patterns of the SQL, written without those of the library.
_S_FOREIGN = "perioperative|cardiac surgery|ostomy|payer|population perspective|cost-effective|cost effective|cost-saving|cost saving|quality-of-life|quality of life|seroma risk|postoperative|surgical drain|breast reconstruction|hemorrhage|carcinoma|cancer|tumor|tumour|microemulsion|nanoemulsion|particle size|release profile|encapsulation efficiency|drug delivery|transdermal delivery|cell migration|dermal papilla|dpc|gene expression|mrna|protein expression"
_S_RESULT = "^(results:|result:|conclusion:|conclusions:)"
_S_DESIGN = "^(aims?:|objectives?:|background:|purposes?:|methods?:|materials and methods:|patients and methods:)"
_S_STUDY = "this study aimed to|this study aims to|this study was designed to|this review aims to|to assess the efficacy|to assess the effectiveness|to evaluate the efficacy|to evaluate the safety|to develop and characterize|to develop a|patients were divided into|were randomized to|in a further approach|we developed"
_S_ELSEWHERE = "^(berberine|β-nicotinamide mononucleotide|nicotinamide mononucleotide|nicotinamide riboside|mdba|pt-liposomes?|basic emollient formulations?|vehicle|formulations?|liposomes?|bacterial-derived ceramides?|cer[0-9]+)\\b"
_S_POSITIVE = "improve[ds]|improvement|reduce[ds]|reduction|increase|enhance[ds]|effective|efficacy|beneficial|ameliorated|alleviated|prevented|prevents|significantly|associated with|attenuated|restored|promoted|demonstrated|showed|shown|showing|resulted in|led to|superior improvements|relieves|mitigate|healing|recovery|well-tolerated|well tolerated|tolerability|promising|offer greater protection|protective|show promise|appears to be|appear to be|no remarkable side effects|no significant differences in safety outcomes|lowered|improve hyperpigmentation|antioxidative|normalized|normalizing|accelerate[ds]|supports|supported"
_S_SKIN = "skin|topical|cosmetic|cosmeceutical|dermatolog(y|ic)|epiderm(is|al)|cutaneous|facial|barrier|hydrat(ion|e|ing)|moisturiz(ing|ation)|transepidermal water loss|tewl|pigmentation|melasma|pih|photoaging|photo-?damaged|uv|erythema|redness|acne|wrinkle|elasticity|irritation|brightening|depigmenting|exfoliation|keratoly(tic|sis)|peeling|desquamation|texture|roughness|dullness|repair|anti-aging|immunosuppression|tolerability|tolerance"
_S_WORDS = "\\b(sebum|oil|oily|oiliness|pores?|seborrhea|seborrheic)\\b"
_S_BARE = "regexp_replace(trim(s, ' '), '^(results?|conclusions?):\\s*', '', 'i')"


def _has(pattern: str, text: str = "lower(s)") -> str:
    return f"regexp_matches({text}, '{pattern}')"


_S_LIKE = {
    "is_foreign": _has(_S_FOREIGN),
    "design": f"(NOT {_has(_S_RESULT, 'lower(trim(s))')} AND ({_has(_S_DESIGN, 'lower(trim(s))')} OR {_has(_S_STUDY)}))",
    "elsewhere": _has(_S_ELSEWHERE, f"lower({_S_BARE})"),
    "signal": f"({_has(_S_RESULT, 'lower(trim(s))')} OR {_has(_S_POSITIVE)})",
    "skin": f"({_has(_S_SKIN)} OR {_has(_S_WORDS)})",
}
_S_CLAIM_LIKE = f"(NOT {_S_LIKE['is_foreign']} AND NOT {_S_LIKE['design']} AND NOT {_S_LIKE['elsewhere']} AND {_S_LIKE['signal']} AND {_S_LIKE['skin']})"


@query(f"SELECT DISTINCT claim_key, {', '.join(f'{v} AS {k}' for k, v in _S_LIKE.items())}, {_S_CLAIM_LIKE} AS claim_like FROM {_probes_sql()}")
def claim_like(spark: SparkSession, d: str) -> DataFrame:
    """The predicates of a sentence that states a claim, one by one and together."""
    s = F.col("s")
    return _probes(spark, d).select("claim_key", K.foreign_domain(s).alias("is_foreign"), B.study_design(s).alias("design"), K.leads_elsewhere(s).alias("elsewhere"), K.positive_signal(s).alias("signal"), K.skin_context(s).alias("skin"), K.claim_like(s).alias("claim_like")).distinct()


_S_CONTEXT = f"""CASE WHEN lower(name) = 'niacinamide' THEN NOT {_has("\\b(nmn|nr|nad|nadh|nadp|nadph)\\b")} AND NOT {_has("nicotinamide riboside|nicotinamide mononucleotide|nicotinamide adenine dinucleotide|mitochondria|metaboli(sm|c)|bioenergetic|coenzyme")}
    AND ({_has("skin|topical|uv|photoaging|photo-?damaged|pigmentation|melasma|barrier|immunosuppression|erythema|acne|facial")} OR {_has(_S_WORDS)}) ELSE true END"""
_S_EXCLUDED = f"""CASE name WHEN 'Niacinamide' THEN {_has("nicotinamide mononucleotide|nicotinamide riboside|\\(nmn\\)|\\(nr\\)")} OR {_has("\\b(nmn|nr|nad|nadh|nadp|nadph)\\b")} ELSE false END"""


@query(f"""SELECT DISTINCT claim_key, coalesce({_S_CONTEXT}, true) AS allowed, coalesce({_S_EXCLUDED}, false) AS excluded,
    {_has('literature review|systematic review|narrative review|scoping review|review on efficacy', "lower(concat_ws(' ', s, title))")} AS review, {_has('scalp|hair growth|hair loss|hair follicle|hair care|hair tonic|dandruff', "lower(concat_ws(' ', title, s))")} AS hair FROM {_probes_sql('title')}""")
def name_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Whether a sentence allows a name, excludes it, reports a review, or is about hair."""
    s, name = F.col("s"), F.col("name")
    patterns = F.coalesce(*(F.when(name == k, F.array(*(F.lit(x.strip()) for x in v))) for k, v in C.EXTRA_EXCLUDES.items()), F.array().cast("array<string>"))
    return _probes(spark, d, "title").select("claim_key", F.coalesce(K.context_allows(name, s), F.lit(True)).alias("allowed"), B.excluded(s, patterns, C.WHOLE_WORDS).alias("excluded"), K.review_style(s, F.col("title"), F.lit(None).cast("string")).alias("review"), K.hair_or_scalp(s, F.col("title")).alias("hair")).distinct()


# ---- names ------------------------------------------------------------------------------------------------------

# Aliases of names in the SQL.
_S_ALIASES = "niacinamide=Niacinamide nicotinamide=Niacinamide nia=Niacinamide panthenol=Panthenol d-panthenol=Panthenol dexpanthenol=Panthenol ceramide=Ceramide ceramides=Ceramide txa=Tranexamic_acid tranexamic_acid=Tranexamic_acid hyaluronic_acid=Hyaluronic_acid sodium_hyaluronate=Hyaluronic_acid hyaluronan=Hyaluronic_acid l-ascorbic_acid=Ascorbic_acid ascorbic_acid=Ascorbic_acid vitamin_c=Ascorbic_acid vit_c=Ascorbic_acid centella_asiatica=Centella_asiatica gotu_kola=Centella_asiatica cica=Centella_asiatica madecassoside=Madecassoside retinol=Retinol ubiquinone=Coenzyme_Q10 coenzyme_q10=Coenzyme_Q10 coq10=Coenzyme_Q10"
_S_ALIAS_ROWS = ", ".join("('{}', '{}')".format(*p.replace("_", " ").split("=")) for p in _S_ALIASES.split())
_S_RULES = "(SELECT DISTINCT trim(canonical_name) AS canonical_name, trim(query_name) AS query_name, alias_list, exclude_if_contains FROM issue26_sebum_targets WHERE lower(trim(is_target)) = 'true' AND trim(canonical_name) <> '')"
_S_CELLS = "list_filter(list_transform(string_split(coalesce(alias_list, ''), '|'), lambda x: trim(x, ' ')), lambda x: x <> '')"
_S_RULE_ALIASES = f"list_concat([canonical_name], CASE WHEN query_name <> '' THEN [query_name] ELSE [] END, {_S_CELLS})"
_S_ONCE = f"list_filter({_S_RULE_ALIASES}, lambda x, i: list_position(list_transform({_S_RULE_ALIASES}, lambda y: lower(y)), lower(x)) = i)"


@query(f"""SELECT canonical_name, max({_S_ONCE}) AS aliases FROM {_S_RULES} GROUP BY 1""")
def ingredient_rules(spark: SparkSession, d: str) -> DataFrame:
    """Aliases of every active target, its own names first, without repeats."""
    return K.ingredient_rules(read_table(spark, d, "issue26_sebum_targets")).select("canonical_name", "aliases")


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    return K.alias_map(K.ingredient_rules(read_table(spark, d, "issue26_sebum_targets")))


@query(f"""WITH r AS (SELECT canonical_name, {_S_ONCE} AS aliases FROM {_S_RULES}), m AS (SELECT lower(a) AS alias, max(canonical_name) AS canonical_name FROM (SELECT canonical_name, unnest(aliases) AS a FROM r) GROUP BY 1),
    f AS (SELECT * FROM (VALUES {_S_ALIAS_ROWS}) v(alias, canonical_name)), look AS (SELECT * FROM m WHERE alias NOT IN (SELECT alias FROM f) UNION ALL SELECT * FROM f)
    SELECT DISTINCT claim_key, name, coalesce(canonical_name, CASE WHEN regexp_matches(lower(trim(name, ' ')), '^ceramide(\\s+[a-z0-9]+)+$') THEN 'Ceramide' END) AS normal_name FROM {_probes_sql()} LEFT JOIN look ON alias = lower(trim(name, ' '))""")
def normal_names(spark: SparkSession, d: str) -> DataFrame:
    """The one form of the name of each claim: by alias, else by family, else none."""
    return K.normal_names(_probes(spark, d), "name", _aliases(spark, d)).select("claim_key", "name", "normal_name").distinct()


# ---- claims -----------------------------------------------------------------------------------------------------

_TARGETS = ("melasma severity", "Skin  hydration.", "PIH", "redness", "benefits", "blood loss", "uv-induced immunosuppression", "photo damaged skin", "TEWL", "tolerance / tolerability", "laser-induced PIH", "dry skin cell migration", "", "a very long phrase on the skin of the face today", "photoaging", "cutaneous hydration", "skin irritation")
_RELATIONS = ("improves", "increases", "causes", "does_not_cause", "stimulates", "reduces", "", "supports", "is_safe_for")


def _claims(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("source_sentence")
    p = _probes(spark, d, "source_sentence", "target", "relation", "claim_type", "evidence_direction", "confidence_score", "target_category")
    fields = {
        "target": F.when(n % 3 > 0, pick(_TARGETS, F.floor(n / 3))).otherwise(F.col("target")),
        "relation": F.when(n % 4 > 0, pick(_RELATIONS, F.floor(n / 4))).otherwise(F.col("relation")),
        "confidence": F.when(n % 11 == 0, "high").otherwise((F.col("confidence_score") * 1.25).cast("string")),
        "study_context": pick((*C.STUDY_CONTEXTS, "rumour"), F.floor(n / 2)),
        "target_category": pick((*C.TARGET_CATEGORIES, "odd"), F.floor(n / 6)),
        "evidence_direction": F.when(n % 13 > 0, F.col("evidence_direction")).otherwise(F.lit(" refutes ")),
        "claim_type": F.when(n % 17 > 0, F.col("claim_type")).otherwise(F.lit("")),
    }
    names = spark.createDataFrame([(n_.lower(), n_) for n_ in _NAMES if n_], "alias string, canonical_name string")
    terms = read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select(F.lower("canonical_name").alias("alias"), "canonical_name")
    return K.normal_names(p.withColumns(fields), "name", names.unionByName(terms)).withColumn("source_sentence", F.col("s"))


_S_T = f"CASE WHEN length(source_sentence) % 3 > 0 THEN {pick_sql(_TARGETS, 'length(source_sentence) // 3')} ELSE target END"
_S_CLAIMS = f"""(SELECT p.*, coalesce(a.canonical_name, CASE WHEN regexp_matches(lower(trim(name, ' ')), '^ceramide(\\s+[a-z0-9]+)+$') THEN 'Ceramide' END) AS normal_name FROM (SELECT claim_key, s, name, {_S_T} AS target,
        CASE WHEN length(source_sentence) % 4 > 0 THEN {pick_sql(_RELATIONS, 'length(source_sentence) // 4')} ELSE relation END AS relation, CASE WHEN length(source_sentence) % 11 > 0 THEN confidence_score * 1.25 END AS confidence,
        {pick_sql((*C.STUDY_CONTEXTS, 'rumour'), 'length(source_sentence) // 2')} AS study_context, {pick_sql((*C.TARGET_CATEGORIES, 'odd'), 'length(source_sentence) // 6')} AS target_category, CASE WHEN length(source_sentence) % 13 > 0 THEN trim(evidence_direction) ELSE 'refutes' END AS evidence_direction,
        CASE WHEN length(source_sentence) % 17 > 0 THEN trim(claim_type) ELSE '' END AS claim_type FROM {_probes_sql('source_sentence', 'target', 'relation', 'claim_type', 'evidence_direction', 'confidence_score')}) p
    LEFT JOIN (SELECT lower(canonical_name) AS alias, canonical_name FROM canonical_terms WHERE kind = 'ingredient' UNION SELECT lower(x), x FROM (SELECT unnest([{', '.join(f"'{n}'" for n in _NAMES if n)}]) AS x)) a ON a.alias = lower(trim(name, ' ')))"""
_S_PREFIX = "(topical(ly)?\\s+|oral\\s+|application of\\s+|treatment with\\s+|use of\\s+|the use of\\s+|using\\s+|with\\s+|post-treatment with\\s+)?"
_S_TABLE = f"(SELECT canonical_name AS n, term_id AS r FROM canonical_terms WHERE kind = 'ingredient' UNION ALL SELECT x, 100000 + i FROM (SELECT unnest([{', '.join(f"'{n}'" for n in _NAMES if n)}]) AS x, generate_subscripts([{', '.join('0' for n in _NAMES if n)}], 1) AS i))"


def flat_sql(text: str) -> str:
    """Text in small letters as its words with one blank around each."""
    return f"' ' || trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' '"


#: A name of the table stands in the text of `x` (columns t and flat) as whole words.
_S_STANDS = "contains(lower(x.t), lower(n)) AND contains(x.flat, names.flat)"
_S_NAMES = f"(SELECT n, r, {flat_sql('n')} AS flat FROM {_S_TABLE})"


def _subject_sql(rows: str) -> str:
    """The text and the name each sentence is about: the longest it begins with, else the longest in it."""
    ahead = "(starts_with({0}, lower(n)) AND NOT regexp_matches(substr({0}, length(n) + 1, 1), '[\\p{{L}}\\p{{N}}_]'))"
    front = f"({ahead.format('bare')} OR {ahead.format('rest')})"
    return f"""(SELECT t AS s, arg_min(n, struct_pack(a := NOT front, b := -length(n), c := r)) AS subject FROM (SELECT t, n, r, {front} AS front FROM (SELECT *, regexp_replace(bare, '^{_S_PREFIX}', '') AS rest FROM (SELECT DISTINCT s AS t, {flat_sql('s')} AS flat, lower({_S_BARE}) AS bare FROM {rows})) x JOIN {_S_NAMES} names ON {_S_STANDS}) GROUP BY t)"""


@query(f"""WITH c AS (SELECT *, {target_flat_sql('target')} AS f FROM {_S_CLAIMS}), v AS (SELECT *, {TARGET_SQL.format('f')} AS t FROM c), sub AS {_subject_sql('c')}
    SELECT DISTINCT claim_key, normal_name, t AS target, trim(relation, ' ') AS relation, coalesce(CAST(confidence AS DOUBLE), 0) AS confidence FROM v LEFT JOIN sub USING (s)
    WHERE normal_name IS NOT NULL AND NOT {_S_LIKE['elsewhere']} AND subject = normal_name AND trim(target, ' ') <> '' AND NOT {REJECTED_SQL.format('t')} AND trim(relation, ' ') <> '' AND {COMPATIBLE_SQL.format('t', 'relation')} AND claim_type <> '' AND evidence_direction <> ''""")
def validated_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims that hold, in their one form."""
    c = _claims(spark, d)
    table = dictionary(spark, d, "ingredient") | {n.lower(): n for n in _NAMES if n}
    return K.validated(c, table).select("claim_key", "normal_name", "target", "relation", "confidence").distinct()


@query(f"""SELECT DISTINCT claim_key, trim(target, ' ') AS target, trim(relation, ' ') AS relation, least(greatest(confidence, 0), 1) AS confidence FROM {_S_CLAIMS} WHERE normal_name IS NOT NULL AND claim_type IN ('efficacy', 'safety', 'mechanism')
    AND trim(relation, ' ') IN ('improves', 'reduces', 'prevents', 'increases', 'is_safe_for', 'is_well_tolerated_for', 'causes', 'does_not_cause', 'inhibits', 'stimulates', 'regulates', 'modulates') AND target_category <> 'odd' AND evidence_direction IN ('supports', 'refutes', 'neutral') AND study_context <> 'rumour'
    AND trim(target, ' ') <> '' AND lower(trim(target, ' ')) NOT IN ('benefit', 'benefits', 'outcome', 'outcomes', 'condition', 'conditions', 'efficacy', 'safety', 'improvement', 'result', 'results', 'therapy', 'treatment') AND confidence IS NOT NULL""")
def listed_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims whose every field is one that may be."""
    return K.validated_by_lists(_claims(spark, d)).select("claim_key", "target", "relation", "confidence").distinct()


@query(f"""WITH p AS (SELECT DISTINCT claim_key, s, pmid, chunk_index FROM {_probes_sql('pmid', 'chunk_index')}), sub AS {_subject_sql('p')},
    many AS (SELECT t AS s, count(DISTINCT n) AS n FROM (SELECT DISTINCT s AS t, {flat_sql('s')} AS flat FROM p) x JOIN {_S_NAMES} names ON {_S_STANDS} GROUP BY t),
    e AS (SELECT p.*, coalesce(many.n, 0) >= 2 AND {_has('containing|contains|along with|combined with|plus|such as')} AS enumerates, subject AS name FROM p LEFT JOIN sub USING (s) LEFT JOIN many USING (s)),
    o AS (SELECT *, CASE WHEN {_S_CLAIM_LIKE} AND NOT enumerates AND NOT coalesce({_S_EXCLUDED}, false) AND {_S_CONTEXT} THEN name END AS own FROM e),
    c AS (SELECT pmid, chunk_index, count(DISTINCT own) AS n, min(own) AS sole FROM o GROUP BY ALL)
    SELECT DISTINCT claim_key, enumerates, own, coalesce(own, CASE WHEN n = 1 THEN sole END) AS name FROM o LEFT JOIN c ON c.pmid IS NOT DISTINCT FROM o.pmid AND c.chunk_index IS NOT DISTINCT FROM o.chunk_index""")
def extracted_names(spark: SparkSession, d: str) -> DataFrame:
    """The name each sentence makes a claim about; else the only one of its chunk."""
    table = dictionary(spark, d, "ingredient") | {n.lower(): n for n in _NAMES if n}
    p = _probes(spark, d, "pmid", "chunk_index")
    s = p.select("claim_key", "s", "pmid", "chunk_index", B.enumerates(F.col("s"), table).alias("enumerates"), K.extracted_name(F.col("s"), table).alias("own"))
    chunk = s.groupBy("pmid", "chunk_index").agg(F.countDistinct("own").alias("_n"), F.min("own").alias("_only"))
    both = s.join(chunk, s.pmid.eqNullSafe(chunk.pmid) & s.chunk_index.eqNullSafe(chunk.chunk_index), "left")
    return both.select("claim_key", "enumerates", "own", F.coalesce("own", F.when(F.col("_n") == 1, F.col("_only"))).alias("name")).distinct()


# ---- labels -----------------------------------------------------------------------------------------------------

# Patterns of the labels in the SQL.
_S_NAMED = """((regexp_matches({n}, '[\\p{{L}}\\p{{N}}]') AND contains(lower({t}), lower(trim({n}, ' '))) AND contains(' ' || regexp_replace(lower({t}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g') || ' ', ' ' || trim(regexp_replace(lower({n}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' ')) OR CASE lower(trim({n}, ' ')) WHEN 'tranexamic acid' THEN regexp_matches(lower({t}), '\\btxa\\b|tranexamic') WHEN 'panthenol' THEN contains(lower({t}), 'dexpanthenol')
    WHEN 'hyaluronic acid' THEN regexp_matches(lower({t}), 'hyaluron') WHEN 'ascorbic acid' THEN regexp_matches(lower({t}), '\\b(l-)?ascorbic\\s+acid\\b|vitamin c|\\bvit\\s+c\\b') WHEN 'centella asiatica' THEN regexp_matches(lower({t}), '\\bcentella\\b|gotu kola') WHEN 'madecassoside' THEN contains(lower({t}), 'madecassoside')
    WHEN 'retinol' THEN regexp_matches(lower({t}), '\\bretinol\\b') WHEN 'coenzyme q10' THEN regexp_matches(lower({t}), 'ubiquinone|coq10|coenzyme q10') ELSE false END)"""
_S_CARRIER = "\\b(enriched|containing|infused|ointment|cream|lotion|moisturizer|emollient|serum|mask|gel|hydrogel|patch|formulation|vehicle)\\b|topical\\s+formulation|-enriched|-containing"
_S_ADJUNCT = "micro[\\s-]?needling|combined\\s+with\\s+(a\\s+)?(fractional\\s+)?laser|adjunctive\\s+.*(laser|microneedling)|(laser|microneedling)\\s+with\\s+(tranexamic|vitamin|tca|acid)|plus\\s+(fractional\\s+)?laser"
_S_AFTERCARE = "after\\s+(non[\\s-]?ablative\\s+|facial\\s+)?laser|post[\\s-]?(non[\\s-]?ablative\\s+)?laser|post[\\s-]?procedure|following\\s+laser|laser[\\s-]?(induced|treatment)|post\\s+(non[\\s-]?ablative\\s+)?laser\\s+"
_S_PROCEDURE = "\\b(laser|peeling|procedure|lllt|ipl)\\b|fractional\\s+laser|radiofrequency|phototherapy|subcision|chemical\\s+peel|cryotherapy"
_S_ENUMERATION = "\\b(such\\s+as|including)\\s+[^.]{0,200},[^.]{0,200},|\\balong\\s+with\\s+[^.]{0,200},|\\bcontaining\\s+[^.]{0,200},\\s*[^.]{0,80},\\s*(and|&)\\s+|\\bsupplemented\\s+with\\s+[^.]{0,120}\\s+and\\s+|,\\s*[^,]{3,50},\\s*and\\s+[a-z]|\\bwith\\s+soothing\\s+ingredients\\s+such\\s+as\\b"
_S_CONNECTED = "combined\\s+with|supplemented\\s+with|,\\s*[^,]{2,50},\\s+and\\s+|\\bplus\\b|with\\s+vitamin\\s+c\\b|containing\\s+[^.]{0,80},\\s*[^.]{0,80}\\s+and\\s+| and "
_S_TAGS = {"vit_c": "\\bvitamin\\s+c\\b|\\bascorbic\\s+acid\\b", "glabridin": "\\bglabridin\\b", "ellagic": "\\bellagic\\s+acid\\b", "ple": "\\bpolypodium\\b", "hq": "\\bhydroquinone\\b", "tret": "\\btretinoin\\b", "glycolic": "\\bglycolic\\s+acid\\b", "sal_acid": "\\bsalicylic\\s+acid\\b", "tca": "\\btrichloroacetic\\b|\\b15%\\s*tca\\b|\\btca\\s+chemical\\b", "ha": "\\bhyaluronic\\s+acid\\b", "madecassoside": "\\bmadecassoside\\b", "dipotassium_glycyrrhizate": "\\bdipotassium\\s+glycyrrhizate\\b", "portulaca_oleracea": "\\bportulaca\\s+oleracea\\b", "platinum_liposome": "\\bplatinum\\s+liposome\\b", "liposome_technology": "\\bliposome\\s+technology\\b", "centella": "\\bcentella\\b", "ceramide_np": "\\bceramide\\s+np\\b"}
_S_VERBS = "improv|reduc|enhanc|promot|effect|efficac|demonstrat|show|treat|decreas|superior"
_S_HINTS = "improv|reduc|show|demonstr|conclusion|result|evaluat|study|method|patient|significant|objective|background"
_S_LINES = f"list_transform(list_filter(list_transform(regexp_split_to_array(lower({{0}}), '\\r?\\n'), lambda x: trim(x, ' ')), lambda x: length(x) BETWEEN 3 AND 120 AND NOT regexp_matches(x, '{_S_HINTS}')), lambda x: '[line:' || substr(x, 1, 100) || ']')"
_S_LINED = f"CASE WHEN len(list_distinct({_S_LINES})) >= 2 THEN list_distinct({_S_LINES}) ELSE [] END"
_S_TAGGED = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower({{0}}), '{p}') THEN '[{t}]' END" for t, p in _S_TAGS.items()) + "], lambda x: x IS NOT NULL)"


def _units_sql(source: str) -> str:
    """t and the sorted units named in each distinct text t of `source`: names anywhere, tags, listing lines."""
    return f"""(SELECT t, list_sort(list_distinct(list_concat(coalesce(list(n) FILTER (n IS NOT NULL), []), any_value({_S_TAGGED.format('t')}), any_value({_S_LINED.format('t')})))) AS units FROM (SELECT DISTINCT t, {flat_sql('t')} AS flat FROM {source}) x
        LEFT JOIN {_S_NAMES} names ON {_S_STANDS} GROUP BY t)"""


_S_KEYS = "list_filter(list_transform(list_filter(pu, lambda u: NOT starts_with(u, '[line:')), lambda u: lower(trim(u, '[]'))), lambda k: length(k) > 2)"
_S_TOKENS = "list_filter(regexp_split_to_array(lower(clause), '\\s+'), lambda w: w <> '')"
_S_AT = "list_filter(list_transform(tokens, lambda w, i: CASE WHEN len(list_filter(keys, lambda k: contains(w, k))) > 0 THEN i - 1 END), lambda x: x IS NOT NULL)"
_LABELS_SQL = f"""WITH p AS (SELECT DISTINCT claim_key, s, name FROM {_probes_sql()}),
    q AS (SELECT *, coalesce(list_filter(list_filter(string_split(regexp_replace(trim(s, ' '), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda c: c <> ''), lambda c: {_S_NAMED.format(n='name', t='c')})[1], trim(s, ' ')) AS clause FROM p),
    u AS {_units_sql('(SELECT s AS t FROM q UNION SELECT clause FROM q)')},
    j AS (SELECT q.*, a.units AS su, b.units AS pu FROM q JOIN u a ON a.t = q.s JOIN u b ON b.t = q.clause),
    k AS (SELECT *, {_S_KEYS} AS keys, {_S_TOKENS} AS tokens FROM j), l AS (SELECT *, {_S_AT} AS ats FROM k),
    m AS (SELECT *, coalesce(list_sum(list_transform(tokens[1:list_min(ats)], lambda w: length(w) + 1)), 0) AS b FROM l),
    o AS (SELECT *, CASE WHEN {_has(_S_ADJUNCT)} THEN 'procedure_adjunct_combination' WHEN {_has(_S_AFTERCARE)} AND {_has(_S_CARRIER)} THEN 'post_procedure_recovery_formulation' WHEN {_has(_S_PROCEDURE)} AND NOT {_has(_S_CARRIER)} THEN 'procedure_adjunct_combination'
        WHEN len(pu) >= 2 AND (len(list_filter(pu, lambda x: starts_with(x, '[line:'))) >= 2 OR {_has(_S_CONNECTED, 'lower(clause)')} OR (len(ats) >= 2 AND (list_max(ats) - list_min(ats) <= 6 OR (list_max(ats) - list_min(ats) <= 12 AND {_has(_S_VERBS, "substr(lower(clause), CAST(greatest(b - 80, 0) + 1 AS BIGINT), CAST(b + 120 - greatest(b - 80, 0) AS BIGINT))")})))) THEN 'multi_active_combination'
        WHEN {_has(_S_CARRIER)} AND len(pu) <= 1 AND ({_S_NAMED.format(n='name', t='clause')} OR {_S_NAMED.format(n='name', t='s')}) THEN 'single_formulation' WHEN {_S_NAMED.format(n='name', t='clause')} OR {_S_NAMED.format(n='name', t='s')} THEN 'single_active' ELSE 'ambiguous' END AS first_label FROM m)
    SELECT DISTINCT claim_key, clause, array_to_string(su, '|') AS units, len(su) AS n_units, first_label, CASE WHEN first_label = 'single_active' AND (len(su) >= 2 OR {_has(_S_ENUMERATION)} OR len({_S_LINED.format('s')}) >= 2) THEN 'multi_active_combination' ELSE first_label END AS attribution, {_has(_S_ENUMERATION)} AS lists, {_has(_S_ENUMERATION)} AND len(su) <= 1 AS suspect FROM o"""


@query(_LABELS_SQL)
def attribution_labels(spark: SparkSession, d: str) -> DataFrame:
    """Primary clause, units, attribution before and after reconciliation, list guard and suspicion of each claim."""
    table = dictionary(spark, d, "ingredient") | {n.lower(): n for n in _NAMES if n}
    units = lambda c: L.detected_units(c, table, L.DETECTION_TAGS, L.VERB_HINTS)
    s = _probes(spark, d).withColumn("clause", B.primary_clause(F.col("s"), F.col("name")))
    s = s.withColumn("_su", units(F.col("s")))
    s = s.withColumn("_pu", F.when(F.col("clause") == F.trim("s"), F.col("_su")).otherwise(units(F.col("clause"))))
    s = s.withColumn("lists", B.list_guard(F.col("s"))).withColumn("first_label", B.attribution(F.col("s"), F.col("name"), F.col("_pu"), F.col("clause")))
    return s.select("claim_key", "clause", F.array_join(F.array_sort("_su"), "|").alias("units"), B.unit_count(F.col("_su")).cast("long").alias("n_units"), "first_label", B.reconciled(F.col("first_label"), F.col("s"), F.col("_su"), F.col("lists")).alias("attribution"), "lists", B.detection_suspect(F.col("s"), F.col("_su"), F.col("lists")).alias("suspect")).distinct()


# Cues and weights of the SQL.
_S_NOT_SIG = "no significant difference|not statistically significant|none reached statistical significance|failed to reach significance|not significant|no significant |did not significantly|no effect"
_S_SIG = "statistically significant|significant improvement|significant reduction|significantly reduced|significantly improved|p <|p<|p =|p="
_S_STRONG = "significantly improved|significantly reduced|statistically significant|superior to placebo|superior to control|randomized trial showed|double-blind study demonstrated|clinically significant improvement|rct |randomized controlled"
_S_WEAK = "may |might |suggests|promising|could |potential|possibly|appears to|appeared to|trend toward|proof-of-concept"
_S_MODERATE = "improved|reduced|enhanced|promoted|restored|effective in|demonstrated improvement|showed efficacy|was effective|resulted in improvement|effectively |decreased|effective |well-tolerated|well tolerated"
_S_CLAUSES = "list_filter(string_split(regexp_replace(trim(lower(s), ' '), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda c: c <> '')"
_S_TWORDS = "list_slice(regexp_extract_all(lower(coalesce(target, '')), '[a-z]{4,}'), 1, 4)"


@query(f"""WITH p AS (SELECT DISTINCT * FROM {_probes_sql('target', 'relation', 'claim_type', 'chunk_index')}),
    c AS (SELECT *, coalesce(list_filter({_S_CLAUSES}, lambda c: len(list_filter({_S_TWORDS}, lambda w: contains(c, w))) > 0)[1], list_filter({_S_CLAUSES}, lambda c: regexp_matches(c, '{_S_VERBS}'))[-1], lower(s)) AS scored FROM p),
    g AS (SELECT *, CASE WHEN {_has(_S_NOT_SIG, 'scored')} THEN 'not_significant' WHEN {_has(_S_SIG, 'scored')} THEN 'significant' WHEN (lower(trim(coalesce(claim_type, ''))) = 'safety' OR lower(trim(coalesce(relation, ''))) IN ('is_well_tolerated_for', 'is_safe_for')) AND {_has('tolerat|safe', 'scored')} THEN 'not_applicable' WHEN lower(trim(coalesce(claim_type, ''))) = 'mechanism' AND NOT {_has('efficacy|improv', 'scored')} THEN 'not_applicable' ELSE 'unclear' END AS significance FROM c),
    t AS (SELECT *, CASE WHEN significance = 'not_significant' THEN 'weak' WHEN {_has(_S_STRONG)} THEN 'strong' WHEN {_has(_S_WEAK)} THEN 'weak' WHEN {_has(_S_MODERATE)} THEN 'moderate' WHEN (regexp_matches(lower(trim(s, ' ')), '^(conclusion|results:|result:)') OR contains(substr(lower(trim(s, ' ')), 1, 50), 'conclusion:')) AND {_has('effective|decreased|improvement|repair|barrier')} THEN 'moderate' ELSE 'weak' END AS strength FROM g)
    SELECT DISTINCT claim_key, significance, strength, {pick_sql((*C.STUDY_CONTEXTS, 'odd'), 'chunk_index')} AS study_context, round(CASE strength WHEN 'strong' THEN 1.0 WHEN 'moderate' THEN 0.75 ELSE 0.35 END::DOUBLE * CASE significance WHEN 'significant' THEN 1.0 WHEN 'not_applicable' THEN 0.7 WHEN 'not_significant' THEN 0.05 ELSE 0.8 END::DOUBLE
        * CASE {pick_sql((*B.ATTRIBUTION_WEIGHT, 'odd'), 'length(s)')} WHEN 'single_active' THEN 1.0 WHEN 'single_formulation' THEN 0.8 WHEN 'multi_active_combination' THEN 0.45 WHEN 'procedure_adjunct_combination' THEN 0.35 WHEN 'procedure_combination' THEN 0.35 WHEN 'post_procedure_recovery_formulation' THEN 0.72 ELSE 0.2 END::DOUBLE
        * CASE {pick_sql((*C.STUDY_CONTEXTS, 'odd'), 'chunk_index')} WHEN 'human_topical' THEN 1.0 WHEN 'human_oral' THEN 0.95 WHEN 'human_intradermal' THEN 0.9 WHEN 'in_vitro' THEN 0.4 WHEN 'animal' THEN 0.65 WHEN 'review' THEN 0.5 ELSE 0.75 END::DOUBLE, 6) AS row_weight FROM t""")
def evidence_labels(spark: SparkSession, d: str) -> DataFrame:
    """Significance, strength and the weight of a row by four labels."""
    p = _probes(spark, d, "target", "relation", "claim_type", "chunk_index")
    s = F.col("s")
    p = p.withColumn("significance", B.significance(s, F.col("target"), F.col("claim_type"), F.col("relation")))
    p = p.withColumn("strength", B.strength(s, F.col("significance")))
    p = p.withColumns({"study_context": pick((*C.STUDY_CONTEXTS, "odd"), F.col("chunk_index")), "_label": pick((*B.ATTRIBUTION_WEIGHT, "odd"), F.length("s"))})
    w = B.weight((F.col("strength"), B.STRENGTH_WEIGHT, 0.35), (F.col("significance"), B.SIGNIFICANCE_WEIGHT, 0.8), (F.col("_label"), B.ATTRIBUTION_WEIGHT, 0.2), (F.col("study_context"), B.CONTEXT_WEIGHT, 0.75))
    return p.select("claim_key", "significance", "strength", "study_context", w.alias("row_weight")).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
