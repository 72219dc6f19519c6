"""Vocabularies of evidence sentences, and the patterns composed from them."""

from __future__ import annotations

from collections.abc import Sequence

from quillstone.functions.lexicon import LEFT, RIGHT, alternation

GAP, JOINT = r"\s+", r"[\s-]?"


def words(phrases: Sequence[str]) -> str:
    """Any of the phrases as whole words; a blank in one is any run of blanks."""
    return f"{LEFT}(?:{phrase(phrases)}){RIGHT}"


def phrase(phrases: Sequence[str]) -> str:
    """Any of the phrases, also within words; a blank in one is any run of blanks, a tilde a blank, a hyphen or nothing."""
    return alternation(phrases).replace(" ", GAP).replace("~", JOINT)


def upto(n: int, without: str = ".") -> str:
    """At most `n` characters of one sentence."""
    return f"[^{without}]{{0,{n}}}"


# Headings before which a sentence tells of the design of a study.
DESIGN_HEADINGS = ("aim:", "aims:", "objective:", "objectives:", "background:", "purpose:", "purposes:", "methods:", "method:", "materials and methods:", "patients and methods:")

# Subjects at the beginning of a sentence that are no targets; "#" is any number.
LEADING_SUBJECTS = (
    "berberine", "β-nicotinamide mononucleotide", "nicotinamide mononucleotide", "nicotinamide riboside", "mdba", "pt-liposome", "pt-liposomes", "basic emollient formulation",
    "basic emollient formulations", "vehicle", "formulation", "formulations", "liposome", "liposomes", "bacterial-derived ceramide", "bacterial-derived ceramides", "cer#",
)

# Phrases of domains in which nothing is claimed of skin care.
FOREIGN_DOMAINS = (
    "perioperative", "cardiac surgery", "ostomy", "payer", "population perspective", "cost-effective", "cost effective", "cost-saving", "cost saving", "quality-of-life", "quality of life",
    "seroma risk", "postoperative", "surgical drain", "breast reconstruction", "traumatic hemorrhage", "hemorrhage", "carcinoma", "cancer", "tumor", "tumour", "microemulsion", "nanoemulsion",
    "particle size", "release profile", "encapsulation efficiency", "drug delivery", "transdermal delivery", "cell migration", "dermal papilla", "dpc", "gene expression", "mrna",
    "protein expression",
)

# Signs that something has an effect.
POSITIVE_SIGNALS = (
    "improved", "improves", "improvement", "reduced", "reduces", "reduction", "increase", "increased", "increases", "enhanced", "enhances", "effective", "efficacy", "beneficial", "ameliorated",
    "alleviated", "prevented", "prevents", "significantly", "associated with", "attenuated", "restored", "promoted", "demonstrated", "showed", "shown", "showing", "resulted in", "led to",
    "improvement in", "superior improvements", "confer superior improvements", "relieves", "mitigate", "mitigates", "healing", "recovery", "well-tolerated", "well tolerated", "tolerability",
    "promising", "offer greater protection", "protective", "show promise", "appears to be", "appear to be", "no remarkable side effects", "no significant differences in safety outcomes", "lowered",
    "reduced melasma severity", "improve hyperpigmentation", "improvement in melasma scores", "photoprotective", "antioxidative", "normalized", "normalizing", "accelerated", "accelerates",
    "supports", "supported",
)

# Phrases that set a sentence in the context of skin.
SKIN_CONTEXT = (
    "skin", "topical", "cosmetic", "cosmeceutical", "dermatology", "dermatologic", "epidermis", "epidermal", "cutaneous", "facial", "barrier", "skin barrier", "barrier function", "hydration",
    "hydrate", "hydrating", "moisturizing", "moisturization", "transepidermal water loss", "tewl", "pigmentation", "hyperpigmentation", "melasma", "pih", "photoaging", "photodamaged",
    "photo-damaged", "uv", "uvb", "erythema", "redness", "acne", "wrinkle", "wrinkles", "elasticity", "irritation", "sensitive skin", "dry skin", "brightening", "depigmenting", "exfoliation",
    "keratolytic", "keratolysis", "peeling", "skin renewal", "desquamation", "texture", "roughness", "dullness", "uneven skin tone", "repair", "anti-aging", "laser-induced pih",
    "infraorbital hyperpigmentation", "immunosuppression", "epidermal recovery", "tolerability", "tolerance",
)

# What rules a name out or must stand beside it, by name: words, phrases, and context that is needed.
CONTEXT_RULES = {
    "niacinamide": (
        ("nmn", "nr", "nad", "nad+", "nadh", "nadp", "nadph"),
        ("nicotinamide riboside", "nicotinamide mononucleotide", "β-nicotinamide mononucleotide", "nicotinamide adenine dinucleotide", "mitochondria", "mitochondrial", "metabolism", "metabolic", "bioenergetic", "coenzyme"),
        ("skin", "topical", "uv", "uvb", "photoaging", "photodamaged", "photo-damaged", "hyperpigmentation", "pigmentation", "melasma", "barrier", "immunosuppression", "erythema", "acne", "facial"),
    ),
}
#: Exclude patterns that count as whole words only.
WHOLE_WORDS = ("nad", "nad+", "nadh", "nadp", "nadph", "nmn", "nr")

# Aliases and exclude patterns of single names besides those of the target table.
EXTRA_ALIASES = {
    "Niacinamide": ("nicotinamide", "nia"),
    "Panthenol": ("d-panthenol", "dexpanthenol"),
    "Ceramide": ("ceramides", "ceramide np", "ceramide ap", "ceramide eop", "ceramide ns", "ceramide ng", "ceramide as", "ceramide eos", "ceramide np c15"),
    "Tranexamic acid": ("txa",),
}
EXTRA_EXCLUDES = {
    "Niacinamide": ("nicotinamide mononucleotide", "β-nicotinamide mononucleotide", "nicotinamide riboside", "(nmn)", "(nr)", " nmn ", " nr ", "nad", "nad+", "nadh", "nadp", "nadph"),
    "Ceramide": ("cer2", "cer14", "bacterial-derived ceramides"),
}

# Aliases that stand for a name whatever the target table says.
ALIAS_OVERRIDES = {
    "Niacinamide": "niacinamide|nicotinamide|nia",
    "Panthenol": "panthenol|d-panthenol|dexpanthenol",
    "Ceramide": "ceramide|ceramides|ceramide np|ceramide ap|ceramide eop|ceramide ns|ceramide ng|ceramide as|ceramide eos|ceramide np c15",
    "Tranexamic acid": "tranexamic acid|txa",
    "Salicylic acid": "salicylic acid",
    "Hyaluronic acid": "hyaluronic acid|sodium hyaluronate|hyaluronan",
    "Ascorbic acid": "l-ascorbic acid|ascorbic acid|vitamin c|vit c",
    "Azelaic acid": "azelaic acid",
    "Zinc PCA": "zinc pca|zinc pyrrolidone carboxylate",
    "Centella asiatica": "centella asiatica|gotu kola|cica",
    "Madecassoside": "madecassoside",
    "Retinol": "retinol",
    "Bakuchiol": "bakuchiol",
    "Glycolic acid": "glycolic acid",
    "Lactic acid": "lactic acid",
    "Alpha arbutin": "alpha arbutin|arbutin",
    "Kojic acid": "kojic acid",
    "Adenosine": "adenosine",
    "Caffeine": "caffeine",
    "Resveratrol": "resveratrol",
    "Ferulic acid": "ferulic acid",
    "Green tea extract": "green tea|egcg|camellia sinensis",
    "Beta-glucan": "beta-glucan|β-glucan",
    "Allantoin": "allantoin",
    "Urea": "urea",
    "Copper tripeptide-1": "copper tripeptide-1|ghk-cu|copper peptide",
    "Ectoin": "ectoin",
    "Coenzyme Q10": "ubiquinone|coenzyme q10|coq10",
}

# Other ways to mention a name, by name: whole words, and parts of words.
MENTIONS = {
    "tranexamic acid": (("txa",), ("tranexamic",)),
    "panthenol": ((), ("dexpanthenol",)),
    "hyaluronic acid": ((), ("hyaluron", "sodium hyaluronate")),
    "ascorbic acid": (("ascorbic acid", "l-ascorbic acid", "vit c"), ("vitamin c",)),
    "zinc pca": (("zinc pca",), ()),
    "centella asiatica": (("centella",), ("gotu kola",)),
    "madecassoside": ((), ("madecassoside",)),
    "retinol": (("retinol",), ()),
    "coenzyme q10": ((), ("ubiquinone", "coq10", "coenzyme q10")),
}

# Words for devices and treatments, for what carries an active, and for what may follow one.
DEVICES = ("laser", "microneedling")
TREATMENTS, TREATMENT_STEMS = ("laser", "peeling", "procedure", "lllt", "ipl"), ("radiofrequency", "phototherapy", "subcision", "chemical peel", "cryotherapy", "fractional laser")
BESIDE_DEVICES = ("tranexamic", "vitamin", "tca", "acid")
CARRIERS = ("enriched", "containing", "infused", "ointment", "cream", "lotion", "moisturizer", "emollient", "serum", "mask", "gel", "hydrogel", "patch", "formulation", "vehicle")
CARRIER_STEMS = ("topical formulation", "-enriched", "-containing")
AFTER_LASER = ("after laser", "after non~ablative laser", "after facial laser", "post~laser", "post~non~ablative laser", "post~procedure", "following laser", "laser~induced", "laser~treatment")
LIST_INTROS = ("such as", "including", "along with", "supplemented with", "containing")

_LASERS = tuple(f"{how} {which}laser" for how, kinds in (("combined with", ("", "a ", "fractional ", "a fractional ")), ("plus", ("", "fractional "))) for which in kinds)
#: A device or treatment applied together with an active.
ADJUNCT = "|".join((phrase(("micro~needling", *_LASERS, *(f"{d} with {a}" for d in DEVICES for a in BESIDE_DEVICES))), rf"adjunctive{GAP}.*(?:{phrase(DEVICES)})"))
#: Skin that recovers from a treatment.
AFTERCARE = phrase(AFTER_LASER) + rf"|post{GAP}laser{GAP}|post{GAP}non{JOINT}ablative{GAP}laser{GAP}"
#: Any treatment.
PROCEDURE = f"{words(TREATMENTS)}|{phrase(TREATMENT_STEMS)}"
#: What carries an active to the skin.
CARRIER = f"{words(CARRIERS)}|{phrase(CARRIER_STEMS)}"
#: Sentences that enumerate: a phrase that brings in a list, then commas or 'and' within reach.
ENUMERATION = "|".join(
    (
        *(rf"\b{phrase((intro,))}{GAP}{upto(200)},{upto(200)}," for intro in ("such as", "including")),
        rf"\b{phrase(('along with',))}{GAP}{upto(200)},",
        rf"\bcontaining{GAP}{upto(200)},\s*{upto(80)},\s*(?:and|&){GAP}",
        rf"\b{phrase(('supplemented with',))}{GAP}{upto(120)}{GAP}and{GAP}",
        rf",\s*[^,]{{3,50}},\s*and{GAP}[a-z]",
        words(("with soothing ingredients such as",)),
    )
)
#: Connectors of several actives.
MULTI_CUE = "|".join(
    (
        phrase(("combined with", "supplemented with")),
        rf",\s*[^,]{{2,50}},{GAP}and{GAP}",
        words(("plus",)),
        rf"{phrase(('with vitamin c',))}\b",
        rf"containing{GAP}{upto(80)},\s*{upto(80)}{GAP}and{GAP}",
        " and ",
    )
)

# Papers that review others, and hair or scalp as the place of an effect.
REVIEWS = ("literature review", "systematic review", "narrative review", "scoping review", "review on efficacy")
HAIR_AND_SCALP = ("scalp", "hair growth", "hair loss", "hair follicle", "hair care", "hair tonic", "dandruff")

# What a claim may say, field by field, and targets that say nothing.
CLAIM_TYPES = ("efficacy", "safety", "mechanism")
RELATIONS = ("improves", "reduces", "prevents", "increases", "is_safe_for", "is_well_tolerated_for", "causes", "does_not_cause", "inhibits", "stimulates", "regulates", "modulates")
TARGET_CATEGORIES = ("effect", "concern", "mechanism_target")
DIRECTIONS = ("supports", "refutes", "neutral")
STUDY_CONTEXTS = ("human_topical", "human_oral", "human_intradermal", "in_vitro", "animal", "review", "unknown")
WEAK_TARGETS = ("benefit", "benefits", "outcome", "outcomes", "condition", "conditions", "efficacy", "safety", "improvement", "result", "results", "therapy", "treatment")

# Names of preparations taken for ingredients, and node ids of such.
NO_INGREDIENTS = ("cream", "water", "lotion", "serum", "gel", "foam", "oil", "emulsion", "크림", "빙하수", "멜라닌")
NO_NODES = ("CREAM", "WATER", "MELANIN")
# Concerns that an active may cause, and attributions that name their cause.
SENSITIVITIES = ("SENSITIVE_SKIN", "REDNESS", "IRRITATED_SKIN", "ATOPIC_PRONE", "ROSACEA_PRONE", "BARRIER_DAMAGE")
SURE_ATTRIBUTIONS = ("single_active", "single_formulation")
# Effects that meet a concern.
CONCERN_EFFECTS = {
    "ACNE": ("ANTI_INFLAMMATORY", "SEBUM_REGULATION", "KERATOLYTIC", "COMEDOLYTIC", "ANTIMICROBIAL"),
    "SENSITIVE_SKIN": ("SOOTHING", "ANTI_INFLAMMATORY", "BARRIER_REPAIR", "HYDRATING"),
    "BARRIER_DAMAGE": ("BARRIER_REPAIR", "HYDRATING", "MOISTURE_RETENTION", "SOOTHING"),
    "HYPERPIGMENTATION": ("DEPIGMENTING", "BRIGHTENING", "ANTI_INFLAMMATORY"),
    "DRY_SKIN": ("HYDRATING", "MOISTURE_RETENTION", "BARRIER_REPAIR"),
    "OILY_SKIN": ("SEBUM_REGULATION", "ANTI_INFLAMMATORY"),
    "POST_ACNE_MARKS": ("DEPIGMENTING", "BRIGHTENING", "ANTI_INFLAMMATORY"),
}
# Names that stand for a node whatever the lookup says.
NODE_OVERRIDES = {"alpha arbutin": "ALPHA-ARBUTIN", "azelaic acid": "AZELAIC ACID", "ceramide": "CERAMIDE NP", "coenzyme q10": "UBIQUINONE"}
