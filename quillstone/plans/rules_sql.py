"""Pieces that several queries and their SQL share: options picked by a number, and the rules on targets as SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(options: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (number % len(options) + 1).cast("int"))


def pick_sql(options: tuple[str, ...], number: str) -> str:
    text = ", ".join("'" + o.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for o in options)
    return f"([{text}])[({number}) % {len(options)} + 1]"


# Rewritings of targets in the SQL, and lists of targets that are none.
def target_flat_sql(column: str) -> str:
    """`column` in small letters without blanks and marks around it, rewritten phrase by phrase."""
    out = f"lower(trim(regexp_replace(trim({column}, ' '), '\\s+', ' ', 'g'), ' .;,:()[]{{}}'))"
    for a, b in (
        ("\\bpost inflammatory hyperpigmentation\\b", "post-inflammatory hyperpigmentation"), ("\\blaser induced post inflammatory hyperpigmentation\\b", "laser-induced post-inflammatory hyperpigmentation"), ("\\blaser-induced pih\\b", "laser-induced post-inflammatory hyperpigmentation"),
        ("\\bpih\\b", "post-inflammatory hyperpigmentation"), ("\\bphoto damaged\\b", "photo-damaged"), ("\\bphotoaging\\b", "facial photoaging"), ("\\btolerability / tolerance\\b", "tolerability"), ("\\btolerance / tolerability\\b", "tolerability"), ("\\btolerance\\b", "tolerability"),
    ):
        out = f"regexp_replace({out}, '{a}', '{b}', 'g')"
    return out


TARGET_SQL = """CASE WHEN {0} IN ('barrier', 'skin barrier', 'barrier function', 'skin barrier function') THEN 'skin barrier function' WHEN {0} IN ('transepidermal water loss', 'tewl', 'increased transepidermal water loss', 'reduced transepidermal water loss') THEN 'transepidermal water loss'
    WHEN {0} IN ('hydration', 'skin hydration', 'cutaneous hydration') THEN 'hydration' WHEN {0} IN ('erythema', 'skin erythema', 'facial erythema', 'redness') THEN 'erythema' WHEN {0} IN ('melasma severity', 'melasma') THEN 'melasma'
    WHEN {0} IN ('hyperpigmentation', 'facial hyperpigmentation') THEN 'hyperpigmentation' WHEN {0} = 'uv-induced immunosuppression' THEN 'UV-induced immunosuppression' ELSE {0} END"""
_S_EXACT = "benefit|benefits|effect|effects|effectiveness|outcome|outcomes|properties|treatment|treatments|topical treatment|topical treatments|effectiveness of topical treatments|patient outcomes|blood loss|perioperative bleeding|perioperative bleeding treatment|fibrinolysis|systemic txa levels|seroma risk|reparative effects|anti-inflammatory effects|protective metabolites|therapeutic option|clinical improvement|unknown|ven|surgical contexts|microemulsion area|cell migration|dermal papilla cells|dpcs|anti-acne therapies|peristomal skin complications|gingival pigmentation|gingival melanin|gingival"
_S_NOT_HERE = "perioperative|blood loss|fibrinolysis|systemic txa|seroma risk|surgery|surgical|ostomy|ven|clinical improvement|topical treatment|therapeutic option|protective metabolite|carcinoma|cancer|tumor|tumour|microemulsion|nanoemulsion|particle size|release profile|encapsulation efficiency|drug delivery|transdermal delivery|dermal papilla|dpc|cell migration|gene expression|mrna|protein expression|fibroblast proliferation|keratinocyte proliferation|anti-acne therap|peristomal|stoma|gingival|rhinitis|rhinosinusitis|nasal obstruction"
_S_HINT = "skin|facial|barrier|hydration|hydrate|moistur|xerosis|transepidermal water loss|tewl|pigmentation|melasma|photoaging|photo-damaged|photodamaged|wrinkle|elasticity|erythema|redness|irritation|acne|sebum|oiliness|oil control|pore|exfoliation|keratolytic|keratolysis|peeling|desquamation|texture|roughness|dullness|immunosuppression|pih|tolerance|tolerability"
REJECTED_SQL = f"({{0}} = '' OR regexp_matches({{0}}, '^({_S_EXACT})$') OR regexp_matches({{0}}, '{_S_NOT_HERE}') OR len(list_filter(regexp_split_to_array(trim({{0}}, ' '), '\\s+'), lambda w: w <> '')) > 8 OR NOT regexp_matches({{0}}, '{_S_HINT}'))"
COMPATIBLE_SQL = "CASE lower(trim({1}, ' ')) WHEN 'stimulates' THEN NOT regexp_matches({0}, 'cell|migration') WHEN 'increases' THEN regexp_matches({0}, 'hydration|tolerability|elasticity|tolerance') WHEN 'causes' THEN regexp_matches({0}, 'irritation|erythema|redness|sensitivity') WHEN 'does_not_cause' THEN regexp_matches({0}, 'irritation|erythema|redness|sensitivity') ELSE true END"
