"""String operators as Column expressions; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_map(pairs: Mapping[str, str | float]) -> Column:
    """A map literal for lookups."""
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def pipe_split(text: Column, delimiter: str = r"\|") -> Column:
    """Parts of a delimited list without blanks around them; blank parts go, null gives null."""
    return F.filter(F.transform(F.split(text, delimiter), lambda x: F.trim(x)), lambda x: x != "")


def dedup_ci(items: Column) -> Column:
    """Items without repeats, whatever their case; the first spelling of each, in order. Blank items go."""
    flat = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    keys = F.transform(flat, lambda x: F.lower(x))
    return F.filter(flat, lambda x, i: F.array_position(keys, F.lower(x)) == (i + 1).cast("long"))


def or_group(terms: Column, field: str = "Title/Abstract") -> Column:
    """'("a"[field] OR "b"[field])' over distinct terms."""
    return F.concat(F.lit("("), F.array_join(F.transform(dedup_ci(terms), lambda t: F.concat(F.lit('"'), t, F.lit(f'"[{field}]'))), " OR "), F.lit(")"))


def boolean_query(name: Column, aliases: Column, keywords: Column, required: Column, excluded: Column, domain_terms: Sequence[str], hint_terms: Sequence[str]) -> Column:
    """Groups of alternatives joined by AND: names, domain words, hint words, required ones; then AND NOT the excluded.

    The list columns are pipe-delimited; null or blank ones add nothing.
    """
    none = F.array().cast("array<string>")
    parts = lambda c: F.coalesce(pipe_split(c), none)
    words = lambda terms: F.array(*(F.lit(t) for t in terms))
    groups = F.array_compact(
        F.array(
            or_group(F.concat(F.array(F.trim(name)), parts(aliases))),
            or_group(F.concat(words(domain_terms), parts(keywords))),
            or_group(F.concat(words(hint_terms), parts(keywords))),
            F.when(F.size(parts(required)) > 0, or_group(parts(required))),
            F.when(F.size(parts(excluded)) > 0, F.concat(F.lit("NOT "), or_group(parts(excluded)))),
        )
    )
    return F.array_join(groups, " AND ")


#: Abbreviations whose stop ends no sentence in the plain splitter.
ABBREVIATIONS = ("e.g.", "i.e.", "vs.", "Dr.", "Mr.", "Mrs.", "Prof.")


def plain_sentences(text: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """Sentences of English text: cut at blanks after . ! or ?, save after an abbreviation. Null gives null."""
    held = F.trim(text)
    for a in abbreviations:
        held = F.replace(held, F.lit(a), F.lit(a.replace(".", "<DOT>")))
    return F.filter(F.transform(F.split(held, r"(?<=[.!?])\s+"), lambda s: F.trim(F.replace(s, F.lit("<DOT>"), F.lit(".")))), lambda s: s != "")


def with_offsets(text: Column, parts: Column) -> Column:
    """array<struct<part, start_at, end_at>>: where each part stands in the text, looked for from the end of the one
    before; a part that isn't found starts there."""
    start = F.struct(F.lit(0).alias("cursor"), F.expr("cast(array() as array<struct<part:string,start_at:int,end_at:int>>)").alias("found"))

    def step(acc: Column, part: Column) -> Column:
        hit = F.call_function("locate", part, text, acc["cursor"] + 1)
        at = F.when(hit > 0, hit - 1).otherwise(acc["cursor"]).cast("int")
        end = (at + F.length(part)).cast("int")
        return F.struct(end.alias("cursor"), F.concat(acc["found"], F.array(F.struct(part.alias("part"), at.alias("start_at"), end.alias("end_at")))).alias("found"))

    return F.aggregate(parts, start, step, lambda acc: acc["found"])


def word_count(text: Column) -> Column:
    """Number of stretches between blanks; 0 for blank text."""
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def slug(text: Column) -> Column:
    """Small letters and digits, anything else one underscore; 'unknown' if nothing is left."""
    flat = F.btrim(F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(flat == "", "unknown").otherwise(flat)


#: Relations taken for another in canonical claims.
CANONICAL_RELATIONS = {"is_safe_for": "is_well_tolerated_for", "increases": "improves", "inhibits": "reduces", "stimulates": "improves", "regulates": "improves", "modulates": "improves"}


def canonical_relation(relation: Column, synonyms: Mapping[str, str] = CANONICAL_RELATIONS) -> Column:
    flat = F.lower(F.trim(F.coalesce(relation, F.lit(""))))
    return F.coalesce(lit_map(synonyms)[flat], flat)


def canonical_key(ingredient: Column, relation: Column, target: Column, category: Column) -> Column:
    return F.concat_ws("|", slug(ingredient), slug(canonical_relation(relation)), slug(target), slug(category))


def scope_key(pmid: Column, sentence: Column, ingredient: Column, relation: Column, target: Column) -> Column:
    """The first 20 hex digits of the SHA-1 of the parts that make a claim the same; nulls count as empty."""
    flat = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return F.substring(F.sha1(F.concat_ws("|", flat(pmid), flat(sentence), F.lower(flat(ingredient)), F.lower(flat(relation)), F.lower(flat(target)))), 1, 20)


def evidence_id(batch_id: Column, scope: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", F.coalesce(batch_id, F.lit("")), scope)), 1, 16)


def strip_heading(text: Column) -> Column:
    """Text without a leading 'Results:' or 'Conclusions:'."""
    return F.regexp_replace(F.trim(text), r"(?i)^(results?|conclusions?):\s*", "")


def rewrite(text: Column, rules: Sequence[tuple[str, str]], equal: Mapping[str, str] | None = None, trim: str = " .;,:()[]{}") -> Column:
    """Text in small letters with blanks squeezed and marks stripped, rewritten by the rules in order, then, if the
    whole of it is a key of `equal`, replaced."""
    flat = F.lower(F.btrim(F.regexp_replace(F.trim(text), r"\s+", " "), F.lit(trim)))
    for pattern, by in rules:
        flat = F.regexp_replace(flat, pattern, by)
    return F.coalesce(lit_map(equal)[flat], flat) if equal else flat


#: Rewritings of target phrases, in order.
TARGET_RULES = (
    (r"\bpost inflammatory hyperpigmentation\b", "post-inflammatory hyperpigmentation"),
    (r"\blaser induced post inflammatory hyperpigmentation\b", "laser-induced post-inflammatory hyperpigmentation"),
    (r"\blaser-induced pih\b", "laser-induced post-inflammatory hyperpigmentation"),
    (r"\bpih\b", "post-inflammatory hyperpigmentation"),
    (r"\bphoto damaged\b", "photo-damaged"),
    (r"\bphotoaging\b", "facial photoaging"),
    (r"\btolerability / tolerance\b", "tolerability"),
    (r"\btolerance / tolerability\b", "tolerability"),
    (r"\btolerance\b", "tolerability"),
)
#: Whole target phrases that mean the same.
TARGET_EQUALS = {
    "barrier": "skin barrier function",
    "skin barrier": "skin barrier function",
    "barrier function": "skin barrier function",
    "tewl": "transepidermal water loss",
    "increased transepidermal water loss": "transepidermal water loss",
    "reduced transepidermal water loss": "transepidermal water loss",
    "skin hydration": "hydration",
    "cutaneous hydration": "hydration",
    "skin erythema": "erythema",
    "facial erythema": "erythema",
    "redness": "erythema",
    "melasma severity": "melasma",
    "facial hyperpigmentation": "hyperpigmentation",
    "uv-induced immunosuppression": "UV-induced immunosuppression",
}


def function_names(cell: Column) -> Column:
    """Names in a ';' list, in capitals, without what follows ' - '."""
    return F.transform(pipe_split(cell, ";"), lambda f: F.trim(F.split_part(F.upper(f), F.lit(" - "), F.lit(1))))


def id_list(ids: Column, delimiter: str = "|") -> Column:
    """Sorted distinct numbers joined; empty for none."""
    return F.array_join(F.sort_array(F.array_distinct(F.coalesce(ids, F.array().cast("array<int>")))), delimiter)


def safe_int(text: Column) -> Column:
    """A whole number, or null for anything else, '1.0' included."""
    return F.when(F.regexp_like(F.trim(text), F.lit(r"^[+-]?\d+$")), F.trim(text).try_cast("int"))


def float_int(text: Column) -> Column:
    """The whole part of a number, or null for other text, NaN and numbers that are no int."""
    return F.trim(text).try_cast("double").try_cast("int")


def pipe_ints(text: Column) -> Column:
    """Distinct sorted whole parts of the numbers in a pipe list; blanks, 'nan' and other text are passed over."""
    parts = F.filter(pipe_split(text), lambda p: F.lower(p) != "nan")
    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, float_int), lambda i: i.isNotNull())))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def dict_cell_to_json(cell: Column) -> Column:
    """A cell that holds a dictionary as Python writes it, as JSON without its false values; null if nothing is left."""
    # words of Python outside quotes become those of JSON; what quotes hold stays
    parts = F.regexp_extract_all(cell, F.lit(r"""(?s)'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+"""), F.lit(0))
    plain = lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    text = F.array_join(F.transform(parts, lambda p: F.when(p.startswith("'") | p.startswith('"'), p).otherwise(plain(p))), "")
    kept = F.map_filter(F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"}), lambda k, v: v.isNotNull() & ~v.isin("", "0", "0.0", "false"))
    return F.when(F.size(kept) > 0, F.to_json(kept))


def title_case(text: Column) -> Column:
    """Each letter after something that is no letter as a capital, the others small: "alpha-arbutin 2b" as "Alpha-Arbutin 2B"."""
    parts = F.split(F.lower(text), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))), "")
