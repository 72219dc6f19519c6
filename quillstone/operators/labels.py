"""Sentence predicates and deterministic labels: ordered rules over lists of phrases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T


def worthy_section(section: Column, blocked: Sequence[str] = L.BLOCKED_SECTIONS) -> Column:
    """False for the listed sections; null and blank ones pass."""
    return F.coalesce(~F.lower(F.trim(section)).isin(list(blocked)), F.lit(True))


def blocked_heading(sentence: Column) -> Column:
    return L.starts_any(sentence, L.BLOCKED_HEADINGS)


def result_heading(sentence: Column) -> Column:
    return L.starts_any(sentence, L.RESULT_HEADINGS)


def in_domain(sentence: Column, markers: Sequence[str] = L.DOMAIN_MARKERS, words: Sequence[str] = L.DOMAIN_WORDS) -> Column:
    return L.contains_any(sentence, markers) | L.words_any(sentence, words)


def claim_signal(sentence: Column) -> Column:
    return result_heading(sentence) | L.contains_any(sentence, (*L.CLAIM_MARKERS, *L.NEGATION_MARKERS))


def candidate_sentence(sentence: Column) -> Column:
    """Whether a sentence may state a claim: in the domain, with a signal, and neither about method nor about a
    subject that is no target."""
    bare = T.strip_heading(sentence)
    return ~L.contains_any(sentence, L.NON_CLAIM_MARKERS) & ~L.starts_any(bare, L.NON_SUBJECTS) & ~F.coalesce(F.lower(bare).rlike("^cer[0-9]"), F.lit(False)) & in_domain(sentence) & claim_signal(sentence)


def study_design(sentence: Column) -> Column:
    """Whether a sentence tells how a study was made: by its heading or by a phrase, unless it is headed as a result."""
    return ~result_heading(sentence) & (L.starts_any(sentence, C.DESIGN_HEADINGS) | L.contains_any(sentence, L.STUDY_PHRASES))


def enumerates(sentence: Column, table: Mapping[str, str] | None = None, names: Column | None = None) -> Column:
    """Whether a sentence brings in a list and names two things or more, those of `table` or those in `names`."""
    if names is None:
        names = F.transform(L.alias_matches(sentence, table), lambda a: L.name_of(a, table))
    return L.contains_any(sentence, L.LIST_TRIGGERS) & (F.size(F.array_distinct(names)) >= 2)


def excluded(sentence: Column, phrases: Column, whole_words: Sequence[str] = ()) -> Column:
    """Whether a sentence holds one of the phrases in an array column, as a whole word if it is one of `whole_words`."""
    low = F.lower(sentence)
    # the pattern of a phrase, read literally
    bounded = lambda p: F.concat(F.lit(L.LEFT + r"\Q"), F.lower(p), F.lit(r"\E" + L.RIGHT))
    return F.coalesce(F.exists(phrases, lambda p: F.when(F.lower(p).isin(list(whole_words)), F.regexp_like(low, bounded(p))).otherwise(low.contains(F.lower(p)))), F.lit(False))


def rejected_target(target: Column, exact: Sequence[str], patterns: Sequence[str], hints: Sequence[str], most_words: int = 8) -> Column:
    """Whether a target phrase is blank, generic, out of the domain or too long."""
    flat = F.lower(F.trim(F.coalesce(target, F.lit(""))))
    return (flat == "") | flat.isin(list(exact)) | L.contains_any(flat, patterns) | (T.word_count(flat) > most_words) | ~L.contains_any(flat, hints)


def compatible(relation: Column, target: Column, rules: Mapping[str, tuple[bool, Sequence[str]]]) -> Column:
    """Whether a relation may be said of a target: `rules` gives, per relation, whether the target must (True) or must
    not (False) hold one of the phrases. Other relations may."""
    flat = F.lower(F.trim(relation))
    out = F.lit(True)
    for name, (must, phrases) in rules.items():
        hit = L.contains_any(target, phrases)
        out = F.when(flat == name, hit if must else ~hit).otherwise(out)
    return out


def significance(sentence: Column, target: Column, claim_type: Column, relation: Column) -> Column:
    """'not_significant', 'significant', 'not_applicable' or 'unclear', read from the clause that matters."""
    scored = L.scored_clause(sentence, target, L.EFFECT_VERBS)
    kind, rel = F.lower(F.trim(F.coalesce(claim_type, F.lit("")))), F.lower(F.trim(F.coalesce(relation, F.lit(""))))
    return L.first_label(
        [
            (L.contains_any(scored, L.NOT_SIGNIFICANT), "not_significant"),
            (L.contains_any(scored, L.SIGNIFICANT), "significant"),
            (((kind == "safety") | rel.isin("is_well_tolerated_for", "is_safe_for")) & L.contains_any(scored, ("tolerat", "safe")), "not_applicable"),
            ((kind == "mechanism") & ~L.contains_any(scored, ("efficacy", "improv")), "not_applicable"),
        ],
        "unclear",
    )


def strength(sentence: Column, significance_label: Column) -> Column:
    """'strong', 'moderate' or 'weak' by the cues of a sentence."""
    closing = L.starts_any(sentence, ("conclusion", "results:", "result:")) | F.coalesce(F.substring(F.lower(F.trim(sentence)), 1, 50).contains("conclusion:"), F.lit(False))
    return L.first_label(
        [
            (F.coalesce(significance_label == "not_significant", F.lit(False)), "weak"),
            (L.contains_any(sentence, L.STRONG_CUES), "strong"),
            (L.contains_any(sentence, (*L.HEDGES, *L.WEAK_CUES)), "weak"),
            (L.contains_any(sentence, L.MODERATE_CUES), "moderate"),
            (closing & L.contains_any(sentence, ("effective", "decreased", "improvement", "repair", "barrier")), "moderate"),
        ],
        "weak",
    )


def modality(sentence: Column, claim_type: Column, relation: Column) -> Column:
    kind, rel = F.lower(F.trim(F.coalesce(claim_type, F.lit("")))), F.lower(F.trim(F.coalesce(relation, F.lit(""))))
    return L.first_label(
        [
            (kind == "mechanism", "mechanism"),
            ((rel == "prevents") | L.starts_any(sentence, ("to prevent",)), "prevention"),
            ((kind == "safety") | rel.isin("is_well_tolerated_for", "is_safe_for"), "safety"),
            (L.contains_any(sentence, L.VEHICLE_CUES), "formulation_support"),
        ],
        "efficacy",
    )


def named(name: Column, text: Column, cues: Mapping[str, tuple[Sequence[str], Sequence[str]]] = C.MENTIONS) -> Column:
    """Whether text mentions a name: as a whole word, or by one of its cues (whole words, parts of words).
    A name without letter or digit is mentioned nowhere."""
    low, flat = F.lower(text), F.lower(F.trim(name))
    by_cue = F.lit(False)
    for who, (whole, parts) in cues.items():
        hit = F.lit(False)
        if whole:
            hit = hit | low.rlike(C.words(whole))
        if parts:
            hit = hit | L.contains_any(text, parts)
        by_cue = F.when(flat == who, hit).otherwise(by_cue)
    return F.coalesce((low.contains(flat) & flat.rlike(r"[\p{L}\p{N}]") & F.regexp_like(low, F.concat(F.lit(L.LEFT + r"\Q"), flat, F.lit(r"\E" + L.RIGHT)))) | by_cue, F.lit(False))


def primary_clause(sentence: Column, name: Column) -> Column:
    """The first clause that mentions the name, else the whole; '' for null."""
    whole = F.coalesce(F.trim(sentence), F.lit(""))
    return F.coalesce(F.try_element_at(F.filter(L.clauses(whole), lambda c: named(name, c)), F.lit(1)), whole)


def several_actives(clause: Column, units: Column) -> Column:
    """Whether a clause ties the units named in it together: by listing lines, by a connector, or by standing within
    twelve words of each other near a verb of effect, or within six."""
    low = F.lower(clause)
    lines = F.size(F.filter(units, lambda u: u.startswith("[line:")))
    keys = F.filter(F.transform(F.filter(units, lambda u: ~u.startswith("[line:")), lambda u: F.lower(F.btrim(u, F.lit("[]")))), lambda k: F.length(k) > 2)
    tokens = F.filter(F.split(F.trim(low), r"\s+"), lambda t: t != "")
    at = F.array_compact(F.transform(tokens, lambda t, i: F.when(F.exists(keys, lambda k: t.contains(k)), i)))
    first, span = F.array_min(at), F.array_max(at) - F.array_min(at)
    begin = F.aggregate(F.slice(tokens, 1, F.coalesce(first, F.lit(0))), F.lit(0), lambda n, t: n + F.length(t) + 1)
    low_end = F.greatest(begin - 80, F.lit(0))
    near = F.substring(low, low_end + 1, begin + 120 - low_end)
    close = (F.size(at) >= 2) & ((span <= 6) | ((span <= 12) & L.contains_any(near, L.EFFECT_VERBS)))
    return F.coalesce((lines >= 2) | ((F.size(F.array_distinct(units)) >= 2) & (low.rlike(C.MULTI_CUE) | close)), F.lit(False))


def attribution(sentence: Column, name: Column, units: Column, clause: Column | None = None, aliases: Column | None = None) -> Column:
    """What an effect is owed to: a procedure, a preparation, several actives, one active, or it is ambiguous.

    `clause` is the primary clause, the sentence if left out, and `units` the things named in it; `aliases` of the name
    count where it is not mentioned itself. `reconciled` looks at the units of the whole sentence afterwards.
    """
    clause = sentence if clause is None else clause
    s = F.lower(F.coalesce(sentence, F.lit("")))
    n_units = F.size(F.array_distinct(units))
    called = named(name, clause) | named(name, sentence)
    if aliases is not None:
        called = called | F.coalesce(F.exists(aliases, lambda a: named(a, sentence, {})), F.lit(False))
    carrier = s.rlike(C.CARRIER)
    return L.first_label(
        [
            (s.rlike(C.ADJUNCT), "procedure_adjunct_combination"),
            (s.rlike(C.AFTERCARE) & carrier, "post_procedure_recovery_formulation"),
            (s.rlike(C.PROCEDURE) & ~carrier, "procedure_adjunct_combination"),
            ((n_units >= 2) & several_actives(clause, units), "multi_active_combination"),
            (carrier & (n_units <= 1) & called, "single_formulation"),
            (called, "single_active"),
        ],
        "ambiguous",
    )


def reconciled(label: Column, sentence: Column, units: Column, lists: Column | None = None) -> Column:
    """A single active becomes several where the sentence names two things, writes a list or is listing lines. `lists`:
    the list guard, where it is known."""
    lists = list_guard(sentence) if lists is None else lists
    several = (unit_count(units) >= 2) | lists | (F.size(L.line_units(sentence, L.VERB_HINTS)) >= 2)
    return F.when((label == "single_active") & several, "multi_active_combination").otherwise(label)


def unit_count(units: Column) -> Column:
    """Distinct units that are not blank; 0 for null."""
    return F.coalesce(F.size(F.array_distinct(F.filter(F.transform(units, lambda u: F.trim(u)), lambda u: u != ""))), F.lit(0))


def list_guard(sentence: Column) -> Column:
    return F.coalesce(F.lower(sentence).rlike(C.ENUMERATION), F.lit(False))


def detection_suspect(sentence: Column, units: Column, lists: Column | None = None) -> Column:
    """A list is written but at most one unit was found. `lists`: the list guard, where it is known."""
    return (list_guard(sentence) if lists is None else lists) & (unit_count(units) <= 1)


def weight(*factors: tuple[Column, Mapping[str, float], float]) -> Column:
    """Product of looked-up weights, rounded to six places; each factor is (label, table, weight of other labels)."""
    out = F.lit(1.0)
    for label, table, other in factors:
        out = out * F.coalesce(T.lit_map(table)[F.lower(F.trim(label))], F.lit(other))
    return F.round(out, 6)


# Weights of the labels.
STRENGTH_WEIGHT = {"strong": 1.0, "moderate": 0.75, "weak": 0.35}
SIGNIFICANCE_WEIGHT = {"significant": 1.0, "unclear": 0.8, "not_applicable": 0.7, "not_significant": 0.05}
ATTRIBUTION_WEIGHT = {"single_active": 1.0, "single_formulation": 0.8, "multi_active_combination": 0.45, "procedure_adjunct_combination": 0.35, "post_procedure_recovery_formulation": 0.72, "procedure_combination": 0.35, "ambiguous": 0.2}
CONTEXT_WEIGHT = {"human_topical": 1.0, "human_oral": 0.95, "human_intradermal": 0.9, "in_vitro": 0.4, "animal": 0.65, "review": 0.5, "unknown": 0.75}


def mentions(text: Column, synonyms: Mapping[str, Sequence[str]], relation: Column | None = None, only: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Sorted codes whose name or synonym stands in text, as part of a word too; those in `only` need one of its relations."""
    by_word: dict[str, set[str]] = {}
    for code, many in synonyms.items():
        for w in many:
            if w:
                by_word.setdefault(w.lower(), set()).add(code)
    if not by_word:
        return F.array().cast("array<string>")
    # at each place the longest word that begins there is taken, which stands for the shorter ones it begins with
    codes = {w: sorted(set().union(*(c for o, c in by_word.items() if w.startswith(o)))) for w in by_word}
    of = L.lookup(codes, "array<string>")
    hits = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?=({L.automaton(list(by_word))}))"), F.lit(1)))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, of))))
    if not only:
        return found
    said = F.coalesce(F.lower(F.trim(relation)), F.lit(""))
    for code, relations in only.items():
        found = F.when(said.isin(list(relations)), found).otherwise(F.array_remove(found, code))
    return found
