"""Which sentences state a claim, about which name, and which claims hold: predicates as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import labels as B



def _or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# ---- sentences --------------------------------------------------------------------------------------------------


def foreign_domain(sentence: Column) -> Column:
    """Whether a sentence speaks of a domain in which nothing is claimed of skin care."""
    return L.contains_any(sentence, C.FOREIGN_DOMAINS)


def leads_elsewhere(sentence: Column) -> Column:
    """Whether a sentence, its heading left out, begins with a subject that is no target."""
    subjects = L.alternation(C.LEADING_SUBJECTS).replace("cer#", r"cer\d+")
    return _or_false(F.lower(T.strip_heading(sentence)).rlike(rf"^(?:{subjects})\b"))


def positive_signal(sentence: Column) -> Column:
    return B.result_heading(sentence) | L.contains_any(sentence, C.POSITIVE_SIGNALS)


def skin_context(sentence: Column) -> Column:
    return L.contains_any(sentence, C.SKIN_CONTEXT) | L.words_any(sentence, L.DOMAIN_WORDS)


def claim_like(sentence: Column) -> Column:
    """Whether a sentence states a claim about skin: false for null and blank."""
    return _or_false(F.trim(sentence) != "") & ~foreign_domain(sentence) & ~B.study_design(sentence) & ~leads_elsewhere(sentence) & positive_signal(sentence) & skin_context(sentence)


def context_allows(name: Column, sentence: Column, rules: Mapping[str, tuple[Sequence[str], Sequence[str], Sequence[str]]] = C.CONTEXT_RULES) -> Column:
    """Whether the sentence is one in which `name` may be meant. `rules` gives, by name in small letters, words and
    phrases that rule it out and phrases of which one must be there; a word of the domain will do as well."""
    out = F.lit(True)
    for who, (out_words, out_phrases, needed) in rules.items():
        ok = ~L.words_any(sentence, out_words) & ~L.contains_any(sentence, out_phrases) & (L.contains_any(sentence, needed) | L.words_any(sentence, L.DOMAIN_WORDS))
        out = F.when(F.lower(name) == who, ok).otherwise(out)
    return out


def review_style(sentence: Column, title: Column, study_context: Column) -> Column:
    """Whether a sentence reports what a review says."""
    both = F.concat_ws(" ", sentence, title)
    return _or_false(F.lower(F.trim(study_context)) == "review") | L.contains_any(both, C.REVIEWS)


def hair_or_scalp(sentence: Column, title: Column) -> Column:
    """Whether hair or the scalp is the place of an effect."""
    return L.contains_any(F.concat_ws(" ", title, sentence), C.HAIR_AND_SCALP)


# ---- names ------------------------------------------------------------------------------------------------------


def ingredient_rules(targets: DataFrame, *, name: str = "canonical_name", query: str = "query_name", aliases: str = "alias_list", excludes: str = "exclude_if_contains", flag: str = "is_target", more_aliases: Mapping[str, Sequence[str]] = C.EXTRA_ALIASES, more_excludes: Mapping[str, Sequence[str]] = C.EXTRA_EXCLUDES) -> DataFrame:
    """canonical_name, aliases and excludes of the targets that are switched on, one row per name: its own name, query
    name and listed aliases, then those of `more_aliases`; exclude patterns likewise. Without repeats whatever the case,
    the first spelling stays. Of several rows with a name the last one by all its columns counts."""
    from quillstone.sources.readers import is_true

    none = F.array().cast("array<string>")
    more = lambda table, c: F.coalesce(F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))[c], none) if table else none
    parts = lambda c: F.coalesce(T.pipe_split(F.col(c)), none)
    own = F.trim(name)
    # exclude patterns of the table are trimmed, those of single names keep their blanks
    rows = targets.where(is_true(F.col(flag)) & (own != "")).select(
        own.alias("canonical_name"),
        T.dedup_ci(F.array_compact(F.concat(F.array(own, F.nullif(F.trim(query), F.lit(""))), parts(aliases), more(more_aliases, own)))).alias("aliases"),
        F.array_distinct(F.concat(parts(excludes), F.transform(more(more_excludes, own), lambda x: F.trim(x)))).alias("excludes"),
    )
    return rows.groupBy("canonical_name").agg(F.max(F.struct("aliases", "excludes")).alias("r")).select("canonical_name", "r.*")


def alias_map(rules: DataFrame, overrides: Mapping[str, str] = C.ALIAS_OVERRIDES) -> DataFrame:
    """alias (small letters) and the name it stands for: of `rules`, of several names the last in order; an override
    always wins, also for names that no rule has."""
    cells = rules.select("canonical_name", F.explode("aliases").alias("alias")).select(F.lower("alias").alias("alias"), "canonical_name")
    listed = cells.groupBy("alias").agg(F.max("canonical_name").alias("canonical_name"))
    fixed = rules.sparkSession.createDataFrame([(a, n) for n, many in overrides.items() for a in many.split("|")], "alias string, canonical_name string")
    from quillstone.runtime import broadcast_if_small

    return listed.join(broadcast_if_small(fixed), "alias", "left_anti").unionByName(fixed)


def normal_names(rows: DataFrame, name: str, aliases: DataFrame, out: str = "normal_name", families: Mapping[str, str] | None = None) -> DataFrame:
    """`rows` with column `out`: the name that `name` is an alias of; else the family whose pattern it fits; else null."""
    from quillstone.runtime import broadcast_if_small

    families = {r"^ceramide(?:\s+[a-z0-9]+)+$": "Ceramide"} if families is None else families
    flat = F.lower(F.trim(name))
    look = broadcast_if_small(aliases.select(F.col("alias").alias("_alias"), F.col("canonical_name").alias("_name")))
    kin = F.lit(None).cast("string")
    for pattern, family in families.items():
        kin = F.when(flat.rlike(pattern), family).otherwise(kin)
    return rows.withColumn("_flat", flat).join(look, F.col("_flat") == F.col("_alias"), "left").select(*rows.columns, F.coalesce("_name", kin).alias(out))


def extracted_name(sentence: Column, table: Mapping[str, str], excludes: Mapping[str, Sequence[str]] = C.EXTRA_EXCLUDES) -> Column:
    """The one name a sentence makes a claim about; null where it states none, enumerates several, or the name is ruled
    out by its exclude patterns or its context."""
    name = L.subject(sentence, table, L.PREFIX_PATTERNS)
    out = F.lit(False)
    for who, patterns in excludes.items():
        out = F.when(name == who, B.excluded(sentence, F.array(*map(F.lit, patterns)), C.WHOLE_WORDS)).otherwise(out)
    ok = claim_like(sentence) & ~B.enumerates(sentence, table) & ~out & context_allows(name, sentence)
    return F.when(ok, name)


# ---- claims -----------------------------------------------------------------------------------------------------


def validated(claims: DataFrame, table: Mapping[str, str], *, name: str = "normal_name", sentence: str = "source_sentence", target: str = "target", relation: str = "relation", claim_type: str = "claim_type", direction: str = "evidence_direction", confidence: str = "confidence") -> DataFrame:
    """The claims that hold, with name and target in their one form and trimmed fields. A claim holds if its name is
    known (`name` is not null), the sentence, if there is one, is about that name, its target is no generic phrase, the
    relation may be said of it, and type and direction are given. A confidence that is no number becomes 0."""
    c = F.col
    flat = T.rewrite(c(target), T.TARGET_RULES, T.TARGET_EQUALS)
    said = F.nullif(F.trim(sentence), F.lit(""))
    about = said.isNull() | (~leads_elsewhere(said) & _or_false(L.subject(said, table, L.PREFIX_PATTERNS) == c(name)))
    filled = lambda x: _or_false(F.trim(x) != "")
    sound = ~B.rejected_target(flat, L.GENERIC_TARGETS, L.FOREIGN_TARGETS, L.TARGET_HINTS)
    ok = c(name).isNotNull() & about & filled(target) & sound & filled(relation) & B.compatible(c(relation), flat, L.TARGET_RELATIONS) & filled(claim_type) & filled(direction)
    fields = {target: flat, relation: F.trim(relation), claim_type: F.trim(claim_type), direction: F.trim(direction), confidence: F.coalesce(c(confidence).cast("string").try_cast("double"), F.lit(0.0)), sentence: F.coalesce(F.trim(sentence), F.lit(""))}
    return claims.where(ok).withColumns(fields)


def validated_by_lists(claims: DataFrame, allowed: Sequence[str] | None = None, *, name: str = "normal_name") -> DataFrame:
    """The claims whose every field is one that may be: known name, listed type, relation, category, direction and
    context, a target that says something, a confidence that is a number, brought into 0 to 1. A null field rules a
    claim out."""
    c = F.col
    one_of = lambda field, values: _or_false(F.trim(field).isin(list(values)))
    number = c("confidence").cast("string").try_cast("double")
    ok = c(name).isNotNull() & one_of("claim_type", C.CLAIM_TYPES) & one_of("relation", C.RELATIONS) & one_of("target_category", C.TARGET_CATEGORIES) & one_of("evidence_direction", C.DIRECTIONS) & one_of("study_context", C.STUDY_CONTEXTS)
    ok &= _or_false(F.trim("target") != "") & ~F.lower(F.trim("target")).isin(list(C.WEAK_TARGETS)) & number.isNotNull()
    if allowed is not None:
        ok &= c(name).isin(list(allowed))
    return claims.where(ok).withColumns({"confidence": T.clamp(number, 0.0, 1.0)} | {f: F.trim(f) for f in ("claim_type", "relation", "target_category", "evidence_direction", "study_context", "target")})
