"""Queries of the evidence operators over the project's tables, each with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import cues as C
from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.operators import aggregate as A
from quillstone.operators import graph as G
from quillstone.operators import labels as B
from quillstone.operators import quality as Q
from quillstone.operators import upsert as U
from quillstone.operators.dictionary import find_entries, subject_of
from quillstone.operators.extract import claims_of, extract_cached
from quillstone.operators.packed import listed, unpack
from quillstone.plans.rules_sql import COMPATIBLE_SQL, REJECTED_SQL, TARGET_SQL, pick, pick_sql, target_flat_sql
from quillstone.runtime import broadcast_if_small, cut, read_table
from quillstone.sources import readers as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- scans and papers -------------------------------------------------------------------------------------------

_PAPERS_SQL = """
    SELECT pmid, title, abstract_text, journal, publication_year, searched_ingredients, searched_ingredient_count FROM (
        SELECT pmid, title, abstract_text, journal, publication_year, row_number() OVER (PARTITION BY pmid ORDER BY collected_at NULLS FIRST, source NULLS FIRST, searched_ingredient NULLS FIRST, batch_id NULLS FIRST) AS rn FROM bronze_paper
        WHERE pmid IS NOT NULL AND trim(abstract_text, ' ') <> '') p
    JOIN (SELECT pmid, coalesce(string_agg(DISTINCT trim(searched_ingredient), '|' ORDER BY trim(searched_ingredient)) FILTER (trim(searched_ingredient) <> ''), '') AS searched_ingredients,
        CAST(count(DISTINCT trim(searched_ingredient)) FILTER (trim(searched_ingredient) <> '') AS INTEGER) AS searched_ingredient_count
        FROM bronze_paper WHERE pmid IS NOT NULL AND trim(abstract_text, ' ') <> '' GROUP BY pmid) s USING (pmid) WHERE rn = 1"""


@query(_PAPERS_SQL)
def silver_papers(spark: SparkSession, d: str) -> DataFrame:
    """Papers with an abstract, one row each, with the sorted ingredients they were found for."""
    rows = read_table(spark, d, "bronze_paper").where("pmid is not null and trim(abstract_text) <> ''")
    found = A.inverted_index(rows, "pmid", {"searched_ingredient": "|"}).withColumnRenamed("searched_ingredient", "searched_ingredients")
    order = ["collected_at", "source", "searched_ingredient", "batch_id"]
    first = A.first_wins(rows.select("pmid", "title", "abstract_text", "journal", "publication_year", *order), ["pmid"], order).drop(*order)
    return first.join(found, "pmid").withColumn("searched_ingredient_count", R.searched(found, "searched_ingredients"))


@query("""SELECT pmid, string_agg(DISTINCT trim(searched_ingredient), '|' ORDER BY trim(searched_ingredient)) AS searched_ingredient, string_agg(DISTINCT trim(final_query), ' || ' ORDER BY trim(final_query)) AS final_query
    FROM bronze_paper WHERE pmid IS NOT NULL GROUP BY pmid""")
def paper_index(spark: SparkSession, d: str) -> DataFrame:
    """pmid to its ingredients and search texts."""
    return A.inverted_index(read_table(spark, d, "bronze_paper"), "pmid", {"searched_ingredient": "|", "final_query": " || "})


#: Headings that make a labelled section of an abstract, at its start or after a blank.
_LABELS = "|".join(h.rstrip(":").upper() for h in sorted({*L.BLOCKED_HEADINGS, *(r.upper() for r in L.RESULT_HEADINGS)}, key=len, reverse=True))
_SECTION = rf"(?s)^({_LABELS}): (.+)$"
#: A forename and a surname; names with a comma or bare initials at the end are written whole, so that they come back as they are.
_PERSON = r"^([^,]*\S) (?!\p{Lu}{1,3}$)([^\s,]+)$"


@query()
def papers_from_xml(spark: SparkSession, d: str) -> DataFrame:
    """Records written as article XML, one element per author and labelled section, and read back."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    tag = lambda name, c, attr="": F.coalesce(F.concat(F.lit(f"<{name}{attr}>"), esc(c), F.lit(f"</{name}>")), F.lit(""))
    part = lambda c, pattern, i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))

    def section(s: Column) -> Column:
        label = part(s, _SECTION, 1)
        return F.coalesce(F.concat(F.lit('<AbstractText Label="'), label, F.lit('">'), esc(part(s, _SECTION, 2)), F.lit("</AbstractText>")), tag("AbstractText", s))

    def author(a: Column) -> Column:
        inner = F.when(a.rlike(_PERSON), F.concat(tag("LastName", part(a, _PERSON, 2)), tag("ForeName", part(a, _PERSON, 1)))).when(~a.rlike("[ ,]"), tag("LastName", a)).otherwise(tag("CollectiveName", a))
        return F.concat(F.lit("<Author>"), inner, F.lit("</Author>"))

    rows = read_table(spark, d, "bronze_paper").where("pmid is not null and trim(abstract_text) <> ''").where(one(F.col("abstract_text")) != "")
    rows = listed(rows.select("pmid", "title", "abstract_text", "journal", "publication_year", "authors", "doi", "pmcid").distinct(), field="authors", people=True, out="names")
    sections = F.split(one(F.col("abstract_text")), rf" (?=(?:{_LABELS}): )")
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation>"), tag("PMID", F.col("pmid")), F.lit("<Article>"), tag("ArticleTitle", F.trim("title")),
        F.lit("<Journal>"), tag("Title", F.col("journal")), F.lit("<JournalIssue><PubDate>"), tag("Year", F.col("publication_year").cast("string")), F.lit("</PubDate></JournalIssue></Journal>"),
        F.lit("<Abstract>"), F.array_join(F.transform(sections, section), ""), F.lit("</Abstract><AuthorList>"), F.array_join(F.transform("names", lambda a: author(one(a))), ""), F.lit("</AuthorList>"),
        tag("ELocationID", F.col("doi"), ' EIdType="doi"'), F.lit("</Article></MedlineCitation><PubmedData><ArticleIdList>"), tag("ArticleId", F.col("pmcid"), ' IdType="pmc"'), F.lit("</ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return rows.select(R.parse_articles(xml).alias("p")).select("p.*").drop("source_url").distinct()


# Headings that make a labelled section of an abstract, at its start or after a blank.
_SECTIONS = "PATIENTS AND METHODS|MATERIALS AND METHODS|OBJECTIVES|CONCLUSIONS|BACKGROUND|CONCLUSION|OBJECTIVE|PURPOSE|METHODS|RESULTS|RESULT|AIMS|AIM"


@query(f"""WITH b AS (SELECT DISTINCT pmid, trim(title) AS title, trim(regexp_replace(abstract_text, '\\s+', ' ', 'g')) AS t, nullif(trim(journal), '') AS journal, publication_year, authors, doi, pmcid FROM bronze_paper WHERE pmid IS NOT NULL AND trim(regexp_replace(abstract_text, '\\s+', ' ', 'g')) <> '')
    SELECT DISTINCT pmid, title, regexp_replace(t, ' ({_SECTIONS}): ', chr(10) || '\\1: ', 'g') AS abstract_text, journal, publication_year, nullif(array_to_string(list_filter(list_transform(string_split(coalesce(authors, ''), ';'), lambda a: trim(regexp_replace(a, '\\s+', ' ', 'g'))), lambda a: a <> ''), '; '), '') AS authors, doi, pmcid,
        'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' AS source_url FROM b""")
def articles_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Records written as article XML and read back: one element per labelled section and per part of the authors
    between semicolons, forename and surname apart where they can be told, the year at times only as a free date, the
    first word of titles and sections in italics."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    tag = lambda name, c, attr="": F.coalesce(F.concat(F.lit(f"<{name}{attr}>"), c, F.lit(f"</{name}>")), F.lit(""))
    slanted = lambda c: F.regexp_replace(esc(c), r"^(\w+)", "<i>$1</i>")

    def section(s: Column) -> Column:
        label = F.regexp_extract(s, rf"(?s)^({_SECTIONS}): (.+)$", 1)
        body = F.regexp_extract(s, rf"(?s)^({_SECTIONS}): (.+)$", 2)
        return F.when(label != "", F.concat(F.lit('<AbstractText Label="'), label, F.lit('">'), slanted(body), F.lit("</AbstractText>"))).otherwise(tag("AbstractText", slanted(s)))

    def author(a: Column) -> Column:
        # a forename and a surname; what has a comma or bare initials at the end is written whole, to come back as it is
        person = r"^([^,]*\S) (?!\p{Lu}{1,3}$)([^\s,]+)$"
        inner = F.when(a.rlike(person), F.concat(tag("LastName", esc(F.regexp_extract(a, person, 2))), tag("ForeName", esc(F.regexp_extract(a, person, 1))))).when(~a.rlike("[ ,]"), tag("LastName", esc(a))).otherwise(tag("CollectiveName", esc(a)))
        return tag("Author", inner)

    rows = read_table(spark, d, "bronze_paper").where("pmid is not null").where(one(F.col("abstract_text")) != "").select("pmid", "title", "abstract_text", "journal", "publication_year", "authors", "doi", "pmcid")
    sections = F.split(one(F.col("abstract_text")), rf" (?=(?:{_SECTIONS}): )")
    names = F.filter(F.transform(F.split(F.coalesce("authors", F.lit("")), ";"), one), lambda a: a != "")
    year = F.col("publication_year").cast("string")
    date = F.when(F.length("abstract_text") % 3 == 0, tag("MedlineDate", F.concat(year, F.lit(" Jan-Feb")))).otherwise(tag("Year", year))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation>"), tag("PMID", esc(F.col("pmid"))), F.lit("<Article>"), tag("ArticleTitle", slanted(F.trim("title"))),
        F.lit("<Journal>"), tag("Title", esc(F.col("journal"))), F.lit("<JournalIssue><PubDate>"), date, F.lit("</PubDate></JournalIssue></Journal>"),
        F.lit("<Abstract>"), F.array_join(F.transform(sections, section), ""), F.lit("</Abstract><AuthorList>"), F.array_join(F.transform(names, author), ""), F.lit("</AuthorList>"),
        tag("ELocationID", F.lit("other"), ' EIdType="pii"'), tag("ELocationID", esc(F.col("doi")), ' EIdType="doi"'),
        F.lit("</Article></MedlineCitation><PubmedData><ArticleIdList>"), tag("ArticleId", esc(F.col("pmid")), ' IdType="pubmed"'), tag("ArticleId", esc(F.col("pmcid")), ' IdType="pmc"'), F.lit("</ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return rows.distinct().select(R.parse_articles(xml).alias("p")).select("p.*").distinct()


@query("SELECT ingredient_code, canonical_name FROM issue26_sebum_targets WHERE lower(trim(is_target)) = 'true'")
def active_targets(spark: SparkSession, d: str) -> DataFrame:
    return R.targets(read_table(spark, d, "issue26_sebum_targets")).select("ingredient_code", "canonical_name")


@query("SELECT batch_id, claim_key, effect_id FROM gold_claim_effect_map WHERE batch_id = (SELECT max(batch_id) FROM gold_claim_effect_map)")
def latest_batch(spark: SparkSession, d: str) -> DataFrame:
    return R.latest(read_table(spark, d, "gold_claim_effect_map")).select("batch_id", "claim_key", "effect_id")


@query("SELECT batch_id, count(*) AS n FROM gold_claim WHERE batch_id >= '2025-01' GROUP BY batch_id")
def batches_since(spark: SparkSession, d: str) -> DataFrame:
    return R.batches(read_table(spark, d, "gold_claim"), since="2025-01").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


# ---- text -------------------------------------------------------------------------------------------------------

_WORDS = ("skin", "topical", "cosmetic", "facial")
_HINTS = ("barrier", "sebum", "pore", "TEWL")


def _split_sql(column: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({column}, ''), '|'), lambda x: trim(x, ' ')), lambda x: x <> '')"


def _group_sql(terms: str) -> str:
    once = f"list_filter({terms}, lambda x, i: list_position(list_transform({terms}, lambda y: lower(y)), lower(x)) = i)"
    return f"""'(' || array_to_string(list_transform({once}, lambda t: '"' || t || '"[Title/Abstract]'), ' OR ') || ')'"""


@query(f"""SELECT ingredient_code, {_group_sql(f"list_concat([trim(query_name, ' ')], {_split_sql('alias_list')})")} || ' AND ' || {_group_sql(f"list_concat(['skin', 'topical', 'cosmetic', 'facial'], {_split_sql('concern_keywords')})")} || ' AND ' || {_group_sql(f"list_concat(['barrier', 'sebum', 'pore', 'TEWL'], {_split_sql('concern_keywords')})")}
    || CASE WHEN len({_split_sql('required_context_keywords')}) > 0 THEN ' AND ' || {_group_sql(_split_sql('required_context_keywords'))} ELSE '' END || CASE WHEN len({_split_sql('excluded_context_keywords')}) > 0 THEN ' AND NOT ' || {_group_sql(_split_sql('excluded_context_keywords'))} ELSE '' END AS final_query FROM issue26_sebum_targets""")
def search_queries(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "issue26_sebum_targets")
    text = T.boolean_query(F.col("query_name"), F.col("alias_list"), F.col("concern_keywords"), F.col("required_context_keywords"), F.col("excluded_context_keywords"), _WORDS, _HINTS)
    return t.select("ingredient_code", text.alias("final_query"))


@query("""SELECT ingredient_code, list_filter(list_transform(string_split(alias_list, '|'), lambda x: trim(x, ' ')), lambda x: x <> '') AS aliases FROM issue26_sebum_targets WHERE alias_list IS NOT NULL""")
def alias_parts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "issue26_sebum_targets").where("alias_list is not null").select("ingredient_code", T.pipe_split(F.col("alias_list")).alias("aliases"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    chunks = read_table(spark, d, "silver_chunk").where("pmid is not null and chunk_text is not null").select("pmid", "chunk_index", "chunk_text").distinct()
    parts = T.with_offsets(F.col("chunk_text"), T.plain_sentences(F.col("chunk_text")))
    return chunks.select("pmid", "chunk_index", F.posexplode(parts).alias("sentence_no", "s")).select("pmid", "chunk_index", "sentence_no", "s.part", "s.start_at", "s.end_at")


_HELD = "trim(chunk_text, ' ')"
for _a in T.ABBREVIATIONS:
    _HELD = f"replace({_HELD}, '{_a}', '{_a.replace('.', '<DOT>')}')"


@query(f"""SELECT pmid, chunk_index, CAST(sum(length(s)) AS BIGINT) AS total_chars, count(*) AS n_sentences, CAST(sum(len(list_filter(regexp_split_to_array(s, '\\s+'), lambda w: w <> ''))) AS BIGINT) AS n_words FROM (
    SELECT pmid, chunk_index, unnest(list_filter(list_transform(string_split(regexp_replace({_HELD}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(replace(x, '<DOT>', '.'), ' ')), lambda x: x <> '')) AS s
    FROM (SELECT DISTINCT pmid, chunk_index, chunk_text FROM silver_chunk WHERE pmid IS NOT NULL AND chunk_text IS NOT NULL)) GROUP BY pmid, chunk_index""")
def sentence_counts(spark: SparkSession, d: str) -> DataFrame:
    """Plain sentences per chunk, with characters and words."""
    s = _sentences(spark, d)
    return s.groupBy("pmid", "chunk_index").agg(F.sum(F.length("part")).alias("total_chars"), F.count(F.lit(1)).alias("n_sentences"), F.sum(T.word_count(F.col("part"))).cast("long").alias("n_words"))


@query(f"""WITH RECURSIVE t AS (SELECT pmid, chunk_index, chunk_text, list_filter(list_transform(string_split(regexp_replace({_HELD}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(replace(x, '<DOT>', '.'), ' ')), lambda x: x <> '') AS parts
        FROM (SELECT DISTINCT pmid, chunk_index, chunk_text FROM silver_chunk WHERE pmid IS NOT NULL AND chunk_text IS NOT NULL)),
    f AS (SELECT pmid, chunk_index, chunk_text, parts, 0 AS no, 0 AS a, 0 AS b FROM t UNION ALL
        SELECT pmid, chunk_index, chunk_text, parts, no + 1, CASE WHEN contains(substr(chunk_text, b + 1), parts[no + 1]) THEN b + position(parts[no + 1] IN substr(chunk_text, b + 1)) - 1 ELSE b END,
            CASE WHEN contains(substr(chunk_text, b + 1), parts[no + 1]) THEN b + position(parts[no + 1] IN substr(chunk_text, b + 1)) - 1 ELSE b END + length(parts[no + 1]) FROM f WHERE no < len(parts))
    SELECT pmid, chunk_index, CAST(no - 1 AS INTEGER) AS sentence_no, parts[no] AS part, CAST(a AS INTEGER) AS start_at, CAST(b AS INTEGER) AS end_at FROM f WHERE no > 0""")
def sentence_offsets(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d)


_SLUG = "coalesce(nullif(trim(regexp_replace(lower(trim(coalesce({0}, ''), ' ')), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown')"
_REL = "CASE lower(trim(coalesce(relation, ''), ' ')) WHEN 'is_safe_for' THEN 'is_well_tolerated_for' WHEN 'increases' THEN 'improves' WHEN 'inhibits' THEN 'reduces' WHEN 'stimulates' THEN 'improves' WHEN 'regulates' THEN 'improves' WHEN 'modulates' THEN 'improves' ELSE lower(trim(coalesce(relation, ''), ' ')) END"
_CKEY = f"concat_ws('|', {_SLUG.format('ingredient_name')}, {_SLUG.format(_REL)}, {_SLUG.format('target')}, {_SLUG.format('target_category')})"
_F = "trim(coalesce({0}, ''), ' ')"
_SCOPE = f"substr(sha1(concat_ws('|', {_F.format('pmid')}, {_F.format('source_sentence')}, lower({_F.format('ingredient_name')}), lower({_F.format('relation')}), lower({_F.format('target')}))), 1, 20)"


def _keyed(claims: DataFrame) -> DataFrame:
    c = F.col
    scope = T.scope_key(c("pmid"), c("source_sentence"), c("ingredient_name"), c("relation"), c("target"))
    return claims.withColumn("scope_key", scope).withColumns({"evidence_id": T.evidence_id(c("batch_id"), c("scope_key")), "canonical_claim_key": T.canonical_key(c("ingredient_name"), c("relation"), c("target"), c("target_category"))})


@query(f"SELECT DISTINCT claim_key, {_SCOPE} AS scope_key, substr(sha1(concat_ws('|', coalesce(batch_id, ''), {_SCOPE})), 1, 16) AS evidence_id, {_CKEY} AS canonical_claim_key, concat_ws(' ', ingredient_name, relation, target) AS summary FROM gold_claim")
def claim_keys(spark: SparkSession, d: str) -> DataFrame:
    """Scope keys, evidence ids, canonical keys and summaries of claims."""
    return _keyed(read_table(spark, d, "gold_claim")).select("claim_key", "scope_key", "evidence_id", "canonical_claim_key", F.concat_ws(" ", "ingredient_name", "relation", "target").alias("summary")).distinct()


def _first_claims(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The first claim of each scope with the columns asked for; the sentence is read for its key and goes no further."""
    rows = _keyed(read_table(spark, d, "gold_claim")).select("scope_key", "created_at", "claim_key", "is_active", *columns)
    return A.first_wins(rows, ["scope_key"], ["created_at", "claim_key", "is_active"])


_FIRST = f"(SELECT * FROM (SELECT *, {_SCOPE} AS scope_key, row_number() OVER (PARTITION BY {_SCOPE} ORDER BY created_at NULLS FIRST, claim_key NULLS FIRST, is_active NULLS FIRST) AS rn FROM gold_claim) WHERE rn = 1)"


@query(f"SELECT scope_key, claim_key, created_at, is_active FROM {_FIRST}")
def dedup_claims(spark: SparkSession, d: str) -> DataFrame:
    """The first claim of each scope over all batches."""
    return _first_claims(spark, d).select("scope_key", "claim_key", "created_at", "is_active")


#: Target phrases that the rules rewrite; the test tables hardly have any.
TARGETS = ("melasma severity", "Skin  hydration.", "PIH", "redness", "post inflammatory hyperpigmentation", "Laser induced post inflammatory hyperpigmentation", "uv-induced immunosuppression", "photo damaged skin", "TEWL", "tolerance / tolerability", "laser-induced PIH", "tolerability / tolerance", "(skin barrier)", "reduced transepidermal water loss", "photoaging", "facial hyperpigmentation", "tolerance of skin", "increased transepidermal water loss", "facial erythema", "barrier function")


@query(f"""SELECT DISTINCT target, coalesce({TARGET_SQL.format('f')}, '~') AS target_key FROM (SELECT target, {target_flat_sql('target')} AS f FROM (SELECT target FROM gold_claim UNION ALL SELECT {pick_sql(TARGETS, 'length(target)')} || CASE WHEN length(target) % 7 = 0 THEN ' on the nose' ELSE '' END FROM gold_claim))""")
def target_phrases(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every target, and of as many phrases that have another."""
    g = read_table(spark, d, "gold_claim").select("target")
    n = F.length("target")
    other = g.select(F.concat(pick(TARGETS, n), F.when(n % 7 == 0, " on the nose").otherwise("")).alias("target"))
    return g.unionByName(other).select("target", F.coalesce(T.rewrite(F.col("target"), T.TARGET_RULES, T.TARGET_EQUALS), F.lit("~")).alias("target_key")).distinct()


@query("""SELECT ingredient_code, TRY_CAST(CASE WHEN regexp_matches(trim(query_name, ' '), '^[+-]?\\d+$') THEN trim(query_name, ' ') END AS INTEGER) AS as_int, CAST(trunc(TRY_CAST(trim(canonical_name, ' ') AS DOUBLE)) AS INTEGER) AS as_float_int FROM issue26_sebum_targets""")
def number_cells(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "issue26_sebum_targets")
    return t.select("ingredient_code", T.safe_int(F.col("query_name")).alias("as_int"), T.float_int(F.col("canonical_name")).alias("as_float_int"))


_CELLS = ("%", "+%", "%.7", "-%.5", "%e2", " % ", "%.0", "% mg", "", "nan", "1,%")


@query(f"""WITH c AS (SELECT DISTINCT ingredient_code, replace(([{', '.join(f"'{x}'" for x in _CELLS)}])[ingredient_code % {len(_CELLS)} + 1], '%', CAST(ingredient_code AS VARCHAR)) AS cell FROM issue26_sebum_targets WHERE ingredient_code IS NOT NULL),
    n AS (SELECT *, CASE WHEN cell <> 'nan' THEN TRY_CAST(trim(cell, ' ') AS DOUBLE) END AS x FROM c)
    SELECT ingredient_code, cell, CASE WHEN regexp_matches(trim(cell, ' '), '^[+-]?\\d+$') THEN CAST(trim(cell, ' ') AS INTEGER) END AS as_int, CAST(trunc(x) AS INTEGER) AS as_float_int,
        array_to_string(list_sort(list_distinct(list_filter([ingredient_code, 7, CAST(trunc(x) AS INTEGER)], lambda i: i IS NOT NULL))), '|') AS as_ids FROM n""")
def number_variants(spark: SparkSession, d: str) -> DataFrame:
    """The readings of numbers, on cells written in as many ways as people do."""
    t = read_table(spark, d, "issue26_sebum_targets").where("ingredient_code is not null").select("ingredient_code").distinct()
    code = F.col("ingredient_code").cast("string")
    cell = F.replace(F.element_at(F.array(*map(F.lit, _CELLS)), (F.col("ingredient_code") % len(_CELLS) + 1).cast("int")), F.lit("%"), code)
    listed = F.concat_ws("|", code, F.lit("7.2"), F.lit(" nan "), F.lit("x"), cell)
    return t.select("ingredient_code", cell.alias("cell"), T.safe_int(cell).alias("as_int"), T.float_int(cell).alias("as_float_int"), F.array_join(T.pipe_ints(listed), "|").alias("as_ids"))


@query("SELECT lower(trim(claim_key)) AS claim_key, string_agg(DISTINCT CAST(effect_id AS VARCHAR), '|') IS NOT NULL AS has_ids, array_to_string(list_sort(list_distinct(list(effect_id) FILTER (effect_id IS NOT NULL))), '|') AS effect_ids FROM gold_claim_effect_map WHERE claim_key IS NOT NULL AND effect_id IS NOT NULL GROUP BY 1")
def effect_id_lists(spark: SparkSession, d: str) -> DataFrame:
    m = read_table(spark, d, "gold_claim_effect_map").where("claim_key is not null and effect_id is not null")
    return m.groupBy(F.lower(F.trim("claim_key")).alias("claim_key")).agg(F.lit(True).alias("has_ids"), T.id_list(F.collect_set("effect_id")).alias("effect_ids"))


# ---- dictionary matching ----------------------------------------------------------------------------------------


def dictionary(spark: SparkSession, d: str, kind: str) -> dict[str, str]:
    """The reference names of one kind: a list of some hundred, read to the driver to become a pattern."""
    rows = read_table(spark, d, "canonical_terms").where(F.col("kind") == kind).orderBy("term_id").select("canonical_name").toLocalIterator()
    return L.alias_table([(r[0], r[0]) for r in rows])


def _ingredients(spark: SparkSession, d: str) -> DataFrame:
    """alias and name of the listed ingredients and of every name and alias of the active targets: an alias stands for the
    query name of its target, of the last target if several have it, and never for another listed name."""
    listed_names = read_table(spark, d, "canonical_terms").where("kind = 'ingredient' and trim(canonical_name) <> ''").groupBy(F.lower(F.trim("canonical_name")).alias("alias")).agg(F.max_by("canonical_name", "term_id").alias("name"))
    t = R.targets(read_table(spark, d, "issue26_sebum_targets")).where("trim(query_name) <> ''").select("ingredient_code", "query_name", "canonical_name", "alias_list").distinct()
    own = t.select("ingredient_code", "query_name", F.lit(0).alias("pos"), F.explode(F.array("canonical_name", "query_name")).alias("alias"))
    other = unpack(t.select("ingredient_code", "query_name", "alias_list"), field="alias_list", out="alias").select("ingredient_code", "query_name", "pos", "alias")
    rows = own.unionByName(other).withColumn("alias", F.lower(F.trim("alias"))).where("alias <> ''").groupBy("alias").agg(F.max_by(F.trim("query_name"), F.struct("ingredient_code", "pos", "query_name")).alias("name"))
    look = broadcast_if_small(listed_names)
    # a target that is listed under its query name goes by the listed spelling
    spelled = rows.join(look.select(F.col("alias").alias("_q"), F.col("name").alias("_listed")), F.lower("name") == F.col("_q"), "left").select("alias", F.coalesce("_listed", "name").alias("name"))
    return spelled.join(look.select("alias"), "alias", "left_anti").unionByName(listed_names)


def _claim_sentences(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "gold_claim").where("claim_key is not null and source_sentence is not null").select("claim_key", "source_sentence", "ingredient_name", "target", "relation", "claim_type", "pmid", "chunk_index").distinct()


@query("""SELECT claim_key, term AS subject_name FROM (SELECT s.claim_key, t.canonical_name AS term, row_number() OVER (PARTITION BY s.claim_key, s.source_sentence ORDER BY length(t.canonical_name) DESC, t.term_id) AS rn FROM
    (SELECT DISTINCT claim_key, source_sentence, ' ' || regexp_replace(lower(source_sentence), '[^\\p{L}\\p{N}_]+', ' ', 'g') || ' ' AS flat FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL) s
    JOIN canonical_terms t ON t.kind = 'target' AND contains(lower(s.source_sentence), lower(t.canonical_name)) AND contains(s.flat, ' ' || regexp_replace(lower(t.canonical_name), '[^\\p{L}\\p{N}_]+', ' ', 'g') || ' ')) WHERE rn = 1""")
def target_mentions(spark: SparkSession, d: str) -> DataFrame:
    """The longest target named in each claim sentence."""
    table = dictionary(spark, d, "target")
    s = read_table(spark, d, "gold_claim").where("claim_key is not null and source_sentence is not null").select("claim_key", "source_sentence").distinct()
    best = L.best_alias(L.alias_matches(F.col("source_sentence"), table), table)
    return s.select("claim_key", L.name_of(best, table).alias("subject_name")).where("subject_name is not null")


@query()
def ingredient_subjects(spark: SparkSession, d: str) -> DataFrame:
    """The ingredient each sentence is about; else the only one of its chunk."""
    s = find_entries(_claim_sentences(spark, d), "source_sentence", _ingredients(spark, d)).withColumn("own", subject_of(F.col("source_sentence"), F.col("found")))
    chunk = s.groupBy("pmid", "chunk_index").agg(F.array_compact(F.collect_set("own")).alias("names"))
    both = s.join(chunk, ["pmid", "chunk_index"], "left")
    return both.select("claim_key", F.coalesce("own", F.when(F.size("names") == 1, F.col("names")[0])).alias("ingredient"), B.enumerates(F.col("source_sentence"), names=F.col("found.name")).alias("enumerates"))


@query()
def detection_units(spark: SparkSession, d: str) -> DataFrame:
    """What each sentence names, and how an effect in it is attributed."""
    members, entries = dictionary(spark, d, "ingredient"), cut(_ingredients(spark, d))
    s = _claim_sentences(spark, d).withColumn("clause", B.primary_clause(F.col("source_sentence"), F.col("ingredient_name")))
    # most sentences are one clause, which is looked through once
    apart = F.col("clause") != F.trim("source_sentence")
    s = find_entries(s.withColumn("part", F.when(apart, F.col("clause"))), "source_sentence", entries)
    s = find_entries(s, "part", entries, "in_part")
    units = lambda c, found: L.detected_units(F.col(c), members, L.DETECTION_TAGS, L.VERB_HINTS, found=F.col(f"{found}.name"))
    s = s.withColumn("units", units("source_sentence", "found"))
    s = s.withColumn("_own", F.when(apart, units("part", "in_part")).otherwise(F.col("units")))
    s = s.withColumns({"lists": B.list_guard(F.col("source_sentence")), "_label": B.attribution(F.col("source_sentence"), F.col("ingredient_name"), F.col("_own"), F.col("clause"))})
    label = B.reconciled(F.col("_label"), F.col("source_sentence"), F.col("units"), F.col("lists"))
    return s.select("claim_key", F.array_join("units", "|").alias("units"), F.size("units").alias("n_units"), label.alias("attribution"), "lists", B.detection_suspect(F.col("source_sentence"), F.col("units"), F.col("lists")).alias("suspect"))


def _mapped(spark: SparkSession, d: str, kind: str, synonyms: dict, only: dict | None = None) -> DataFrame:
    """Claims with the codes they mention: those of a taxonomy, a list of some dozen read to the driver, by name and
    synonyms, and those of the synonyms that it does not list. Codes listed as inactive only are none."""
    words = {code: list(w) for code, w in synonyms.items()}
    rows = read_table(spark, d, f"{kind}_taxonomy").where(f"{kind}_code is not null").orderBy(f"{kind}_id").select(f"{kind}_code", f"{kind}_name_en", "is_active").collect()
    active = {code for code, _, on in rows if on}
    for code, name, on in rows:
        if code not in active:
            words.pop(code, None)
        elif on and name and name.strip():
            words.setdefault(code, []).append(name)
    g = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", "relation", F.lower(F.concat_ws(" ", "target", "source_sentence", "claim_text")).alias("said"))
    return g.select("claim_key", F.array_join(B.mentions(F.col("said"), words, F.col("relation"), only), "|").alias("codes")).distinct()


def _mapped_sql(kind: str, synonyms: dict, only: dict | None = None) -> str:
    pairs = ", ".join(f"('{code}', '{w}')" for code, words in synonyms.items() for w in words)
    allowed = " AND ".join(f"(code <> '{code}' OR relation IN {rel})" for code, rel in (only or {}).items()) or "true"
    return f"""WITH t AS (SELECT {kind}_code AS code, lower({kind}_name_en) AS word FROM {kind}_taxonomy WHERE is_active AND {kind}_code IS NOT NULL AND trim({kind}_name_en) <> ''
        UNION SELECT code, word FROM (VALUES {pairs}) s(code, word) WHERE code NOT IN (SELECT {kind}_code FROM {kind}_taxonomy WHERE {kind}_code IS NOT NULL GROUP BY 1 HAVING NOT coalesce(bool_or(is_active), false))),
    g AS (SELECT DISTINCT claim_key, lower(trim(coalesce(relation, ''))) AS relation, lower(concat_ws(' ', target, source_sentence, claim_text)) AS s FROM gold_claim WHERE claim_key IS NOT NULL)
    SELECT DISTINCT claim_key, coalesce(array_to_string(list_sort(list(DISTINCT code) FILTER (code IS NOT NULL)), '|'), '') AS codes FROM g LEFT JOIN t ON contains(s, word) AND {allowed} GROUP BY claim_key, relation, s"""


# The synonyms and relations of the SQL.
_S_EFFECTS = {
    "ANTI_INFLAMMATORY": ["inflammation", "inflammatory"], "SOOTHING": ["soothing", "calming", "redness", "erythema", "irritation", "sensitive skin", "tolerability"], "BARRIER_REPAIR": ["barrier", "tewl"], "HYDRATING": ["hydration", "hydrate", "hydrating", "moistur", "dry skin"],
    "MOISTURE_RETENTION": ["transepidermal water loss", "tewl", "moisture retention"], "SEBUM_REGULATION": ["sebum", "oil control", "oiliness", "oily skin", "pore"], "KERATOLYTIC": ["keratolytic", "keratolysis", "exfoliation", "peel", "skin renewal", "desquamation", "scab removal", "texture", "roughness"],
    "COMEDOLYTIC": ["comedone", "blackhead", "whitehead"], "ANTIMICROBIAL": ["antibacterial", "microbial"], "DEPIGMENTING": ["depigment", "melasma", "pigmentation", "pih"], "BRIGHTENING": ["brightening", "skin tone", "dyschromia", "dullness"], "ANTIOXIDANT": ["antioxidant", "antioxidative", "oxidative stress"],
    "WOUND_HEALING": ["healing", "repair", "regeneration", "re-epithelialization", "reepithelialization"], "ANTI_AGING": ["wrinkle", "elasticity", "aging", "photo-damaged", "skin remodeling", "firmness", "fine lines", "collagen synthesis"], "PHOTOPROTECTIVE": ["photoprotective", "uv", "photoaging", "photodamaged", "immunosuppression"],
}
_S_CONCERNS = {
    "ACNE": ["acne", "pimple"], "COMEDONES": ["comedone", "blackhead", "whitehead"], "OILY_SKIN": ["oily skin", "sebum", "oiliness", "oil control"], "SENSITIVE_SKIN": ["sensitive skin", "sensitivity", "tolerance", "tolerability"], "REDNESS": ["redness", "erythema"], "IRRITATED_SKIN": ["irritation", "stinging", "burning"],
    "DRY_SKIN": ["dry skin", "xerosis"], "DEHYDRATED_SKIN": ["dehydrated skin", "dehydration", "hydration"], "BARRIER_DAMAGE": ["barrier", "tewl"], "HYPERPIGMENTATION": ["melasma", "pigmentation", "pih"], "DULLNESS": ["dullness", "skin tone"],
    "AGING_SIGNS": ["aging", "wrinkle", "elasticity", "photo-damaged", "photodamaged"], "ATOPIC_PRONE": ["atopic"], "ROSACEA_PRONE": ["rosacea"], "POST_ACNE_MARKS": ["post-acne", "post-inflammatory hyperpigmentation", "pih"],
}
_S_ONLY = {code: "('improves', 'reduces', 'prevents')" for code in ("BARRIER_REPAIR", "DEPIGMENTING", "BRIGHTENING")} | {"SOOTHING": "('reduces', 'improves', 'does_not_cause', 'is_well_tolerated_for')"}


@query(_mapped_sql("effect", _S_EFFECTS, _S_ONLY))
def effect_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Codes of active effects whose name or synonym stands in target, sentence or claim, if the relation allows them."""
    return _mapped(spark, d, "effect", L.EFFECT_SYNONYMS, L.EFFECT_RELATIONS)


@query(_mapped_sql("concern", _S_CONCERNS))
def concern_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Codes of active concerns whose name or synonym stands in target, sentence or claim."""
    return _mapped(spark, d, "concern", L.CONCERN_SYNONYMS)


# ---- predicates and labels --------------------------------------------------------------------------------------


def _any(column: str, phrases) -> str:
    return f"regexp_matches(lower({column}), '{L.alternation([p.lower() for p in phrases])}')"


def _starts(column: str, phrases) -> str:
    return f"regexp_matches(lower(trim({column}, ' ')), '^({L.alternation([p.lower() for p in phrases])})')"


_DOMAIN = f"({_any('s', L.DOMAIN_MARKERS)} OR regexp_matches(lower(s), '\\b({L.alternation(L.DOMAIN_WORDS)})\\b'))"
_SIGNAL = f"({_starts('s', L.RESULT_HEADINGS)} OR {_any('s', (*L.CLAIM_MARKERS, *L.NEGATION_MARKERS))})"
_BARE = "regexp_replace(trim(s, ' '), '(?i)^(results?|conclusions?):\\s*', '')"


@query(f"""SELECT claim_key, coalesce(lower(trim(section_type, ' ')) NOT IN ('{"', '".join(L.BLOCKED_SECTIONS)}'), true) AS worthy, {_starts('s', L.BLOCKED_HEADINGS)} AS blocked, {_DOMAIN} AS in_domain, {_SIGNAL} AS signal,
    (NOT {_any('s', L.NON_CLAIM_MARKERS)} AND NOT {_starts(_BARE, L.NON_SUBJECTS)} AND NOT regexp_matches(lower({_BARE}), '^cer[0-9]') AND {_DOMAIN} AND {_SIGNAL}) AS candidate,
    (NOT {_starts('s', L.RESULT_HEADINGS)} AND ({_starts('s', L.BLOCKED_HEADINGS)} OR {_any('s', L.STUDY_PHRASES)})) AS study_design
    FROM (SELECT DISTINCT claim_key, section_type, source_sentence AS s FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL)""")
def sentence_filters(spark: SparkSession, d: str) -> DataFrame:
    """Which sentences may state a claim, predicate by predicate."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null and source_sentence is not null").select("claim_key", "section_type", F.col("source_sentence").alias("s")).distinct()
    s = F.col("s")
    return g.select("claim_key", B.worthy_section(F.col("section_type")).alias("worthy"), B.blocked_heading(s).alias("blocked"), B.in_domain(s).alias("in_domain"), B.claim_signal(s).alias("signal"), B.candidate_sentence(s).alias("candidate"), B.study_design(s).alias("study_design"))


@query(f"""SELECT DISTINCT claim_key, {REJECTED_SQL.format('t')} AS rejected, {COMPATIBLE_SQL.format('t', 'relation')} AS compatible FROM (SELECT claim_key, relation, lower(trim(coalesce(target, ''), ' ')) AS t FROM gold_claim)""")
def target_filters(spark: SparkSession, d: str) -> DataFrame:
    g = read_table(spark, d, "gold_claim")
    reject = B.rejected_target(F.col("target"), L.GENERIC_TARGETS, L.FOREIGN_TARGETS, L.TARGET_HINTS)
    return g.select("claim_key", reject.alias("rejected"), B.compatible(F.col("relation"), F.col("target"), L.TARGET_RELATIONS).alias("compatible")).distinct()


_STRONG = f"CASE WHEN {_any('s', L.STRONG_CUES)} THEN 'strong' WHEN {_any('s', (*L.HEDGES, *L.WEAK_CUES))} THEN 'weak' WHEN {_any('s', L.MODERATE_CUES)} THEN 'moderate' WHEN ({_starts('s', ('conclusion', 'results:', 'result:'))} OR contains(substr(lower(trim(s, ' ')), 1, 50), 'conclusion:')) AND {_any('s', ('effective', 'decreased', 'improvement', 'repair', 'barrier'))} THEN 'moderate' ELSE 'weak' END"
_MODE = f"CASE WHEN lower(trim(claim_type, ' ')) = 'mechanism' THEN 'mechanism' WHEN lower(trim(relation, ' ')) = 'prevents' OR {_starts('s', ('to prevent',))} THEN 'prevention' WHEN lower(trim(claim_type, ' ')) = 'safety' OR lower(trim(relation, ' ')) IN ('is_well_tolerated_for', 'is_safe_for') THEN 'safety' WHEN {_any('s', L.VEHICLE_CUES)} THEN 'formulation_support' ELSE 'efficacy' END"


@query(f"SELECT DISTINCT claim_key, {_STRONG} AS strength, {_MODE} AS modality FROM (SELECT claim_key, claim_type, relation, source_sentence AS s FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL)")
def sentence_labels(spark: SparkSession, d: str) -> DataFrame:
    """Strength by cues alone, and modality."""
    g = read_table(spark, d, "gold_claim").where("claim_key is not null and source_sentence is not null")
    s = F.col("source_sentence")
    return g.select("claim_key", B.strength(s, F.lit("unclear")).alias("strength"), B.modality(s, F.col("claim_type"), F.col("relation")).alias("modality")).distinct()


_CL = "list_filter(string_split(regexp_replace(trim(lower(s), ' '), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda c: c <> '')"
_TW = "list_slice(regexp_extract_all(lower(coalesce(target, '')), '[a-z]{4,}'), 1, 4)"
_ABOUT = f"list_filter({_CL}, lambda c: len(list_filter({_TW}, lambda w: contains(c, w))) > 0)"
_EFFECT = f"list_filter({_CL}, lambda c: regexp_matches(c, '{L.alternation(L.EFFECT_VERBS)}'))"


@query(f"""SELECT DISTINCT claim_key, CASE WHEN {_any('scored', L.NOT_SIGNIFICANT)} THEN 'not_significant' WHEN {_any('scored', L.SIGNIFICANT)} THEN 'significant' WHEN (kind = 'safety' OR rel IN ('is_well_tolerated_for', 'is_safe_for')) AND {_any('scored', ('tolerat', 'safe'))} THEN 'not_applicable' WHEN kind = 'mechanism' AND NOT {_any('scored', ('efficacy', 'improv'))} THEN 'not_applicable' ELSE 'unclear' END AS significance FROM (
    SELECT claim_key, lower(trim(coalesce(claim_type, ''), ' ')) AS kind, lower(trim(coalesce(relation, ''), ' ')) AS rel, coalesce({_ABOUT}[1], {_EFFECT}[-1], lower(s)) AS scored FROM (SELECT DISTINCT claim_key, source_sentence AS s, target, relation, claim_type FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL))""")
def significance_labels(spark: SparkSession, d: str) -> DataFrame:
    s = _claim_sentences(spark, d)
    return s.select("claim_key", B.significance(F.col("source_sentence"), F.col("target"), F.col("claim_type"), F.col("relation")).alias("significance")).distinct()


# ---- evidence: labels from columns, then aggregates -------------------------------------------------------------

_DIRECTION = {"supports": 1.0, "mixed": 0.5, "contradicts": 0.1}
_KIND = {"efficacy": 1.0, "safety": 0.7, "mechanism": 0.4}
_TIERS = {"evidence_only": 0, "recommendation_only": 1, "soft_graph": 2, "strict_graph": 3}
_TIER_SQL = "CASE WHEN evidence_direction IS NULL OR evidence_direction = 'contradicts' THEN 'evidence_only' WHEN evidence_direction = 'mixed' THEN 'recommendation_only' WHEN claim_type = 'efficacy' THEN 'strict_graph' ELSE 'soft_graph' END"
_W_SQL = "round(coalesce(CASE lower(trim(evidence_direction)) WHEN 'supports' THEN 1.0::DOUBLE WHEN 'mixed' THEN 0.5::DOUBLE WHEN 'contradicts' THEN 0.1::DOUBLE END, 0.2::DOUBLE) * coalesce(CASE lower(trim(claim_type)) WHEN 'efficacy' THEN 1.0::DOUBLE WHEN 'safety' THEN 0.7::DOUBLE WHEN 'mechanism' THEN 0.4::DOUBLE END, 0.3::DOUBLE), 6)"


def _weight() -> Column:
    return B.weight((F.col("evidence_direction"), _DIRECTION, 0.2), (F.col("claim_type"), _KIND, 0.3))


def _tier() -> Column:
    e = F.col("evidence_direction")
    return L.first_label([(e.isNull() | (e == "contradicts"), "evidence_only"), (e == "mixed", "recommendation_only"), (F.col("claim_type") == "efficacy", "strict_graph")], "soft_graph")


@query(f"SELECT claim_key, {_W_SQL} AS row_weight FROM (SELECT DISTINCT claim_key, evidence_direction, claim_type FROM gold_claim)")
def row_weights(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "gold_claim").select("claim_key", "evidence_direction", "claim_type").distinct().select("claim_key", _weight().alias("row_weight"))


@query(f"""WITH e AS (SELECT *, {_CKEY} AS ckey, {_W_SQL} AS w, {_TIER_SQL} AS tier FROM {_FIRST}),
    p AS (SELECT ckey, pmid, max(w) AS a, max(w) FILTER (tier IN ('strict_graph', 'soft_graph')) AS g, max(w) FILTER (tier <> 'evidence_only') AS r FROM e GROUP BY ckey, pmid),
    s AS (SELECT ckey, CAST(count(*) AS INTEGER) AS paper_count_distinct, round(sum(a), 6) AS paper_support_sum, round(coalesce(sum(g), 0), 6) AS paper_support_sum_graph, round(coalesce(sum(r), 0), 6) AS paper_support_sum_reco, CAST(count(g) AS INTEGER) AS paper_count_graph, CAST(count(r) AS INTEGER) AS paper_count_reco, round(ln(1 + sum(a)), 6) AS evidence_score, round(ln(1 + coalesce(sum(g), 0)), 6) AS graph_score, round(ln(1 + coalesce(sum(r), 0)), 6) AS recommendation_score_base FROM p GROUP BY ckey),
    n AS (SELECT ckey, CAST(count(*) AS INTEGER) AS evidence_count_raw, CAST(count(DISTINCT coalesce(nullif(trim(section_type), ''), 'unknown')) AS INTEGER) AS study_count_distinct, max(CASE tier WHEN 'strict_graph' THEN 3 WHEN 'soft_graph' THEN 2 WHEN 'recommendation_only' THEN 1 ELSE 0 END) AS top FROM e GROUP BY ckey),
    f AS (SELECT * FROM (SELECT ckey, ingredient_name, target, target_category, row_number() OVER (PARTITION BY ckey ORDER BY created_at, claim_key) AS rn FROM e) WHERE rn = 1),
    l AS (SELECT * FROM (SELECT ckey, label, row_number() OVER (PARTITION BY ckey ORDER BY c DESC, o, k) AS rn FROM (SELECT e.ckey, coalesce(relation, '') AS label, count(*) AS c, min(created_at) AS o, arg_min(claim_key, struct_pack(a := created_at, b := claim_key)) AS k FROM e JOIN n ON e.ckey = n.ckey AND n.top = CASE tier WHEN 'strict_graph' THEN 3 WHEN 'soft_graph' THEN 2 WHEN 'recommendation_only' THEN 1 ELSE 0 END GROUP BY 1, 2)) WHERE rn = 1)
    SELECT s.ckey AS canonical_claim_key, f.ingredient_name, f.target, f.target_category, evidence_count_raw, paper_count_distinct, study_count_distinct, paper_support_sum, paper_support_sum_graph, paper_support_sum_reco, paper_count_graph, paper_count_reco, evidence_score, graph_score, recommendation_score_base,
    CASE top WHEN 3 THEN 'strict_graph' WHEN 2 THEN 'soft_graph' WHEN 1 THEN 'recommendation_only' ELSE 'evidence_only' END AS top_eligibility_tier, l.label AS top_attribution_label, graph_score > 0 AS is_graph_eligible FROM s JOIN n USING (ckey) JOIN f USING (ckey) JOIN l USING (ckey)""")
def canonical_claims(spark: SparkSession, d: str) -> DataFrame:
    columns = ("canonical_claim_key", "pmid", "ingredient_name", "target", "target_category", "relation", "section_type", "evidence_direction", "claim_type")
    e = _first_claims(spark, d, *columns).withColumns({"_weight": _weight(), "_tier": _tier(), "pmid": F.coalesce("pmid", F.lit(""))})
    out = A.canonical(e, "canonical_claim_key", "pmid", "_weight", "_tier", _TIERS, ("strict_graph", "soft_graph"), ("strict_graph", "soft_graph", "recommendation_only"), "relation", "section_type", ["created_at", "claim_key"], ["ingredient_name", "target", "target_category"])
    return out


_MAP = "(SELECT DISTINCT lower(trim(claim_key)) AS ck, {0}_id FROM gold_claim_{0}_map WHERE claim_key IS NOT NULL AND {0}_id IS NOT NULL)"


_EDGE = ("ingredient_name", "relation", "pmid", "evidence_direction", "claim_type")


def _edges(spark: SparkSession, d: str, kind: str, evidence: DataFrame) -> DataFrame:
    ids = read_table(spark, d, f"gold_claim_{kind}_map").where(F.col(f"{kind}_id").isNotNull() & F.col("claim_key").isNotNull()).select(F.lower(F.trim("claim_key")).alias("ck"), f"{kind}_id").distinct()
    codes = read_table(spark, d, f"{kind}_taxonomy").where(f"{kind}_code is not null").groupBy(f"{kind}_id").agg(F.max(f"{kind}_code").alias(f"{kind}_code"))
    rows = evidence.join(ids, evidence.claim_key == ids.ck).join(broadcast_if_small(codes), f"{kind}_id")
    return A.paper_support(rows, ["ingredient_name", f"{kind}_code", "relation"], "pmid", "row_weight")


def _edge_sql(kind: str, where: str) -> str:
    return f"""SELECT ingredient_name, {kind}_code, relation, round(ln(1 + sum(w)), 6) AS graph_score, CAST(count(*) AS INTEGER) AS paper_count FROM (
        SELECT ingredient_name, t.{kind}_code, relation, coalesce(pmid, '') AS p, max({_W_SQL}) AS w FROM {_FIRST} e JOIN {_MAP.format(kind)} m ON m.ck = e.claim_key JOIN (SELECT {kind}_id, max({kind}_code) AS {kind}_code FROM {kind}_taxonomy WHERE {kind}_code IS NOT NULL GROUP BY 1) t USING ({kind}_id)
        WHERE {where} GROUP BY ALL) GROUP BY 1, 2, 3"""


@query(_edge_sql("effect", f"{_TIER_SQL} IN ('strict_graph', 'soft_graph') AND coalesce(lower(ingredient_name), '') NOT IN ('cream', 'water', 'lotion', 'serum', 'gel', 'foam', 'oil', 'emulsion', '크림', '빙하수', '멜라닌') AND coalesce(upper(ingredient_name), '') NOT IN ('CREAM', 'WATER', 'MELANIN') AND NOT (t.effect_code = 'SEBUM_REGULATION' AND relation = 'increases')"))
def affects_edges(spark: SparkSession, d: str) -> DataFrame:
    """Ingredient, effect, relation: the log of the summed best weights of papers, over graph tiers."""
    generic = F.coalesce(F.lower("ingredient_name").isin(*C.NO_INGREDIENTS) | F.upper("ingredient_name").isin(*C.NO_NODES), F.lit(False))
    e = _first_claims(spark, d, *_EDGE).withColumn("row_weight", _weight()).where(_tier().isin("strict_graph", "soft_graph") & ~generic).select("claim_key", "ingredient_name", "relation", "pmid", "row_weight")
    return _edges(spark, d, "effect", e).where(~((F.col("effect_code") == "SEBUM_REGULATION") & (F.col("relation") == "increases")))


@query(_edge_sql("concern", "relation = 'causes' AND evidence_direction = 'supports' AND claim_type IN ('safety', 'efficacy')"))
def caution_edges(spark: SparkSession, d: str) -> DataFrame:
    e = _first_claims(spark, d, *_EDGE).where("relation = 'causes' and evidence_direction = 'supports' and claim_type in ('safety', 'efficacy')").withColumn("row_weight", _weight()).select("claim_key", "ingredient_name", "relation", "pmid", "row_weight")
    return _edges(spark, d, "concern", e)


@query(f"""SELECT count(*) AS scanned, count(*) FILTER (relation = 'causes' AND evidence_direction = 'supports') AS causes_supports, count(DISTINCT ingredient_name) FILTER (relation = 'causes') AS names, count(*) FILTER ({_TIER_SQL} = 'strict_graph') AS strict_graph, count(*) FILTER ({_TIER_SQL} = 'soft_graph') AS soft_graph, count(*) FILTER ({_TIER_SQL} = 'recommendation_only') AS recommendation_only, count(*) FILTER ({_TIER_SQL} = 'evidence_only') AS evidence_only FROM gold_claim""")
def batch_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The counters of a run in one pass."""
    from quillstone.sources.writers import metrics

    c = F.col
    counts = {"scanned": F.count(F.lit(1)), "causes_supports": F.count_if((c("relation") == "causes") & (c("evidence_direction") == "supports")), "names": F.countDistinct(F.when(c("relation") == "causes", c("ingredient_name")))}
    return metrics(read_table(spark, d, "gold_claim"), counts | {t: F.count_if(_tier() == t) for t in ("strict_graph", "soft_graph", "recommendation_only", "evidence_only")})


# ---- joins, graph, warehouse ------------------------------------------------------------------------------------


@query("""SELECT t.term_id, min(g.n) AS n_claims FROM canonical_terms t JOIN (SELECT lower(trim(ingredient_name, ' ')) AS k, count(DISTINCT claim_key) AS n FROM gold_claim GROUP BY 1) g ON g.k = lower(t.canonical_name) AND t.kind = 'ingredient' GROUP BY 1""")
def name_join(spark: SparkSession, d: str) -> DataFrame:
    """Claims per listed ingredient, by spelling whatever its case."""
    look = G.name_lookup(read_table(spark, d, "canonical_terms").where("kind = 'ingredient'"), "term_id", ["canonical_name"], "term_id")
    known, _ = G.map_names(read_table(spark, d, "gold_claim"), "ingredient_name", look)
    return known.groupBy(F.col("ident").alias("term_id")).agg(F.countDistinct("claim_key").alias("n_claims"))


@query("SELECT DISTINCT ingredient_name AS unmapped_name FROM gold_claim WHERE ingredient_name IS NOT NULL AND lower(trim(ingredient_name, ' ')) NOT IN (SELECT lower(canonical_name) FROM canonical_terms WHERE kind = 'ingredient')")
def unmapped_names(spark: SparkSession, d: str) -> DataFrame:
    look = G.name_lookup(read_table(spark, d, "canonical_terms").where("kind = 'ingredient'"), "term_id", ["canonical_name"], "term_id")
    return G.map_names(read_table(spark, d, "gold_claim").where("ingredient_name is not null"), "ingredient_name", look)[1]


def _pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = read_table(spark, d, "effect_taxonomy").where("is_active").select("effect_code", "effect_group")
    c = read_table(spark, d, "concern_taxonomy").where("is_active").select("concern_code", "concern_group")
    both = read_table(spark, d, "effect_taxonomy").select("effect_code", "effect_group").join(read_table(spark, d, "concern_taxonomy").select("concern_code", "concern_group"), F.col("effect_group") == F.col("concern_group")).select("effect_code", "concern_code")
    return e, c, both


@query("SELECT DISTINCT e.effect_code, c.concern_code FROM effect_taxonomy e JOIN concern_taxonomy c ON e.effect_group = c.concern_group WHERE e.is_active AND c.is_active AND e.effect_code IS NOT NULL AND c.concern_code IS NOT NULL")
def relates_pairs(spark: SparkSession, d: str) -> DataFrame:
    e, c, both = _pairs(spark, d)
    return G.code_pairs(e, c, both)


@query("""WITH n AS (SELECT trim(canonical_name) AS id FROM canonical_terms WHERE kind = 'ingredient')
    SELECT 'blank_node' AS problem, count(*) FILTER (coalesce(id, '') = '') AS n FROM n UNION ALL SELECT 'repeated_node', count(*) FROM (SELECT id FROM n WHERE id <> '' GROUP BY id HAVING count(*) > 1) UNION ALL
    SELECT 'dangling_ingredient_name', count(*) FROM gold_claim WHERE ingredient_name IS NULL OR ingredient_name NOT IN (SELECT id FROM n)""")
def graph_integrity(spark: SparkSession, d: str) -> DataFrame:
    return G.integrity(read_table(spark, d, "canonical_terms").where("kind = 'ingredient'"), "canonical_name", read_table(spark, d, "gold_claim"), ["ingredient_name"])


_OLD, _NEW = "(SELECT DISTINCT ingredient_name, target, relation FROM gold_claim WHERE batch_id < '2025-01')", "(SELECT DISTINCT ingredient_name, target, relation FROM gold_claim WHERE batch_id >= '2025-01')"


@query(f"""SELECT * FROM {_NEW} UNION ALL SELECT o.* FROM {_OLD} o WHERE ingredient_name IN (SELECT canonical_name FROM canonical_terms WHERE kind = 'ingredient') AND target IN (SELECT canonical_name FROM canonical_terms WHERE kind = 'target')
    AND NOT EXISTS (SELECT 1 FROM {_NEW} n WHERE n.ingredient_name = o.ingredient_name AND n.target = o.target AND n.relation = o.relation)""")
def retained_edges(spark: SparkSession, d: str) -> DataFrame:
    """New edges, and old ones that still have both ends and were not made anew."""
    g = read_table(spark, d, "gold_claim")
    keys = ["ingredient_name", "target", "relation"]
    old, new = (g.where(c).select(*keys).distinct() for c in ("batch_id < '2025-01'", "batch_id >= '2025-01'"))
    terms = read_table(spark, d, "canonical_terms")
    return G.retain(old, new, keys, terms.where("kind = 'ingredient'").select("canonical_name"), "ingredient_name", terms.where("kind = 'target'").select("canonical_name"), "target").select(*keys)


@query("""SELECT id, coalesce(n.v, o.v) AS v FROM (SELECT DISTINCT canonical_name AS id FROM canonical_terms WHERE kind = 'ingredient' UNION SELECT DISTINCT canonical_name FROM issue26_sebum_targets WHERE canonical_name <> '') i
    LEFT JOIN (SELECT canonical_name AS id, 'term' AS v FROM canonical_terms WHERE kind = 'ingredient' GROUP BY 1) n USING (id) LEFT JOIN (SELECT canonical_name AS id, 'target' AS v FROM issue26_sebum_targets GROUP BY 1) o USING (id)""")
def node_union(spark: SparkSession, d: str) -> DataFrame:
    terms = read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select(F.col("canonical_name").alias("id"), F.lit("term").alias("v"))
    t = read_table(spark, d, "issue26_sebum_targets").select(F.col("canonical_name").alias("id"), F.lit("target").alias("v"))
    return G.union_first([terms, t], "id")


@query("""WITH inc AS (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY collected_at DESC, source DESC NULLS LAST, searched_ingredient DESC NULLS LAST) AS rn FROM bronze_paper WHERE batch_id >= '2025-01' AND pmid IS NOT NULL),
    old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY collected_at DESC, source DESC NULLS LAST, searched_ingredient DESC NULLS LAST) AS rn FROM bronze_paper WHERE batch_id < '2025-01' AND pmid IS NOT NULL) WHERE rn = 1),
    f AS (SELECT pmid, max(title) FILTER (rn = 1) AS title, max(source) FILTER (rn = 1) AS source, arg_max(doi, -rn) FILTER (doi IS NOT NULL) AS doi, arg_max(journal, -rn) FILTER (journal IS NOT NULL) AS journal FROM inc GROUP BY pmid)
    SELECT coalesce(f.pmid, old.pmid) AS pmid, CASE WHEN f.pmid IS NOT NULL THEN f.title ELSE old.title END AS title, CASE WHEN f.pmid IS NOT NULL THEN f.source ELSE old.source END AS source, coalesce(f.doi, old.doi) AS doi, coalesce(f.journal, old.journal) AS journal, old.publication_year FROM f FULL JOIN old USING (pmid)""")
def upserted_papers(spark: SparkSession, d: str) -> DataFrame:
    """Earlier papers after the later batches arrived: some columns overwritten, some only filled."""
    columns = ["batch_id", "collected_at", "source", "searched_ingredient", "pmid", "title", "doi", "journal", "publication_year"]
    b = read_table(spark, d, "bronze_paper").where("pmid is not null").select(*columns).withColumns({"s": F.coalesce("source", F.lit("")), "i": F.coalesce("searched_ingredient", F.lit(""))})
    old = A.last_wins(b.where("batch_id < '2025-01'"), ["pmid"], ["collected_at", "s", "i"]).select("pmid", "title", "source", "doi", "journal", "publication_year")
    return U.upsert(old, b.where("batch_id >= '2025-01'"), "pmid", ["collected_at", "s", "i"], ["title", "source"], ["doi", "journal"]).select("pmid", "title", "source", "doi", "journal", "publication_year")


@query("""SELECT pmid, chunk_index, min(chunk_text) AS chunk_text FROM silver_chunk s WHERE batch_id >= '2025-01' AND pmid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver_chunk o WHERE o.batch_id < '2025-01' AND o.pmid = s.pmid AND o.chunk_index = s.chunk_index) GROUP BY 1, 2""")
def inserted_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "silver_chunk").where("pmid is not null").select("batch_id", "pmid", "chunk_index", "chunk_text")
    new = U.insert_new(c.where("batch_id < '2025-01'"), c.where("batch_id >= '2025-01'"), ["pmid", "chunk_index"], ["chunk_text"])
    return new.select("pmid", "chunk_index", "chunk_text")


@query("SELECT DISTINCT pmid FROM bronze_paper b WHERE pmid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver_chunk s WHERE s.pmid = b.pmid)")
def unchunked_papers(spark: SparkSession, d: str) -> DataFrame:
    return U.not_processed(read_table(spark, d, "bronze_paper").where("pmid is not null"), read_table(spark, d, "silver_chunk"), ["pmid"]).select("pmid").distinct()


@query("""SELECT t.ingredient_code, coalesce(c.term_id, -t.ingredient_code) AS term_id FROM (SELECT DISTINCT ingredient_code, canonical_name FROM issue26_sebum_targets) t LEFT JOIN canonical_terms c ON c.kind = 'ingredient' AND c.canonical_name = t.canonical_name""")
def node_properties(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "issue26_sebum_targets").select("ingredient_code", "canonical_name").distinct().withColumn("term_id", -F.col("ingredient_code"))
    v = read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select("canonical_name", "term_id")
    return U.set_properties(n, v, "canonical_name", ["term_id"]).select("ingredient_code", "term_id")


_FUN = [("PEPTIDE", ["HYDRATING", "BARRIER"], "improves", 0.1), ("ACID", ["KERATOLYTIC", "BRIGHTENING"], "improves", 0.15), ("LIPID", ["BARRIER"], "improves", 0.03), ("PLANT", ["SOOTHING", "HYDRATING"], "reduces", 0.05)]


@query("""WITH f AS (SELECT canonical_name AS owner, category AS fn FROM issue26_sebum_targets WHERE category IS NOT NULL),
    m AS (SELECT * FROM (VALUES ('PEPTIDE', ['HYDRATING', 'BARRIER'], 'improves', 0.1::DOUBLE), ('ACID', ['KERATOLYTIC', 'BRIGHTENING'], 'improves', 0.15::DOUBLE), ('LIPID', ['BARRIER'], 'improves', 0.03::DOUBLE), ('PLANT', ['SOOTHING', 'HYDRATING'], 'reduces', 0.05::DOUBLE)) v(fn, effects, relation, confidence)),
    x AS (SELECT DISTINCT owner, relation, confidence, unnest(effects) AS effect, generate_subscripts(effects, 1) AS p FROM f JOIN m ON m.fn = upper(trim(split_part(f.fn, ' - ', 1))))
    SELECT owner, effect, relation, arg_min(CASE WHEN p = 1 THEN confidence ELSE round(confidence * 0.6, 6) END, p) AS score FROM x GROUP BY 1, 2, 3""")
def function_edges(spark: SparkSession, d: str) -> DataFrame:
    owners = read_table(spark, d, "issue26_sebum_targets").where("category is not null").select("canonical_name", T.function_names(F.col("category")).alias("functions"))
    return A.function_edges(owners, "canonical_name", "functions", spark.createDataFrame(_FUN, "function string, effects array<string>, relation string, confidence double"))


_KEYWORDS = {"PEPTIDE": "hydration|TEWL", "ACID": "exfoliation|Texture|hydration", "LIPID": "barrier|dry skin", "PLANT": "soothing|Barrier"}


@query("""SELECT row_number() OVER (ORDER BY ingredient_code) AS target_no, ingredient_code, coalesce(lower(category), 'other') AS category, CASE upper(category) WHEN 'ACID' THEN 'exfoliation|Texture|hydration' WHEN 'LIPID' THEN 'barrier|dry skin' WHEN 'PEPTIDE' THEN 'hydration|TEWL' WHEN 'PLANT' THEN 'soothing|Barrier' ELSE '' END AS keywords
    FROM (SELECT DISTINCT ingredient_code, category FROM issue26_sebum_targets WHERE coalesce(upper(category), '') <> 'MINERAL')""")
def target_list(spark: SparkSession, d: str) -> DataFrame:
    """Targets built from function cells: inactive ones out, keywords of the functions, consecutive numbers."""
    t = read_table(spark, d, "issue26_sebum_targets").select("ingredient_code", "category").distinct()
    built = A.build_targets(t, "category", _KEYWORDS, {k: k.lower() for k in _KEYWORDS}, ("MINERAL",))
    from quillstone.sources.writers import batch_numbers

    return batch_numbers(built, "ingredient_code", 1).select((F.col("batch_no") + 1).cast("long").alias("target_no"), "ingredient_code", F.lower("category").alias("category"), "keywords")


@query("SELECT t.ingredient_code, coalesce(c.canonical_name, t.query_name) AS name, coalesce(e.effect_name_ko, t.category) AS local_name FROM (SELECT DISTINCT ingredient_code, canonical_name, query_name, category FROM issue26_sebum_targets) t LEFT JOIN canonical_terms c ON c.kind = 'ingredient' AND c.canonical_name = t.canonical_name LEFT JOIN (SELECT effect_id, max(effect_name_ko) AS effect_name_ko FROM effect_taxonomy GROUP BY 1) e ON e.effect_id = t.ingredient_code")
def node_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes from the reference list first, from the row itself where there are none."""
    t = read_table(spark, d, "issue26_sebum_targets").select("ingredient_code", "canonical_name", "query_name", "category").distinct()
    c = read_table(spark, d, "canonical_terms").where("kind = 'ingredient'").select("canonical_name", F.col("canonical_name").alias("listed"))
    e = read_table(spark, d, "effect_taxonomy").groupBy(F.col("effect_id").alias("ingredient_code")).agg(F.max("effect_name_ko").alias("ko"))
    return t.join(c, "canonical_name", "left").join(e, "ingredient_code", "left").select("ingredient_code", F.coalesce("listed", "query_name").alias("name"), F.coalesce("ko", "category").alias("local_name"))


# ---- audits and invariants --------------------------------------------------------------------------------------

_SUM = "concat_ws(' ', ingredient_name, relation, target)"


@query(f"SELECT CASE WHEN s ILIKE '% is_well_tolerated_for %' THEN 'is_well_tolerated_for' WHEN s ILIKE '% improves %' THEN 'improves' WHEN s ILIKE '% reduces %' THEN 'reduces' WHEN s ILIKE '% prevents %' THEN 'prevents' WHEN s ILIKE '% increases %' THEN 'increases' ELSE 'other' END AS relation, count(*) AS cnt FROM (SELECT {_SUM} AS s FROM gold_claim) GROUP BY 1")
def audit_relations(spark: SparkSession, d: str) -> DataFrame:
    s = F.concat_ws(" ", "ingredient_name", "relation", "target")
    names = ("is_well_tolerated_for", "improves", "reduces", "prevents", "increases")
    return read_table(spark, d, "gold_claim").groupBy(L.first_label([(s.ilike(f"% {n} %"), n) for n in names], "other").alias("relation")).agg(F.count(F.lit(1)).alias("cnt"))


@query("SELECT normalized_summary, count(*) AS cnt FROM gold_claim GROUP BY 1 HAVING count(*) > 1")
def audit_repeats(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "gold_claim").groupBy("normalized_summary").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


@query("SELECT split_part(normalized_summary, ' ', 1) AS ingredient, split_part(normalized_summary, ' ', 2) AS relation, substr(r, position(' ' in r) + 1) AS target, count(*) AS evidence_count FROM (SELECT normalized_summary, substr(normalized_summary, position(' ' in normalized_summary) + 1) AS r FROM gold_claim) GROUP BY 1, 2, 3")
def audit_split(spark: SparkSession, d: str) -> DataFrame:
    g = read_table(spark, d, "gold_claim")
    s = F.col("normalized_summary")
    rest = F.expr("substring(normalized_summary, locate(' ', normalized_summary) + 1)")
    return g.withColumn("_r", rest).groupBy(F.split_part(s, F.lit(" "), F.lit(1)).alias("ingredient"), F.split_part(s, F.lit(" "), F.lit(2)).alias("relation"), F.expr("substring(_r, locate(' ', _r) + 1)").alias("target")).agg(F.count(F.lit(1)).alias("evidence_count"))


@query("SELECT DISTINCT claim_key, normalized_summary FROM gold_claim WHERE regexp_matches(normalized_summary, '(?i)(cancer|fracture|blood sugar|body weight|surgery)')")
def audit_odd_targets(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "gold_claim").where(F.col("normalized_summary").rlike("(?i)(cancer|fracture|blood sugar|body weight|surgery)")).select("claim_key", "normalized_summary").distinct()


@query("""SELECT 'relation_known' AS "check", count(*) FILTER (coalesce(relation NOT IN ('improves', 'reduces', 'supports', 'causes', 'increases', 'prevents'), true)) AS n_bad FROM gold_claim UNION ALL SELECT 'confidence_in_range', count(*) FILTER (NOT coalesce(confidence_score BETWEEN 0 AND 1, false)) FROM gold_claim UNION ALL SELECT 'offsets_ordered', count(*) FILTER (NOT coalesce(source_end_offset + 1e-9 >= source_start_offset, false)) FROM gold_claim""")
def invariants(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return Q.violations(read_table(spark, d, "gold_claim"), {"relation_known": Q.in_list(c("relation"), ("improves", "reduces", "supports", "causes", "increases", "prevents")), "confidence_in_range": c("confidence_score").between(0, 1), "offsets_ordered": Q.at_least(c("source_end_offset"), c("source_start_offset"))})


@query("SELECT k AS term, count(*) AS n_targets FROM (SELECT DISTINCT ingredient_code, unnest(list_transform(string_split(concern_keywords, '|'), lambda x: lower(trim(x, ' ')))) AS k FROM issue26_sebum_targets WHERE concern_keywords IS NOT NULL) WHERE k <> '' GROUP BY 1")
def keyword_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Targets per keyword."""
    t = read_table(spark, d, "issue26_sebum_targets").where("concern_keywords is not null").select("ingredient_code", F.explode(T.pipe_split(F.lower("concern_keywords"))).alias("term")).distinct()
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("n_targets"))


@query("SELECT confidence_score, least(greatest(confidence_score, 0.6), 0.85) AS map_score, count(*) AS n FROM gold_claim GROUP BY 1, 2")
def clamped_scores(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "gold_claim").groupBy("confidence_score", T.clamp(F.col("confidence_score"), 0.6, 0.85).alias("map_score")).agg(F.count(F.lit(1)).alias("n"))


# ---- extraction -------------------------------------------------------------------------------------------------


def rule_extractor(sentences: list[str]) -> list[str]:
    """A deterministic stand-in for a model: one claim per sentence that says that something changed something."""
    import json
    import re

    pattern = re.compile(r"^(?:RESULTS:\s*)?(?P<i>[A-Z][\w, -]+?) (?P<r>improved|worsened|lowered|raised|masks|blurs) (?P<t>[a-zA-Z -]+?)(?: in | by |,|\.)")
    out = []
    for s in sentences:
        m = pattern.search(s)
        claims = [{"ingredient": m["i"], "relation": m["r"], "target": m["t"], "claim_type": "efficacy", "confidence": 0.5}] if m else []
        out.append(json.dumps({"claims": claims}))
    return out


_SAID = "^(?:RESULTS:\\s*)?([A-Z][\\p{L}\\p{N}_, -]+?) (improved|worsened|lowered|raised|masks|blurs) ([a-zA-Z -]+?)(?: in | by |,|\\.)"


@query(f"""SELECT claim_key, regexp_extract(source_sentence, '{_SAID}', 1) AS ingredient, regexp_extract(source_sentence, '{_SAID}', 2) AS relation, regexp_extract(source_sentence, '{_SAID}', 3) AS target, 0.5::DOUBLE AS confidence FROM (SELECT DISTINCT claim_key, source_sentence FROM gold_claim WHERE claim_key IS NOT NULL)
    WHERE regexp_matches(source_sentence, '{_SAID}') AND NOT regexp_matches(lower(regexp_extract(source_sentence, '{_SAID}', 3)), 'carcinoma|cancer|tumor|tumour|microemulsion|nanoemulsion|particle size|release profile|drug delivery|cell migration|dermal papilla|gene expression|therapy|treatment|blood loss|perioperative')""")
def extracted_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims by the stand-in extractor behind the cache."""
    s = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", "source_sentence").distinct()
    model = {"question": "source_sentence", "model": "rules", "prompt": "one claim"}
    # half of the sentences were asked before
    _, cache = extract_cached(s.where(F.length("source_sentence") % 2 == 0), spark.createDataFrame([], "cache_key string, response string"), rule_extractor, **model)
    answered, _ = extract_cached(s, cache, rule_extractor, **model)
    return answered.select("claim_key", F.explode(claims_of(F.col("response"))).alias("c")).select("claim_key", "c.ingredient", "c.relation", "c.target", "c.confidence")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
