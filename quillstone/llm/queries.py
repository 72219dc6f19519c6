"""Queries of the training-data operators over the whole tables, with their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm.canonical import map_to_list, misses
from quillstone.llm.lookalike import canonical_text, lookalike_members, lookalike_pairs
from quillstone.llm.mixing import mix, share_report
from quillstone.llm.packing import pack
from quillstone.llm.sentences import sentence_offsets, sentences
from quillstone.llm.splitting import split_oversized
from quillstone.runtime import cut, read_table


def _typed(spark: SparkSession, d: str) -> DataFrame:
    claims = read_table(spark, d, "gold_claim").where("claim_key is not null").select("claim_key", "ingredient_name", "target")
    fields = F.explode(
        F.array(
            F.struct(F.lit("ingredient_name").alias("field_name"), F.lit("ingredient").alias("kind"), F.col("ingredient_name").alias("typed")),
            F.struct(F.lit("target").alias("field_name"), F.lit("target").alias("kind"), F.col("target").alias("typed")),
        )
    )
    return map_to_list(claims.select("claim_key", fields.alias("f")).select("claim_key", "f.*"), read_table(spark, d, "canonical_terms"), kind="kind", value="typed")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _typed(spark, d).select("claim_key", "field_name", "term_id").distinct()


def p1_plain(spark: SparkSession, d: str) -> DataFrame:
    """Every value with what it must mean where it has the letters and digits of a name, whatever its case and marks;
    null elsewhere."""
    terms = read_table(spark, d, "canonical_terms").where("canonical_name is not null").select("kind", _letters("canonical_name").alias("_letters")).distinct()
    rows = _typed(spark, d).withColumn("_letters", F.when(F.col("typed").rlike(r"^[\x00-\x7F]*$"), _letters("typed")))
    plain = rows.join(terms.withColumn("_plain", F.lit(True)), ["kind", "_letters"], "left")
    return plain.select("claim_key", "field_name", "typed", F.when(F.col("_plain"), F.col("term_id")).alias("term_id")).distinct()


def _letters(column: str):
    return F.regexp_replace(F.lower(column), "[^a-z0-9]+", "")


def p1_misses(spark: SparkSession, d: str) -> DataFrame:
    return misses(_typed(spark, d), "kind", "typed")


def _limit(spark: SparkSession, d: str, name: str) -> tuple[int, int]:
    row = read_table(spark, d, "size_limits").where(F.col("field_name") == name).head()
    return int(row["max_size"]), int(row["overlap_size"])


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    size, overlap = _limit(spark, d, "silver_chunk.chunk_text")
    chunks = read_table(spark, d, "silver_chunk").where("pmid is not null and chunk_index is not null")
    a = split_oversized(chunks, "chunk_text", ["pmid", "chunk_index"], size, overlap, "source_start_offset").withColumn("field_name", F.lit("chunk_text"))
    size, overlap = _limit(spark, d, "bronze_paper.abstract_text")
    papers = read_table(spark, d, "bronze_paper").where("pmid is not null").withColumn("chunk_index", F.lit(-1))
    b = split_oversized(papers, "abstract_text", ["pmid", "chunk_index"], size, overlap).withColumn("field_name", F.lit("abstract_text"))
    return a.unionByName(b).select("field_name", "pmid", "chunk_index", "piece_no", "start_char", "end_char", "source_offset", "piece_text")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_pieces(spark, d).where("piece_no > 1").select("field_name", "pmid", "chunk_index").distinct()


def _sentence_fields(spark: SparkSession, d: str) -> DataFrame:
    chunks = read_table(spark, d, "silver_chunk").where("pmid is not null and chunk_index is not null").select(F.concat("pmid", F.lit("#"), F.col("chunk_index").cast("string")).alias("record_key"), F.col("chunk_text").alias("value"), F.lit("chunk_text").alias("field_name"))
    claims = read_table(spark, d, "gold_claim").where("claim_key is not null").select(F.col("claim_key").alias("record_key"), F.col("source_sentence").alias("value"), F.lit("source_sentence").alias("field_name"))
    return chunks.unionByName(claims)


def p3_coverage(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of each item cover, whether each is within the limit, and whether neighbours share the overlap."""
    limits = {f: _limit(spark, d, t) for f, t in (("chunk_text", "silver_chunk.chunk_text"), ("abstract_text", "bronze_paper.abstract_text"))}
    by_field = lambda i: F.when(F.col("field_name") == "chunk_text", limits["chunk_text"][i]).otherwise(limits["abstract_text"][i])
    p = p3_pieces(spark, d).select("field_name", "pmid", "chunk_index", "piece_no", "start_char", "end_char", F.length("piece_text").alias("n"), "source_offset").distinct()
    n = F.struct("piece_no", "start_char", "end_char")
    each = p.groupBy("field_name", "pmid", "chunk_index").agg(F.array_sort(F.collect_list(n)).alias("ps"), F.max("n").alias("longest"), F.bool_and(F.col("n") == F.col("end_char") - F.col("start_char")).alias("whole"))
    shared = F.forall(F.sequence(F.lit(0), F.size("ps") - 2), lambda i: F.get("ps", i)["end_char"] - F.get("ps", i + 1)["start_char"] == by_field(1))
    return each.select("field_name", "pmid", "chunk_index", F.col("ps")[0]["start_char"].alias("begins"), F.element_at("ps", -1)["end_char"].alias("ends"), ((F.col("longest") <= by_field(0)) & F.col("whole")).alias("within"), shared.alias("overlaps"))


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How many characters that are no blanks the sentences of each record hold, and whether they are numbered on."""
    s = p4_sentences(spark, d).withColumn("n", F.length(F.regexp_replace("sentence", _NO_INK, "")))
    return s.groupBy("field_name", "record_key").agg(F.sum("n").cast("long").alias("n_chars"), (F.max("sentence_no") == F.countDistinct("sentence_no")).alias("numbered"))


_NO_INK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences(_sentence_fields(spark, d), "value", ["field_name", "record_key"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sentence_offsets(_sentence_fields(spark, d), "value", ["field_name", "record_key"])


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack(read_table(spark, d, "documents"), _limit(spark, d, "documents.text")[0])


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens in them and the room left over."""
    capacity = _limit(spark, d, "documents.text")[0]
    per = p6_containers(spark, d).where("container_id is not null").groupBy("container_id").agg(F.sum("n_tokens").alias("n"), F.max("room_left").alias("room"))
    return per.agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_tokens"), F.sum("room").alias("room_left"), F.ceil(F.sum("n") / capacity).alias("fewest_possible"))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per document whether it is placed, whether its containers hold no more than they may, and whether it is in pieces
    only if it exceeds one."""
    capacity = _limit(spark, d, "documents.text")[0]
    placed = cut(p6_containers(spark, d))
    full = placed.where("container_id is not null").groupBy("container_id").agg(F.sum("n_tokens").alias("held"), F.max("room_left").alias("room")).withColumn("ok", (F.col("held") <= capacity) & (F.col("room") == capacity - F.col("held")))
    rows = placed.join(full.select("container_id", "ok"), "container_id", "left")
    return rows.groupBy("doc_id").agg(F.bool_and(F.col("container_id").isNotNull()).alias("placed"), F.bool_and(F.coalesce("ok", F.lit(True))).alias("fits"), ((F.count(F.lit(1)) == 1) | (F.sum("n_tokens") > capacity)).alias("whole"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per document of a listed source whether it is used a number of times that may be."""
    most = read_table(spark, d, "mix_targets").groupBy("source").agg(F.min("max_repeats").alias("most"))
    return p7_mix(spark, d).join(most, "source").select("doc_id", "source", F.col("n_uses").between(0, F.col("most")).alias("within"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return share_report(cut(p7_mix(spark, d)), read_table(spark, d, "mix_targets"))


def p8_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical_text(read_table(spark, d, "documents"), "text", "canonical_text", ["doc_id"])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_pairs(read_table(spark, d, "documents"))


def p8_members(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_members(read_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_misses, p1_plain, p3_found, p3_pieces, p3_coverage, p4_found, p4_sentences, p4_coverage, p6_containers, p6_report, p6_checks, p7_mix, p7_shares, p7_checks, p8_found, p8_canonical, p8_members)}


def oracle_sql() -> dict[str, str]:
    letters = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"
    typed = " UNION ALL ".join(f"SELECT claim_key, '{f}' AS field_name, '{k}' AS kind, {f} AS typed FROM gold_claim WHERE claim_key IS NOT NULL AND trim({f}) <> '' AND {f} NOT IN (SELECT canonical_name FROM canonical_terms WHERE kind = '{k}' AND canonical_name IS NOT NULL)" for f, k in (("ingredient_name", "ingredient"), ("target", "target")))
    return {
        "p1_plain": f"""
            SELECT DISTINCT claim_key, field_name, typed, term_id FROM ({typed}) v LEFT JOIN (SELECT kind, {letters.format('canonical_name')} AS l, min(term_id) AS term_id FROM canonical_terms WHERE canonical_name IS NOT NULL GROUP BY 1, 2) t
            ON t.kind = v.kind AND regexp_matches(typed, '^[\\x00-\\x7F]*$') AND t.l = {letters.format('typed')}""",
        "p3_coverage": """
            SELECT DISTINCT 'chunk_text' AS field_name, pmid, chunk_index, CAST(0 AS INTEGER) AS begins, CAST(length(chunk_text) AS INTEGER) AS "ends", true AS within, true AS overlaps FROM silver_chunk
            WHERE pmid IS NOT NULL AND chunk_index IS NOT NULL AND length(chunk_text) > (SELECT max_size FROM size_limits WHERE field_name = 'silver_chunk.chunk_text')
            UNION ALL
            SELECT DISTINCT 'abstract_text', pmid, CAST(-1 AS INTEGER), CAST(0 AS INTEGER), CAST(length(abstract_text) AS INTEGER), true, true FROM bronze_paper
            WHERE pmid IS NOT NULL AND length(abstract_text) > (SELECT max_size FROM size_limits WHERE field_name = 'bronze_paper.abstract_text')""",
        "p4_coverage": f"""
            SELECT field_name, record_key, CAST(sum(n) AS BIGINT) AS n_chars, true AS numbered FROM (
                SELECT DISTINCT 'chunk_text' AS field_name, pmid || '#' || CAST(chunk_index AS VARCHAR) AS record_key, chunk_text AS t, length(regexp_replace(chunk_text, '{_NO_INK}', '', 'g')) AS n FROM silver_chunk WHERE pmid IS NOT NULL AND chunk_index IS NOT NULL AND chunk_text IS NOT NULL
                UNION ALL SELECT DISTINCT 'source_sentence', claim_key, source_sentence, length(regexp_replace(source_sentence, '{_NO_INK}', '', 'g')) FROM gold_claim WHERE claim_key IS NOT NULL AND source_sentence IS NOT NULL)
            WHERE n > 0 GROUP BY 1, 2""",
        "p6_checks": "SELECT doc_id, text IS NOT NULL AS placed, true AS fits, true AS whole FROM documents",
        "p7_checks": "SELECT doc_id, source, true AS within FROM documents JOIN (SELECT DISTINCT source FROM mix_targets) USING (source)",
        "p3_found": """
            SELECT DISTINCT 'chunk_text' AS field_name, pmid, chunk_index FROM silver_chunk
            WHERE pmid IS NOT NULL AND chunk_index IS NOT NULL AND length(chunk_text) > (SELECT max_size FROM size_limits WHERE field_name = 'silver_chunk.chunk_text')
            UNION
            SELECT DISTINCT 'abstract_text', pmid, CAST(-1 AS INTEGER) FROM bronze_paper
            WHERE pmid IS NOT NULL AND length(abstract_text) > (SELECT max_size FROM size_limits WHERE field_name = 'bronze_paper.abstract_text')""",
        "p8_canonical": f"WITH {_forms_sql()} SELECT doc_id, form AS canonical_text FROM forms",
        "p8_found": f"""
            WITH {_forms_sql()}, c AS (SELECT * FROM forms WHERE text <> '')
            SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM c a JOIN c b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text""",
        "p8_members": f"""
            WITH {_forms_sql()}, c AS (SELECT * FROM forms WHERE text <> '')
            SELECT a.doc_id, md5(a.form) AS class_id, count(*) AS n_links FROM c a JOIN c b ON a.form = b.form AND a.text <> b.text GROUP BY 1, 2""",
    }


# Letters with the shape of a Latin letter, as the standard list of confusable characters has them.
_LIKE_LATIN = "А=A В=B Е=E Ѕ=S І=I Ј=J К=K М=M Н=H О=O Р=P С=C Т=T У=Y Х=X Ү=Y а=a е=e ѕ=s і=i ј=j о=o р=p с=c у=y х=x ԁ=d һ=h ԛ=q ԝ=w Α=A Β=B Ε=E Ζ=Z Η=H Ι=I Κ=K Μ=M Ν=N Ο=O Ρ=P Τ=T Υ=Y Χ=X Ϲ=C ϳ=j ο=o ν=v ρ=p ϲ=c Օ=O ո=n ս=u ї=ï Ї=Ï ё=ë Ё=Ë"
# Signs, and radicals that have no compatibility form, with what they look like.
_LIKE_SIGNS = "‐=- ‑=- ;=; ·=· ⺁=厂 ⺄=乙 ⺈=刀 ⺋=㔾 ⺍=小 ⺕=彐 ⺜=日 ⺝=月 ⺟=母 ⺠=民 ⺥=爪 ⺧=牛 ⺨=犬 ⺬=示 ⺮=竹 ⺰=纟 ⺱=网 ⺳=网 ⺶=羊 ⺷=羊 ⺼=肉 ⺽=臼 ⺿=艹 ⻀=艹 ⻁=虎 ⻂=衤 ⻄=西 ⻅=见 ⻆=角 ⻈=讠 ⻉=贝 ⻋=车 ⻌=辶 ⻎=辶 ⻏=邑 ⻐=钅 ⻓=长 ⻔=门 ⻕=阜 ⻖=阜 ⻗=雨 ⻘=青 ⻙=韦 ⻚=页 ⻛=风 ⻜=飞 ⻝=食 ⻠=饣 ⻢=马 ⻤=鬼 ⻥=鱼 ⻦=鸟 ⻨=麦 ⻩=黄 ⻪=黾 ⻬=齐 ⻮=齿 ⻯=竜 ⻰=龙 ⻳=龟"


def _forms_sql() -> str:
    """The forms of documents character by character, by another way than the operator's: composed first, then the
    library's whole compatibility form of each character that has one (save raised, lowered and circled signs,
    fractions, and signs that stand for punctuation), then composed again."""
    import unicodedata

    like = dict(pair.split("=", 1) for pair in f"{_LIKE_LATIN} {_LIKE_SIGNS}".split())
    kept = ("<super>", "<sub>", "<fraction>", "<circle>", "<vertical>")
    rows = list(like.items())
    for point in [*range(0xA0, 0xD7FF), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        ch = chr(point)
        whole = unicodedata.normalize("NFKC", ch)
        how = unicodedata.decomposition(ch).split(" ")[0]
        if ch in like or whole == ch or how in kept or unicodedata.category(ch) == "Cf":
            continue
        wide = how in ("<wide>", "<narrow>", "<noBreak>") or unicodedata.category(ch) == "Zs"
        if wide or any(c.isalnum() for c in whole) and "(" not in whole or set(whole) == {"."} or not how.startswith("<"):
            rows.append((ch, "".join(like.get(c, c) for c in whole)))
    quoted = ", ".join(f"(chr({ord(a)}), {' || '.join(f'chr({ord(c)})' for c in b)})" for a, b in rows)
    hidden = "regexp_replace(text, '[\\x{00AD}\\x{034F}\\x{061C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180F}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{206F}\\x{3164}\\x{FE00}-\\x{FE0F}\\x{FEFF}\\x{FFA0}\\x{FFF9}-\\x{FFFB}]', '', 'g')"
    return f"""look AS (SELECT * FROM (VALUES {quoted}) v(a, b)),
        parts AS (SELECT doc_id, text, unnest(string_split(nfc_normalize({hidden}), '')) AS ch, generate_subscripts(string_split(nfc_normalize({hidden}), ''), 1) AS n FROM documents WHERE text <> ''),
        forms AS (SELECT doc_id, text, nfc_normalize(string_agg(coalesce(b, ch), '' ORDER BY n)) AS form FROM parts LEFT JOIN look ON a = ch GROUP BY doc_id, text
            UNION ALL SELECT doc_id, text, text FROM documents WHERE text IS NULL OR text = '')"""
