"""One form for text that looks the same.

DuckDB runs inside each Arrow partition. Its SQL drops invisible characters, brings letters of another script with the
same shape, widths, blanks and compatibility signs to one character, and composes the rest with nfc_normalize. Raised
and lowered digits, fractions and signs that stand for punctuation keep their own look. The character tables follow
from rules over the Unicode database, except the short lists of shapes below.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import broadcast_if_small, cut, ship

# Letters of other scripts with the shape of a Latin letter.
_CYRILLIC = "АВЕЅІЈКМНОРСТУХ" + "аеѕіјорсухԁһԛԝ" + "Ү"
_CYRILLIC_AS = "ABESIJKMHOPCTYX" + "aesijopcyxdhqw" + "Y"
_GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονρϲ"
_GREEK_AS = "ABEZHIKMNOPTYXCjovpc"
_ARMENIAN = "Օոս"
_ARMENIAN_AS = "Onu"
# Signs that look like another sign.
_SIGNS = "‐‑;·"
_SIGNS_AS = "--;·"
# Radicals without a compatibility mapping that stand for a whole character.
_RADICALS = "⺁⺄⺈⺋⺍⺕⺜⺝⺟⺠⺥⺧⺨⺬⺮⺰⺱⺳⺶⺷⺼⺽⻀⻁⻂⻄⻅⻆⻈⻉⻋⻌⻎⻏⻐⻓⻔⻕⻖⻗⻘⻙⻚⻛⻜⻝⻠⻢⻤⻥⻦⻨⻩⻪⻬⻮⻯⻰⻳"
_RADICALS_AS = "厂乙刀㔾小彐日月母民爪牛犬示竹纟网网羊羊肉臼艹虎衤西见角讠贝车辶辶邑钅长门阜阜雨青韦页风飞食饣马鬼鱼鸟麦黄黾齐齿竜龙龟"
#: Blanks that look like a space.
_BLANKS = "               　"
#: Characters that show nothing: soft hyphen, joiners, direction marks, variation selectors, tags.
_INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}]"
#: Bytes of text that DuckDB gets at once.
SLICE_BYTES = 24_000_000
#: Copies of one text that a task may have to pair with other spellings.
HOT_COPIES = 10_000
_KEPT_KINDS = ("<super>", "<sub>", "<fraction>", "<circle>", "<vertical>")


def _plain(ch: str) -> str:
    """The compatibility form of one character, keeping raised and lowered signs, fractions and circled ones."""
    parts = unicodedata.decomposition(ch).split()
    if not parts or parts[0] in _KEPT_KINDS:
        return ch
    points = parts[1:] if parts[0].startswith("<") else parts
    return "".join(_plain(chr(int(p, 16))) for p in points)


@cache
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters to one character, and characters to several."""
    one: dict[str, str] = {}
    for a, b in ((_CYRILLIC, _CYRILLIC_AS), (_GREEK, _GREEK_AS), (_ARMENIAN, _ARMENIAN_AS), (_SIGNS, _SIGNS_AS), (_RADICALS, _RADICALS_AS)):
        assert len(a) == len(b), (a, b)
        one |= dict(zip(a, b, strict=True))
    shapes = dict(one)
    one |= dict.fromkeys(_BLANKS, " ")
    several: dict[str, str] = {}
    for point in [*range(0xA0, 0x3400), *range(0xA69C, 0xAB70), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA20)]:
        ch = chr(point)
        if ch in one or 0xAC00 <= point < 0xD800:
            continue
        raw = unicodedata.decomposition(ch)
        if not raw:
            continue
        flat = "".join(shapes.get(c, c) for c in _plain(ch))
        plain = unicodedata.normalize("NFC", flat)
        if plain == ch:
            continue
        if raw.startswith("<"):
            if raw.startswith("<compat>") and (plain[0] == " " or not any(c.isalnum() or c == "." for c in plain)) or raw.split()[0] in _KEPT_KINDS:
                continue  # spacing accents and marks: a sign of its own; rows of dots are dots
            if raw.startswith("<compat>") and len(plain) > 1 and any(unicodedata.category(c) == "Ps" for c in plain):
                continue
        if len(plain) == 1:
            one[ch] = plain
        else:
            several[ch] = plain
    return one, several


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(chars: str) -> str:
    """A character class for DuckDB's regular expressions, neighbours as ranges."""
    points, out = sorted(map(ord, chars)), []
    start = last = points[0]
    for p in [*points[1:], -2]:
        if p != last + 1:
            out.append(rf"\x{{{start:X}}}" + (rf"-\x{{{last:X}}}" if last > start else ""))
            start = p
        last = p
    return "[" + "".join(out) + "]"


@cache
def canonical_sql(column: str = "t") -> str:
    """The SQL expression that brings `column` to its one form."""
    one, several = tables()
    sql = f"regexp_replace({column}, {_quote(_INVISIBLE)}, '', 'g')"
    # Characters that become several: looked for all at once, then in blocks, so that most texts skip them.
    items = list(several.items())
    blocks = "s"
    for at in range(0, len(items), 60):
        block = items[at : at + 60]
        inner = "s"
        for a, b in block:
            inner = f"replace({inner}, {_quote(a)}, {_quote(b)})"
        found = f"regexp_matches(s, {_quote(_class(''.join(a for a, _ in block)))})"
        blocks = f"list_transform([{blocks}], lambda s: CASE WHEN {found} THEN {inner} ELSE s END)[1]"
    sql = f"list_transform([{sql}], lambda s: CASE WHEN regexp_matches(s, {_quote(_class(''.join(several)))}) THEN {blocks} ELSE s END)[1]"
    names = "".join(one)
    sql = f"list_transform([{sql}], lambda s: CASE WHEN regexp_matches(s, {_quote(_class(names))}) THEN translate(s, {_quote(names)}, {_quote(''.join(one.values()))}) ELSE s END)[1]"
    # an accent on a letter that only now is Latin composes here
    return f"nfc_normalize({sql})"


def _normalise(columns: list[str], text: str, out: str):
    schema_names = [*columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "autoinstall_known_extensions": False, "autoload_known_extensions": False})
        expression = canonical_sql("t")
        ascii_only = "regexp_full_match(t, '[\\x00-\\x7F]*')"
        query = f"SELECT CASE WHEN t IS NULL THEN NULL WHEN {ascii_only} THEN t ELSE {expression} END AS c FROM texts ORDER BY i"
        for batch in batches:
            # planning the long expression costs more than running it on a few rows: slices as large as memory allows
            rows = max(1, min(batch.num_rows, 16_384, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)) or 1))
            for at in range(0, batch.num_rows, rows):
                part = pa.Table.from_batches([batch.slice(at, rows)])
                texts = pa.table({"i": pa.array(range(part.num_rows), pa.int32()), "t": part.column(text).cast(pa.string())})
                con.register("texts", texts)
                got = con.sql(query).to_arrow_table()
                con.unregister("texts")
                done = got.column("c").cast(pa.string()).combine_chunks()
                for x in pa.table([*(part.column(c) for c in columns), done], names=schema_names).to_batches():
                    yield x

    return run


def canonical_text(docs: DataFrame, text: str = "text", out: str = "canonical_text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with column `out`: `text` in the one form in which texts that look the same are equal.

    Null stays null, empty stays empty; a text of invisible characters alone becomes empty. Texts of any length are
    taken whole. Repeated rows stay. A column named as `out` is replaced.
    """
    ship(docs.sparkSession)
    columns = [c for c in (keep if keep is not None else docs.columns) if c.lower() != out.lower()]
    source = docs.select(*dict.fromkeys([*columns, text]))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return source.mapInArrow(_normalise(columns, text, out), f"{fields}, `{out}` string" if fields else f"`{out}` string")


def lookalike_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (digest of the one form), text_id (digest of the text as stored) of every text that is not null or empty."""
    known = docs.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    form = canonical_text(known, "text", "canonical_text", ["doc_id", "text"])
    return form.select("doc_id", F.md5("canonical_text").alias("class_id"), F.md5("text").alias("text_id"))


def _spellings(members: DataFrame) -> DataFrame:
    """class_id, text_id and copies of every spelling of the classes that have several."""
    own = members.groupBy("class_id", "text_id").agg(F.count(F.lit(1)).alias("copies"))
    mixed = own.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("members")).where("n > 1").select("class_id", "members")
    return own.join(mixed, "class_id")


def lookalike_members(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id and n_links of every document that looks like one with another string: its class, and how many
    documents of the class are stored differently. One row per document, however many pairs its class makes; null and
    empty texts and classes of one spelling give none."""
    members = cut(lookalike_classes(docs, doc_id, text))
    links = cut(_spellings(members).select("text_id", (F.col("members") - F.col("copies")).alias("n_links")))
    return members.join(broadcast_if_small(links), "text_id").select("doc_id", "class_id", "n_links")


def lookalike_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_copies: int = HOT_COPIES) -> DataFrame:
    """Pairs doc_a < doc_b whose texts look the same but are not the same string, once each.

    Null and empty texts are no cases. Exact copies of one text are in no pair with each other, but each is in a pair
    with every other spelling; `lookalike_members` gives the same in one row per document. Classes of one spelling
    only, however many copies it has, are dropped before any join. A text with more than `hot_copies` copies in a class
    of several spellings is spread over as many parts, and its links are repeated for each.
    """
    members = cut(lookalike_classes(docs, doc_id, text))
    own = cut(_spellings(members))
    links = own.alias("x").join(own.alias("y"), (F.col("x.class_id") == F.col("y.class_id")) & (F.col("x.text_id") < F.col("y.text_id"))).select(F.col("x.text_id").alias("text_x"), F.col("y.text_id").alias("text_y"))
    parts = own.where(F.col("copies") > hot_copies).select("text_id", F.ceil(F.col("copies") / hot_copies).cast("int").alias("_parts"))
    parts = broadcast_if_small(parts)  # at most one text in `hot_copies` documents

    def with_docs(linked: DataFrame, text_name: str, doc_name: str) -> DataFrame:
        n = F.coalesce("_parts", F.lit(1))
        left = linked.join(parts, F.col(text_name) == F.col("text_id"), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("text_id", "_parts")
        right = members.join(parts, "text_id", "left").select(F.col("text_id").alias(text_name), F.col("doc_id").alias(doc_name), F.pmod(F.xxhash64("doc_id"), n).cast("int").alias("_part"))
        return left.join(right, [text_name, "_part"]).drop(text_name, "_part")

    pairs = with_docs(with_docs(links, "text_x", "doc_x"), "text_y", "doc_y")
    return pairs.select(F.least("doc_x", "doc_y").alias("doc_a"), F.greatest("doc_x", "doc_y").alias("doc_b")).where("doc_a <> doc_b").distinct()
