"""Several values packed in one field, taken apart by rules resolved once per delimiter skeleton.

1. `skeleton` masks everything that can't matter: words become class letters, what quotes or brackets hold becomes one
   sign, repeated items are folded. Fields written the same way share a skeleton, however many there are.
2. `resolve` decides, for each distinct skeleton, which of a few splitting rules a reader would apply.
3. The resolved skeletons, counted against a bound, are broadcast to the fields and the rule's pattern takes the values
   out by position. Steps 1 and 3 are Spark expressions; only distinct skeletons pass through Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import broadcast_if_small, cut, ship

# Words that follow a comma inside one term ("..., dried") whatever the data; others are learned.
KEPT_TAILS = ("dried", "hot skin")
#: Words after a comma are a tail if they stand so in this many values that can't be split at a comma, in more of them
#: than stand alone, and in this share of all such values, which bounds the number of tails.
LEAST_TAILS, TAIL_SHARE = 5, 0.0005

_Q = '"'
#: A quoted stretch counts as one only where a value can begin and end; other quotes are ordinary characters.
_QUOTED = r'(?<![^\s|;,/、，；·&])"(?:[^"]|"")*"(?=\s*(?:$|[|;,/、，；·\t\r\n&]))'
_BRACKET = r"\([^()\"]*\)"
_CJK = r"\p{IsHan}\p{IsHangul}\p{IsHiragana}\p{IsKatakana}"
#: Delimiters that are never part of a term: signs, a slash or dot between blanks, a dot between syllabic letters.
_STRONG = rf"[|;\t\r\n、，；]|(?<=\s)/(?=\s)|(?<=\s)·(?=\s)|(?<=[{_CJK}])·(?=[{_CJK}])"


def _comma(tails: tuple[str, ...]) -> str:
    kept = "|".join(map(re.escape, tails))
    return rf"(?<!\d),|,(?!\d)" if not kept else rf"(?!,\s?(?i:{kept})\b)(?:(?<!\d),|,(?!\d))"


def _item(delimiter: str) -> str:
    """A pattern for one value up to the next delimiter that no quotes or brackets hold."""
    return rf"(?:{_QUOTED}|{_BRACKET}|(?!{delimiter}).)+"


#: Commas, 'and' and '&' between full names; a generation mark stays with its name.
_PERSON = r"\s*,\s*(?:and|&)\s+|\s*,\s*(?!(?:Jr|Sr)\.)|\s+(?:and|&)\s+"


#: Delimiters in a skeleton that are never part of a term.
_STRONG_SIGNS = r"[|;\n、，；]|(?: |^)/(?: |$)|(?: |^)·(?: |$)|c·c"


def skeleton(field: Column, people: bool = False, tails: tuple[str, ...] = KEPT_TAILS) -> Column:
    """The delimiter skeleton of a field: q quoted, b bracketed, n 'and', j generation mark, c syllabic, g given name with
    initial, l name with bare initials, p several words, w one word, 9 digits, d a kept tail; delimiters as they are.
    Where a delimiter stands that is never part of a term, which ones do is all that is left, so the number of
    skeletons follows the ways to write a field, not the fields. Only fields of `people` keep the classes of words."""
    kept = "|".join(map(re.escape, tails))
    # class signs are private-use characters until the end, so that no later pattern takes them for letters
    q, b, d, nine, c, j, n, name_l, g, p, w = (chr(0xE000 + i) for i in range(11))
    word = r"[\p{L}][\p{L}\p{M}'’®.\-]*"
    classes = f"{q}-{w}"
    ends = r"(?=\s*(?:$|[\n|;,/、，；·&]))"
    steps = [
        (_QUOTED, q),
        (_BRACKET, b),
        (r"(?s)[\r\n\t]+", "\n"),
        *([(rf",\s?(?i:{kept})\b", d)] if kept else []),
        (r"\d+(?:[.,]\d+)*", nine),
        (rf"[{_CJK}]+", c),
        (r"(?<![\p{L}])(?:Jr|Sr)\.", j),
        (r"(?<![\p{L}])and(?![\p{L}])", n),
        # names: word(s), then bare or dotted initials
        (rf"{word}(?: {word})* \p{{Lu}}{{1,3}}{ends}", name_l),
        (rf"{word}(?: \p{{Lu}}\.)+{ends}", g),
        (rf"{word}(?: {word})+", p),
        (word, w),
        (rf"[^\n|;,/、，；·&\"{classes} ]", ""),
        (r" +", " "),
        # the same item and delimiter again and again is one
        (rf"(?s)(([{classes}\"])+( ?[\n|;,/、，；·&] ?))\1+", "$1+"),
        (rf"(?s)(([{classes}\"])+, ?([{classes}\"])+( ?[\n|;/；] ?))\1+", "$1+"),
    ]
    flat = F.trim(field)
    out = flat
    for pattern, by in steps:
        out = F.regexp_replace(out, pattern, by)
    out = F.translate(out, "".join((q, b, d, nine, c, j, n, name_l, g, p, w)), "qbd9cjnlgpw")
    if not people:
        out = F.regexp_replace(F.regexp_replace(out, "[bd9jnlgpw+]+(?: [bd9jnlgpw+]+)*", "w"), r"(w ?, ?)\1+", "$1")

    def signs(text: Column) -> Column:
        found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"([|;\n、，；/·])"), F.lit(1))))
        return F.concat(F.lit("c "), F.array_join(found, " "), F.lit(" c"))

    # without quotes and brackets such a delimiter decides at once, and nothing needs to be masked
    plain = ~flat.rlike(r'["(]') & flat.rlike(r"[|;\t\r\n、，；]")
    # in a lambda the masked text is worked out once, and only for the other fields
    masked = F.get(F.transform(F.array(out), lambda o: F.when(o.rlike(_STRONG_SIGNS), signs(o)).otherwise(o)), F.lit(0))
    return F.when(plain, signs(F.regexp_replace(flat, r"[\r\n\t]+", "\n"))).otherwise(masked)


def rule_of(skel: str, people: bool) -> str:
    """The splitting rule for a skeleton: 'strong', 'comma', 'person' or 'one'. `people`: the field holds persons."""
    bare = skel.replace("+", "")
    if re.search(_STRONG_SIGNS, bare):
        return "strong"
    if not people:
        return "comma" if "," in bare else "one"
    if "," not in bare and "n" not in bare and "&" not in bare:
        return "one"
    pieces = [x for x in (x.strip() for x in bare.split(",")) if x and x != "j"]
    if any("q" in x for x in pieces):
        return "comma"
    if pieces and all(x in ("l", "c") for x in pieces):
        return "comma"
    names = [x.strip() for part in pieces for x in re.split(r"n |[n&]", part) if x.strip()]
    if names and all(x in ("p", "pj") for x in names) and len(names) + bare.count("j") > 1:
        return "person"
    return "one"


def _resolve(people: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"_skeleton": pdf["_skeleton"], "_rule": [rule_of(s, people) for s in pdf["_skeleton"]]})

    return run


def learn_tails(fields: DataFrame, field: str) -> tuple[str, ...]:
    """Words that belong to the term before their comma, in small letters: seen after one inside quotes or between
    delimiters that are never part of a term, counted over all rows."""
    flat = F.trim(field)
    # quoted values everywhere, and what stands between strong delimiters; only fields that have either
    whole = F.when(flat.rlike(r"[|;\t\r\n、，；]"), F.regexp_extract_all(flat, F.lit(rf"(?s){_item(_STRONG)}"), F.lit(0))).otherwise(F.regexp_extract_all(flat, F.lit(_QUOTED), F.lit(0)))
    values = fields.where(flat.rlike(r'["|;\t\r\n、，；]')).select(F.explode(whole).alias("v")).select(F.lower(F.btrim("v", F.lit(' "\t\r\n'))).alias("v")).where("v <> ''")
    tail = F.regexp_extract("v", r"(?<!\d),\s+(\p{L}[^,()\[\]\"]*)$", 1)
    counted = values.select(F.when(tail != "", tail).otherwise(F.col("v")).alias("word"), (tail != "").alias("after"))
    seen = cut(counted.groupBy("word").agg(F.count_if("after").alias("n"), F.count_if(~F.col("after")).alias("alone")))
    every = seen.agg(F.coalesce(F.sum(F.col("n") + F.col("alone")), F.lit(0)).alias("n")).head()["n"]
    kept = seen.where((F.col("n") >= max(LEAST_TAILS, TAIL_SHARE * every)) & (F.col("n") > F.col("alone")))
    return tuple(r["word"] for r in kept.orderBy(F.desc("n"), "word").select("word").toLocalIterator())


def resolve(skeletons: DataFrame, people: bool) -> DataFrame:
    """The rule of each distinct skeleton (`_skeleton`, `_rule`)."""
    return skeletons.distinct().mapInPandas(_resolve(people), "_skeleton string, _rule string")


def _values(field: Column, rule: Column, tails: tuple[str, ...]) -> Column:
    flat = F.trim(field)
    strong = F.regexp_extract_all(flat, F.lit(rf"(?s){_item(_STRONG)}"), F.lit(0))
    comma = F.regexp_extract_all(flat, F.lit(rf"(?s){_item(_comma(tails))}"), F.lit(0))
    person = F.split(flat, _PERSON)
    raw = F.when(rule == "strong", strong).when(rule == "comma", comma).when(rule == "person", person).otherwise(F.array(flat))
    unwrapped = F.transform(
        raw,
        lambda v: F.when(
            F.regexp_like(_strip(v), F.lit(r'(?s)^"(?:[^"]|"")*"$')),
            _strip(F.regexp_replace(F.regexp_replace(_strip(v), r'^"|"$', ""), '""', _Q)),
        ).otherwise(_strip(v)),
    )
    return F.filter(unwrapped, lambda v: v != "")


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s​﻿]+|[\s​﻿]+$", "")


def unpack(fields: DataFrame, *, field: str, people: bool = False, tails: tuple[str, ...] = KEPT_TAILS, out: str = "item_value", pos: str = "pos") -> DataFrame:
    """One row per value of column `field`, with its place `pos` among the field's non-empty values, counted from 1.

    The other columns of `fields` are kept, save those named like `pos` or `out` or beginning with an underscore, which
    go. A null or blank field, or one of delimiters alone, gives no row. Quotes that wrap a value go, doubled ones inside become
    single; quotes elsewhere and brackets belong to the value, as do delimiters within either. Repeated rows give
    repeated rows. Texts of any length are taken whole. A comma before `tails`, and before what `learn_tails` finds in
    `fields`, parts nothing; fields of `people` need neither.
    """
    ship(fields.sparkSession)
    if not people:
        tails = tuple(dict.fromkeys((*tails, *learn_tails(fields, field))))
    kept = [c for c in fields.columns if c != field and c.lower() not in (pos.lower(), out.lower()) and not c.startswith("_")]
    known = fields.select(*kept, field).where(F.col(field).isNotNull() & (_strip(F.col(field)) != "")).withColumn("_skeleton", skeleton(F.col(field), people, tails))
    rules = broadcast_if_small(cut(resolve(known.select("_skeleton"), people)), 200_000)
    values = known.join(rules, "_skeleton").select(*kept, _values(F.col(field), F.col("_rule"), tails).alias("_values"))
    return values.select(*kept, F.posexplode("_values").alias("_pos", out)).select(*kept, (F.col("_pos") + 1).cast("int").alias(pos), out)


def listed(fields: DataFrame, *, field: str, people: bool = False, tails: tuple[str, ...] = KEPT_TAILS, out: str = "item_values") -> DataFrame:
    """Every row of `fields` with the values of column `field` in order as array `out`, empty for a null or blank field.
    The values are those of `unpack`."""
    ship(fields.sparkSession)
    if not people:
        tails = tuple(dict.fromkeys((*tails, *learn_tails(fields, field))))
    known = fields.withColumn("_skeleton", F.when(_strip(F.col(field)) != "", skeleton(F.col(field), people, tails)))
    rules = broadcast_if_small(cut(resolve(known.where("_skeleton is not null").select("_skeleton"), people)), 200_000)
    values = F.when(F.col("_skeleton").isNotNull(), _values(F.col(field), F.col("_rule"), tails)).otherwise(F.array().cast("array<string>"))
    return known.join(rules, "_skeleton", "left").select(*fields.columns, values.alias(out))
