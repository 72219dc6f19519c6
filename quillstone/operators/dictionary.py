"""Names of a list found in texts, however long the list is.

A list of up to `PATTERN_ENTRIES` becomes one pattern that shares beginnings and stays in the JVM. A longer one is read
in parts; each becomes an automaton, made once and broadcast, that a text is run through once. What the parts find is
brought together per text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import lexicon as L
from quillstone.functions import text as T
from quillstone.runtime import cut, ship

#: Entries that one pattern holds.
PATTERN_ENTRIES = 20_000
#: Entries of one automaton, some hundred bytes each in every worker.
AUTOMATON_ENTRIES = 200_000

_HIT = "struct<start:int,n:int,alias:string,name:string>"
_FOUND = "array<struct<alias:string,name:string>>"


def _inside(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _search(automaton, keep: Sequence[str], text: str, out: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = automaton.value
        for pdf in batches:
            found = []
            for t in pdf[text]:
                hits = []
                for last, (alias, name) in look.iter(t) if t else ():
                    first = last - len(alias) + 1
                    if (first == 0 or not _inside(t[first - 1])) and (last + 1 == len(t) or not _inside(t[last + 1])):
                        hits.append({"start": first, "n": -len(alias), "alias": alias, "name": name})
                found.append(hits)
            yield pdf[list(keep)].assign(**{out: found})

    return run


def _apart(hits: Column) -> Column:
    """Of what was found the leftmost, the longest at a place, none inside or over another."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        one = F.array(F.struct(x["alias"].alias("alias"), x["name"].alias("name"))).cast(_FOUND)
        return F.when(x["start"] >= acc["at"], F.struct((x["start"] - x["n"]).alias("at"), F.concat(acc["kept"], one).alias("kept"))).otherwise(acc)

    return F.aggregate(F.array_sort(hits), none, step, lambda acc: acc["kept"])


def find_entries(rows: DataFrame, text: str, entries: DataFrame, out: str = "found", pattern_entries: int = PATTERN_ENTRIES, automaton_entries: int = AUTOMATON_ENTRIES) -> DataFrame:
    """`rows` with `out`: array<struct<alias, name>> of the entries (alias in small letters, name) that stand in column
    `text` as whole words, from left to right, the longest at a place, none over another; the same by either way.

    A null text and an empty list give empty arrays; blank aliases are none; of several names of an alias the greatest
    counts. A column of `rows` called as `out`, or beginning with an underscore, goes.
    """
    rows = rows.select(*(c for c in rows.columns if c.lower() != out.lower() and not c.startswith("_")))
    once = cut(entries.where(F.trim("alias") != "").groupBy("alias").agg(F.max("name").alias("name")))
    if once.count() <= pattern_entries:
        table = {r["alias"]: r["name"] for r in once.orderBy("alias").toLocalIterator()}
        name = L.lookup(table, "string")
        hits = F.coalesce(L.alias_matches(F.col(text), table), F.array().cast("array<string>"))
        return rows.withColumn(out, F.transform(hits, lambda a: F.struct(a.alias("alias"), name(a).alias("name"))).cast(_FOUND))
    import ahocorasick

    ship(rows.sparkSession)
    sc = rows.sparkSession.sparkContext
    result = rows.withColumns({"_low": F.lower(text), "_all": F.array().cast(f"array<{_HIT}>")})

    def look(result: DataFrame, automaton) -> DataFrame:
        automaton.make_automaton()
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema.fields)
        more = result.mapInPandas(_search(sc.broadcast(automaton), result.columns, "_low", "_new"), f"{fields}, _new array<{_HIT}>")
        return more.withColumn("_all", F.concat("_all", "_new")).drop("_new")

    part, held = ahocorasick.Automaton(), 0
    for r in once.orderBy("alias").toLocalIterator():
        part.add_word(r["alias"], (r["alias"], r["name"]))
        held += 1
        if held >= automaton_entries:
            result = look(result, part)
            part, held = ahocorasick.Automaton(), 0
    if held:
        result = look(result, part)
    return result.select(*rows.columns, _apart(F.col("_all")).alias(out))


def subject_of(text: Column, found: Column, prefixes: Sequence[str] = L.PREFIX_PATTERNS) -> Column:
    """The name a text is about, from what was found in it: the one it begins with, after a heading and at most one of
    the prefix patterns, else that of the longest alias; null for none."""
    bare = F.lower(T.strip_heading(text))
    rest = F.regexp_replace(bare, f"^(?:{'|'.join(prefixes)})", "") if prefixes else bare
    first = F.get(found, F.lit(0))
    front = F.when(bare.startswith(first["alias"]) | rest.startswith(first["alias"]), first["name"])
    best = F.array_min(F.transform(found, lambda x: F.struct((-F.length(x["alias"])).alias("n"), x["alias"].alias("alias"), x["name"].alias("name"))))["name"]
    return F.coalesce(front, best)
