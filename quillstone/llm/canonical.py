"""Freely typed values mapped to a reference list.

A symmetric-delete dictionary of the reference names (each name with up to two characters left out, and the beginnings
of names with up to one left out) is broadcast; a typed value is looked up by its own deletes, so near names are found
without comparing against the list. Candidates are ranked by a weighted Damerau-Levenshtein distance, in which
look-alike and doubled letters cost little and digits much, then by how often the data use the name exactly.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import broadcast_if_small, cut, ship

from quillstone.llm.lookalike import tables

# Words that typists put around a name whatever the list; the others are learned from the data.
DECORATION = ("the", "of", "topical", "purified", "serum", "cream", "w")
#: A word that stands beside so many different names, unchanged, tells none of them apart: it is decoration.
LEAST_NAMES = 4
#: Such a word must be in at least this share of the values that hold a name and something else, which bounds the
#: number of learned words by the mean number of words beside a name over this share.
LEAST_SHARE = 0.0005
#: Names per broadcast dictionary (some 250 entries each); a longer list is looked up part by part.
SHARD_TERMS = 5_000
#: Distinct values that one task resolves.
VALUES_PER_TASK = 50_000
#: What look-alike letters and digits may add to the weighted distance of two edits.
SLACK = 0.65
#: The least that two edits cost: both exchanges of look-alike letters, or one of them something else.
TWO_ALIKE, TWO_EDITS = 1.0, 1.1

_SHARE = regex.compile(r"[(\[]?\d+(?:[.,]\d+)?[\s_\-/.]*[%％][)\]]?")
_NUMBERED = regex.compile(r"(\D+)\d+s?\Z")
_TOKENS = regex.compile(r"[^\W_]+")
_CUT_OFF = regex.compile(r"(?:\.\.|…|[^\W_]\.)\W*$")
_ALIKE = {frozenset(p) for p in ("1l", "1i", "li", "0o", "5s", "uv", "vw", "cs", "ck", "iy", "mn", "bd")}


@lru_cache(maxsize=1)
def _folding() -> dict[int, str]:
    one, several = tables()
    return str.maketrans(one | several)


def fold(text: str) -> str:
    """`text` in small letters of one script, without accents, invisible characters and double blanks."""
    if text.isascii():
        return " ".join(text.lower().split())
    flat = unicodedata.normalize("NFKD", text.translate(_folding()))
    flat = "".join(c for c in flat if not unicodedata.combining(c) and unicodedata.category(c) != "Cf")
    return " ".join(flat.casefold().split())


@lru_cache(maxsize=4096)
def _swap_cost(a: str, b: str) -> float:
    if frozenset((a, b)) in _ALIKE:
        return 0.5
    if a.isdigit() and b.isdigit():
        return 3.0
    return 1.5 if a.isdigit() or b.isdigit() else 1.0


def distance(a: str, b: str, bound: float = 99.0) -> float:
    """Weighted Damerau-Levenshtein distance (transposed letters may have edits between them), or more than `bound`."""
    if abs(len(a) - len(b)) * 0.6 > bound:
        return bound + 1
    # what both begin and end with costs nothing; one character of it stays, as doubled letters look one back
    same = 0
    most = min(len(a), len(b))
    while same < most and a[same] == b[same]:
        same += 1
    if same == len(a) == len(b):
        return 0.0
    head = max(0, same - 1)
    tail = 0
    while tail < most - same and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    tail = max(0, tail - 1)
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    n, m = len(a), len(b)
    grid = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        grid[i][0] = grid[i - 1][0] + (1.5 if a[i - 1].isdigit() else 1.0)
    for j in range(1, m + 1):
        grid[0][j] = grid[0][j - 1] + (1.5 if b[j - 1].isdigit() else 1.0)
    last_row: dict[str, int] = {}
    for i in range(1, n + 1):
        x, last_match, row, above = a[i - 1], 0, grid[i], grid[i - 1]
        drop = 0.6 if i > 1 and a[i - 2] == x else 1.5 if x.isdigit() else 1.0
        for j in range(1, m + 1):
            y = b[j - 1]
            add = 0.6 if j > 1 and b[j - 2] == y else 1.5 if y.isdigit() else 1.0
            cost = min(above[j] + drop, row[j - 1] + add, above[j - 1] + (0.0 if x == y else _swap_cost(x, y)))
            k = last_row.get(y, 0)
            if k and last_match and x != y:
                cost = min(cost, grid[k - 1][last_match - 1] + (i - k - 1) + 0.9 + (j - last_match - 1))
            if x == y:
                last_match = j
            row[j] = cost
        last_row[x] = i
        if min(row) > bound + 2:
            return bound + 1
    return grid[n][m]


_SHAPE = str.maketrans("l10", "iio")
#: Letters joined by a chain of look-alike pairs are one here.
_ALIKE_SHAPE = str.maketrans({"l": "i", "1": "i", "y": "i", "0": "o", "5": "s", "c": "s", "k": "s", "v": "u", "w": "u", "n": "m", "d": "b"})


def shape(text: str) -> str:
    """`text` with the letters and digits that look alike made one, as a key of the dictionary."""
    return text.translate(_SHAPE)


def deletes(text: str, most: int) -> set[str]:
    """`text` with 0 to `most` of its characters left out."""
    every = last = {text}
    if most == 2:  # each pair of places once
        n = len(text)
        return {text, *(text[:i] + text[i + 1 :] for i in range(n)), *(text[:i] + text[i + 1 : j] + text[j + 1 :] for i in range(n) for j in range(i + 1, n))}
    for _ in range(most):
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
        every = every | last
    return every


def _reach(length: int) -> int:
    """Edits allowed for a name of so many characters."""
    return 0 if length < 4 else 1 if length < 7 else 2


def units(tokens: list[str]) -> Iterator[str]:
    """The words among tokens beside a name; a number counts as '#' with the word before it."""
    before = ""
    for t in tokens:
        m = _NUMBERED.match(t)
        if m:
            yield m[1] + "#"
        elif t.isdigit():
            if before:
                yield before + "#"
        else:
            yield t
        before = t


@dataclass
class Lexicon:
    """The symmetric-delete dictionary of one kind of names."""

    names: dict[int, str]
    frequency: dict[int, int]
    decoration: tuple[str, ...] = DECORATION
    exact: dict[str, list[int]] = field(default_factory=dict)
    near: dict[str, list[str]] = field(default_factory=dict)
    begun: dict[str, list[str]] = field(default_factory=dict)
    begins: dict[str, list[int]] = field(default_factory=dict)
    alike: dict[str, list[str]] = field(default_factory=dict)
    common: dict[str, str] = field(default_factory=dict)

    def index(self, every_word: Iterable[str] | None = None) -> Lexicon:
        """The names by their letters run together. `every_word`: the words of the whole list, where this is a part."""
        self.exact = {}
        words: set[str] = set()
        for term, name in self.names.items():
            tokens = _TOKENS.findall(fold(name))
            words.update(tokens)
            self.exact.setdefault("".join(tokens), []).append(term)
        self._words = words if every_word is None else set(every_word)
        self._longest = max((len(f) for f in self.exact), default=0)
        self._judged: dict[str, bool] = {}
        return self

    def build(self, every_word: Iterable[str] | None = None) -> Lexicon:
        """The dictionary; building again gives the same."""
        self.index(every_word)
        near: dict[str, set[str]] = {}
        begun: dict[str, set[str]] = {}
        self.begins, self.alike = {}, {}
        for flat, terms in self.exact.items():
            self.alike.setdefault(flat.translate(_ALIKE_SHAPE), []).append(flat)
            for end in range(4, len(flat)):
                self.begins.setdefault(flat[:end], []).extend(terms)
            for d in deletes(shape(flat), _reach(len(flat))):
                near.setdefault(d, set()).add(flat)
        for start in self.begins:
            if len(start) >= 6:
                for d in deletes(start, 1):
                    begun.setdefault(d, set()).add(start)
        self.near = {k: sorted(v) for k, v in near.items()}
        self.begun = {k: sorted(v) for k, v in begun.items()}
        # a shortened word stands for the one word of the list that begins so, or has its consonants
        short: dict[str, set[str]] = {}
        for w in self._words:
            if len(w) > 3 and not w.isdigit():
                for end in range(2, len(w)):
                    short.setdefault(w[:end], set()).add(w)
                bare = w[0] + regex.sub("[aeiou]", "", w[1:])
                short.setdefault(bare[0] + bare[2:] if len(bare) > 3 else bare, set()).add(w)
        self.common = {k: next(iter(v)) for k, v in short.items() if len(v) == 1 and k not in self._words}
        return self

    def beside(self, typed: str) -> tuple[int, set[str]] | None:
        """(term, units) if a value holds a whole name and something else: the longest name, and what stands beside it."""
        tokens = _TOKENS.findall(_SHARE.sub(" ", fold(typed)))
        best: tuple[int, int, int] | None = None
        for i in range(len(tokens)):
            flat = ""
            for j in range(i, len(tokens)):
                flat += tokens[j]
                if len(flat) > self._longest:
                    break
                if flat in self.exact and (best is None or len(flat) > best[0]):
                    best = (len(flat), i, j + 1)
        if best is None or best[2] - best[1] == len(tokens):
            return None
        _, i, j = best
        rest = {*units(tokens[:i]), *units(tokens[j:])} - self._words
        return self.exact["".join(tokens[i:j])][0], rest

    def _decorates(self, token: str) -> bool:
        known = self._judged.get(token)
        if known is None:
            known = token in self.decoration
            if not known and token not in self._words and len(token) > 4:
                known = any(len(w) > 4 and abs(len(w) - len(token)) < 2 and distance(token, w, 1.0) <= 1.0 for w in self.decoration)
            if len(self._judged) > 200_000:
                self._judged.clear()
            self._judged[token] = known
        return known

    def _bare(self, tokens: list[str]) -> list[str]:
        """Tokens that decorate nothing."""
        # the number of "week 8" stands after the word, or first where the words are turned
        numbers = set()
        for i, t in enumerate(tokens):
            if t + "#" in self.decoration:
                numbers.add(i + 1 if i + 1 < len(tokens) and tokens[i + 1].isdigit() else 0)
        out: list[str] = []
        for i, t in enumerate(tokens):
            if i in numbers and t.isdigit() or (m := _NUMBERED.match(t)) is not None and m[1] + "#" in self.decoration:
                continue
            if not self._decorates(t):
                out.append(t)
        if len(out) == 1:  # decoration may run into the name
            t = out[0]
            out[0] = next((t[len(w) :] for w in self.decoration if len(w) > 2 and t.startswith(w) and len(t) - len(w) > 5), t)
        return out

    def _forms(self, typed: str) -> Iterator[tuple[str, float, bool]]:
        """Ways to read a typed value: (letters run together, penalty, whether cut off)."""
        text = fold(typed)
        cut_off = _CUT_OFF.search(text) is not None
        tokens = _TOKENS.findall(_SHARE.sub(" ", text))
        if not tokens:
            return
        bare = self._bare(tokens)
        bases = [(tokens, 0.0), (bare, 0.02)]
        if cut_off and len(bare) > 1 and any(w.startswith(bare[-1]) for w in self.decoration):
            bases.append((bare[:-1], 0.04))  # decoration cut off
        seen = set()
        for base, penalty in bases:
            # a reading longer than any name by more than the edits allowed can't be one, however its words are turned
            if sum(map(len, base)) > self._longest + 4:
                continue
            for whole in (base, [self.common.get(t, t) for t in base]):
                for turn in range(len(whole)):
                    flat = "".join(whole[turn:] + whole[:turn])
                    for form, extra in ((flat, 0.0), (flat[:-1] if flat.endswith("s") else flat, 0.05)):
                        if form and form not in seen:
                            seen.add(form)
                            yield form, penalty + extra + (0.1 if turn else 0.0), cut_off

    def resolve(self, typed: str) -> tuple[int, float]:
        """(term, distance) of the name that `typed` means; (-1, inf) if it means none."""
        best: tuple[float, int, int] | None = None
        forms: list[tuple[str, float, bool]] = []

        def offer(cost: float, terms: list[int]) -> None:
            nonlocal best
            for term in terms:
                key = (round(cost, 3), -self.frequency.get(term, 0), term)
                if best is None or key < best:
                    best = key

        def begun(edited: bool) -> None:
            for form, penalty, cut_off in forms:
                if len(form) < 4:
                    continue
                if form in self.begins:
                    if len(form) >= 5 or cut_off:
                        offer(0.3 + penalty, self.begins[form])
                elif edited and len(form) >= 6:
                    tried: set[str] = set()
                    for d in self.begun.keys() & deletes(form, 1):
                        for start in self.begun[d]:
                            if start not in tried:
                                tried.add(start)
                                got = distance(form, start, 1.0)
                                if got <= 1.0 and form[0] == start[0]:
                                    offer(0.6 + got + penalty, self.begins[start])

        for f in self._forms(typed):
            if len(f[0]) <= self._longest + 3:
                forms.append(f)
                if f[0] in self.exact:
                    offer(f[1], self.exact[f[0]])
                    if not f[1]:
                        break  # the value as it is: no other reading is as near
        checked: set[tuple[str, str]] = set()
        for most_left_out in (1, 2) if best is None else ():
            if best is not None and best[0] < TWO_EDITS:
                # nothing but two look-alike exchanges can be as near
                for form, penalty, _ in forms if best[0] >= TWO_ALIKE else ():
                    for flat in self.alike.get(form.translate(_ALIKE_SHAPE), ()):
                        if (form, flat) not in checked and len(form) == len(flat):
                            offer(distance(form, flat) + penalty, self.exact[flat])
                break
            if best is None and most_left_out == 2:
                # a value cut off is nearer to its name than two edits are
                begun(False)
                if best is not None:
                    break
            for form, penalty, _ in forms:
                reach = _reach(len(form))
                if most_left_out > reach:
                    continue
                for d in self.near.keys() & deletes(shape(form), most_left_out):
                    for flat in self.near[d]:
                        if (form, flat) not in checked:
                            checked.add((form, flat))
                            most = min(reach, _reach(len(flat))) + SLACK
                            got = distance(form, flat, most)
                            if got <= most:
                                offer(got + penalty, self.exact[flat])
        if best is None or best[0] > 1.2:
            begun(True)
        return (-1, float("inf")) if best is None else (best[2], best[0])


def _well_spelled(counts: dict[str, int]) -> set[str]:
    """Words without those that are one edit from a word ten times as frequent."""
    return {u for u, n in counts.items() if not (len(u) > 4 and any(m >= 10 * n and abs(len(w) - len(u)) < 2 and distance(u, w, 1.0) <= 1.0 for w, m in counts.items()))}


def _beside(lexicons, kind: str, value: str):
    """Words beside whole names: kind, term_id, unit, each once per batch and name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = lexicons.value
        for pdf in batches:
            rows = []
            for k, v in zip(pdf[kind], pdf[value], strict=True):
                got = ready[k].beside(v) if k in ready else None
                if got is not None:
                    rows.append((k, got[0], ""))
                    rows += ((k, got[0], u) for u in got[1])
            if rows:
                yield pd.DataFrame(rows, columns=["kind", "term_id", "unit"]).groupby(["kind", "term_id", "unit"], as_index=False).size().rename(columns={"size": "n"})

    return run


def _resolver(lexicons, kind: str, value: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = lexicons.value
        for pdf in batches:
            found = [ready[k].resolve(v) if k in ready else (-1, float("inf")) for k, v in zip(pdf[kind], pdf[value], strict=True)]
            used = [ready[k].frequency.get(t, 0) if t >= 0 and k in ready else 0 for k, (t, _) in zip(pdf[kind], found, strict=True)]
            yield pdf[[kind, value]].assign(_term=[t for t, _ in found], _cost=[c for _, c in found], _used=used)

    return run


def _shards(counted: DataFrame, size: int) -> Iterator[dict[str, Lexicon]]:
    """The list in parts of `size` names, read part by part."""
    shard: dict[str, Lexicon] = {}
    held = 0
    for row in counted.toLocalIterator():
        lexicon = shard.setdefault(row["kind"], Lexicon({}, {}))
        lexicon.names[row["term_id"]] = row["canonical_name"]
        lexicon.frequency[row["term_id"]] = row["n"]
        held += 1
        if held >= size:
            yield shard
            shard, held = {}, 0
    if held:
        yield shard


def map_to_list(rows: DataFrame, terms: DataFrame, *, kind: str, value: str, decoration: tuple[str, ...] = DECORATION, shard_terms: int = SHARD_TERMS, least_names: int = LEAST_NAMES) -> DataFrame:
    """`rows` whose `value` is neither null nor blank nor exactly a name of its `kind` in `terms` (term_id, kind,
    canonical_name), with term_id: the entry meant, or -1 if the value names none.

    Each distinct value is resolved once, whatever its length and number of words, and joined back. Words that stand
    beside at least `least_names` different whole names of a kind count as decoration, besides those of `decoration`.
    Between equal distances the name used exactly more often in `rows` wins, then the lower term_id. A null kind and
    null or blank values give no row; an empty list gives -1 throughout. Repeated rows stay. Columns of
    `rows` called term_id or cost, or beginning with an underscore, go.
    """
    rows = rows.select(*(c for c in rows.columns if c.lower() not in ("term_id", "cost") and not c.startswith("_")))
    ship(rows.sparkSession)
    sc = rows.sparkSession.sparkContext
    listed = terms.where(F.col("canonical_name").isNotNull() & F.col("term_id").isNotNull()).groupBy("kind", "canonical_name").agg(F.min("term_id").alias("term_id"))
    typed = rows.where(F.col(kind).isNotNull() & F.col(value).isNotNull() & (F.trim(F.regexp_replace(F.col(value), r"(?U)[\s​﻿]+", "")) != ""))
    # every distinct value once, with the name it is exactly, if any: a value that a third of all rows share is one row
    exact = broadcast_if_small(listed.select(F.col("kind").alias("_kind"), F.col("canonical_name").alias("_name"), F.col("term_id").alias("_exact")))
    values = typed.groupBy(kind, value).agg(F.count(F.lit(1)).alias("_n")).join(exact, (F.col(kind) == F.col("_kind")) & (F.col(value) == F.col("_name")), "left").select(kind, value, "_n", "_exact")
    values = cut(values)
    used = values.where("_exact is not null").groupBy(F.col("_exact").alias("term_id")).agg(F.sum("_n").alias("n"))
    counted = cut(listed.join(used, "term_id", "left").select("kind", "term_id", "canonical_name", F.coalesce("n", F.lit(0)).alias("n"))).orderBy("kind", "term_id")
    # the work is in the values, not in their bytes: tasks by number
    n_tasks = max(sc.defaultParallelism, -(-values.count() // VALUES_PER_TASK))
    free = values.where("_exact is null").select(kind, value).repartition(n_tasks, kind, value)
    n_terms = counted.count()
    words: dict[str, set[str]] = {}
    learned: dict[str, set[str]] = {}
    if n_terms > shard_terms:
        # shortened words are read over the whole list: its words, kept per kind
        for shard in _shards(counted, shard_terms):
            for k, lexicon in shard.items():
                words.setdefault(k, set()).update(w for name in lexicon.names.values() for w in _TOKENS.findall(fold(name)))
    schema = f"{_field(rows, kind)}, {_field(rows, value)}, _term int, _cost double, _used long"
    beside: list[DataFrame] = []
    for shard in _shards(counted, shard_terms):
        ready = sc.broadcast({k: lexicon.index(words.get(k)) for k, lexicon in shard.items()})
        beside.append(free.mapInPandas(_beside(ready, kind, value), "kind string, term_id int, unit string, n long"))
    if beside:
        seen = cut(reduce(DataFrame.unionByName, beside).groupBy("kind", "unit", "term_id").agg(F.sum("n").alias("n")).groupBy("kind", "unit").agg(F.count(F.lit(1)).alias("names"), F.sum("n").alias("n")))
        # at most (mean words beside a name) / LEAST_SHARE of them pass
        counts: dict[str, dict[str, int]] = {}
        for r in seen.where((F.col("unit") != "") & (F.col("names") >= least_names)).join(broadcast_if_small(seen.where("unit = ''").select("kind", F.col("n").alias("_all"))), "kind").where(F.col("n") >= F.col("_all") * LEAST_SHARE).toLocalIterator():
            counts.setdefault(r["kind"], {})[r["unit"]] = r["n"]
        learned = {k: _well_spelled(c) for k, c in counts.items()}
    parts: list[DataFrame] = []
    for shard in _shards(counted, shard_terms):
        for k, lexicon in shard.items():
            lexicon.decoration = tuple(sorted({*decoration, *learned.get(k, ())}))
            lexicon.build(words.get(k))
        parts.append(free.mapInPandas(_resolver(sc.broadcast(shard), kind, value), schema))
    if not parts:
        return typed.withColumn("term_id", F.lit(-1))
    if len(parts) == 1:
        found = parts[0].select(kind, value, "_term")
    else:
        # the nearest over all parts
        key = F.struct((F.col("_term") < 0).alias("a"), F.col("_cost").alias("b"), (-F.col("_used")).alias("c"), F.col("_term").alias("d"))
        found = reduce(DataFrame.unionByName, parts).groupBy(kind, value).agg(F.min(key)["d"].alias("_term"))
    found = broadcast_if_small(cut(found.select(F.col(kind).alias("_kind"), F.col(value).alias("_value"), "_term")))
    return typed.join(found, (F.col(kind) == F.col("_kind")) & (F.col(value) == F.col("_value"))).select(*rows.columns, F.col("_term").alias("term_id"))


def _field(rows: DataFrame, name: str) -> str:
    return f"`{name}` {rows.schema[name].dataType.simpleString()}"


def misses(mapped: DataFrame, kind: str, value: str) -> DataFrame:
    """The values that name nothing in the list, with the number of rows that hold them."""
    return mapped.where("term_id < 0").groupBy(F.col(kind).alias("kind"), F.col(value).alias("typed_value")).agg(F.count(F.lit(1)).alias("n_rows"))
