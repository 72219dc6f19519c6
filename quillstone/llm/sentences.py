"""Sentences of text in any script.

Breaks follow the sentence-break properties of Unicode (STerm, ATerm, Close, Sp, SContinue, Lower, OLetter), tailored
three ways: abbreviations, initials and ordinals suppress a break; quotes and brackets are matched first, so that what
they hold stays in the sentence around them; and text in scripts that mark sentences by blanks (Thai, Lao, Khmer,
Burmese) breaks at blanks. Offsets count code points.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import ship

# Words that a full stop abbreviates and that are always followed by more of the sentence.
_NEVER = frozenset(
    # titles
    "dr prof mr mrs ms mme mmes mlle hr fr frl st ste sr sra srta dra drs rev gen lt col sgt hon mgr ing dipl д-р проф акад г-н г-жа डॉ प्रो श्री د أ "
    # pointers and introductions
    "fig figs tab tabs tabl tbl app sect sec secs ch chap vol vols eq eqs ref refs suppl supp cf vs viz e.g i.e incl excl approx appr aprox ca "
    "pág págs núm art cap abb abschn kap vgl bzw rd evtl ggf sog bspw bsp env ex ej ee c.-à-d см рис табл стр гл ср напр ок им прим op "
    "z.b d.h u.a o.ä i.d.r s.o s.u v.a т.е т.к т.н т.д.".split()
)
# Abbreviations that go on only where a number follows.
_BEFORE_NUMBER = frozenset("no nos nr n° wk wks pts pt pp p temp temps lot grade g gr v ver т п стр пп".split())
# Abbreviations that may end a sentence too; before a small letter they go on.
_MAY_END = frozenset(
    "al etc inc ltd co corp bros min mins hr hrs h sec secs s yr yrs y mo mos wk wks d oz fl lb lbs ft sq cu tsp tbsp temp temps pt pts resp esp orig avg max est dept univ assoc spp sp subsp var "
    "jr sr cit ibid vol ed eds usw ggü uu ud uds cie av bd г гг др пр тыс млн млрд руб".split()
)
# Words that carry a sentence on after an ellipsis.
_LINKS = frozenset("and but or so then yet nor that which who und aber oder et mais ou y pero o и а но или".split())
# Words after which a German one- or two-digit number with a full stop is an ordinal.
_ORDINAL_AFTER = frozenset("am der die das dem den des im vom zum zur beim bis ab seit und ein eine einer einem jeder jede jedes ihr ihre sein seine".split())
# Words that begin a sentence even after an acronym or initial.
_STARTERS = frozenset("the a an in it we this these that those after at on for by but and no not most both did do does why what when where who how there they he she i as if all each".split())

_PAIRS = {"(": ")", "[": "]", "（": "）", "［": "］", "【": "】", "“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "《": "》", "〈": "〉", "‘": "’", "‚": "‘", '"': '"', "＂": "＂"}
_CLOSERS = {c for v in _PAIRS.values() for c in v}
_OPENED_BY = {c: tuple(o for o, v in _PAIRS.items() if c in v) for c in _CLOSERS}
_QUOTES = set("“„«‹「『《〈‘‚\"＂")
_MARK = regex.compile("[" + regex.escape("".join(sorted({*_PAIRS, *_CLOSERS}))) + "]")
_BLANK_LINE = regex.compile(r"\n[^\S\n]*\n| |\r\n[^\S\n]*\r\n")

_TERM = r"[\p{SB=STerm}\p{SB=ATerm}…⋯]+"
_SPACED = r"\p{Script=Thai}\p{Script=Lao}\p{Script=Khmer}\p{Script=Myanmar}"
_EVENT = regex.compile(rf"(?P<term>{_TERM})|(?P<gap>(?<=[{_SPACED}][\p{{M}}ๆฯ]*)\s+(?=\S))|(?P<para>\n[^\S\n]*\n\s*)")
_AFTER = regex.compile(r"[\"'”’»›)\]）］」』】》〉＂]*")
_CITATION = regex.compile(r"(?:\s?[\[［]\d[\d\s,;–—-]*[\]］])+(?=\s|$|[^\w])|(?:[¹²³⁰-⁹][¹²³⁰-⁹,–-]*)(?=\s|$)")
_BARE_CITATION = regex.compile(r"\d{1,3}(?:[,–-]\d{1,3})*(?=\s+[\p{Lu}“«„(]|\s*$)")
#: What a token can't hold: blanks and opening marks.
_EDGE_BEFORE = regex.compile(r"(?r)[\s(\[（“„«\"‘「『]")
_BLANK_BEFORE = regex.compile(r"(?r)\s")
_LETTER_BEFORE = regex.compile(r"(?r)\p{L}")
_CLOSING = regex.compile("[ \t\n\r  　\"'”’»›)）」』]*")
_NEXT_WORD = regex.compile(r"[\p{L}\p{M}]+")
_CONTINUES = regex.compile(r"[\p{SB=SContinue};,:،؛；：，、)\]）」』”»–—-]")
_ACRONYM_TAIL = regex.compile(r"(?:\.\p{L})*")
_INITIAL = regex.compile(r"(?:\p{Lu}\.?-)?\p{Lu}\Z")
_PARTICLE = regex.compile(r"(?:(?:van|von|de|del|della|di|da|du|des|la|le|den|der|ter|ten|dos) )+\p{Lu}\p{Ll}+|al-\p{Lu}|d['’]\p{Lu}")
_GLUED = regex.compile(r"\p{Lu}\p{L}*(?:[\s,.:;-]|$)")
_ADDRESS = regex.compile(r"www\.|://|@|\.\w{2,}/")
_NO_BLANKS = regex.compile(r"[\p{Script=Han}\p{Script=Hiragana}\p{Script=Katakana}\p{Script=Thai}\p{Script=Lao}\p{Script=Khmer}\p{Script=Hangul}]")
_OF_SPACED = regex.compile(rf"[{_SPACED}]")
_FOREIGN_RUN = regex.compile(rf"[^{_SPACED}]*")
_FULL_TERM = regex.compile(r"[。！？｡．؟۔।॥܀-܂։።፧‼⁇⁈⁉︒︖︕]")


def _pairs(text: str) -> list[tuple[int, int]]:
    """Outermost matched quotes and brackets, in order; none reaches over a blank line."""
    stack: list[tuple[str, int]] = []
    waiting: dict[str, list[int]] = {ch: [] for ch in _PAIRS}  # by opening mark, their places in the stack
    found: list[tuple[int, int]] = []
    limits = [m.start() for m in _BLANK_LINE.finditer(text)] if "\n" in text or " " in text else []
    block = 0
    for m in _MARK.finditer(text):
        ch, at = m.group(), m.start()
        if limits:
            now = bisect_right(limits, at)
            if now != block:
                stack.clear()
                for places in waiting.values():
                    places.clear()
                block = now
        if ch in "’'" and at + 1 < len(text) and text[at + 1].isalpha() and at and text[at - 1].isalpha():
            continue  # an apostrophe
        hit = max((waiting[o][-1] for o in _OPENED_BY[ch] if waiting[o]), default=None) if ch in _CLOSERS else None
        if hit is not None and not (ch == '"' and at and text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace() and len(stack) == 0):
            found.append((stack[hit][1], at))
            while len(stack) > hit:
                waiting[stack.pop()[0]].pop()
        elif ch in _PAIRS and not (ch == "‘" and at and text[at - 1].isalpha()):
            waiting[ch].append(len(stack))
            stack.append((ch, at))
    found.sort()
    outer: list[tuple[int, int]] = []
    for a, b in found:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


class _Before:
    """What stands before the stops of a text, asked for from left to right, in time linear in the text."""

    def __init__(self, text: str):
        self.text = text
        self._edge = self._blank = (0, 0)  # read up to; end of the last edge, of the last blank
        self._acronym = (-1, 0, True)  # start of a token, how far it was read, whether an acronym so far
        self._letter = (0, -1)  # read up to, last letter

    def token(self, start: int, dot: int) -> int:
        """Where the token that ends at `dot` begins, not before `start`; `dot` if there is none."""
        to, edge = self._edge if self._edge[0] <= dot else (0, 0)
        m = _EDGE_BEFORE.search(self.text, to, dot)
        if m:
            edge = m.end()
        self._edge = (dot, edge)
        return min(dot, max(start, edge))

    def word(self, start: int, at: int) -> tuple[int, int] | None:
        """The word that stands one character before the token at `at`."""
        if at <= start:
            return None
        end = at - 1
        to, blank = self._blank if self._blank[0] <= end else (0, 0)
        m = _BLANK_BEFORE.search(self.text, to, end)
        if m:
            blank = m.end()
        self._blank = (end, blank)
        begin = max(start, blank)
        return (begin, end) if begin < end else None

    def acronym(self, at: int, dot: int) -> bool:
        """Whether the token [at, dot) is letters with full stops between."""
        began, to, good = self._acronym
        if began != at or to > dot:
            to, good = at + 1, self.text[at].isalpha()
        if good and to < dot:
            good = _ACRONYM_TAIL.fullmatch(self.text, to, dot) is not None
        self._acronym = (at, max(to, dot), good)
        return good and dot - at > 2

    def cased(self, i: int) -> bool:
        """Whether the last letter before `i` belongs to a script with capitals; true if there is none."""
        to, last = self._letter
        if i < to:
            to, last = 0, -1
        m = _LETTER_BEFORE.search(self.text, to, i)
        if m:
            last = m.start()
        self._letter = (i, last)
        return last < 0 or self.text[last].islower() or self.text[last].isupper()


#: No listed abbreviation is longer.
_LONGEST = max(map(len, _NEVER | _BEFORE_NUMBER | _MAY_END))


def _suppressed(before: _Before, dot: int, start: int, nxt: int) -> bool:
    """Whether the full stop at `dot` abbreviates, with more of the sentence from `nxt`."""
    text = before.text
    at = before.token(start, dot)
    if at == dot:
        return False
    length = dot - at
    token = text[at:dot] if length <= _LONGEST else ""  # a longer one is no listed word, number or initial
    c = text[nxt]
    low = token.lower()
    word = _NEXT_WORD.match(text, nxt)
    starter = bool(word) and word.group().lower() in _STARTERS
    if low in _NEVER:
        return True
    acronym = before.acronym(at, dot)
    if c.islower() and (low in _MAY_END or low in _BEFORE_NUMBER or length == 1 and token.isalpha() or acronym):
        return True
    if low in _BEFORE_NUMBER and (c.isdigit() or c in "−-±<>="):
        return True
    if low == "al" and c in "([（" or low == "al" and c.isdigit():
        return True
    if token.isdigit():
        previous = before.word(start, at)
        if not text[start:at].strip():
            return length <= 3  # the number of a list item
        return length <= 2 and previous is not None and previous[1] - previous[0] <= _LONGEST and text[slice(*previous)].lower() in _ORDINAL_AFTER and c.isalnum()
    if acronym:
        return low.replace(".", "") in ("eg", "ie", "zb", "dh", "ua") or not starter and c.isalpha() and text[at:dot].isupper()
    if length == 1 and token.isalpha():
        previous = before.word(start, at)
        if previous and text[previous[1] - 1].isdigit():
            return False  # a unit
        if token.isupper():
            return not (starter and previous is not None and not text[previous[0]].isupper())
        return token != "í"
    return bool(_INITIAL.match(token)) and not starter


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence of `text` without the blanks around it, in order; none for null or blank text."""
    if not text or not text.strip():
        return []
    pairs = _pairs(text)
    opens = [a for a, _ in pairs]
    before = _Before(text)
    n = len(text)
    ends: list[int] = []
    start = 0

    def close(at: int) -> None:
        nonlocal start
        ends.append(at)
        start = at

    resume = 0
    for m in _EVENT.finditer(text):
        i, j = m.span()
        if i < resume or i < start:
            continue
        if j - i == 1 and text[i] == "." and i and j < n and "0" <= text[j] <= "9" and "0" <= text[i - 1] <= "9":
            continue  # inside a number
        k = bisect_right(opens, i) - 1
        pair = pairs[k] if k >= 0 and pairs[k][1] > i else None
        kind = m.lastgroup
        if kind == "para":
            if pair is None and not text[start:i].rstrip().endswith((":", "：")) and text[start:i].strip():
                close(i)
            continue
        if kind == "gap":
            if pair is None and _breaks_at_gap(text, start, i, j):
                close(i)
            continue
        term = m.group()
        quoted = False
        if pair is not None:
            if _CLOSING.match(text, j, pair[1]).end() < pair[1]:
                continue
            e, quoted = pair[1] + 1, text[pair[0]] in _QUOTES
            resume = e
            if not quoted and text[start : pair[0]].strip():
                continue  # a bracket inside a sentence
        else:
            e = _AFTER.match(text, j).end()
            quoted = any(c in "”’»›」』》〉\"＂“" for c in text[j:e])
            if e == j and term[-1] == "." and j - i == 1 and i and text[i - 1].islower() and (b := _BARE_CITATION.match(text, j)) and not text[max(start, i - 3) : i].isspace():
                if text[before.token(start, i) : i].isalpha():
                    e = b.end()
        if c := _CITATION.match(text, e):
            e = c.end()
        nxt = e
        while nxt < n and text[nxt].isspace():
            nxt += 1
        if nxt >= n:
            break
        gap = text[e:nxt]
        if gap and _BLANK_LINE.search(gap):
            close(e)
            continue
        ch = text[nxt]
        whole = _FULL_TERM.search(term) is not None
        dots = "…" in term or "⋯" in term or term.startswith("..")
        if _CONTINUES.match(text, nxt) and not (ch == "-" and gap) and not (ch in "–—" and gap and whole):
            if not (ch in "-−–—" and gap and nxt + 1 < n and text[nxt + 1].isdigit()):
                continue
        # after a quote a small letter goes on, save in names as "pH" and before surname particles
        lower = ch.islower() and not text[nxt + 1 : nxt + 2].isupper() and not _PARTICLE.match(text, nxt)
        own = pair is not None and not text[start : pair[0]].strip()
        if pair is not None and not quoted:
            close(e)  # a bracketed sentence of its own
        elif quoted:
            if not gap:
                if e > j and pair is None and whole and ch.isupper():
                    close(e)
                continue
            begins = ch.isupper() or ch.islower() and not lower or ch in _PAIRS or ch in "¿¡" or ch.isdigit() and before.cased(i)
            if lower and pair is not None and not own:
                # speech brought in by a colon, or begun before, ends with its last quote
                begins = text[start : pair[0]].rstrip().endswith((":", "：")) or text[start : pair[0]].lstrip()[:1] in _QUOTES
                lower = not begins
            if lower or own and not begins or pair is None and not begins and not whole:
                continue
            close(e)
        elif whole and not dots:
            close(e)
        elif dots:
            word = _NEXT_WORD.match(text, nxt, nxt + 8)
            if gap and not (word and word.group().lower() in _LINKS):
                close(e)
        elif not gap:
            if _NO_BLANKS.match(ch) and not (term[-1] == "." and text[i - 1 : i].isdigit() and ch.isdigit()):
                if term[-1] != "." or not _suppressed(before, j - 1, start, nxt):
                    close(e)
            elif ch.isupper() and i >= 3 and (c is not None or text[i - 1].islower() and text[i - 2].islower() or text[i - 1] in ")”" or term[-1] in "!?") and _GLUED.match(text, nxt) and not _ADDRESS.search(text, before.token(start, i), i):
                close(e)
        elif term[-1] in ".．․﹒" and len(term) == 1 and e == j and _suppressed(before, i, start, nxt):
            continue
        else:
            close(e)
    ends.append(n)
    spans = []
    at = 0
    for end in ends:
        piece = text[at:end]
        left = len(piece) - len(piece.lstrip())
        if piece.strip():
            spans.append((at + left, at + len(piece.rstrip())))
        at = end
    return spans


def _breaks_at_gap(text: str, start: int, i: int, j: int) -> bool:
    """Whether the blanks [i, j) after a letter of a script that marks sentences by blanks end one."""
    if not text[start:i].strip():
        return False
    if _OF_SPACED.match(text, j):
        return True
    run = _FOREIGN_RUN.match(text, j).group()
    return len(run.split()) >= 4 or regex.search(r"[.!?。！？](?:\s|$|[”\"»)])", run) is not None


def _spans(keep: list[str], text: str, once: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if once:  # copies that come together are split once
                pdf = pdf.drop_duplicates(once, ignore_index=True)
            found = [sentence_spans(value) for value in pdf[text]]
            yield pdf[keep].assign(_starts=[np.array([a for a, _ in f], np.int32) for f in found], _ends=[np.array([b for _, b in f], np.int32) for f in found])

    return run


def _with_spans(rows: DataFrame, text: str, keep: list[str], once: list[str]) -> DataFrame:
    ship(rows.sparkSession)
    known = rows.where(F.col(text).isNotNull() & (F.trim(text) != ""))
    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep)
    return known.select(*dict.fromkeys([*keep, text])).mapInPandas(_spans(keep, text, once), f"{fields}, _starts array<int>, _ends array<int>")


def _each(spans: DataFrame, *columns: str) -> DataFrame:
    zipped = F.zip_with("_starts", "_ends", lambda a, b: F.struct(a.alias("start_char"), b.alias("end_char")))
    return spans.select(*columns, F.posexplode(zipped).alias("_no", "_s")).select(*columns, (F.col("_no") + 1).alias("sentence_no"), "_s.start_char", "_s.end_char")


def sentence_offsets(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Distinct `keys`, sentence_no (from 1), start_char and end_char (exclusive) of every sentence of column `text`.

    Null and blank texts give no row. Texts of any length are taken whole; none is shuffled, only keys and offsets are,
    once, one row per text. Other columns are ignored, whatever their names.
    """
    once = _with_spans(rows, text, keys, [*keys, text]).repartition(*keys).distinct()
    return _each(once, *keys).distinct()  # in place: the rows are by key already


def sentences(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """`keys`, sentence_no (from 1), start_char, end_char (exclusive) and sentence of every sentence of column `text`.

    Null and blank texts give no row. Repeated rows are split once, for which texts are shuffled; `sentence_offsets`
    goes without. Texts of any length are taken whole. Other columns are ignored, whatever their names.
    """
    once = rows.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(text).alias("_text")).distinct()
    names = [f"_k{i}" for i in range(len(keys))]
    each = _each(_with_spans(once, "_text", [*names, "_text"], []), *names, "_text")
    return each.select(*(F.col(n).alias(k) for n, k in zip(names, keys, strict=True)), "sentence_no", "start_char", "end_char", F.substring("_text", F.col("start_char") + 1, F.col("end_char") - F.col("start_char")).alias("sentence"))
