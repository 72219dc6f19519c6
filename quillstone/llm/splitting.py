"""Cutting oversized items at natural boundaries.

A text is a tree: sections (blank lines), lines and list items, sentences, clauses, words, characters. Packing goes
bottom-up: neighbouring subtrees are merged while they fit, and only a node over the limit is opened. Pieces then start
`overlap` characters before the cut, so consecutive ones share exactly that many.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import ship

from quillstone.llm.sentences import sentence_spans

_SECTION = regex.compile(r"\n[^\S\n]*\n\s*")
_LINE = regex.compile(r"\n(?=\s*(?:[-*•‣◦▪]|\(?\d{1,3}[.)]|\(?[a-z][.)]|#{1,6} )\s)|\n(?=\p{Lu}[\p{Lu} ]{3,40}:)")
_CLAUSE = regex.compile(r"[;:,](?=\s)\s*|[；：，、؛،]\s*|\s[–—]\s")
_WORD = regex.compile(r"\s+")
_CLUSTER = regex.compile(r"\X")


def _edges(kind: int, text: str, a: int, b: int) -> list[int]:
    """Ends of the children of the node [a, b) at level `kind`, the last being b."""
    if kind == 0:
        cuts = [m.end() for m in _SECTION.finditer(text, a, b)]
    elif kind == 1:
        cuts = [m.end() for m in _LINE.finditer(text, a, b)]
    elif kind == 2:
        part = text[a:b]
        cuts = [a + s for s, _ in sentence_spans(part)][1:]
    elif kind == 3:
        cuts = [m.end() for m in _CLAUSE.finditer(text, a, b)]
    elif kind == 4:
        cuts = [m.end() for m in _WORD.finditer(text, a, b)]
    else:
        cuts = [m.end() for m in _CLUSTER.finditer(text, a, b)]
    return [c for c in cuts if a < c < b] + [b]


def _units(text: str, a: int, b: int, room: int, kind: int) -> list[int]:
    """Ends of the packed units of the node [a, b), each unit at most `room` long."""
    if b - a <= room:
        return [b]
    if kind > 5:  # one cluster longer than a piece: cut it hard
        return [*range(a + room, b, room), b]
    out: list[int] = []
    start = at = a  # `start`: where the last unit of `out`, or the first one, begins
    for end in _edges(kind, text, a, b):
        for unit in _units(text, at, end, room, kind + 1):
            if out and unit - start <= room:
                out[-1] = unit  # siblings, or what an opened one leaves at its edge, merge while they fit
            else:
                start = out[-1] if out else a
                out.append(unit)
        at = end
    return out


def pieces(text: str, max_size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of `text`: each at most `max_size` long, each but the first beginning `overlap`
    characters before the end of the one before. A text within the limit is one piece."""
    if not 0 <= overlap < max_size:
        raise ValueError("overlap must be at least 0 and less than max_size")
    if len(text) <= max_size:
        return [(0, len(text))]
    ends = _units(text, 0, len(text), max_size - overlap, 0)
    while len(ends) > 1 and ends[0] <= overlap:
        del ends[0]  # too short to lend the next piece its overlap; the two fit one piece
    return [(max(0, (ends[i - 1] if i else 0) - overlap), end) for i, end in enumerate(ends)]


def _cut(keys: list[str], text: str, offset: str | None, max_size: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500].reset_index(drop=True)
                values = part[text].tolist()
                rows = [(r, no, a, b) for r, v in enumerate(values) for no, (a, b) in enumerate(pieces(v, max_size, overlap), 1)]
                if not rows:
                    continue
                idx, no, a, b = (list(x) for x in zip(*rows, strict=True))
                out = part[keys].iloc[idx].reset_index(drop=True)
                first = pd.Series(0, index=range(len(idx)), dtype="Int64") if offset is None else part[offset].astype("Int64").iloc[idx].reset_index(drop=True)
                starts = pd.array(a, dtype="Int64")
                yield out.assign(
                    piece_no=no,
                    start_char=a,
                    end_char=b,
                    source_offset=(first + starts).astype(object).where((first + starts).notna(), None),
                    piece_text=[values[r][x:y] for r, x, y in zip(idx, a, b, strict=True)],
                )

    return run


def split_oversized(rows: DataFrame, text: str, keys: list[str], max_size: int, overlap: int, offset: str | None = None) -> DataFrame:
    """The pieces of every `text` longer than `max_size` characters: `keys`, piece_no (from 1), start_char and end_char
    in the text, source_offset (start_char counted on from column `offset`; null where that is null) and piece_text.

    Texts within the limit, null and empty ones give no row. Items delivered twice are cut once. Cuts fall, in this
    order of choice, between sections, lines that begin a list item or heading, sentences, clauses, words and
    characters that can stand alone.
    """
    ship(rows.sparkSession)
    columns = [*keys, *([offset] if offset else [])]
    big = rows.select(*columns, F.col(text)).where(F.length(text) > max_size).distinct()
    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return big.mapInPandas(_cut(keys, text, offset, max_size, overlap), f"{fields}, piece_no int, start_char int, end_char int, source_offset int, piece_text string")
