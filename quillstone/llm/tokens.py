"""Sizes of texts in tokens of a public tokenizer, whose files stay where they are."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import ship

#: Folder of the rank files; a parameter of every operator that counts tokens.
TOKENIZERS = os.environ.get("QUILLSTONE_TOKENIZERS", "/opt/tokenizers")
RANKS = "byte_bpe_multi_50k.tiktoken"
#: The split pattern the rank files were made with; a fixed value of theirs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(folder: str = TOKENIZERS, ranks: str = RANKS):
    import tiktoken

    with open(os.path.join(folder, ranks), "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def _count(text: str, keep: list[str], out: str, folder: str, ranks: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(folder, ranks)
        for pdf in batches:
            yield pdf[keep].assign(**{out: [None if t is None else len(enc.encode_ordinary(t)) for t in pdf[text]]}).astype({out: "Int32"})

    return run


def with_tokens(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "n_tokens", folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """Columns `keep` of `docs` with the number of tokens of each whole text; null for a null text, 0 for an empty one."""
    ship(docs.sparkSession)
    keep = [c for c in (keep if keep is not None else docs.columns) if c.lower() != out.lower()]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInPandas(_count(text, keep, out, folder, ranks), f"{fields}, `{out}` int")


def spread(key: str, blocks: int):
    """A block number for each key, even whatever the keys' own pattern."""
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks)).cast("int")
