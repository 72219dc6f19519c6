"""Claim extraction by a model behind a cache.

Sentences are reduced to distinct cache keys before the model is asked, answered ones are taken from the cache table,
and only the rest passes through the extractor, once; the new answers are kept before anything reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import cut, ship

RESPONSE = "struct<claims:array<struct<ingredient:string,claim_type:string,relation:string,target:string,target_category:string,evidence_direction:string,evidence_text:string,study_context:string,hedging:boolean,negation:boolean,confidence:double>>>"
#: Phrases that rule a claimed target out.
BLOCKED_TARGETS = ("carcinoma", "cancer", "tumor", "tumour", "microemulsion", "nanoemulsion", "particle size", "release profile", "drug delivery", "cell migration", "dermal papilla", "gene expression", "therapy", "treatment", "blood loss", "perioperative")


def cache_key(model: str, prompt: str, schema: str, question: Column) -> Column:
    return F.sha2(F.concat_ws("\n", F.lit(model), F.lit(prompt), F.lit(schema), question), 256)


def claims_of(response: Column, blocked: Sequence[str] = BLOCKED_TARGETS) -> Column:
    """The claims in a response text; none for text that isn't a list of them. Claims on blocked targets go."""
    found = F.coalesce(F.from_json(response, RESPONSE)["claims"], F.from_json(F.lit('{"claims":[]}'), RESPONSE)["claims"])
    return F.filter(found, lambda c: c.isNotNull() & ~F.coalesce(F.lower(c["target"]).rlike("|".join(blocked)), F.lit(False)))


def _ask(extract: Callable[[list[str]], list[str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"cache_key": pdf["cache_key"], "response": extract(pdf["question"].tolist())})

    return run


def extract_cached(questions: DataFrame, cache: DataFrame, extract: Callable[[list[str]], list[str]], *, question: str, model: str, prompt: str, schema: str = RESPONSE) -> tuple[DataFrame, DataFrame]:
    """(`questions` with cache_key and response, the new answers to add to the cache: cache_key, response).

    Null questions get no response. A question asked many times is asked once.
    """
    ship(questions.sparkSession)
    keyed = questions.withColumn("cache_key", F.when(F.col(question).isNotNull(), cache_key(model, prompt, schema, F.col(question))))
    known = cache.groupBy("cache_key").agg(F.max("response").alias("response"))
    distinct = keyed.where("cache_key is not null").groupBy("cache_key").agg(F.first(question).alias("question"))
    fresh = cut(distinct.join(known, "cache_key", "left_anti").mapInPandas(_ask(extract), "cache_key string, response string"))
    return keyed.join(known.unionByName(fresh), "cache_key", "left"), fresh
