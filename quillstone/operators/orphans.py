"""References to records that do not exist.

References are first reduced to one row per key referred to, with how often and how early it is, so a key that holds a
third of all rows is one row per task. A blocked Bloom filter of the parent keys, kept as rows of 1,024 64-bit words,
is joined to them by the number of the row: broadcast while it is small, by a shuffle of both beyond that. A key whose
bits are not all set is an orphan for certain; only the others go through the exact join with one summary row per
parent key. What is left, the keys that do not hold for some row, is joined back to the rows: keys referred to very
often, of which there can only be few, by a broadcast, the others by a broadcast or a shuffle that no such key enters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.runtime import BROADCAST_ROWS, cut

#: Blank characters that may surround a key.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
#: A filter of more 64-bit words is joined by a shuffle; up to 2^23 of them are 64 MB in each executor.
MAX_BLOCKS = 1 << 23
#: Words to a row of the filter.
ROW_WORDS = 1024
#: A key that more than one in so many references name is often named: there are at most so many of them.
OFTEN = 1_000


def tidy_key(key: Column) -> Column:
    """`key` as text in lower case without blanks around it."""
    return F.lower(F.btrim(key.cast("string"), F.lit(BLANKS)))


@dataclass(frozen=True)
class Reference:
    """One reference field of one table to the key of another."""

    map_table: str
    field_name: str
    parent_key: str


def _place(key: str, n_words: int) -> tuple[Column, Column, Column]:
    """Row of the filter, word in it and bits of a key."""
    word = f"pmod(xxhash64({key}), {n_words}L)"
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 'bits'), {6 * i}) & 63 as int))" for i in range(4))
    return F.expr(f"{word} div {ROW_WORDS}L"), F.expr(f"cast({word} % {ROW_WORDS}L as int)"), F.expr(bits)


def bloom_blocks(keys: DataFrame, key: str, n_keys: int, bits_per_key: int = 20) -> tuple[DataFrame, int]:
    """The filter of column `key` as rows (`_row`, `_words`: array of 1,024 words, fewer in a small filter), and its number of words."""
    n_words = 1 << (max(64, n_keys * bits_per_key // 64) - 1).bit_length()
    row, at, bits = _place(key, n_words)
    zero = keys.sparkSession.range(n_words).select(F.expr(f"id div {ROW_WORDS}L").alias("_row"), F.expr(f"cast(id % {ROW_WORDS}L as int)").alias("_at"), F.lit(0).cast("long").alias("_bits"))
    words = keys.select(row.alias("_row"), at.alias("_at"), bits.alias("_bits")).unionByName(zero).groupBy("_row", "_at").agg(F.bit_or("_bits").alias("_bits"))
    packed = words.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "_bits"))).alias("_words"))
    return packed.select("_row", F.col("_words._bits").alias("_words")), n_words


def find_orphans(
    refs: DataFrame,
    parents: DataFrame,
    reference: Reference,
    *,
    record_key: str = "claim_key",
    created: str = "created_at",
    active: str = "is_active",
    bits_per_key: int = 20,
    max_blocks: int = MAX_BLOCKS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Distinct references of `refs` that do not hold: map_table, field_name, claim_key, ref_value, period_month, reason.

    `reason` is 'missing' if no parent has the key, 'deleted' if the newest parent row is not active, 'late' if the
    oldest parent row was created after the referring row. Keys are compared without blanks around them and in lower
    case. Null references, null record keys and blank ones are no cases. Null `created_at`: of a parent, the row counts
    as its oldest version and never as a late one; of a reference, the period is null and it can't be late. A null
    `is_active` counts as active; of rows created at the same time an active one decides. An empty parent table makes
    every reference missing. Other columns are ignored, whatever their names.
    """
    rows = refs.select(
        tidy_key(F.col(record_key)).alias("claim_key"),
        tidy_key(F.col(reference.field_name)).alias("ref_value"),
        F.date_format(F.col(created), "yyyy-MM").alias("period_month"),
        F.col(created).alias("_created"),
    ).where((F.col("claim_key") != "") & (F.col("ref_value") != ""))
    named = rows.groupBy("ref_value").agg(F.min("_created").alias("_first"), F.count(F.lit(1)).alias("_n"))
    keyed = parents.select(tidy_key(F.col(reference.parent_key)).alias("_key"), F.col(created).alias("_at"), F.coalesce(F.col(active), F.lit(True)).alias("_active")).where(F.col("_key").isNotNull() & (F.col("_key") != ""))
    summary = keyed.groupBy("_key").agg(
        F.max(F.struct(F.col("_at").isNotNull().alias("dated"), F.col("_at").alias("at"), F.col("_active").alias("active")))["active"].alias("_active"),
        F.min("_at").alias("_oldest"),
    )
    bloom, n_words = bloom_blocks(keyed.select("_key"), "_key", parents.count(), bits_per_key)
    row, at, bits = _place("ref_value", n_words)
    tested = named.withColumns({"_row": row, "_at": at, "_bits": bits}).join(F.broadcast(bloom) if n_words <= max_blocks else bloom, "_row", "left")
    maybe = F.coalesce(F.get("_words", F.col("_at")).bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    tested = tested.select("ref_value", "_first", "_n", maybe.alias("_maybe"))
    # `_wrong`: the reason where it holds for every row of the key; null where rows before `_oldest` are late
    certain = tested.where(~F.col("_maybe")).select("ref_value", "_n", F.lit("missing").alias("_wrong"), F.lit(None).cast("timestamp").alias("_oldest"))
    wrong = F.when(F.col("_key").isNull(), "missing").when(~F.col("_active"), "deleted")
    exact = tested.where("_maybe").join(summary, F.col("ref_value") == F.col("_key"), "left").withColumn("_wrong", wrong).where(F.col("_wrong").isNotNull() | (F.col("_oldest") > F.col("_first")))
    bad = cut(certain.unionByName(exact.select("ref_value", "_n", "_wrong", F.col("_oldest").cast("timestamp"))))
    n_bad = bad.count()
    if n_bad <= broadcast_rows:
        parts = [rows.join(F.broadcast(bad), "ref_value")]
    else:
        often = cut(named.where(F.col("_n") * OFTEN > refs.count()).select("ref_value"))  # fewer than OFTEN rows
        parts = [
            rows.join(F.broadcast(bad.join(F.broadcast(often), "ref_value", "left_semi")), "ref_value"),
            rows.join(F.broadcast(often), "ref_value", "left_anti").join(bad.join(F.broadcast(often), "ref_value", "left_anti"), "ref_value"),
        ]
    reason = F.coalesce("_wrong", F.when(F.col("_oldest") > F.col("_created"), "late"))
    parts = [p.select("claim_key", "ref_value", "period_month", reason.alias("reason")).where("reason is not null").distinct() for p in parts]
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        F.lit(reference.map_table).alias("map_table"),
        F.lit(reference.field_name).alias("field_name"),
        "claim_key",
        "ref_value",
        "period_month",
        "reason",
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Distinct references that do not hold, counted per map table, field, month and reason."""
    return orphans.groupBy("map_table", "field_name", "period_month", "reason").agg(F.count(F.lit(1)).alias("n_references"))
