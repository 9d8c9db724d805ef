"""Membership bitmaps of a key column, and joins that shuffle only what a bitmap lets through.

A bitmap is an array of 64-bit words, made by an aggregate over (word, bit) of the keys'
hashes and sized by the measured number of keys, up to ``MOST_BITS``: beyond, it only lets
more through. What it rejects is certainly not among the keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, and bits of a bitmap at most (8 MB).
BITS_A_KEY = 16
MOST_BITS = 1 << 26


def _bit(key: Column, words: int) -> tuple[Column, Column]:
    h = F.pmod(F.xxhash64(key), F.lit(words * 64))
    return F.shiftright(h, 6).cast("int"), F.pmod(h, F.lit(64)).cast("int")


class Bitmap:
    """Bitmap of the non-null values of a column."""

    def __init__(self, keys: DataFrame, key: str):
        keys = keys.where(F.col(key).isNotNull())
        bits = min(MOST_BITS, max(64, keys.count() * BITS_A_KEY))
        self.words = 1 << math.ceil(math.log2(bits / 64))
        word, bit = _bit(F.col(key), self.words)
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        held = keys.select(word.alias("word"), one.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        every = keys.sparkSession.range(self.words).select(F.col("id").cast("int").alias("word"))
        filled = every.join(held, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
        # at most MOST_BITS / 64 words, whatever the number of keys
        self.frame = filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))

    def may_hold(self, key: Column) -> Column:
        """False only for keys that are certainly not in the bitmap (null is not)."""
        word, bit = _bit(key, self.words)
        return key.isNotNull() & (F.getbit(F.element_at(self.frame.scalar(), word + 1), bit) == 1)


def anti_join(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``keys`` (a null key is in none): the exact left anti join, of
    which only the rows that the bitmap lets through are shuffled."""
    known = Bitmap(keys.select(key), key)
    maybe = known.may_hold(F.col(key))
    return rows.where(~maybe).unionByName(rows.where(maybe).join(keys.select(key), key, "left_anti").select(*rows.columns))


def semi_join(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys``: the exact left semi join, of rows the bitmap lets through."""
    known = Bitmap(keys.select(key), key)
    return rows.where(known.may_hold(F.col(key))).join(keys.select(key), key, "left_semi").select(*rows.columns)
