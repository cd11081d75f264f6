"""Exact distinct counts that merge: words of bits over a dictionary of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.sources.scratch import staged


def dictionary(df: DataFrame, value: str, near: str) -> DataFrame:
    """``value`` and a ``code`` of its own for every distinct value but null.

    Values are dealt out in order of the least ``near`` that they occur with (a station, say), so that those that occur
    together have neighbouring codes and share words. Codes are given partition by partition, without a global count.
    """
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(near).alias("__near"))
    dealt = first.repartitionByRange("__near", value).sortWithinPartitions("__near", value)
    return staged(dealt.select(value, F.monotonically_increasing_id().alias("code")))


def extended(codes: DataFrame, df: DataFrame, value: str, near: str) -> DataFrame:
    """A dictionary with the values of ``df`` that it lacks; codes that were given stay, so that older states still merge."""
    new = dictionary(df.join(codes, value, "left_anti"), value, near)
    above = codes.agg((F.coalesce(F.max("code"), F.lit(-1)) + 1).alias("above"))
    return codes.unionByName(new.join(F.broadcast(above)).select(value, (F.col("code") + F.col("above")).alias("code")))  # one row


def distinct_state(df: DataFrame, codes: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """``keys, part, bits``: which codes occur with each key, as words of 64 codes each. Rows are combined before they are shuffled.

    A word is a number, so words are combined in place by hash; a key takes room for the words that it has codes in, however few.
    """
    coded = df.select(*keys, value).join(codes, value)
    bit = F.expr("shiftleft(1L, CAST(code & 63 AS INT))")
    return coded.groupBy(*keys, F.expr("shiftright(code, 6)").alias("part")).agg(F.bit_or(bit).alias("bits"))


def merge_distinct(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of finer keys, or of other batches, as states of ``keys``."""
    return states.groupBy(*keys, "part").agg(F.bit_or("bits").alias("bits"))


def finish_distinct(states: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The number of distinct values of each key."""
    return states.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("long")).alias(name))
