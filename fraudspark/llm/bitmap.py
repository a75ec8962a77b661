"""A bitmap of hashes as a small table: thins out rows before they are shuffled to a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18  # of 64 bits; the table has at most so many rows, so it may be broadcast


def maybe_in(rows: DataFrame, column: str, wanted: DataFrame, wanted_column: str) -> DataFrame:
    """The rows whose hash may be among the wanted ones: all that are, and few others.

    With far more than 64 x WORDS wanted hashes nearly all rows pass, and only the join behind decides.
    """
    word = lambda c: F.pmod(F.col(c), F.lit(WORDS)).cast("int")
    bit = lambda c: F.shiftrightunsigned(F.col(c), 18).bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit(wanted_column))
    table = wanted.groupBy(word(wanted_column).alias("__word")).agg(F.bit_or(one).alias("__bits"))
    met = rows.withColumn("__word", word(column)).join(F.broadcast(table), "__word")
    return met.where(F.getbit("__bits", bit(column)) == 1).drop("__word", "__bits")
