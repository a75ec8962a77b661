"""Column expressions for dirty text: null words, timestamps, booleans, numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The words that stand for a missing value.
NULL_TOKENS = (
    "", "NA", "N/A", "#N/A", "#N/A N/A", "#NA", "<NA>", "NAN", "-NAN", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
    "NULL", "NONE",
)

# Fixed value: the compact ISO 8601 form the default timestamp parser does not read.
COMPACT_TIMESTAMP = "yyyyMMdd'T'HHmmss"


def named(name: str) -> Column:
    """Column reference that is safe for names with spaces, dots or quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_token(column: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~F.upper(F.trim(column)).isin(*tokens), column)


def parse_timestamp(column: Column) -> Column:
    """ISO-like text to a timestamp; null words and junk give null.

    Text with an offset or Z is that instant, text without is read as UTC, in every session zone.
    """
    return timestamp_of(timestamp_text(column))


def timestamp_text(column: Column) -> Column:
    """The trimmed text, null words as null; hours and minutes alone get their seconds."""
    text = F.trim(null_if_token(column.cast("string")))
    return F.regexp_replace(text, r"(?i)([T ]\d{1,2}:\d{1,2})(?=(\s*(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?))?$)", "$1:00")


def timestamp_of(text: Column) -> Column:
    """What ``timestamp_text`` gives as a timestamp; the text is used several times."""
    zoned = text.rlike(r"(?i)\d:\d+(:\d+)?(\.\d+)?\s*(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?)$")
    whole = (
        F.when(zoned, text)
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"^\d{4}-\d{1,2}$"), F.concat(text, F.lit("-01T00:00:00Z")))
        .when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    compact = F.concat(F.regexp_replace(text, "(?i)z$", ""), F.lit("+0000"))
    return F.coalesce(F.try_to_timestamp(whole), F.try_to_timestamp(compact, F.lit(COMPACT_TIMESTAMP + "xx")))


def parse_boolean(column: Column) -> Column:
    """true/false words in any case, 1 and 0; anything else that is no boolean gives null."""
    text = F.upper(column.cast("string"))
    return (
        F.when(text.isin("TRUE", "1"), F.lit(True))
        .when(text.isin("FALSE", "0"), F.lit(False))
        .otherwise(column.try_cast("boolean"))
    )


def row_hash(columns: Iterable[Column], seed: int, method: str = "xxhash64") -> Column:
    """Evenly spread, seeded non-negative 32-bit hash of a row, the same under any partitioning."""
    columns = list(columns)
    if method == "xxhash64":
        return F.xxhash64(*columns, F.lit(seed)).bitwiseAND(F.lit(0xFFFFFFFF))
    if method == "md5":
        text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    raise ValueError(f"unknown hash method: {method}")


HASH_RANGE = float(1 << 32)
