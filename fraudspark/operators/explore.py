"""Exploratory tables: flag counts by dimension, reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fraudspark.functions.parsing import HASH_RANGE, named, row_hash


def flag_count(df: DataFrame, group: str, flag: str = "is_fraud") -> DataFrame:
    """(group, fraud_count) for the non-null groups."""
    return (
        df.where(named(group).isNotNull())
        .groupBy(named(group).alias(group))
        .agg(F.coalesce(F.sum(named(flag).cast("int")), F.lit(0)).alias("fraud_count"))
    )


def flag_count_by_dimension(df: DataFrame, dimensions: Sequence[str], flag: str = "is_fraud") -> DataFrame:
    """(dimension, value, fraud_count) for all dimensions in one scan.

    Grouping sets are summed per task before the shuffle, so only distinct
    values travel and a hot group costs one row per task.
    """
    dimensions = [d for d in dimensions if d in df.columns]
    keys = [named(d) for d in dimensions]
    sets = df.groupingSets([[k] for k in keys], *keys).agg(
        F.coalesce(F.sum(named(flag).cast("int")), F.lit(0)).alias("fraud_count"),
        *[F.grouping(d).alias(f"outside_{i}") for i, d in enumerate(dimensions)],
    )
    dimension, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dimensions):
        here = F.col(f"outside_{i}") == 0
        dimension = F.when(here, F.lit(d)).otherwise(dimension)
        value = F.when(here, named(d).cast("string")).otherwise(value)
    return sets.select(dimension.alias("dimension"), value.alias("value"), "fraud_count").where(
        F.col("value").isNotNull()
    )


def hash_sample(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    fraction: float = 0.05,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """About a ``fraction`` of the rows with all ``columns`` present, at every table size.

    A row is in or out by the hash of ``keys``, so the sample does not depend on files, partitions
    or retries; rows that share all keys are in or out together, so name keys that tell rows apart.
    """
    rows = df.na.drop(subset=list(columns))
    key = row_hash([named(c) for c in keys], seed, method)
    return rows.where(key < F.lit(fraction * HASH_RANGE)).select(*[named(c) for c in columns])
