"""Profiles of a table: describe, schema, null counts, preview."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from fraudspark.functions.parsing import named
from fraudspark.operators.quantiles import exact_quantiles, number

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 5) -> DataFrame:
    """(column, statistic, value): count, mean, std, min, exact quartiles, max of numeric columns.

    Takes a few passes; write the numeric columns first when ``df`` is costly to read again.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    basics = []
    for i, c in enumerate(columns):
        v = number(c)
        basics += [
            F.count(v).alias(f"count{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    rows = []
    if columns:
        stats = df.agg(*basics).first()
        quartiles = exact_quantiles(df, columns, list(QUARTILES.values()))
        for i, c in enumerate(columns):
            values = {name: stats[f"{name}{i}"] for name in ("count", "mean", "std", "min")}
            values.update(zip(QUARTILES, quartiles[c]))
            values["max"] = stats[f"max{i}"]
            rows += [(c, name, None if v is None else float(v)) for name, v in values.items()]
    report = df.sparkSession.createDataFrame(rows, "column string, statistic string, value double")
    return report.withColumn("value", F.round("value", digits))


def _per_column(df: DataFrame, columns: Sequence[str], counts: dict[str, list], extra: dict[str, list]) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    names = list(counts)
    wide = df.agg(*[e.alias(f"{name}{i}") for name in names for i, e in enumerate(counts[name])])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.lit(values[i]).alias(name) for name, values in extra.items()],
            *[F.col(f"{name}{i}").alias(name) for name in names],
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*cells)))


def schema_info(df: DataFrame) -> DataFrame:
    """(column, type, non_null), in one pass."""
    types = dict(df.dtypes)
    columns = df.columns
    return _per_column(
        df,
        columns,
        {"non_null": [F.count(named(c)) for c in columns]},
        {"type": [types[c] for c in columns]},
    )


def observed_schema_info(df: DataFrame, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What ``write`` returns, and ``schema_info`` of it, counted while the rows were written."""
    types, seen = dict(df.dtypes), Observation()
    counts = [F.count(named(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    written = write(df.observe(seen, *counts))
    rows = [(c, types[c], seen.get[f"n{i}"]) for i, c in enumerate(df.columns)]
    return written, df.sparkSession.createDataFrame(rows, "column string, type string, non_null long")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls), in one pass."""
    columns = list(columns) if columns is not None else df.columns
    return _per_column(df, columns, {"nulls": [F.count_if(named(c).isNull()) for c in columns]}, {})


def joint_null_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows have all the given columns null."""
    together = F.lit(True)
    for c in columns:
        together = together & named(c).isNull()
    return df.agg(F.count_if(together).alias("joint_nulls"))


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows; with ``order_by`` always the same ones."""
    return df.orderBy(*[named(c) for c in order_by]).limit(n) if order_by else df.limit(n)
