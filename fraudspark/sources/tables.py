"""Read transaction files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from fraudspark.functions.parsing import NULL_TOKENS, named, null_if_token


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def normalize_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Null words become nulls in every text column."""
    tokens = tuple(tokens)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: null_if_token(named(name), tokens) for name in text})


def cast_columns(df: DataFrame, column_types: Mapping[str, str]) -> DataFrame:
    """Typed columns where present; text that does not fit the type becomes null."""
    present = set(df.columns)
    return df.withColumns(
        {name: named(name).try_cast(kind) for name, kind in column_types.items() if name in present}
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_tokens: Iterable[str] = NULL_TOKENS,
    column_types: Mapping[str, str] | None = None,
    file_format: str | None = None,
    malformed_column: str | None = None,
) -> DataFrame:
    """CSV or Parquet files or folders, also compressed, with trimmed names and normalised nulls.

    Without ``file_format`` a path that ends in .parquet is Parquet and all others are CSV.
    Without a schema, CSV columns are read as text and typed later by the
    cleaning operators, so no pass over the files is spent on inference;
    ``schema="infer"`` asks for that pass. With ``malformed_column`` a CSV line that has too few or too
    many cells, or a cell that does not fit its type, keeps its whole text there (null for good lines).
    """
    kind = file_format or ("parquet" if path.rstrip("/").lower().endswith(".parquet") else "csv")
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "csv":
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if schema == "infer":
            reader = reader.option("inferSchema", True)
        elif schema is not None:
            reader = reader.schema(schema)
        if malformed_column is not None:
            plain = reader.csv(path).schema  # of the header and, if asked for, the inferred types
            kept = T.StructType([*plain.fields, T.StructField(malformed_column, T.StringType())])
            reader = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(kept)
            reader = reader.option("columnNameOfCorruptRecord", malformed_column).option("enforceSchema", False)
        df = reader.csv(path)
    else:
        raise ValueError(f"unsupported file format: {kind}")
    df = normalize_nulls(strip_column_names(df), null_tokens)
    return cast_columns(df, column_types) if column_types else df


def split_malformed(df: DataFrame, malformed_column: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the lines that could not be read as such."""
    bad = named(malformed_column).isNotNull()
    return df.where(~bad).drop(malformed_column), df.where(bad).select(named(malformed_column))
