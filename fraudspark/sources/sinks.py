"""Write result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from fraudspark.functions.parsing import named


def fits_csv(kind: T.DataType) -> bool:
    """One plain value: no nested or user-defined type, no bytes, no interval."""
    return isinstance(kind, T.AtomicType) and not isinstance(
        kind, (T.BinaryType, T.AnsiIntervalType, T.VariantType) if hasattr(T, "VariantType") else (T.BinaryType, T.AnsiIntervalType)
    )


def keep_csv_columns(df: DataFrame, vectors_as_json: bool = False) -> DataFrame:
    """Columns a CSV cell can hold; ML vectors are dropped or, on request, written as JSON text."""
    kept = []
    for field in df.schema.fields:
        if fits_csv(field.dataType):
            kept.append(named(field.name))
        elif vectors_as_json and isinstance(field.dataType, VectorUDT):
            kept.append(F.to_json(vector_to_array(named(field.name))).alias(field.name))
    return df.select(*kept)


def write_table(df: DataFrame, path: str, file_format: str = "csv", partition_columns: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with CSV (with header) or Parquet, a file for each task.

    With partition columns a folder for each of their values; rows of one value come together first,
    a frequent one in several tasks, so that files are few and of one size.
    """
    if partition_columns:
        df = df.hint("rebalance", *[named(c) for c in partition_columns])
    writer = df.write.mode("overwrite")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported file format: {file_format}")
