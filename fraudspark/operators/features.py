"""Time parts, encodings and the choice of model columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame, functions as F, types as T

from fraudspark.config import PipelineConfig
from fraudspark.functions.parsing import named


def add_time_parts(
    df: DataFrame, column: str, prefix: str = "transaction", monday_first: bool = False
) -> DataFrame:
    """Month, day of week and hour in UTC, whatever the session zone. Days run 1=Sunday..7=Saturday, or 0=Monday..6=Sunday."""
    stamp = F.convert_timezone(F.current_timezone(), F.lit("UTC"), named(column).cast("timestamp_ntz"))
    return df.withColumns(
        {
            f"{prefix}_month": F.month(stamp),
            f"{prefix}_dayofweek": F.weekday(stamp) if monday_first else F.dayofweek(stamp),
            f"{prefix}_hour": F.hour(stamp),
        }
    )


def booleans_to_int(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    known = set(df.columns)
    return df.withColumns({c: named(c).cast("int") for c in columns if c in known})


ONE_HOT = "one_hot_of"


def category_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, int]]:
    """Rows per distinct non-null value of each column, from one scan.

    Values are counted per task before the shuffle; the distinct ones are what an encoder holds.
    """
    columns = list(columns)
    if not columns:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value")) for c in columns])
    found = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    counts: dict[str, dict[str, int]] = {c: {} for c in columns}
    for row in found:
        counts[row["column"]][row["value"]] = row["rows"]
    return counts


def one_hot_names(columns: Sequence[str], categories: Mapping[str, Sequence[str]], taken: Iterable[str]) -> dict[tuple[str, str], str]:
    """A name for each (column, value): ``<column>_<value>`` in safe letters, with a number where that is taken.

    Spark compares names without case, so names are unique without it.
    """
    used, names = {c.lower() for c in taken}, {}
    for c in columns:
        for value in categories[c]:
            plain = f"{c}_{value}".replace(".", "_").replace("`", "_")
            name, again = plain, 1
            while name.lower() in used:
                again += 1
                name = f"{plain}_{again}"
            used.add(name.lower())
            names[c, value] = name
    return names


def one_hot_dense(
    df: DataFrame, columns: Sequence[str], categories: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` per category, no level dropped, null rows all zero."""
    columns = [c for c in columns if c in df.columns]
    if categories is None:
        categories = {c: sorted(found) for c, found in category_counts(df, columns).items()}
    names = one_hot_names(columns, categories, df.columns)
    made = {
        name: F.when(named(c).cast("string") == value, 1).otherwise(0).alias(name, metadata={ONE_HOT: c})
        for (c, value), name in names.items()
    }
    return df.select("*", *made.values())


def one_hot_columns(df: DataFrame) -> set[str]:
    """The columns that ``one_hot_dense`` made; the mark is kept in the schema, also in Parquet."""
    return {f.name for f in df.schema.fields if ONE_HOT in f.metadata}


def by_frequency(counts: Mapping[str, int]) -> list[str]:
    """Values by falling frequency, ties by value."""
    return sorted(counts, key=lambda value: (-counts[value], value))


def fit_index_encoder(
    df: DataFrame, columns: Sequence[str], index_only: bool = False, categories: Mapping[str, Sequence[str]] | None = None
) -> PipelineModel:
    """Index by falling frequency (ties by value), then sparse one-hot with a slot for unseen values.

    The labels come from the category counts of all columns, one scan, unless they are given.
    """
    columns = list(columns)
    if categories is None:
        categories = {c: by_frequency(found) for c, found in category_counts(df, columns).items()}
    indexers = [
        StringIndexerModel.from_labels(
            list(categories[c]), c, f"{c}_idx", handleInvalid="keep"
        )
        for c in columns
    ]
    if index_only:
        return PipelineModel(indexers)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns], dropLast=False
    )
    return PipelineModel([*indexers, encoder.fit(PipelineModel(indexers).transform(df))])


def one_hot_sparse(
    df: DataFrame, columns: Sequence[str], keep_index: bool = False, categories: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Sparse ``<column>_ohe`` vectors; the index columns go unless asked for."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    encoded = fit_index_encoder(df, columns, categories=categories).transform(df)
    return encoded if keep_index else encoded.drop(*[f"{c}_idx" for c in columns])


def model_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns by type; booleans, excluded names and category indexes are out.

    An index is known by the nominal attribute in its metadata, not by its name.
    """
    exclude = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
        and f.name not in exclude
        and f.metadata.get("ml_attr", {}).get("type") != "nominal"
    ]


def fit_categories(df: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> dict[str, list[str]]:
    """The categories that ``add_features`` encodes, in its order."""
    columns = [c for c in cfg.category_features if c in df.columns]
    order = by_frequency if cfg.encoding == "sparse" else sorted
    return {c: list(order(found)) for c, found in category_counts(df, columns).items()}


def add_features(
    df: DataFrame, cfg: PipelineConfig = PipelineConfig(), categories: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """The full feature step: time parts, flags as 0/1, categories encoded (found in ``df`` unless given)."""
    if cfg.timestamp_column in df.columns:
        df = add_time_parts(df, cfg.timestamp_column, monday_first=cfg.monday_first)
    df = booleans_to_int(df, cfg.flag_features)
    if cfg.encoding == "dense":
        return one_hot_dense(df, cfg.category_features, categories)
    if cfg.encoding == "sparse":
        return one_hot_sparse(df, cfg.category_features, categories=categories)
    raise ValueError(f"unknown encoding: {cfg.encoding}")
