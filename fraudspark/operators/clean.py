"""Cleaning: duplicates, missing values, typed columns, derived flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fraudspark.config import PipelineConfig
from fraudspark.functions.parsing import named, parse_boolean, timestamp_of, timestamp_text
from fraudspark.sources.tables import cast_columns


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    known = set(df.columns)
    return [c for c in columns if c in known]


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates out, null equal to null.

    A hash aggregate on all columns: repeated rows collapse before the shuffle,
    so a row copied any number of times reaches the other side once per task.
    """
    return df.dropDuplicates()


def drop_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    columns = _present(df, columns)
    return df.na.drop(subset=columns) if columns else df


def first_value(df: DataFrame, column: str, order_column: str | None = None) -> DataFrame:
    """One row, one column: the value of the lowest ``order_column``, ties by value."""
    value = named(column)
    key = F.struct(named(order_column), value) if order_column in df.columns else value
    return df.where(value.isNotNull()).agg(F.min_by(value, key).alias(column))


def fill_default(
    df: DataFrame,
    column: str,
    condition: Column,
    order_column: str | None = None,
    scope: str = "matching",
    source: DataFrame | None = None,
    default: str | None = None,
) -> DataFrame:
    """Fill nulls of ``column`` with its first value among the rows that meet ``condition``.

    ``scope="matching"`` fills only rows that meet the condition, ``"all"`` every
    null. The default is a scalar subquery over ``source`` (``df`` if not given);
    nothing is filled when no row offers one. A given ``default`` is taken as it is.
    """
    if scope not in ("matching", "all"):
        raise ValueError(f"unknown scope: {scope}")
    if default is None:
        filler = first_value((df if source is None else source).where(condition), column, order_column).scalar()
    else:
        filler = F.lit(default)
    value = named(column)
    gap = value.isNull() & condition if scope == "matching" else value.isNull()
    return df.withColumn(column, F.when(gap, filler).otherwise(value))


def fill_strings(df: DataFrame, value: str = "NA") -> DataFrame:
    """Nulls of text columns become ``value``; typed columns keep theirs."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(named(c), F.lit(value)) for c in text})


def parse_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """As ``parse_timestamp``, with the trimmed text in a projection of its own, so that it is made once a row."""
    texts = {c: f"__text_{c}" for c in _present(df, columns)}
    made = df.withColumns({text: timestamp_text(named(c)) for c, text in texts.items()})
    return made.withColumns({c: timestamp_of(named(text)) for c, text in texts.items()}).drop(*texts.values())


def parse_booleans(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: parse_boolean(named(c)) for c in _present(df, columns)})


def drop_invalid_flags(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows whose parsed flag is null go; run after ``parse_booleans``."""
    return drop_missing(df, columns)


def add_and_flags(df: DataFrame, flags: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``name = left AND right`` in SQL three-valued logic."""
    known = set(df.columns)
    return df.withColumns(
        {
            name: named(left) & named(right)
            for name, (left, right) in flags.items()
            if left in known and right in known
        }
    )


def clean(df: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The full cleaning step.

    One shuffle, the duplicate removal; the optimizer moves the row filters
    below it. The default category is looked up on the rows before duplicate
    removal, which gives the same value without a second shuffle. Text nulls are
    filled last, so that the fill word never reaches a typed parse.
    """
    df = drop_missing(df, cfg.required_columns)
    rows = drop_duplicate_rows(df)
    if {cfg.category_column, cfg.type_column} <= set(df.columns):
        rows = fill_default(
            rows,
            cfg.category_column,
            named(cfg.type_column) == cfg.default_on_type,
            order_column=cfg.id_column,
            scope=cfg.default_scope,
            source=df,
            default=cfg.default_category,
        )
    rows = rows.transform(cast_columns, dict(cfg.numeric_types))
    rows = rows.transform(parse_timestamps, [cfg.timestamp_column])
    rows = rows.transform(parse_booleans, cfg.boolean_columns)
    rows = rows.transform(drop_invalid_flags, cfg.required_flags)
    rows = rows.transform(add_and_flags, {n: (a, b) for n, a, b in cfg.derived_flags})
    return rows.transform(fill_strings, cfg.string_fill)


def default_category(df: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> str | None:
    """The value that ``clean`` fills in, so that later rows get the same one."""
    if cfg.default_category is not None or not {cfg.category_column, cfg.type_column} <= set(df.columns):
        return cfg.default_category
    rows = drop_missing(df, cfg.required_columns).where(named(cfg.type_column) == cfg.default_on_type)
    return first_value(rows, cfg.category_column, cfg.id_column).first()[0]
