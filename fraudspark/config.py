"""Settings for one run over a transaction table."""

from __future__ import annotations

from dataclasses import dataclass

from fraudspark.functions.parsing import NULL_TOKENS


@dataclass(frozen=True)
class PipelineConfig:
    """Column roles and model settings; the defaults describe the card table."""

    input_path: str = ""
    input_format: str = "csv"
    input_schema: str | None = None  # a DDL string, "infer", or None: text, typed by numeric_types
    null_tokens: tuple[str, ...] = NULL_TOKENS
    output_path: str = ""

    # column roles
    id_column: str = "transaction_id"
    timestamp_column: str = "transaction_datetime"
    amount_column: str = "transaction_amount"
    age_column: str = "cardholder_age"
    type_column: str = "transaction_type"
    category_column: str = "merchant_category"
    label_column: str = "is_fraud"
    numeric_types: tuple[tuple[str, str], ...] = (
        ("transaction_amount", "double"),
        ("cardholder_age", "int"),
    )
    required_columns: tuple[str, ...] = ("transaction_country",)
    boolean_columns: tuple[str, ...] = ("is_fraud", "is_online", "is_international")
    required_flags: tuple[str, ...] = ("is_international",)
    derived_flags: tuple[tuple[str, str, str], ...] = (
        ("is_online_fraud", "is_online", "is_fraud"),
        ("is_international_fraud", "is_international", "is_fraud"),
    )
    flag_features: tuple[str, ...] = ("is_international", "is_online")
    category_features: tuple[str, ...] = ("transaction_type", "merchant_category", "entry_mode")
    count_dimensions: tuple[str, ...] = (
        "transaction_month",
        "transaction_dayofweek",
        "transaction_hour",
        "merchant_category",
        "transaction_type",
        "merchant_name",
    )

    # cleaning
    default_on_type: str = "withdrawal"
    default_scope: str = "matching"
    default_category: str | None = None  # None: looked up in the rows
    string_fill: str = "NA"

    # features
    monday_first: bool = False
    encoding: str = "dense"
    null_features: str = "quarantine"
    correlate: bool = True

    # clustering
    n_clusters: int = 4
    pca_components: int = 2
    seed: int = 42

    # forest
    contamination: float = 0.15
    max_samples: int | str = "auto"
    tree_counts: tuple[int, ...] = (50, 100, 150, 200, 250)
    forest_categories: bool = True
    scale_forest_features: bool = False
    metric: str = "f1"

    # output
    output_format: str = "csv"
    partition_columns: tuple[str, ...] = ()  # of the scored rows, e.g. the month
