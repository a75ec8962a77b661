"""The whole job: read, clean, features, clusters, anomalies, write."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fraudspark.config import PipelineConfig
from fraudspark.operators.anomaly import Detection, detect
from fraudspark.operators.clean import clean, default_category
from fraudspark.operators.cluster import Clustering, cluster
from fraudspark.operators.explore import flag_count_by_dimension, hash_sample
from fraudspark.operators.features import add_features, fit_categories, model_columns
from fraudspark.operators.kendall import kendall_matrix, kendall_tau
from fraudspark.operators.profile import describe, null_counts, observed_schema_info
from fraudspark.plans.model import FraudModel, fitted_model
from fraudspark.session import materialize
from fraudspark.sources.sinks import keep_csv_columns, write_table
from fraudspark.sources.tables import read_table


@dataclass(frozen=True)
class RunResult:
    raw: DataFrame
    cleaned: DataFrame
    features: DataFrame
    fraud_counts: DataFrame
    amount_age: DataFrame
    profile_schema: DataFrame
    clustering: Clustering
    detection: Detection
    model: FraudModel
    cfg: PipelineConfig

    @cached_property
    def correlation(self) -> DataFrame | None:
        """Kendall's tau of the model columns, computed when first asked for."""
        if not self.cfg.correlate:
            return None
        columns = model_columns(self.features, [self.cfg.id_column])
        return kendall_matrix(self.features, columns)

    @property
    def scored(self) -> DataFrame:
        """All cleaned rows; those with a null model column have neither label, score nor prediction."""
        rows = self.detection.rows
        for left_out in (self.clustering.quarantined, self.detection.quarantined):
            rows = rows.unionByName(keep_csv_columns(left_out), allowMissingColumns=True)
        return rows

    @cached_property
    def fraud_amount(self) -> DataFrame:
        """Kendall's tau of the label and the amount."""
        return kendall_tau(self.cleaned, self.cfg.label_column, self.cfg.amount_column)

    @cached_property
    def profile_numeric(self) -> DataFrame:
        return describe(self.cleaned)

    def tables(self) -> dict[str, DataFrame]:
        """The small tables behind the charts and the reports."""
        silhouette = [(self.clustering.silhouette,)]
        found = {
            "profile_schema": self.profile_schema,
            "profile_nulls": null_counts(self.raw),
            "profile_numeric": self.profile_numeric,
            "silhouette": self.raw.sparkSession.createDataFrame(silhouette, "silhouette double"),
            "fraud_counts": self.fraud_counts,
            "pca_variance": self.clustering.variance,
            "pca_loadings": self.clustering.loadings,
            "cluster_centroids": self.clustering.centroids,
            "cluster_sample": self.clustering.sample,
            "cluster_profile": self.clustering.profile,
            "tree_count_sweep": self.detection.sweep,
            "class_report": self.detection.report,
            "amount_age_sample": self.amount_age,
        }
        if self.cfg.correlate:
            found["correlation"] = self.correlation
            found["fraud_amount_correlation"] = self.fraud_amount
        return found


def analyze(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> RunResult:
    """Run all steps on a raw table.

    The cleaned rows are written once, after the duplicate removal, which is the
    only shuffle of whole rows; encoding and everything later reads that table.
    Model vectors stay out of the scored rows: they are wide and no sink takes them.
    """
    cleaned, profile_schema = observed_schema_info(clean(raw, cfg), lambda df: materialize(df, "cleaned"))
    categories = fit_categories(cleaned, cfg)
    features = add_features(cleaned, cfg, categories)
    clustering = cluster(features, cfg)
    detection = detect(keep_csv_columns(clustering.rows), cfg)
    pair = [cfg.age_column, cfg.amount_column]
    return RunResult(
        raw=raw,
        cleaned=cleaned,
        features=features,
        fraud_counts=flag_count_by_dimension(features, cfg.count_dimensions, cfg.label_column),
        amount_age=hash_sample(
            cleaned, pair, [cfg.id_column, *pair], seed=cfg.seed
        ),
        profile_schema=profile_schema,
        cfg=cfg,
        clustering=clustering,
        detection=detection,
        model=fitted_model(cfg, categories, default_category(raw, cfg), clustering, detection),
    )


def register_views(result: RunResult, prefix: str = "transactions") -> None:
    """Temp views <prefix>_raw, <prefix>_clean and <prefix>_scored for Spark SQL."""
    result.raw.createOrReplaceTempView(f"{prefix}_raw")
    result.cleaned.createOrReplaceTempView(f"{prefix}_clean")
    result.scored.createOrReplaceTempView(f"{prefix}_scored")


def run(spark: SparkSession, cfg: PipelineConfig) -> RunResult:
    """Read ``cfg.input_path``, analyze, write rows, tables and the model under ``cfg.output_path``."""
    raw = read_table(
        spark,
        cfg.input_path,
        schema=cfg.input_schema,
        null_tokens=cfg.null_tokens,
        column_types=dict(cfg.numeric_types),
        file_format=cfg.input_format,
    )
    result = analyze(raw, cfg)
    output = cfg.output_path.rstrip("/")
    write_table(keep_csv_columns(result.scored), f"{output}/scored", cfg.output_format, cfg.partition_columns)
    result.model.save(f"{output}/model")
    write_table(keep_csv_columns(result.clustering.quarantined), f"{output}/quarantined", cfg.output_format)
    for name, table in result.tables().items():
        write_table(table, f"{output}/tables/{name}", cfg.output_format)
    return result
