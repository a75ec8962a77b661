"""The fitted models of a run as files: saved, loaded, and put to new rows without fitting again."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudspark.config import PipelineConfig
from fraudspark.functions.parsing import named
from fraudspark.functions.trees import NODE_SCHEMA, forest_arrays
from fraudspark.operators import anomaly, cluster
from fraudspark.operators.clean import clean
from fraudspark.operators.features import add_features
from fraudspark.session import materialize
from fraudspark.sources.sinks import keep_csv_columns


@dataclass(frozen=True)
class FraudModel:
    """Categories, projection, clusters, forest and threshold, with the settings they were fitted under."""

    cfg: PipelineConfig
    categories: dict[str, list[str]]
    cluster_columns: list[str]
    cluster_medians: dict[str, float] | None
    cluster_numbers: list[int]
    forest_columns: list[str]
    forest_medians: dict[str, float] | None
    forest_scaling: list[tuple[float, float]] | None
    sample_size: int
    best_count: int
    threshold: float
    projection: PipelineModel
    kmeans: KMeansModel
    nodes: DataFrame

    def save(self, path: str) -> None:
        """Four folders under ``path``: facts, forest, projection, clusters."""
        spark, path = self.nodes.sparkSession, path.rstrip("/")
        facts = {k: getattr(self, k) for k in self.__dataclass_fields__ if k not in ("projection", "kmeans", "nodes")}
        facts["cfg"] = asdict(self.cfg)
        spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")
        used = self.nodes.where(F.col("tree_id") < self.best_count)
        used.write.mode("overwrite").parquet(f"{path}/forest")
        self.projection.write().overwrite().save(f"{path}/projection")
        self.kmeans.write().overwrite().save(f"{path}/clusters")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FraudModel:
        path = path.rstrip("/")
        facts = json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])
        known = PipelineConfig.__dataclass_fields__
        settings = {k: _tuples(v) for k, v in facts.pop("cfg").items() if k in known}
        if facts["forest_scaling"] is not None:
            facts["forest_scaling"] = [tuple(pair) for pair in facts["forest_scaling"]]
        return FraudModel(
            cfg=PipelineConfig(**settings),
            **facts,
            projection=PipelineModel.load(f"{path}/projection"),
            kmeans=KMeansModel.load(f"{path}/clusters"),
            nodes=spark.read.schema(NODE_SCHEMA).parquet(f"{path}/forest"),
        )

    def score_function(self, spark: SparkSession):
        """The anomaly score as a vectorised function of the forest's columns, in their order."""
        anomaly.check_forest_size(self.best_count, self.sample_size)
        wanted = anomaly.node_frame(self.nodes.where(F.col("tree_id") < self.best_count))
        forest = {"": (forest_arrays(wanted, self.sample_size), [self.best_count])}
        return anomaly.score_function(spark, forest)

    def score_features(self, features: DataFrame) -> DataFrame:
        """Cluster label, predictions and anomaly score; rows with a null model column get none of them."""
        cfg = self.cfg
        rows = cluster.prepare_rows(features, self.cluster_columns, cfg.null_features, self.cluster_medians)
        labelled = cluster.label_rows(self.projection.transform(rows), self.kmeans, self.cluster_numbers)
        labelled = keep_csv_columns(labelled)
        rows = cluster.prepare_rows(labelled, self.forest_columns, cfg.null_features, self.forest_medians)
        inputs = [named(c).cast("double") for c in self.forest_columns]
        if self.forest_scaling is not None:
            inputs = [(c - m) / s if s else F.lit(0.0) for c, (m, s) in zip(inputs, self.forest_scaling, strict=True)]
        score = self.score_function(features.sparkSession)(*inputs)[f"n{self.best_count}"]
        found = anomaly.add_predictions(rows.withColumn("anomaly_score", score), F.col("anomaly_score"), self.threshold)
        if cfg.null_features != "quarantine":
            return found
        left_out = keep_csv_columns(cluster.split_missing(features, self.cluster_columns)[1])
        return found.unionByName(left_out, allowMissingColumns=True)

    def score(self, raw: DataFrame) -> DataFrame:
        """New raw rows, cleaned and encoded as the fitted ones were, with labels and scores.

        The cleaned rows are written once, as for the fit: else the null checks of all features are pushed below
        the duplicate removal, as one method too long to be compiled, and the rows left out are cleaned again.
        """
        cleaned = materialize(clean(raw, self.cfg), "cleaned")
        return self.score_features(add_features(cleaned, self.cfg, self.categories))


def _tuples(value):
    return tuple(_tuples(v) for v in value) if isinstance(value, list) else value


def fitted_model(cfg: PipelineConfig, categories, default_category: str | None, clustering, detection) -> FraudModel:
    return FraudModel(
        cfg=replace(cfg, default_category=default_category),
        categories={c: list(v) for c, v in categories.items()},
        cluster_columns=list(clustering.columns),
        cluster_medians=clustering.medians,
        cluster_numbers=list(clustering.numbers),
        forest_columns=list(detection.columns),
        forest_medians=detection.medians,
        forest_scaling=detection.scaling,
        sample_size=detection.sample_size,
        best_count=detection.best_count,
        threshold=detection.threshold,
        projection=clustering.projection,
        kmeans=clustering.kmeans,
        nodes=detection.nodes,
    )


def register_score_function(spark: SparkSession, model: FraudModel, name: str = "anomaly_score") -> Sequence[str]:
    """``SELECT <name>(…).n<trees>`` in SQL, over the model's columns in the order that is returned."""
    spark.udf.register(name, model.score_function(spark))
    return model.forest_columns
