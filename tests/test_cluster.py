from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fraudspark.operators.cluster import component_signs
from fraudspark.operators import cluster as k
from fraudspark.operators.features import add_features


def test_every_scaled_column_has_mean_zero_and_unit_deviation(clustering):
    values = np.array(clustering.rows.select(vector_to_array("features_scaled").alias("v")).toPandas()["v"].tolist())
    assert np.abs(values.mean(axis=0)).max() < 1e-6
    deviations = values.std(axis=0)
    assert np.all((np.abs(deviations - 1) < 0.1) | (deviations == 0))


def test_labels(clustering, cfg):
    assert dict(clustering.rows.dtypes)["cluster_labels"] == "int"
    labels = [r.cluster_labels for r in clustering.rows.select("cluster_labels").distinct().collect()]
    assert len(labels) == cfg.n_clusters and None not in labels


def test_every_row_is_with_its_nearest_centroid(clustering):
    centers = clustering.centroids.toPandas().pivot(index="cluster", columns="component", values="value").to_numpy()
    rows = clustering.rows.select("cluster_labels", vector_to_array("features_pca").alias("v")).toPandas()
    points = np.array(rows["v"].tolist()) * component_signs(clustering.projection.stages[-1])
    assert [tuple(c) for c in centers] == sorted(tuple(c) for c in centers)
    distances = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (distances.argmin(axis=1) == rows["cluster_labels"]).all()


def test_tables(clustering, cfg, featured):
    assert clustering.variance.count() == cfg.pca_components
    assert clustering.loadings.count() == cfg.pca_components * len(k.cluster_columns(featured, cfg))
    assert clustering.sample.columns == ["PC1", "PC2", "cluster_labels"]
    assert -1 <= clustering.silhouette <= 1
    assert clustering.profile.agg(F.sum("fraud_sum")).first()[0] == clustering.rows.where("is_fraud").count()
    assert clustering.rows.count() + clustering.quarantined.count() == featured.count()


def test_silhouette_matches_all_pairs(spark):
    rng = np.random.default_rng(1)
    points, labels = rng.normal(size=(40, 2)), np.arange(40) % 3
    df = k.assemble(["x", "y"], "f").transform(
        spark.createDataFrame(pd.DataFrame({"x": points[:, 0], "y": points[:, 1], "l": labels}))
    )
    d = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(40):
        means = [d[i][labels == c].sum() / ((labels == c).sum() - (labels[i] == c)) for c in range(3)]
        a, b = means[labels[i]], min(m for c, m in enumerate(means) if c != labels[i])
        scores.append((b - a) / max(a, b))
    assert k.silhouette(df, "f", "l") == pytest.approx(np.mean(scores))


def test_sparse_vectors_and_median_fill(cleaned, cfg):
    cfg = replace(cfg, encoding="sparse", null_features="median")
    table = add_features(cleaned, cfg)
    result = k.cluster(table, cfg)
    assert result.rows.count() == table.count() and result.quarantined.count() == 0
    assert result.loadings.where(F.col("feature").startswith("entry_mode_ohe_")).count() > 0


def test_one_distinct_point(spark, cfg):
    df = spark.createDataFrame([(i, 1.0, 2.0, True) for i in range(5)], "transaction_id int, transaction_amount double, cardholder_age double, is_fraud boolean")
    result = k.cluster(df, cfg)
    assert result.silhouette is None and result.rows.count() == 5


def test_no_model_columns(spark, cfg):
    with pytest.raises(ValueError):
        k.cluster(spark.createDataFrame([("a",)], "s string"), cfg)


def test_vectors_are_assembled_once(featured, cfg):
    """The projection reads written vectors, without encodings or null checks, and is that of the plain model."""
    columns = k.cluster_columns(featured, cfg)
    rows = k.prepare_rows(featured, columns)
    model, points = k.project(rows, columns)
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan and "Filter" not in plan and "features_raw" in plan
    wanted = k.component_columns(k.fit_pca(rows, columns).transform(rows).select("features_pca"), 2)
    for found in (points, model.transform(rows).select("features_pca")):
        pairs = zip(sorted(map(tuple, k.component_columns(found, 2).collect())), sorted(map(tuple, wanted.collect())), strict=True)
        assert all(abs(a - b) < 1e-9 for one, other in pairs for a, b in zip(one, other))
