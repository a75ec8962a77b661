"""Scaling, PCA and KMeans over model columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, Imputer, PCAModel, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F

from fraudspark.config import PipelineConfig
from fraudspark.functions.parsing import named
from fraudspark.operators.explore import hash_sample
from fraudspark.operators.features import model_columns
from fraudspark.session import materialize


def vector_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT) and f.name.endswith("_ohe")]


def cluster_columns(df: DataFrame, cfg: PipelineConfig) -> list[str]:
    """Numeric columns without id, label and earlier results, then the one-hot vectors."""
    outside = {cfg.id_column, cfg.label_column, "cluster_labels", "predictions", "df_pred"}
    return model_columns(df, outside) + vector_columns(df)


def _missing(columns: Sequence[str]):
    bad = F.lit(False)
    for c in columns:
        bad = bad | named(c).isNull()
    return bad


def split_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the models, and the quarantined rows with a null model column."""
    bad = _missing(columns)
    return df.where(~bad), df.where(bad)


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Approximate median of each numeric column that has a value."""
    columns = [c for c in columns if c in dict(df.dtypes) and dict(df.dtypes)[c] != "vector"]
    found = Imputer(strategy="median", inputCols=columns, outputCols=columns).fit(df).surrogateDF.first().asDict()
    return {c: v for c, v in found.items() if v is not None}


def impute_median(df: DataFrame, columns: Sequence[str], medians: Mapping[str, float] | None = None) -> DataFrame:
    """Nulls of numeric columns become the column's median, of ``df`` unless given; columns with no value stay."""
    medians = column_medians(df, columns) if medians is None else medians
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(named(c), F.lit(v).cast(types[c])) for c, v in medians.items()})


def prepare_rows(
    df: DataFrame, columns: Sequence[str], null_features: str = "quarantine", medians: Mapping[str, float] | None = None
) -> DataFrame:
    if null_features == "quarantine":
        return split_missing(df, columns)[0]
    if null_features == "median":
        return impute_median(df, columns, medians)
    raise ValueError(f"unknown choice: {null_features}")


def assemble(columns: Sequence[str], output: str = "features_raw") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def standardize(source: str = "features_raw", output: str = "features_scaled") -> StandardScaler:
    """Mean 0, sample standard deviation 1; a constant column becomes 0."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def fit_pca(df: DataFrame, columns: Sequence[str], k: int = 2) -> PipelineModel:
    """Vector, scaling and PCA to ``features_pca``."""
    pca = PCA(k=k, inputCol="features_scaled", outputCol="features_pca")
    return Pipeline(stages=[assemble(columns), standardize(), pca]).fit(df)


def project(df: DataFrame, columns: Sequence[str], k: int = 2) -> tuple[PipelineModel, DataFrame]:
    """The model of ``fit_pca``, and the projected points.

    The vectors are assembled once and written: scaling, both passes of PCA and the projection read
    them there instead of making features and vectors anew for each.
    """
    assembler = assemble(columns)
    vectors = materialize(assembler.transform(df).select("features_raw"), "vectors")
    fitted = Pipeline(stages=[standardize(), PCA(k=k, inputCol="features_scaled", outputCol="features_pca")]).fit(vectors)
    return PipelineModel([assembler, *fitted.stages]), fitted.transform(vectors).select("features_pca")


def fit_kmeans(df: DataFrame, k: int = 4, seed: int = 42, features: str = "features_pca") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster_labels").fit(df)


def explained_variance(model: PCAModel, df: DataFrame) -> DataFrame:
    """(component, ratio)."""
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double")


def feature_names(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """A name per vector slot; the slots of a vector column are numbered."""
    metadata = {f.name: f.metadata for f in df.schema.fields}
    names = []
    for c in columns:
        size = metadata[c].get("ml_attr", {}).get("num_attrs") if c in vector_columns(df) else None
        names += [c] if size is None else [f"{c}_{i}" for i in range(size)]
    return names


def pca_loadings(model: PCAModel, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, component, loading); each component's first non-zero loading is made positive."""
    loadings = model.pc.toArray()
    rows = []
    for j in range(loadings.shape[1]):
        column = loadings[:, j]
        lead = next((v for v in column if abs(v) > 1e-12), 1.0)
        rows += [(n, j + 1, float(v if lead > 0 else -v)) for n, v in zip(names, column)]
    return df.sparkSession.createDataFrame(rows, "feature string, component int, loading double")


def component_signs(model: PCAModel) -> list[int]:
    """The sign that makes each component's first non-zero loading positive, as in the loadings table."""
    loadings = model.pc.toArray()
    leads = [next((v for v in loadings[:, j] if abs(v) > 1e-12), 1.0) for j in range(loadings.shape[1])]
    return [1 if lead > 0 else -1 for lead in leads]


def cluster_numbers(model: KMeansModel, signs: Sequence[int]) -> list[int]:
    """A number for each fitted cluster: centroids in order of their first component, then the next ones.

    So equal clusterings have equal numbers, whatever the seed and the sign of a component.
    """
    centers = [tuple(s * float(v) for s, v in zip(signs, center)) for center in model.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    return [order.index(i) for i in range(len(centers))]


def label_rows(df: DataFrame, model: KMeansModel, numbers: Sequence[int], labels: str = "cluster_labels") -> DataFrame:
    """Labels of ``model`` by the numbers of the clusters."""
    number = F.element_at(F.array(*[F.lit(n) for n in numbers]), F.col("__fitted") + 1)
    found = model.copy({model.getParam("predictionCol"): "__fitted"}).transform(df)
    return found.withColumn(labels, number).drop("__fitted")


def centroids(model: KMeansModel, df: DataFrame, signs: Sequence[int], numbers: Sequence[int]) -> DataFrame:
    """(cluster, component, value), each component with the sign of the loadings table."""
    rows = [
        (numbers[i], j + 1, signs[j] * float(v))
        for i, center in enumerate(model.clusterCenters())
        for j, v in enumerate(center)
    ]
    return df.sparkSession.createDataFrame(rows, "cluster int, component int, value double")


def silhouette(df: DataFrame, features: str = "features_pca", labels: str = "cluster_labels") -> float:
    """Mean silhouette with squared Euclidean distance: one pass of sums, one pass of scores."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=labels, metricName="silhouette").evaluate(df)


def component_columns(
    df: DataFrame, k: int, features: str = "features_pca", signs: Sequence[int] | None = None
) -> DataFrame:
    """PC1, PC2, … as plain double columns in place of the vector."""
    parts = vector_to_array(named(features))
    signs = signs or [1] * k
    return df.withColumns({f"PC{i + 1}": parts[i] * signs[i] for i in range(k)}).drop(features)


def component_sample(
    df: DataFrame, k: int, keys: Sequence[str], fraction: float = 0.05, seed: int = 42, signs: Sequence[int] | None = None
) -> DataFrame:
    """A reproducible sample of points in PCA space with their labels; rows are in or out by their keys."""
    wanted = [f"PC{i + 1}" for i in range(k)] + ["cluster_labels"]
    return hash_sample(component_columns(df, k, signs=signs), wanted, list(keys) or wanted, fraction, seed, "md5" if keys else "xxhash64")


def cluster_profile(
    df: DataFrame,
    labels: str = "cluster_labels",
    amount: str = "transaction_amount",
    age: str = "cardholder_age",
    flag: str = "is_fraud",
) -> DataFrame:
    """Mean amount, mean age and fraud sum per cluster, in one aggregate."""
    return df.groupBy(named(labels).alias(labels)).agg(
        F.avg(named(amount)).alias("mean_amount"),
        F.avg(named(age)).alias("mean_age"),
        F.coalesce(F.sum(named(flag).cast("int")), F.lit(0)).alias("fraud_sum"),
    )


@dataclass(frozen=True)
class Clustering:
    """Labelled rows and the tables that describe the clusters."""

    rows: DataFrame
    quarantined: DataFrame
    variance: DataFrame
    loadings: DataFrame
    centroids: DataFrame
    silhouette: float | None
    sample: DataFrame
    profile: DataFrame
    columns: list[str]
    medians: dict[str, float] | None
    projection: PipelineModel
    kmeans: KMeansModel
    numbers: list[int]


def cluster(df: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> Clustering:
    """The full clustering step over the feature table.

    The vectors are written once for the projection. KMeans passes over its input
    many times, so the projected points, a few doubles per row, are kept by Spark
    while it runs. ``df`` should be a written table: every other step reads it again.
    """
    columns = cluster_columns(df, cfg)
    if not columns:
        raise ValueError("no model columns")
    medians = column_medians(df, columns) if cfg.null_features == "median" else None
    rows = prepare_rows(df, columns, cfg.null_features, medians)
    projection, points = project(rows, columns, cfg.pca_components)
    points = points.persist()
    try:
        kmeans = fit_kmeans(points, cfg.n_clusters, cfg.seed)
        filled = sum(size > 0 for size in kmeans.summary.clusterSizes)
        score = silhouette(kmeans.transform(points)) if filled > 1 else None
    finally:
        points.unpersist()
    pca = projection.stages[-1]
    signs = component_signs(pca)
    numbers = cluster_numbers(kmeans, signs)
    labelled = label_rows(projection.transform(rows), kmeans, numbers)
    keys = [cfg.id_column] if cfg.id_column in df.columns else []
    return Clustering(
        rows=labelled,
        quarantined=split_missing(df, columns)[1] if cfg.null_features == "quarantine" else df.limit(0),
        variance=explained_variance(pca, df),
        loadings=pca_loadings(pca, df, feature_names(df, columns)),
        centroids=centroids(kmeans, df, signs, numbers),
        silhouette=score,
        sample=component_sample(labelled, cfg.pca_components, keys, seed=cfg.seed, signs=signs),
        profile=cluster_profile(
            labelled, amount=cfg.amount_column, age=cfg.age_column, flag=cfg.label_column
        ),
        columns=columns,
        medians=medians,
        projection=projection,
        kmeans=kmeans,
        numbers=numbers,
    )
