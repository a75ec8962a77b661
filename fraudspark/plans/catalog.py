"""Named queries: each operator, run over the transaction table of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudspark.config import PipelineConfig
from fraudspark.operators import anomaly, clean, cluster, evaluate, explore, features, kendall, profile
from fraudspark.plans.model import FraudModel, register_score_function
from fraudspark.plans.run import analyze
from fraudspark.session import materialize, scratch_dir
from fraudspark.sources.sinks import keep_csv_columns, write_table
from fraudspark.sources.tables import read_table, split_malformed
from fraudspark.sources.transactions import read_transactions

CONFIG = PipelineConfig()

# Fixed rule of the label-free quality checks, and fixed cluster labels.
RULE_LIMIT = 600_000
FIXED_CLUSTERS = 4
# The training pools that are compared: sizes are what that operator varies.
POOL_SIZES = (1_000, 10_000)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = prepared
    return function


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean(read_transactions(spark, folder), CONFIG)


def _feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return features.add_features(materialize(_cleaned(spark, folder), "cleaned"), CONFIG)


def _amount_and_age(spark: SparkSession, folder: str) -> DataFrame:
    """Written once, because the fits and comparisons that use it read it several times."""
    columns = ["transaction_id", "transaction_amount", "cardholder_age", "is_fraud"]
    return materialize(_cleaned(spark, folder).select(*columns), "amounts")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# sources and sinks


@query
def raw_transactions(spark, folder):
    return read_transactions(spark, folder)


@query
def csv_round_trip(spark, folder):
    path = f"{scratch_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    write_table(read_transactions(spark, folder), path, "csv")
    return read_table(spark, path, column_types={"transaction_id": "long", **dict(CONFIG.numeric_types)})


@query
def parquet_round_trip(spark, folder):
    path = f"{scratch_dir(spark)}/round-trip-{uuid.uuid4().hex}.parquet"
    write_table(read_transactions(spark, folder), path, "parquet")
    return read_table(spark, path)


@query
def malformed_lines(spark, folder):
    """Lines of a customer file with a cell too few, one too many, or a word for a number, by key class."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    key, balance = F.col("c_custkey"), F.format_string("%.2f", "c_acctbal")
    line = (
        F.when(key % 17 == 3, F.concat_ws(",", key, "c_mktsegment"))
        .when(key % 19 == 5, F.concat_ws(",", key, "c_mktsegment", balance, F.lit("more")))
        .when(key % 23 == 7, F.concat_ws(",", key, "c_mktsegment", F.lit("much")))
        .otherwise(F.concat_ws(",", key, "c_mktsegment", balance))
    )
    path = f"{scratch_dir(spark)}/lines-{uuid.uuid4().hex}"
    customers.select(line.alias("line")).write.text(path)
    raw = spark.read.schema("key long, segment string, balance double, bad string")
    raw = raw.option("columnNameOfCorruptRecord", "bad").csv(path)
    good, bad = split_malformed(materialize(raw, "lines"), "bad")
    return good.groupBy("segment").agg(F.count("*").alias("lines"), F.round(F.sum("balance"), 2).alias("balance")).unionByName(
        bad.agg(F.lit("malformed").alias("segment"), F.count("*").alias("lines"), F.lit(None).cast("double").alias("balance"))
    )


@query
def partitioned_output(spark, folder):
    """One month of the partitioned feature files; only that folder is listed and read."""
    path = f"{scratch_dir(spark)}/by-month-{uuid.uuid4().hex}"
    write_table(features.add_time_parts(_cleaned(spark, folder), "transaction_datetime"), path, "parquet", ["transaction_month"])
    spark.read.parquet(path).createOrReplaceTempView("transactions_by_month")
    return spark.sql(
        """
        SELECT transaction_hour, count(*) AS transactions, count_if(is_fraud) AS frauds
        FROM transactions_by_month WHERE transaction_month = 3 GROUP BY transaction_hour
        """
    )


@query
def csv_safe_columns(spark, folder):
    # written first: the encoders count the categories before they encode
    table = materialize(_cleaned(spark, folder), "cleaned")
    encoded = features.one_hot_sparse(table, ["transaction_type", "entry_mode"])
    return keep_csv_columns(encoded)


# profiles


@query
def profile_numeric(spark, folder):
    """The numeric columns are written first: exact quartiles take several passes over them."""
    raw = read_transactions(spark, folder)
    return profile.describe(materialize(raw.select(*profile.numeric_columns(raw)), "numbers"))


@query
def profile_schema(spark, folder):
    return profile.schema_info(_cleaned(spark, folder))


@query
def profile_nulls(spark, folder):
    return profile.null_counts(read_transactions(spark, folder))


@query
def joint_nulls(spark, folder):
    return profile.joint_null_count(
        read_transactions(spark, folder), ["transaction_city", "transaction_country"]
    )


@query
def preview(spark, folder):
    return profile.preview(read_transactions(spark, folder), 5, ["transaction_id"])


# cleaning


@query
def dedup_rows(spark, folder):
    return clean.drop_duplicate_rows(read_transactions(spark, folder))


@query
def required_columns(spark, folder):
    return clean.drop_missing(read_transactions(spark, folder), CONFIG.required_columns)


def _category_default(spark, folder, scope):
    raw = read_transactions(spark, folder)
    filled = clean.fill_default(
        raw,
        "merchant_category",
        F.col("transaction_type") == "withdrawal",
        order_column="transaction_id",
        scope=scope,
    )
    return filled.select("transaction_id", "transaction_type", "merchant_category")


@query
def category_default(spark, folder):
    return _category_default(spark, folder, "matching")


@query
def category_default_all(spark, folder):
    return _category_default(spark, folder, "all")


@query
def fill_na_strings(spark, folder):
    return clean.fill_strings(read_transactions(spark, folder))


@query
def parse_timestamps(spark, folder):
    parsed = clean.parse_timestamps(read_transactions(spark, folder), ["transaction_datetime"])
    return parsed.select("transaction_id", "transaction_datetime")


@query
def parse_booleans(spark, folder):
    parsed = clean.parse_booleans(read_transactions(spark, folder), CONFIG.boolean_columns)
    return parsed.select("transaction_id", *CONFIG.boolean_columns)


@query
def drop_invalid_flags(spark, folder):
    parsed = clean.parse_booleans(read_transactions(spark, folder), CONFIG.required_flags)
    return clean.drop_invalid_flags(parsed, CONFIG.required_flags)


@query
def derived_flags(spark, folder):
    parsed = clean.parse_booleans(read_transactions(spark, folder), CONFIG.boolean_columns)
    flags = {name: (left, right) for name, left, right in CONFIG.derived_flags}
    return clean.add_and_flags(parsed, flags).select("transaction_id", *flags)


@query
def clean_transactions(spark, folder):
    return _cleaned(spark, folder)


# time, encoding, model columns


@query
def time_parts(spark, folder):
    parts = features.add_time_parts(_cleaned(spark, folder), "transaction_datetime")
    return parts.select("transaction_id", "transaction_month", "transaction_dayofweek", "transaction_hour")


@query
def time_parts_monday_first(spark, folder):
    parts = features.add_time_parts(_cleaned(spark, folder), "transaction_datetime", monday_first=True)
    return parts.select("transaction_id", "transaction_month", "transaction_dayofweek", "transaction_hour")


@query
def flags_as_int(spark, folder):
    table = features.booleans_to_int(_cleaned(spark, folder), CONFIG.flag_features)
    return table.select("transaction_id", *CONFIG.flag_features)


@query
def one_hot(spark, folder):
    table = materialize(_cleaned(spark, folder).select("transaction_id", *CONFIG.category_features), "cleaned")
    table = features.one_hot_dense(table, CONFIG.category_features)
    return table.drop(*CONFIG.category_features)


@query
def string_index(spark, folder):
    columns = list(CONFIG.category_features)
    table = materialize(_cleaned(spark, folder).select("transaction_id", *columns), "cleaned")
    indexed = features.fit_index_encoder(table, columns, index_only=True).transform(table)
    return indexed.drop(*columns)


@query
def one_hot_sparse(spark, folder):
    columns = list(CONFIG.category_features)
    table = materialize(_cleaned(spark, folder).select("transaction_id", *columns), "cleaned")
    encoded = features.one_hot_sparse(table, columns)
    cells = {c: vector_to_array(f"{c}_ohe") for c in columns}
    return encoded.select(
        "transaction_id",
        *[(F.array_position(v, F.lit(1.0)) - 1).cast("int").alias(f"{c}_slot") for c, v in cells.items()],
        *[F.size(v).alias(f"{c}_size") for c, v in cells.items()],
    )


@query
def feature_table(spark, folder):
    return features.add_features(materialize(_cleaned(spark, folder), "cleaned"), CONFIG)


@query
def numeric_features(spark, folder):
    table = features.add_features(materialize(_cleaned(spark, folder), "cleaned"), CONFIG)
    return table.select("transaction_id", *features.model_columns(table, [CONFIG.id_column]))


# exploratory tables


@query
def fraud_by_hour(spark, folder):
    parts = features.add_time_parts(_cleaned(spark, folder), "transaction_datetime")
    return explore.flag_count(parts, "transaction_hour")


@query
def fraud_by_dimension(spark, folder):
    parts = features.add_time_parts(_cleaned(spark, folder), "transaction_datetime")
    return explore.flag_count_by_dimension(parts, CONFIG.count_dimensions)


@query
def amount_age_sample(spark, folder):
    return explore.hash_sample(
        _cleaned(spark, folder), ["cardholder_age", "transaction_amount"], ["transaction_id"], method="md5"
    )


@query
def kendall_amount_age(spark, folder):
    return _rounded(kendall.kendall_tau(_amount_and_age(spark, folder), "transaction_amount", "cardholder_age"), 9)


@query
def kendall_fraud_amount(spark, folder):
    return _rounded(kendall.kendall_tau(_amount_and_age(spark, folder), "is_fraud", "transaction_amount"), 9)


@query
def kendall_matrix(spark, folder):
    table = _feature_table(spark, folder)
    return _rounded(kendall.kendall_matrix(table, features.model_columns(table, [CONFIG.id_column])), 9)


@query
def kendall_events(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("user_id", "value")
    return _rounded(kendall.kendall_matrix(events, ["user_id", "value"], full=True), 9)


# clusters

PAIR = ["transaction_amount", "cardholder_age"]


@query
def feature_vector(spark, folder):
    vector = cluster.assemble(PAIR).transform(_amount_and_age(spark, folder))
    cells = vector_to_array("features_raw")
    return vector.select("transaction_id", cells[0].alias("feature_0"), cells[1].alias("feature_1"))


@query
def standardised(spark, folder):
    vector = cluster.assemble(PAIR).transform(_amount_and_age(spark, folder))
    cells = vector_to_array("features_scaled")
    table = cluster.standardize().fit(vector).transform(vector)
    return _rounded(table.select("transaction_id", cells[0].alias("amount_scaled"), cells[1].alias("age_scaled")))


@query
def pca_variance(spark, folder):
    table = _amount_and_age(spark, folder)
    return _rounded(cluster.explained_variance(cluster.fit_pca(table, PAIR, 2).stages[-1], table))


@query
def pca_loadings(spark, folder):
    table = _amount_and_age(spark, folder)
    return _rounded(cluster.pca_loadings(cluster.fit_pca(table, PAIR, 2).stages[-1], table, PAIR))


@query
def pca_projection(spark, folder):
    """Absolute component values, as the sign of a component is free.

    To four digits: the two columns are almost uncorrelated, so the directions
    themselves are only determined to about twelve.
    """
    table = _amount_and_age(spark, folder)
    points = cluster.component_columns(cluster.fit_pca(table, PAIR, 2).transform(table), 2)
    return _rounded(points.select("transaction_id", F.abs("PC1").alias("pc1"), F.abs("PC2").alias("pc2")), 4)


def _clustering(spark, folder) -> cluster.Clustering:
    return cluster.cluster(_feature_table(spark, folder), CONFIG)


@query
def kmeans_labels(spark, folder):
    return _clustering(spark, folder).rows.select("transaction_id", "cluster_labels")


@query
def kmeans_coverage(spark, folder):
    """What must hold of any clustering: every complete row has one of the k labels."""
    label = F.col("cluster_labels")
    return _clustering(spark, folder).rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(label.isNull()).alias("unlabelled"),
        F.count_distinct(label).alias("clusters"),
        F.count_if(~label.between(0, CONFIG.n_clusters - 1)).alias("out_of_range"),
    )


@query
def kmeans_profile_totals(spark, folder):
    """Cluster sizes times cluster means must add up to the table's totals."""
    clustering = _clustering(spark, folder)
    sizes = clustering.rows.groupBy("cluster_labels").agg(F.count(F.lit(1)).alias("size"))
    return (
        clustering.profile.join(sizes, "cluster_labels")
        .agg(
            F.round(F.sum(F.col("mean_amount") * F.col("size")), 2).alias("amount"),
            F.round(F.sum(F.col("mean_age") * F.col("size")), 2).alias("age"),
            F.sum("fraud_sum").alias("frauds"),
        )
    )


@query
def kmeans_centroids(spark, folder):
    return _clustering(spark, folder).centroids


@query
def kmeans_profile(spark, folder):
    return _clustering(spark, folder).profile


@query
def kmeans_sample(spark, folder):
    return _clustering(spark, folder).sample


def _separated(spark, folder) -> cluster.Clustering:
    """The clustering step over four groups so far apart that only one clustering into four is best."""
    group = F.col("transaction_id") % 4
    table = _amount_and_age(spark, folder).withColumns(
        {
            "transaction_amount": F.col("transaction_amount") + group * 1e8,
            "cardholder_age": F.col("cardholder_age") + (group % 2) * 3e4,
        }
    )
    return cluster.cluster(materialize(table, "separated"), CONFIG)


@query
def separated_labels(spark, folder):
    return _separated(spark, folder).rows.select("transaction_id", "cluster_labels")


@query
def separated_centroids(spark, folder):
    return _rounded(_separated(spark, folder).centroids, 4)


@query
def separated_profile(spark, folder):
    return _rounded(_separated(spark, folder).profile, 4)


@query
def separated_sample(spark, folder):
    return _rounded(_separated(spark, folder).sample, 4)


@query
def separated_silhouette(spark, folder):
    return _rounded(spark.createDataFrame([(_separated(spark, folder).silhouette,)], "silhouette double"))


@query
def kmeans_silhouette(spark, folder):
    return spark.createDataFrame([(_clustering(spark, folder).silhouette,)], "silhouette double")


@query
def kmeans_embeddings(spark, folder):
    """PCA and KMeans over the vectors of the embeddings table."""
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    # one aggregate over all rows: a vector of another length must not lose its tail
    sizes = table.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    if sizes.least != sizes.most:
        raise ValueError(f"vectors of {sizes.least} to {sizes.most} components")
    width = sizes.most
    columns = [f"e{i}" for i in range(width)]
    table = table.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)])
    points = cluster.fit_pca(table, columns, 2).transform(table).select("vec_id", "features_pca")
    return cluster.fit_kmeans(points, 10, CONFIG.seed).transform(points).select("vec_id", "cluster_labels")


@query
def quarantined_rows(spark, folder):
    table = features.add_features(materialize(_cleaned(spark, folder), "cleaned"), CONFIG)
    return cluster.split_missing(table, cluster.cluster_columns(table, CONFIG))[1]


def _fixed_clusters(df: DataFrame) -> DataFrame:
    return df.withColumn("cluster_labels", F.col("cardholder_age") % FIXED_CLUSTERS)


@query
def silhouette_fixed_clusters(spark, folder):
    """Silhouette of scaled amount and age under fixed labels, so that SQL can state it."""
    table = _fixed_clusters(_amount_and_age(spark, folder))
    vector = cluster.assemble(PAIR).transform(table)
    scaled = cluster.standardize().fit(vector).transform(vector)
    score = cluster.silhouette(scaled, "features_scaled")
    return _rounded(spark.createDataFrame([(score,)], "silhouette double"))


@query
def cluster_profile(spark, folder):
    return _rounded(cluster.cluster_profile(_fixed_clusters(_amount_and_age(spark, folder))))


# anomalies and quality


def _ruled(spark, folder) -> DataFrame:
    table = _amount_and_age(spark, folder)
    return table.withColumn("df_pred", (F.col("transaction_amount") > RULE_LIMIT).cast("int"))


@query
def rule_confusion(spark, folder):
    return _rounded(evaluate.confusion(_ruled(spark, folder)))


@query
def class_report(spark, folder):
    return _rounded(evaluate.class_report(_ruled(spark, folder)))


@query
def label_totals(spark, folder):
    return evaluate.label_totals(_cleaned(spark, folder))


@query
def forest_scaled_features(spark, folder):
    return _rounded(anomaly.scaled(_amount_and_age(spark, folder), PAIR).drop("is_fraud"))


@query
def training_pool(spark, folder):
    return anomaly.training_pool(
        _cleaned(spark, folder), PAIR, ["transaction_id"], 0.2, 1000, method="md5"
    )


@query
def contamination_flags(spark, folder):
    """The threshold and the two prediction forms with the amount as the score."""
    table = _amount_and_age(spark, folder)
    amount = F.col("transaction_amount")
    limit = anomaly.contamination_thresholds(table, {"amount": amount}, CONFIG.contamination)["amount"]
    return anomaly.add_predictions(table, amount, limit).select("transaction_id", "predictions", "df_pred")


def _forest(spark, folder):
    table = _feature_table(spark, folder)
    columns = anomaly.forest_columns(table, CONFIG)
    rows = cluster.prepare_rows(table, columns, CONFIG.null_features)
    keys = ["transaction_id"]
    drawn = rows.select(*keys, *columns)
    nodes, size = anomaly.grow_forest(drawn, max(CONFIG.tree_counts), CONFIG.max_samples, CONFIG.seed, keys)
    return rows, columns, materialize(nodes, "forest"), size


@query
def iforest_nodes(spark, folder):
    return _rounded(_forest(spark, folder)[2])


@query
def iforest_scores(spark, folder):
    rows, columns, nodes, sample_size = _forest(spark, folder)
    scored = anomaly.score_rows(rows, columns, nodes, sample_size, CONFIG.tree_counts)
    return _rounded(scored.select("transaction_id", "scores.*"))


@query
def iforest_predictions(spark, folder):
    rows = anomaly.detect(_feature_table(spark, folder), CONFIG).rows
    return _rounded(rows.select("transaction_id", "anomaly_score", "predictions", "df_pred"))


@query
def iforest_report(spark, folder):
    return _rounded(anomaly.detect(_feature_table(spark, folder), CONFIG).report)


@query
def iforest_sweep(spark, folder):
    return _rounded(anomaly.detect(_feature_table(spark, folder), CONFIG).sweep)


@query
def iforest_pool_sweep(spark, folder):
    return _rounded(anomaly.sweep_pools(_feature_table(spark, folder), POOL_SIZES, CONFIG))


# the whole job


@query
def scored_transactions(spark, folder):
    return analyze(read_transactions(spark, folder), CONFIG).scored


@query
def scored_anomalies(spark, folder):
    """All cleaned rows with what the forest adds; cluster labels are left out, as they have no SQL here."""
    scored = analyze(read_transactions(spark, folder), CONFIG).scored.drop("cluster_labels")
    return scored.withColumn("anomaly_score", F.round("anomaly_score", 6))


def _saved_model(spark, folder) -> str:
    path = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
    analyze(read_transactions(spark, folder), CONFIG).model.save(path)
    return path


@query
def rescored_transactions(spark, folder):
    """The raw rows scored anew by the saved and loaded model: the same table as the first run's."""
    model = FraudModel.load(spark, _saved_model(spark, folder))
    scored = model.score(read_transactions(spark, folder)).drop("cluster_labels")
    return scored.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query
def anomaly_score_in_sql(spark, folder):
    """The loaded forest as a SQL function over the feature table."""
    model = FraudModel.load(spark, _saved_model(spark, folder))
    inputs = ", ".join(f"CAST(`{c}` AS double)" for c in register_score_function(spark, model))
    _feature_table(spark, folder).createOrReplaceTempView("transactions_features")
    return spark.sql(
        f"""
        SELECT transaction_id, round(anomaly_score({inputs}).n{model.best_count}, 6) AS anomaly_score
        FROM transactions_features WHERE transaction_month IS NOT NULL
        """
    )


@query
def sql_on_clean_view(spark, folder):
    _cleaned(spark, folder).createOrReplaceTempView("transactions_clean")
    return spark.sql(
        """
        SELECT transaction_country, entry_mode, count(*) AS transactions,
               count_if(is_fraud) AS frauds, round(sum(transaction_amount), 2) AS amount
        FROM transactions_clean
        GROUP BY transaction_country, entry_mode
        """
    )
