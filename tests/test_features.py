import pytest
from pyspark.sql import functions as F, types as T

from fraudspark.config import PipelineConfig
from fraudspark.operators import features as f
from fraudspark.operators.anomaly import forest_columns
from fraudspark.operators.cluster import cluster_columns, split_missing


def test_feature_table_has_no_nulls_after_quarantine(featured, cfg):
    kept, quarantined = split_missing(featured, cluster_columns(featured, cfg))
    assert kept.count() + quarantined.count() == featured.count()
    assert kept.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in kept.columns]).first().asDict() == {
        c: 0 for c in kept.columns
    }


def test_feature_types(featured):
    types = dict(featured.dtypes)
    for c in ("transaction_month", "transaction_dayofweek", "transaction_hour", "is_international", "is_online"):
        assert types[c] == "int"
    assert any(c.startswith("transaction_type_") for c in featured.columns)


def test_day_of_week_options(spark):
    table = spark.sql("SELECT timestamp'2024-01-07 10:00:00' AS t")  # a Sunday
    assert f.add_time_parts(table, "t").first()["transaction_dayofweek"] == 1
    assert f.add_time_parts(table, "t", monday_first=True).first()["transaction_dayofweek"] == 6


def test_dense_one_hot(spark):
    table = spark.createDataFrame([("a b",), ("c.d",), (None,)], "k string")
    rows = f.one_hot_dense(table, ["k"]).drop("k").collect()
    assert rows[0].asDict() == {"k_a b": 1, "k_c_d": 0}
    assert [sum(r) for r in rows] == [1, 1, 0]


def test_names_that_would_clash(spark):
    table = spark.createDataFrame([("a.b",), ("a_b",), ("A_B",)], "k string").withColumn("K_a_b", F.lit(7))
    made = f.one_hot_dense(table, ["k"])
    rows = made.collect()
    assert len(set(c.lower() for c in made.columns)) == 5 and all(sum(r[2:]) == 1 and r[1] == 7 for r in rows)
    assert f.one_hot_columns(made) == set(made.columns[2:])


def test_many_categories(spark):
    table = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert len(f.one_hot_dense(table, ["k"]).columns) == 1001
    assert f.one_hot_sparse(table, ["k"]).first()["k_ohe"].size == 1001


def test_columns_named_like_an_index_are_model_columns(spark):
    table = spark.createDataFrame([("a", 1.0)], "k string, risk_idx double")
    made = f.one_hot_sparse(table, ["k"], keep_index=True)
    assert f.model_columns(made) == ["risk_idx"]


def test_sparse_one_hot_has_a_slot_for_unseen_values(spark):
    table = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    model = f.fit_index_encoder(table, ["k"])
    row = model.transform(spark.createDataFrame([("new",)], "k string")).first()
    assert row["k_ohe"].size == 3 and row["k_idx"] == 2.0
    assert "k_idx" not in f.one_hot_sparse(table, ["k"]).columns


def test_model_columns_exclude_labels_ids_and_flags(featured, cfg):
    for columns in (cluster_columns(featured, cfg), forest_columns(featured, cfg)):
        assert not {"transaction_id", "is_fraud", "is_online_fraud", "is_international_fraud"} & set(columns)
        types = {field.name: field.dataType for field in featured.schema.fields}
        assert all(isinstance(types[c], T.NumericType) for c in columns)


def test_forest_can_leave_categories_out(featured):
    columns = forest_columns(featured, PipelineConfig(forest_categories=False))
    assert "transaction_amount" in columns and not any(c.startswith("entry_mode_") for c in columns)
