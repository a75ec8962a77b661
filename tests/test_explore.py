from pyspark.sql import functions as F

from fraudspark.operators.explore import flag_count, flag_count_by_dimension, hash_sample


def test_dimension_counts_equal_single_counts(featured, cfg):
    found = {(r.dimension, r.value): r.fraud_count for r in flag_count_by_dimension(featured, cfg.count_dimensions).collect()}
    for d in cfg.count_dimensions:
        single = {(d, str(r[d])): r.fraud_count for r in flag_count(featured, d).collect()}
        assert single == {k: v for k, v in found.items() if k[0] == d}


def test_null_groups_are_left_out_and_null_flags_count_zero(spark):
    df = spark.createDataFrame([("a", True), (None, True), ("b", None)], "g string, is_fraud boolean")
    assert {(r.value, r.fraud_count) for r in flag_count_by_dimension(df, ["g"]).collect()} == {("a", 1), ("b", 0)}


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") > 9, F.col("id")).alias("w"))
    for method in ("xxhash64", "md5"):
        samples = [
            [tuple(r) for r in hash_sample(df.repartition(p), ["v", "w"], ["id"], 0.5, method=method).sort("v", "w").collect()]
            for p in (1, 4, 16)
        ]
        assert samples[0] == samples[1] == samples[2] and samples[0]
        assert all(w is not None for _, w in samples[0])


def test_sample_share(spark):
    df = spark.range(20_000)
    assert 800 < hash_sample(df, ["id"], ["id"], 0.05).count() < 1200
    assert hash_sample(df, ["id"], ["id"], 1.0).count() == 20_000
    assert hash_sample(df, ["id"], ["id"], 0.1, seed=1).exceptAll(hash_sample(df, ["id"], ["id"], 0.1)).count() > 0
    big = spark.range(400_000)  # the share is the same for a large table, and for rows of one id
    assert 19_000 < hash_sample(big, ["id"], ["id"], 0.05).count() < 21_000
    one = big.select(F.lit(1).alias("k"), "id")
    assert 19_000 < hash_sample(one, ["id"], ["k", "id"], 0.05).count() < 21_000


def test_counts_read_only_their_columns(cleaned):
    plan = flag_count_by_dimension(cleaned, ["merchant_name", "transaction_type"])
    scan = plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert scan.startswith("struct<transaction_type:string,merchant_name:string,is_fraud:boolean>")
