"""The card-transaction table, derived from the order tables in a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order, with planted fraud, gaps, junk and repeated rows.

    The joins carry no hints: the optimizer broadcasts the sides whose size it
    knows to be small. Repeats come from one explode, not from a second scan.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table("region").select("r_regionkey", "r_name")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )

    key = F.col("o_orderkey")
    priority = F.substring("o_orderpriority", 1, 1)

    def two_digits(value):
        return F.lpad(value.cast("string"), 2, "0")

    def unless(missing, value):
        return F.when(missing, F.lit(None)).otherwise(value)

    stamp = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("T"),
        two_digits(key % 24),
        F.lit(":"),
        two_digits(key % 60),
        F.lit(":00"),
        F.when(key % 3 == 0, F.lit("Z")).otherwise(F.lit("")),
    )
    rows = joined.select(
        key.alias("transaction_id"),
        F.when(key % 997 == 5, F.lit("N/A")).otherwise(stamp).alias("transaction_datetime"),
        F.when(key % 11 == 4, F.col("o_totalprice") * 4)
        .otherwise(F.col("o_totalprice"))
        .alias("transaction_amount"),
        F.when(priority == "1", F.lit("withdrawal"))
        .when(priority == "2", F.lit("purchase"))
        .when(priority == "3", F.lit("transfer"))
        .when(priority == "4", F.lit("refund"))
        .otherwise(F.lit("payment"))
        .alias("transaction_type"),
        unless(((priority == "1") & (key % 4 == 0)) | (key % 101 == 0), F.col("c_mktsegment")).alias(
            "merchant_category"
        ),
        F.concat(F.lit("merchant_"), (F.col("c_custkey") % 20).cast("string")).alias("merchant_name"),
        unless(key % 53 == 0, F.col("n_name")).alias("transaction_city"),
        unless(key % 53 == 0, F.col("r_name")).alias("transaction_country"),
        F.col("o_orderstatus").alias("entry_mode"),
        (F.lit(18) + F.col("c_custkey") % 63).cast("int").alias("cardholder_age"),
        F.when(key % 4 == 0, F.lit("True"))
        .when(key % 4 == 1, F.lit("FALSE"))
        .when(key % 4 == 2, F.lit("1"))
        .otherwise(F.lit("0"))
        .alias("is_online"),
        F.when(key % 29 == 0, F.lit(None))
        .when(key % 31 == 0, F.lit("maybe"))
        .when(key % 7 < 2, F.lit("true"))
        .otherwise(F.lit("false"))
        .alias("is_international"),
        F.when((key % 11 == 4) | (key % 211 == 0), F.lit("True")).otherwise(F.lit("False")).alias("is_fraud"),
    )
    copies = F.when(F.col("transaction_id") % 41 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("copy")
