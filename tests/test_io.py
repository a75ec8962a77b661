import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fraudspark.session import materialize, scratch_dir
from fraudspark.sources.sinks import keep_csv_columns, write_table
from fraudspark.sources.tables import read_table, split_malformed


def test_csv_names_nulls_and_types(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id , amount,city\n1,2.5,NA\n2,junk,Rome\n3,,n/a\n")
    df = read_table(spark, str(path), column_types={"amount": "double", "absent": "int"})
    assert df.columns == ["id", "amount", "city"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", 2.5, None), ("2", None, "Rome"), ("3", None, None)]


def test_csv_inference_and_schema(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,x\n")
    assert dict(read_table(spark, str(path), schema="infer").dtypes) == {"a": "int", "b": "string"}
    assert dict(read_table(spark, str(path), schema="a long, b string").dtypes)["a"] == "bigint"


def test_unknown_file_type(spark):
    with pytest.raises(ValueError, match="unsupported"):
        read_table(spark, "/data/in.xlsx", file_format="xlsx")


def test_csv_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "a int, v array<double>")
    df = df.withColumns({"vector": array_to_vector("v"), "m": F.create_map(F.lit("k"), F.lit(1))})
    assert keep_csv_columns(df).columns == ["a"]
    assert tuple(keep_csv_columns(df, vectors_as_json=True).first()) == (1, "[1.0,2.0]")


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_write_and_overwrite(spark, tmp_path, file_format):
    path = str(tmp_path / f"out.{file_format}")
    for n in (30, 20):
        write_table(spark.range(n).repartition(3), path, file_format)
    assert read_table(spark, path).count() == 20


def test_folders_and_compressed_files(spark, tmp_path):
    out = str(tmp_path / "scored.v2")
    write_table(spark.range(20), out, "parquet")
    assert read_table(spark, out, file_format="parquet").count() == 20
    spark.range(20).write.option("header", True).option("compression", "gzip").csv(out + ".z")
    assert read_table(spark, out + ".z").count() == 20


@pytest.mark.parametrize("word", ["nan", "<NA>", "#N/A", "N/A", "null", " NA "])
def test_null_words(spark, word):
    from fraudspark.sources.tables import normalize_nulls

    assert normalize_nulls(spark.createDataFrame([(word,)], "v string")).first().v is None


def test_written_tables_go_to_the_named_folder(spark):
    folder = scratch_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(3).withColumn("v", array_to_vector(F.array(F.col("id").cast("double")))), "t")
    assert df.inputFiles()[0].startswith("file:" + "//" + folder) and df.count() == 3


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id, name ,amount\n1,a,2.5\n2,b\n3,c,1,9\n4,\"d,d\",3\n")
    df = read_table(spark, str(tmp_path / "in.csv"), malformed_column="bad")
    good, bad = split_malformed(df.cache(), "bad")
    assert good.columns == ["id", "name", "amount"]
    assert {tuple(r) for r in good.collect()} == {("1", "a", "2.5"), ("4", "d,d", "3")}
    assert sorted(r.bad for r in bad.collect()) == ["2,b", "3,c,1,9"]


def test_partitions_are_pruned(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("int").alias("m"))
    write_table(df, str(tmp_path / "out"), "parquet", ["m"])
    month = spark.read.parquet(str(tmp_path / "out")).where("m = 3")
    assert month.count() == 100
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and "(m#" in plan.split("PartitionFilters")[1]
