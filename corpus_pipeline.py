"""Five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns
of documents, the last one the packed pieces. ``run`` writes each result as Parquet to the shared
folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm.decontaminate import decontaminate
from fraudspark.llm.jaccard import jaccard_components
from fraudspark.llm.lines import dedup_lines
from fraudspark.llm.pack import pack
from fraudspark.llm.queries import bpe_path, table
from fraudspark.llm.toxicity import toxicity
from fraudspark.session import materialize, small_batches


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds ``__row``: id (nulls last) and two hashes of the text; rows with equal keys are copies of each other."""
    text = F.col("text").cast("string")
    hashes = [F.xxhash64(F.lit(k), text.isNull(), text).alias(f"k{k}") for k in (1, 2)]
    return docs.withColumn("__row", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), *hashes))


def _same(a: Column, b: Column) -> Column:
    """Whether two keys are equal: the hashes deal the rows out, ids may be null."""
    return (a["k1"] == b["k1"]) & (a["k2"] == b["k2"]) & a["id"].eqNullSafe(b["id"])


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose ``__row`` is not listed; the keys are written, so Spark knows whether they can be broadcast."""
    keys = materialize(keys.distinct().withColumnRenamed("__row", "__gone"), "listed_rows")
    return docs.join(keys, _same(F.col("__row"), F.col("__gone")), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"), keep_rows=True)
    with small_batches(spark):
        return materialize(scored.where(F.col("predicted") == 0).select("row.*"), "not_toxic")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the first of all like lines; a document goes if every line of it stands elsewhere before."""
    found = dedup_lines(docs).where((F.col("n_dropped") == 0) | (F.col("n_dropped") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id, then text hash, of each group of linked rows, and one of rows that repeat its id and text."""
    keyed = _keyed(docs)
    found = jaccard_components(keyed, id_column="__row").withColumnRenamed("doc_id", "__row")
    found = materialize(found.select("__row", "component_id"), "components")
    head = _same(F.col("component_id"), F.col("__row"))
    kept = _without(keyed, found.where(~head).select("__row"))
    again = found.groupBy("__row").count().where("count > 1").select(F.col("__row").alias("__again"))
    again = materialize(again, "repeated_rows")
    same = _same(F.col("__row"), F.col("__again"))
    once = kept.join(again, same, "left_semi").dropDuplicates(["__row"])
    return kept.join(again, same, "left_anti").unionByName(once).drop("__row")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    keyed = _keyed(docs)
    found = decontaminate(keyed, table(spark, sf_dir, "benchmark"), id_column="__row")
    return _without(keyed, found.where("contaminated").select(F.col("doc_id").alias("__row"))).drop("__row")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, bpe_path(), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Learned scores and the packing have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
