"""The registered queries of the operators of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm import decontaminate, lines, ranked


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.toxicity import toxicity

    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.pack import pack

    return pack(table(spark, folder, "documents"), bpe_path(), capacity=2048)


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.shard import shard

    rows = shard(table(spark, folder, "documents"), weights=[1.0] * 40, grown_weights=[1.0] * 41)
    return rows.withColumn("law", F.lit("key"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.quality import quality

    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_approximate_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.search import nearest

    return nearest(table(spark, folder, "embeddings"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.language import language

    return language(table(spark, folder, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("spans")


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.lm import lm_score

    return lm_score(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.variants import spelling_variants

    return spelling_variants(table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from fraudspark.llm.template import extract

    return extract(table(spark, folder, "pages"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_sharding": op5_sharding,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_approximate_nearest_neighbours": op8_approximate_nearest_neighbours,
    "op9_language_id": op9_language_id,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ranked_search": op12_ranked_search,
    "op13_html_extraction": op13_html_extraction,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": lines.ORACLE,
    "op7_benchmark_decontamination": decontaminate.ORACLE,
    "op12_ranked_search": ranked.ORACLE,
}
