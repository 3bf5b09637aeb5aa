"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import (
    decontaminate,
    divergence,
    fill_in_middle,
    html_extract,
    jaccard_join,
    language_id,
    nearest,
    packing,
    pii,
    sharding,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """A vocabulary file of the installed public tokenizers; the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeated_bytes(table(spark, folder, "documents"))


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, folder, "documents"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary_path())


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(table(spark, folder, "documents"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(spark, folder, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_toxicity,
        op3_benchmark_decontamination,
        op4_sharding,
        op5_html_extraction,
        op6_suffix_array_dedup,
        op7_nearest_neighbours,
        op8_pii,
        op9_jaccard_join,
        op10_best_fit_packing,
        op11_source_divergence,
        op12_language_id,
        op13_fill_in_middle,
    )
}
ORACLE_SQL = {
    "op1_substring_dedup": substring_dedup.ORACLE_SQL,
    "op3_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op9_jaccard_join": jaccard_join.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
}
