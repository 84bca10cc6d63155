"""One query for each operator: whole tables, production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.llm import (
    alignment,
    ball_codes,
    html_text,
    language,
    license_rules,
    mixing,
    packing,
    prefix_hash,
    projection_forest,
    quality,
    simhash,
    toxicity,
    url_rules,
)

VOCABULARY = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mix(_table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(_table(spark, folder, "pages"))
    return pages.select("page_id", "content", F.length("content").cast("long").alias("n_chars"))


def op3_prefix_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_hash.fingerprints(_table(spark, folder, "documents"))


def op4_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return projection_forest.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_rules.digest(_table(spark, folder, "documents"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(_table(spark, folder, "pages"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op11_ball_codes(spark: SparkSession, folder: str) -> DataFrame:
    return ball_codes.digest(_table(spark, folder, "embeddings"))


def op12_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.digest(_table(spark, folder, "documents"), *map(public_tokenizers.path, ALIGNED))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_mix_sources,
        op2_html_text,
        op3_prefix_fingerprints,
        op4_nearest_vectors,
        op5_best_fit_packing,
        op6_license_scan,
        op7_url_filter,
        op8_toxicity,
        op9_language_id,
        op10_simhash,
        op11_ball_codes,
        op12_quality_trees,
        op13_token_alignment,
    )
}
