"""A pass over a corpus: from raw documents to packed training sequences.

Each stage takes (spark, docs, folder), works on all that the one before kept, and
returns documents; the last one returns the pieces of the packed sequences.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowtide.llm import language, mixing, packing, simhash, toxicity
from flowtide.session import drop_table, scratch, shared_path

VOCABULARY = "word_bpe_49k.json"

#: Learned decisions and the packing have no SQL: tests compare run() with plain Python.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those that the corpus names."""
    return language.accepted(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not likelier toxic than not."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links: the one with the least id."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written before the next reads it.

    A stage's own tables go once its output stands, and its input with them.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop_table(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
