"""The stages one by one, and run() against the same decisions in plain Python."""

from pathlib import Path

import pytest

import corpus_pipeline
from flowtide.llm import language, mixing, queries, simhash, toxicity
from flowtide.session import materialize

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "toxicity", "simhash_near_dedup", "mix_sources", "best_fit_packing",
    ]


def test_run_equals_the_operators_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    first = language.identify(docs).toPandas().set_index("doc_id")
    rows = docs.toPandas()
    rows = rows[rows.doc_id.map(lambda i: first.lang_pred[i] != "und" and first.score[i] >= language.LEAST_SCORE)]
    kept = materialize(spark.createDataFrame(rows, docs.schema), "kept")
    second = toxicity.assess(kept, labels).toPandas().set_index("doc_id")
    assert second.predicted.sum() > 0
    rows = rows[rows.doc_id.map(lambda i: second.predicted[i] == 0)]
    kept = materialize(spark.createDataFrame(rows, docs.schema), "kept")
    third = simhash.near_duplicates(kept).toPandas().set_index("doc_id")
    rows = rows[rows.doc_id.map(lambda i: third.component_id[i] == i)]
    kept = materialize(spark.createDataFrame(rows, docs.schema), "kept")
    mix = mixing.mix(kept).toPandas().set_index("doc_id")
    texts = {r.doc_id: r.text for r in rows.itertuples()}
    copies = {i: -(-m.taken // m["size"]) if m["size"] else 0 for i, m in mix.iterrows()}
    out = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert out[out.piece == 0].groupby("doc_id").size().to_dict() == {i: n for i, n in copies.items() if n}
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    assert set(out.doc_id) <= set(texts)


def test_filters_keep_columns_and_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, FOLDER)
        assert kept.dtypes == docs.dtypes, name
    packed = queries.op5_best_fit_packing(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()
