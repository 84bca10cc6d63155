"""Every query over whole small tables, against its SQL or plain Python."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from checks.compare import database, difference
from tokenizers import Tokenizer

from flowtide.llm import queries
from flowtide.llm.oracles import ORACLES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").toPandas().sort_values("doc_id")


def result(spark, name, folder=SMALL):
    return queries.QUERIES[name](spark, folder).toPandas()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert difference(spark, queries.QUERIES[name], ORACLES[name], database(SMALL), SMALL) is None


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_op1_takes_the_targets(spark):
    mix = result(spark, "op1_mix_sources")
    assert (mix.taken <= 3 * mix["size"]).all() and mix.target.gt(0).all()
    assert abs(mix.taken.sum() - mix["size"].sum()) <= 20
    assert mix.equals(result(spark, "op1_mix_sources").loc[mix.index]) or (
        mix.sort_values("doc_id").reset_index(drop=True).equals(
            result(spark, "op1_mix_sources").sort_values("doc_id").reset_index(drop=True))
    )


def test_op2_shows_every_paragraph(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").toPandas().set_index("page_id")
    texts = result(spark, "op2_html_text").set_index("page_id")
    assert set(texts.index) == set(pages.index)
    for page_id, html in pages.html.items():
        text = texts.content[page_id]
        assert "track(" not in text and "{margin" not in text
        for paragraph in re.findall(r"<p>([^<&]+)</p>", html):
            assert " ".join(paragraph.split()) in text
        assert texts.n_chars[page_id] == len(text)


def test_op3_against_plain_python(spark, documents):
    found = result(spark, "op3_prefix_fingerprints").set_index("doc_id")
    texts, ids = documents.text.tolist(), documents.doc_id.tolist()
    by_text = {}
    for i, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        row, after, half = found.loc[doc_id], texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        if len(text) > 20 and after != text:
            assert row.near_next < 0.4 <= row.near_edited <= 1
    assert len(set(by_text.values())) == len(by_text)


@pytest.mark.parametrize("folder", [SMALL, LARGER])
def test_op4_recall(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    matrix, ids = np.stack(vectors.embedding.values).astype(float), vectors.vec_id.to_numpy()
    found = result(spark, "op4_nearest_vectors", folder).sort_values(["query_id", "rank"])
    recall = []
    for query, group in found.groupby("query_id"):
        scores = matrix @ matrix[ids == query][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        assert group["rank"].tolist() == list(range(1, 21)) and query not in set(group.vec_id)
        exact = dict(zip(ids, scores, strict=True))
        assert np.allclose(group.score, [exact[i] for i in group.vec_id], rtol=0, atol=1e-12)
        recall.append(len(set(ids[order]) & set(group.vec_id)) / 20)
    assert set(found.query_id) == {i for i in ids if i % 20 == 0}
    assert np.mean(recall) >= 0.9


def test_op5_round_trip(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = result(spark, "op5_best_fit_packing").sort_values(["doc_id", "piece"])
    total = 0
    for doc_id, text in zip(documents.doc_id, documents.text, strict=True):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = pieces[pieces.doc_id == doc_id]
        assert own.length.sum() == len(ids) and own.start.tolist() == list(range(0, len(ids), 4096))
        for row in own.itertuples():
            part = ids[row.start : row.start + row.length]
            assert len(part) == row.length and zlib.crc32(part.tobytes()) == row.ids_crc32
        total += len(ids)
    for _, group in pieces.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]]
        assert group.length.sum() <= 4096
    assert pieces.sequence_id.nunique() <= 1.02 * total / 4096 + 2


def test_op6_base_against_plain_python(spark, documents):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = result(spark, "op6_license_scan").set_index("doc_id")
    hits = 0
    for doc_id, text in zip(documents.doc_id, documents.text, strict=True):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(small))
        places = {p: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p in phrases}
        every, row = sorted(i for at in places.values() for i in at), found.loc[doc_id]
        assert row.n_words == len(words) and row.n_base == len(every)
        labels = sorted({phrases[p] for p, at in places.items() if at})
        assert row.base_labels == ",".join(labels) and set(labels) <= set(row["labels"].split(","))| {""}
        assert 0 <= row.score <= 1
        if every:
            hits += 1
            assert (row.first_word, row.last_word) == (every[0], every[-1]) and row.score > 0
    assert hits


def test_op8_learns_what_is_toxic(spark):
    found = result(spark, "op8_toxicity", LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    assert len(found) == 1000 and found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    ones, zeros = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert (ones[:, None] > zeros).mean() + 0.5 * (ones[:, None] == zeros).mean() > 0.8
    assert held[held.toxic == 0].predicted.mean() < 0.02


def test_op9_held_out_accuracy(spark):
    found = result(spark, "op9_language_id", LARGER)
    known = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(known, on="doc_id")
    assert len(found) == 1000 and found.score.between(0, 1).all()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.98


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = Counter()
    for s in shingles:
        value = xxhash.xxh64_intdigest(s.encode(), 42)
        counts.update(b for b in range(64) if value >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(ids, values):
    least = dict(zip(ids, ids, strict=True))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 3:
                x, y = sorted((root(ids[a]), root(ids[b])))
                least[y] = x
    return [root(i) for i in ids]


def test_op10_against_plain_python(spark, documents):
    found = result(spark, "op10_simhash").sort_values("doc_id")
    ids = documents.doc_id.tolist()
    values = [plain_fingerprint(t) for t in documents.text]
    assert found.fingerprint.tolist() == [f"{v:016x}" for v in values]
    assert found.component_id.tolist() == plain_components(ids, values)
