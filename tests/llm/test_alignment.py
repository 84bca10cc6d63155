"""Token alignment against plain Python, and on odd rows."""

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowtide.llm import alignment, queries

A, B = map(public_tokenizers.path, queries.ALIGNED)
ODD = [
    None, "", " ", "▁x", "<|endoftext|> </s>", "a" * 3000, "日本語 テキスト 😀😀", "  two  spaces \n\n\t",
    "a\x00b", "ﬁ ①", "Ünïcödé", "The The The", "The The The", "1234567890 3.14", "it's we'll",
    " ".join(f"word{i % 97} Wörter" for i in range(30_000)),
]


def plain(texts):
    """The groups of every text and the digest, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment._byte_of_letter()

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    every, held = [], Counter()
    for text in texts:
        groups = []
        if text:
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in left], [piece(i) for i in right]
            if b"".join(parts[0]) == b"".join(parts[1]) == (" " + text).encode():
                ends = [np.cumsum([len(p) for p in side]).tolist() for side in parts]
                i = j = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
                    groups.append((left[i:p], right[j:q]))
                    i, j = p, q
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        every.append((groups, links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for groups, links in every:
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield groups, (
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for (x, y), n in links.items() if held[x, y] == most[x]),
            sum(n * held[p] for p, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        )


@pytest.fixture(scope="module")
def odd(spark):
    kind = "doc_id long, text string, chunk string, links int, id string, pairs int"
    return spark.createDataFrame([(i, t, "c", 1, "x", 2) for i, t in enumerate(ODD)], kind)


def rows(found):
    return list(found.drop(columns="doc_id").itertuples(index=False, name=None))


def test_odd_texts(odd):
    found = alignment.digest(odd, A, B).toPandas().sort_values("doc_id")
    assert rows(found) == [digest for _, digest in plain(ODD)]
    assert rows(found)[:2] == [(0, 0, 0, 0, 0, 0, "")] * 2 and rows(found)[3][-1] == ""
    assert rows(found)[11] == rows(found)[12]


def test_groups(odd):
    found = {r["doc_id"]: r["groups"] for r in alignment.align(odd, A, B).collect()}
    for i, (groups, _) in enumerate(plain(ODD)):
        assert [(list(g["a"]), list(g["b"])) for g in found[i]] == groups


def test_small_chunks_and_slices_give_the_same(odd, monkeypatch):
    import pyarrow as pa

    texts = pa.array(ODD)
    whole = alignment.Aligned(texts, alignment.byte_level(A), alignment.pieces(B))
    links = whole.links().sort_by([("doc", "ascending"), ("pair", "ascending")])
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 100)
    assert whole.links().sort_by([("doc", "ascending"), ("pair", "ascending")]).equals(links)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(ODD))), texts], names=["id", "text"])
    chunks = list(alignment._chunks(batch))
    assert sum(c.num_rows for c in chunks) == len(ODD) < 3 * len(chunks)
    assert pa.Table.from_batches(chunks).column("text").to_pylist() == ODD


def test_both_libraries_give_the_same_ids():
    a = alignment.byte_level(A)
    assert a.fast is not None
    for text in filter(None, ODD):
        assert a.fast.encode_ordinary(text) == a.tokenizer.encode(text, add_special_tokens=False).ids


def test_null_ids_repeated_rows_and_empty_tables(spark, odd):
    twice = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, None)], "doc_id int, text string")
    found = alignment.digest(twice, A, B).toPandas()
    assert len(found) == 4 and found.doc_id.isna().sum() == 2
    assert sorted(found.count_sum) == [0, 9, 9, 9]
    assert alignment.digest(odd.limit(0), A, B).count() == 0
    assert alignment.align(odd.limit(0), A, B).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    if not Path(folder).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas().sort_values("doc_id")
    found = queries.op13_token_alignment(spark, folder).toPandas().sort_values("doc_id")
    assert found.doc_id.tolist() == docs.doc_id.tolist()
    assert rows(found) == [digest for _, digest in plain(docs.text.tolist())]
