"""The packing does not depend on how the documents are stored."""

import random
import struct

import public_tokenizers

from flowtide.llm import packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_sequences_do_not_depend_on_the_layout(spark):
    rng = random.Random(3)
    # half of the documents fill a sequence but for a gap that only short ones close
    sizes = [rng.randrange(2100, 3900) for _ in range(120)] + [rng.randrange(50, 1900) for _ in range(120)]
    rows = [(i, " ".join(["a"] * n)) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    by_length = spark.createDataFrame(sorted(rows, key=lambda r: len(r[1])), docs.schema)
    found = [
        {(r["doc_id"], r["piece"]): (r["sequence_id"], r["offset"]) for r in packing.pack(stored, VOCABULARY).collect()}
        for stored in (docs.coalesce(1), docs.repartition(60), by_length.repartitionByRange(60, "doc_id"))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 240
    total = sum(sizes) + len(sizes)
    assert len({s for s, _ in found[0].values()}) <= 1.02 * total / 4096 + 2


def test_blocks_follow_from_the_number_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 100)
    docs = spark.range(1000).selectExpr("id as doc_id", "repeat('a ', int(id % 300) + 1) as text")
    out = packing.pack(docs.repartition(40), VOCABULARY).toPandas()
    assert len(out) == 1000 and (out.sequence_id // (1 << 40)).nunique() == 10
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]]


def test_forms_of_a_word_are_tokenized_once(monkeypatch):
    asked = []
    for name in ("_letters", "_whole"):
        real = getattr(packing.WordTokenizer, name)
        monkeypatch.setattr(
            packing.WordTokenizer, name, lambda self, part, real=real: asked.append(part.lower()) or real(self, part)
        )
    words = packing.WordTokenizer(VOCABULARY)
    for text in ("zebraness Zebraness, ZEBRANESS!! zebraness***", "Zebraness!! zebraness*** Zebraness,"):
        whole = [*words.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
        assert words.ids(text) == struct.pack(f"<{len(whole)}I", *whole)
    assert sorted(asked) == ["!!", "***", ",", "zebraness"]


def test_ids_do_not_depend_on_what_is_kept(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 3)
    monkeypatch.setattr(packing, "LONGEST_KNOWN", 6)
    words, rng = packing.WordTokenizer(VOCABULARY), random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aBé'.!*_<|>1 İſ\u0301") for _ in range(rng.randrange(30)))
        whole = [*words.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
        assert words.ids(text) == struct.pack(f"<{len(whole)}I", *whole)
    assert len(words.once) <= 3 and len(words.known) <= 3
