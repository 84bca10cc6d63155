"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flowtide.llm import (
    components,
    html_text,
    language,
    license_rules,
    mixing,
    packing,
    prefix_hash,
    projection_forest,
    simhash,
    toxicity,
    url_rules,
)

WORDS = "the quick brown fox jumps over a lazy dog near the river bank every day".split()
LONG = " ".join(WORDS[i % 7] + str(i % 1000) for i in range(60_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, score string, hash int"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def doc(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "x", "y", 1)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        doc(1, "One two three four."),
        doc(2, None),
        doc(3, ""),
        doc(4, " \t\n"),
        doc(5, LONG),
        doc(6, "One two three four.", source=None),
        doc(6, "One two three four.", source=None),
        doc(7, "1234 5678", lang=None, source="b"),
        doc(None, "no id at all", source="b"),
        doc(8, "Ünïcödé \U0001f600 word", lang="de", source="c"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_mixing(spark, odd, empty):
    mix = mixing.mix(odd).toPandas()
    assert len(mix) == 10 and mix["size"].sum() == 60_000 + 3 * 4 + 2 + 4 + 3
    assert mix[mix["size"] == 0].taken.tolist() == [0, 0, 0]
    assert (mix.taken <= 3 * mix["size"]).all()
    assert mix[mix.source.isna()].source_size.tolist() == [8, 8]
    assert mixing.mix(empty).count() == 0
    again = mixing.mix(odd).toPandas()
    assert sorted(map(repr, mix.values.tolist())) == sorted(map(repr, again.values.tolist()))


def test_mixing_targets_reshare_what_is_above_the_limit(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 40), (None, 50)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    # b and c stop at 30 and 120; a weighs 1 and the null source, stopped at 150, weighs 1
    assert found == {"a": 800.0, "b": 30.0, "c": 120.0, None: 150.0}


def test_mixed_repeats_and_cuts(spark):
    rows = [doc(i, "w  x\ty z" if i % 2 else "p q", source="ab"[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    mix = mixing.mix(docs).toPandas().set_index("doc_id")
    got = out.withColumn("words", mixing.word_count(F.col("text"))).groupBy("doc_id").agg(F.sum("words").alias("w"))
    for row in got.collect():
        assert row["w"] == mix.taken[row["doc_id"]]
    for row in out.select("text", "n_chars").collect():
        assert row["n_chars"] == len(row["text"]) and "w  x\ty z".startswith(row["text"]) or row["text"] in ("p q", "p")


def test_html(spark):
    page = """<!doctype html><title>no</title><p hidden>no<p>one<p>two<ul><li>a<li>b<ol><li>c</ol></ul>
    <table><tr><th>Name<th>N<tr><td>x &amp; y<td>10</table><pre>  k
 l</pre><!-- no --><script>"</p>"</script><div style="display:none">no</div>end <b>bold</b>"""
    assert html_text.visible_text(page).split("\n") == [
        "one", "", "two", "", "- a", "- b", "  1. c", "", "Name  | N", "x & y | 10", "", "  k", " l", "", "end bold",
    ]
    assert html_text.visible_text(None) == html_text.visible_text("") == ""
    assert html_text.visible_text("a < b <br> c") == "a < b\nc"
    assert "deep" in html_text.visible_text("<div>" * 5000 + "deep" + "</div>" * 5000)
    assert html_text.visible_text("<table><td colspan=3>wide<td rowspan=2>tall<tr><td>1<td>2").split("\n") == [
        "wide |   | tall", "1    | 2",
    ]
    assert html_text.visible_text("<p>unclosed <b") == "unclosed"
    pages = spark.createDataFrame([(1, None, "u"), (1, "<p>a", "u")], "page_id long, html string, text string")
    assert sorted(r["content"] for r in html_text.extract(pages).collect()) == ["", "a"]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_prefix_hashes(spark, odd, empty):
    a, b = prefix_hash.PrefixHashes("xxabcabc"), prefix_hash.PrefixHashes("abcabd")
    assert a.span(2, 5) == a.span(5, 8) == b.span(0, 3) != b.span(3, 6)
    assert prefix_hash.common_extension(a, 2, b, 0) == 5
    assert prefix_hash.likeness(prefix_hash.fingerprint(LONG), prefix_hash.fingerprint(LONG[:-1])) > 0.8
    assert prefix_hash.likeness(prefix_hash.fingerprint(""), prefix_hash.fingerprint(None)) == 1
    found = prefix_hash.fingerprints(odd).toPandas()
    assert len(found) == 10 and found.near_edited.between(0, 1).all()
    assert found[found.doc_id == 6].fingerprint.nunique() == 1 and found.doc_id.isna().sum() == 1
    assert prefix_hash.fingerprints(empty).count() == 0
    one = prefix_hash.fingerprints(odd.where("doc_id = 1")).toPandas()
    assert one.near_next.tolist() == [1.0]


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 6))
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(1000 + i, [1.0] * 6, 0) for i in range(60)]  # ties
    rows += [(2000, None, 0), (2020, [0.0] * 6, 0), (2040, [1.0, None] + [0.0] * 4, 0), (2060, [float("nan")] * 6, 0),
             (2080, [1.0, 2.0], 0), (None, [1.0] * 6, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    found = projection_forest.nearest(frame, F.col("vec_id") % 20 == 0).toPandas()
    assert set(found.query_id) == {*range(0, 300, 20), 1000, 1020, 1040}
    usable = {r[0]: np.array(r[1]) for r in rows[:360]}
    recall = []
    for query, group in found.sort_values("rank").groupby("query_id"):
        best = sorted((-float(v @ usable[query]), i) for i, v in usable.items() if i != query)[:20]
        recall.append(len({i for _, i in best} & set(group.vec_id)) / 20)
        if query >= 1000 and recall[-1] == 1:
            assert group.vec_id.tolist() == [i for _, i in best]
    assert np.mean(recall) >= 0.9
    assert projection_forest.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = frame.where("vec_id in (0, 1, 2)")
    assert projection_forest.nearest(few, F.col("vec_id") == 0).count() == 2


def test_packing(spark, odd, empty):
    pieces = packing.pack(odd, VOCABULARY).toPandas()
    assert len(pieces[pieces.doc_id == 6]) == 2 and pieces.doc_id.isna().sum() == 1
    assert pieces[pieces.doc_id.isin([2, 3, 4])].length.tolist() == [1, 1, 1]
    long = pieces[pieces.doc_id == 5].sort_values("piece")
    assert (long.length[:-1] == 4096).all() and len(long) > 10
    assert packing.pack(empty, VOCABULARY).count() == 0


@pytest.mark.parametrize("text", ["It's <|endoftext|> ÉCOLE! naïve…", "a.b,c 12,5 ß ŉ İstanbul", "x y \x1cz q", "日本語 テスト ﬁ", "été ½"])
def test_word_tokenizer_equals_the_whole_tokenizer(text):
    words = packing.WordTokenizer(VOCABULARY)
    whole = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.ids(text), "<u4").tolist() == [*whole, 1]


def test_sum_of_squares():
    lengths = np.random.default_rng(1).integers(1, 4097, 2000)
    bins, offsets = packing.sum_of_squares(lengths)
    frame = pd.DataFrame({"bin": bins, "at": offsets, "n": lengths}).sort_values(["bin", "at"])
    assert frame.groupby("bin").n.sum().max() <= 4096
    assert (frame["at"] == frame.groupby("bin").n.cumsum() - frame.n).all()
    assert frame.bin.nunique() <= 1.1 * lengths.sum() / 4096  # even lengths are the hard case
    assert frame.bin.nunique() == frame.bin.max() + 1


def test_licenses(spark, odd, empty):
    found = license_rules.digest(odd).toPandas()
    assert len(found) == 10 and found.n_base.sum() == 0 and (found["labels"] == "").all() and (found.score == 0).all()
    assert license_rules.digest(empty).count() == 0
    texts = [
        "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0.",
        "cc by cc by",
        "CC_BY MIT-License, the GNU General Public License v3",
        "CC0 1.0; all rights reserved. SPDX-License-Identifier: MIT",
        "accby xmit license",
    ]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, labels int")
    got = license_rules.digest(rows).toPandas().set_index("doc_id")
    assert got["labels"].tolist() == [
        "apache,apache-2.0,cc-by,cc-by-nc-4.0", "cc-by", "cc-by,gpl,gpl-3.0,mit", "all-rights-reserved,cc0-1.0,mit", "",
    ]
    assert got.base_labels.tolist() == ["apache,cc-by", "cc-by", "cc-by,gpl,mit", "", ""]
    assert got.loc[1, ["n_words", "n_base", "first_word", "last_word"]].tolist() == [4, 2, 0, 2]
    spans = license_rules.scan(rows.where("doc_id = 0")).select("licenses.found").first()[0]
    assert [(s["start"], s["stop"], s["label"]) for s in spans] == [(0, 8, "apache-2.0"), (9, 14, "cc-by-nc-4.0")]


def test_urls(spark):
    pages = [
        (1, "http://WWW.a.net/x?utm_source=f#t", None, 0),
        (2, "http://a.net/x", '<link rel="canonical" href="https://b.com/de/y">', 0),
        (3, "https://b.com/de/y", "", 0),
        (4, "https://c.net/", '<meta http-equiv=refresh content="0; url=//example.org/es/z">', 0),
        (5, "https://d.org/ok", "<link href='http://b.com/de/y' rel='canonical'>", 0),
        (6, None, None, 0),
        (7, "no scheme", None, 0),
        (8, "https://e.net/alone", None, 0),
        (8, "https://e.net/alone", None, 0),
        (9, "https://x.example.org/en/12", None, 0),
        (10, "https://notexample.net/p", None, 0),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, verdict int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(frame).collect()}
    assert got[1] == ("www.a.net", "/x", None, "block") and got[2][3] == "block"
    assert got[3] == ("b.com", "/de/y", "com/de/", "block") and got[4][3] == "block"
    assert got[5] == ("d.org", "/ok", "org/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow") and got[8][3] == got[10][3] == "allow"
    assert got[9] == ("x.example.org", "/en/12", "example.org/en/1", "block")
    assert url_rules.judge(frame).count() == 11 and url_rules.judge(frame.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 200)]
    edges = spark.createDataFrame(chain + chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components.connected_components(edges.limit(0), "a", "b").count() == 0


def test_toxicity(spark, odd, empty):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(300)] + [(5, None), (None, 1)], "doc_id long, toxic int"
    )
    docs = spark.createDataFrame([doc(i, f"word{i} " + ("scum" if i % 2 else "kind")) for i in range(300)], DOCS)
    found = toxicity.assess(docs, labels).toPandas()
    assert (found.predicted == found.doc_id % 2).all()
    assert toxicity.accepted(docs, labels).count() == 150
    few = toxicity.assess(odd, labels).toPandas()
    assert len(few) == 10 and few.score.between(0, 1).all()
    assert toxicity.assess(empty, labels).count() == 0
    none = toxicity.assess(odd, labels.limit(0)).toPandas()
    assert (none.score == 0).all() and (none.predicted == 0).all()


def test_pairs_weigh_more_than_their_parts():
    """Neither term alone is toxic; both together are."""
    x = np.array([[a, b] for a in (0, 1) for b in (0, 1)] * 50, np.float32)
    y = (x[:, 0] * x[:, 1]).astype(np.float32)
    model = toxicity._train(x, y, [1, 2])
    z = lambda rows: model.bias + model.weights[rows].sum() + (
        0.5 * ((model.vectors[rows].sum(0) ** 2).sum() - (model.vectors[rows] ** 2).sum())
    )
    assert z([0, 1]) > 0 > max(z([0]), z([1]), z([]))
    assert model.vectors[0] @ model.vectors[1] > 1


def test_language(spark, odd, empty):
    found = language.identify(odd).toPandas().set_index("doc_id")
    assert len(found) == 10
    assert found.loc[[2, 3, 4, 7], "lang_pred"].tolist() == ["und"] * 4
    assert found.loc[[2, 3, 4, 7], "score"].tolist() == [0.0] * 4
    assert language.identify(empty).count() == 0
    kept = language.accepted(odd)
    assert kept.columns == odd.columns and not {2, 3, 4, 7} & {r["doc_id"] for r in kept.collect()}


def test_language_bits_of_many_languages():
    names = [f"l{i:02d}" for i in range(70)]
    masks = np.zeros((2, language.SLOTS), np.uint64)
    for i, name in enumerate(names):
        for grams in language.ngrams(f"{name[0] * 3}{chr(97 + i % 26)}{chr(97 + i // 26)}word{chr(97 + i % 26)}"):
            for places in language._places(grams, language.SLOTS):
                masks[i // 64, places] |= np.uint64(1) << np.uint64(i % 64)
    model = language.LanguageFilter(names, masks)
    assert model.predict("lllbcwordb")[0] == "l53"
    whole = np.concatenate(list(language.ngrams("ab " * 200_000)))
    assert len(whole) > 1_000_000 and len(np.unique(whole)) == len(np.unique(np.concatenate(list(language.ngrams("ab ab ab")))))


def test_simhash(spark, odd, empty):
    found = simhash.near_duplicates(odd).toPandas()
    assert len(found) == 10
    by = found.set_index("doc_id")
    assert by.loc[[2, 3, 4], "fingerprint"].tolist() == ["0" * 16] * 3
    assert by.loc[[2, 3, 4], "component_id"].tolist() == [2, 2, 2]
    assert by.loc[6, "component_id"].tolist() == [1, 1]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "2", "5", "7", "8", "None"]
    twice = simhash.one_of_each(odd.where("doc_id = 6")).collect()
    assert [r["doc_id"] for r in twice] == [6]


def test_clashing_names(spark):
    """Columns named like those that the operators make on their way."""
    kind = "id long, text string, source string, n_chars long, _cut int, _at int, rows int, stays string, root int, row int"
    rows = [(i, f"a b c d{i % 3} e", "ab"[i % 2], 9, 1, 2, 3, "s", 4, 5) for i in range(12)] + [(3, "z", "a", 1, 1, 2, 3, "s", 4, 5)]
    docs = spark.createDataFrame(rows, kind)
    kept = simhash.one_of_each(docs, id_col="id")
    # of id 3 only one text is the least of its component; an id that repeats keeps one row
    assert kept.dtypes == docs.dtypes and sorted(r["id"] for r in kept.collect()) == [0, 1, 2, 3]
    assert [r["text"] for r in kept.where("id = 3").collect()] == ["z"]
    out = mixing.mixed(docs, id_col="id")
    assert out.dtypes == docs.dtypes and out.count() > 0


@pytest.mark.parametrize("blocks", [4, 5, 6, 7])
def test_links_keep_all_connections(spark, blocks):
    """Against every pair: random values, a dense cluster, a chain, equal keys."""
    rng = np.random.default_rng(blocks)
    values = [int(v) for v in rng.integers(0, 1 << 63, 150, dtype=np.uint64)]
    center = int(rng.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(250):
        v = center
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            v ^= 1 << int(b)
        values.append(v)
    for i in range(40):
        values.append((1 << i) - 1)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), blocks)
    pairs = edges.collect()
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 3 for r in pairs)

    def groups(linked):
        least = {v: v for v in signed}

        def root(v):
            while least[v] != v:
                v = least[v]
            return v

        for a, b in linked:
            x, y = sorted((root(a), root(b)))
            least[y] = x
        return {v: root(v) for v in signed}

    every = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert groups((r["a"], r["b"]) for r in pairs) == groups(every)
