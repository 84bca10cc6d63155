"""Quality rules: counts against plain Python, trees against a walk node by node."""

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from flowtide.llm import quality, queries
from flowtide.llm.common import fold_of

FOLDER = "/root/testdata/sf0.01"
KIND = "doc_id long, text string, quality string, score int, n_words string, id long"
LONG = " ".join(f"w{i % 5000}" for i in range(120_000))
ODD = [
    None, "", " \t\n", "one", "a b c a b c", "x x x x x", "a\n b \n\n a\n b \nb", "# * $ % & | < >##",
    "Ünï ① x y", "a\x00b \x1c c\x0b\x0cd", "a\r\na\r\n", "one two three four", LONG, "ok. " * 60,
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = text.split("\n")
    told = [any(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in lines]
    seen, duplicates = set(), 0
    for line, has_word in zip(lines, told, strict=True):
        duplicates += has_word and line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)]


@pytest.mark.parametrize("number", range(len(ODD)))
def test_counts(number):
    assert quality.statistics(ODD[number])[0] == plain(ODD[number])


def test_many_distinct_words(monkeypatch):
    ids = np.array([0, 1, 2, 3, 0, 1, 2, 9, 9])
    assert quality._repeated(ids, 10) == quality._repeated(ids, 1 << 22) == 6


def trained():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4)).round(1)
    y = (x[:, 0] - x[:, 1] ** 2 + x[:, 2] * x[:, 3] + rng.normal(0, 0.5, 3000) > 0).astype(float)
    return x, y, quality.grow(x, y, [-1, 0, 1, 0])


def test_flat_arrays_equal_a_walk():
    x, _, trees = trained()
    raw = trees.raw(x[:200])
    for row, value in zip(x[:200], raw, strict=True):
        total = trees.bias
        for node in trees.roots:
            while trees.left[node] != node:
                goes_left = row[trees.feature[node]] <= trees.threshold[node]
                node = trees.left[node] if goes_left else trees.right[node]
            total += trees.value[node]
        assert value == pytest.approx(total, abs=1e-12)


def test_monotonic_where_asked():
    x, _, trees = trained()
    for feature, sign in ((0, -1), (2, 1)):
        steps = np.repeat(x[:300, None], 41, axis=1)
        steps[:, :, feature] = np.linspace(-4, 4, 41)
        raw = trees.raw(steps.reshape(-1, 4)).reshape(300, 41)
        assert (sign * np.diff(raw, axis=1) >= -1e-12).all()
        assert (np.diff(raw, axis=1) != 0).any() or feature == 0


def test_first_split_has_the_largest_gain():
    x, y, _ = trained()
    stump = quality.grow(x, y, [0, 0, 0, 0], rounds=1, depth=1)
    g, h = y.mean() - y, np.full(len(y), y.mean() * (1 - y.mean()))
    part = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + quality.LAMBDA)
    gains = {
        (f, c): part(x[:, f] <= c) + part(x[:, f] > c) for f in range(4) for c in quality._cuts(x[:, f])
    }
    found = gains[stump.feature[0], stump.threshold[0]]
    assert found == pytest.approx(max(gains.values()))


def test_learns_what_is_not_additive():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (2000, 3)).astype(float) + rng.normal(0, 0.01, (2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.grow(x[:1500], y[:1500], [0, 0, 0])
    assert ((trees.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95


def test_odd_rows(spark):
    rows = [(i, t, "q", 1, "n", 5) for i, t in enumerate(ODD)] + [(None, LONG, "q", 1, "n", 5), (3, "one", "q", 1, "n", 5)]
    docs = spark.createDataFrame(rows, KIND)
    labels = spark.createDataFrame([(12, 1), (13, 0), (4, None), (None, 1), (99, 0), (12, 1)], "doc_id long, quality int")
    found = quality.assess(docs, labels).toPandas()
    assert len(found) == len(rows) and found.doc_id.isna().sum() == 1 and found.score.between(0, 1).all()
    by_id = found.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    for i, text in enumerate(ODD):
        assert by_id.loc[i, list(quality.COUNTS)].tolist() == plain(text)
    assert by_id.base_failed.tolist() == [n[0] < 50 or 100 * n[4] > 50 * n[0] for n in map(plain, ODD)]
    assert not found[found.base_failed].kept.any()
    assert quality.assess(docs.limit(0), labels).count() == 0
    unlabelled = quality.assess(docs, labels.limit(0)).toPandas()
    assert (unlabelled.kept == ~unlabelled.base_failed).all()
    assert quality.accepted(docs, labels).dtypes == docs.dtypes


def test_query(spark):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id")
    found = queries.op12_quality_trees(spark, FOLDER).toPandas().set_index("doc_id")
    assert sorted(found.index) == sorted(docs.index)
    for i, text in docs.text.items():
        assert found.loc[i, list(quality.COUNTS)].tolist() == plain(text)
    assert not (found.kept & found.base_failed).any()
    held = [i for i in labels.index if fold_of(i, quality.FOLDS) == quality.HELD_OUT]
    right = (found.score[held] >= 0.5) == (labels.quality[held] == 1)
    assert len(held) > 50 and right.mean() >= 0.97
