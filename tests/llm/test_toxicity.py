"""The factorization machine against its definition, and labels that only pairs can tell."""

import math
import random
from itertools import combinations

import numpy as np
import pytest

from flowtide.llm import toxicity


def corpus(spark, n, label):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        held = {w for w in ("rude", "group") if rng.random() < 0.5}
        text = rng.choices(words, k=12) + sorted(held)
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(label(held))))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"), {r[0]: r[2] for r in rows}


def accuracy(found, truth):
    held = found[found.held_out]
    return np.mean([truth[i] == p for i, p in zip(held.doc_id, held.predicted, strict=True)])


@pytest.mark.parametrize("label", [lambda held: len(held) == 1, lambda held: len(held) != 1], ids=["one", "both or none"])
def test_a_label_of_pairs_alone(spark, label):
    """Neither word says anything alone: what counts is whether the other one is there."""
    docs, labels, truth = corpus(spark, 1500, label)
    assert accuracy(toxicity.assess(docs, labels).toPandas(), truth) >= 0.95


def test_both_words_together(spark):
    docs, labels, truth = corpus(spark, 1500, lambda held: len(held) == 2)
    assert accuracy(toxicity.assess(docs, labels).toPandas(), truth) >= 0.95


def test_labels_without_a_reason_bring_no_pairs():
    rng = np.random.default_rng(0)
    bits, y = rng.random((3000, 300)) < 0.1, (rng.random(3000) < 0.2).astype(np.float32)
    bits[:, 1] = bits[:, 0]  # a copied word
    assert toxicity._paired(bits, y, list(range(300))) == []
    y[:] = bits[:, 0]
    assert toxicity._paired(bits, y, list(range(300))) == []
    y[:] = bits[:, 5] ^ bits[:, 9]
    assert sorted(toxicity._paired(bits, y, list(range(300)))) == [5, 9]


def test_gains_equal_the_definition():
    """The gain of a pair, cell by cell."""
    rng = np.random.default_rng(1)
    bits, y = rng.random((400, 6)) < 0.4, rng.random(400) < 0.3

    def likelihood(groups):
        total = 0.0
        for g in groups:
            k, m = int(g.sum()), len(g)
            total += sum(c * math.log(c / m) for c in (k, m - k) if c)
        return total

    def gain(i, j):
        cells = [y[(bits[:, i] == a) & (bits[:, j] == b)] for a in (0, 1) for b in (0, 1)]
        alone = sum(likelihood([y[bits[:, t]], y[~bits[:, t]]]) - likelihood([y]) for t in (i, j))
        return 2 * (likelihood(cells) - likelihood([y]) - alone)

    least = sorted(gain(i, j) for i, j in combinations(range(6), 2))[-1]
    best = max(combinations(range(6), 2), key=lambda p: gain(*p))
    for limit, expected in ((least - 1e-6, sorted(best)), (least + 1e-6, [])):
        toxicity.PAIR_GAIN, before = limit, toxicity.PAIR_GAIN
        try:
            assert sorted(toxicity._paired(bits, y.astype(np.float32), list(range(6)))) == expected
        finally:
            toxicity.PAIR_GAIN = before


def test_scores_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    texts = ["rude words to a group", "a a a rude", "", None, "nothing known"]
    known = sorted(set().union(*(toxicity.terms(t) for t in texts[:2])))
    model = toxicity.FactorizationMachine(known, -0.5, rng.normal(size=len(known)), rng.normal(size=(len(known), 6)) / 4)
    for text in texts:
        rows = [known.index(t) for t in toxicity.terms(text) if t in known]
        z = -0.5 + sum(model.weights[i] for i in rows)
        z += sum(float(model.vectors[i] @ model.vectors[j]) for i, j in combinations(rows, 2))
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-z)))
