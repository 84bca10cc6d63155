"""Toxicity by a factorization machine over hashed terms.

A text is the set of its words, hashed. Each term has a weight and a short vector;
the score adds the weights of a text's terms and the inner products of all pairs of
their vectors, so that two terms may weigh more together than each on its own. With
s the sum of the vectors, the pairs cost one pass: (|s|^2 - sum of |v|^2) / 2.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``). Terms are
counted and screened by Spark: those enter that say much about the label alone. So do
both terms of a pair that says much more than its terms do, for the pairs of the
``PAIR_TERMS`` terms that stand in most documents. The driver gets the terms that
passed, and for the pairs one bit a document and term.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.common import column, fold, fresh
from flowtide.session import materialize

BUCKETS = 1 << 22
STEMS = ((6, 11), (8, 21))  # bytes of a word's beginning, and the start of their hash
SAMPLE = 12_000  # labelled documents that the model is fitted on, chosen by hash
TERMS = 1200  # terms that may enter the model
LEAST_DOCUMENTS = 3  # of the sample in which a term has to occur
LEAST_GAIN = 12.0  # log-likelihood ratio of a term and the label
PAIR_TERMS = 3000  # terms, those of most documents of the sample, whose pairs are looked at
PAIR_GAIN = 50.0  # what a pair has to say about the label beyond both of its terms
PAIRED = 400  # terms that may enter the model for their pairs
FACTORS = 6
ROUNDS = 250
RATE = 0.05
DECAY = 2e-4
FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.5

_WORD = re.compile(r"\w+")


def terms(text: str | None) -> set[int]:
    """The hashed terms of a text: its words, and the beginnings of its longer words.

    A beginning that several different words share is a term of its own, since
    inflected words of one stem say more together.
    """
    words = {w.encode("utf-8", "surrogatepass") for w in set(_WORD.findall((text or "").lower()))}
    found = {zlib.crc32(w) for w in words}
    for size, mark in STEMS:
        stems = Counter(w[:size] for w in words if len(w) > size)
        found.update(zlib.crc32(s, mark) for s in stems)
        found.update(zlib.crc32(s, mark + 1) for s, n in stems.items() if n > 1)
    return {t % BUCKETS for t in found}


class FactorizationMachine:
    def __init__(self, known: list[int], bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.index = {t: i for i, t in enumerate(known)}
        self.bias, self.weights, self.vectors = bias, weights, vectors

    def score(self, text: str | None) -> float:
        """Between 0 and 1; the score of an empty text is that of the bias alone."""
        if np.isneginf(self.bias):
            return 0.0  # nothing was learned
        rows = sorted(self.index[t] for t in terms(text) if t in self.index)
        if not rows:
            return float(_sigmoid(self.bias))
        own = self.vectors[rows]
        pairs = 0.5 * float((own.sum(axis=0) ** 2).sum() - (own**2).sum())
        return float(_sigmoid(self.bias + self.weights[rows].sum() + pairs))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _train(x: np.ndarray, y: np.ndarray, known: list[int]) -> FactorizationMachine:
    """Logistic loss with weight decay, by full-batch Adam steps from a fixed start."""
    rng = np.random.default_rng(0)
    start = [np.array([np.log(y.mean() / (1 - y.mean()))]), np.zeros(len(known)),
             rng.normal(0, 0.02, (len(known), FACTORS))]
    params = [p.astype(np.float32) for p in start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, ROUNDS + 1):
        bias, weights, vectors = params
        summed = x @ vectors
        z = bias + x @ weights + 0.5 * ((summed**2).sum(1) - x @ (vectors**2).sum(1))
        error = (_sigmoid(z) - y) / len(y)
        hit = x.T @ error
        slopes = [np.array([error.sum()]), hit + DECAY * weights,
                  x.T @ (error[:, None] * summed) - vectors * hit[:, None] + DECAY * vectors]
        for p, g, m, v in zip(params, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return FactorizationMachine(known, float(params[0][0]), params[1], params[2])


def _term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for key, label, text in zip(batch["key"], batch["label"], batch["text"], strict=True):
            yield pd.DataFrame({"key": key, "label": label, "term": np.array(sorted(terms(text)), np.int64)})


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``id, label, text`` of the rows that may teach; an id's labels are averaged."""
    known = (
        labels.where(column(label_col).isNotNull() & column(id_col).isNotNull())
        .groupBy(column(id_col).alias("id"))
        .agg((F.avg(column(label_col)) >= 0.5).cast("int").alias("label"))
        .where(fold(F.col("id"), FOLDS) != HELD_OUT)
    )
    chosen = known.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(SAMPLE)
    texts = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    return texts.join(chosen, "id")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> FactorizationMachine:
    """Learn from the labelled rows outside the held-out fold.

    Copies of a text teach once. Without any label the model scores everything 0;
    with labels of one kind only, it scores that kind's smoothed share.
    """
    rows = labelled(docs, labels, id_col, text_col, label_col).groupBy(F.xxhash64("text").alias("key")).agg(
        F.max("label").alias("label"), F.first("text").alias("text")
    )
    bags = materialize(rows.mapInPandas(_term_rows, "key long, label int, term long"), "terms")
    keys = bags.select("key", "label").distinct()
    n, ones = keys.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    nothing = np.zeros(0), np.zeros((0, FACTORS))
    if not n:
        return FactorizationMachine([], -np.inf, *nothing)
    if ones in (0, n):
        return FactorizationMachine([], float(np.log((ones + 0.5) / (n - ones + 0.5))), *nothing)
    label_of = {r["key"]: r["label"] for r in keys.collect()}
    single = [r["term"] for r in _screened(bags, n, ones).collect()]
    often = [r["term"] for r in _frequent(bags, n).collect()]
    everything = sorted({*single, *often})
    bits = _bits(bags, everything, sorted(label_of))
    y = np.array([label_of[key] for key in sorted(label_of)], np.float32)
    place = {t: i for i, t in enumerate(everything)}
    paired = _paired(bits[:, [place[t] for t in often]], y, often)
    known = [*single, *[t for t in paired if t not in set(single)]]
    return _train(bits[:, [place[t] for t in known]].astype(np.float32), y, known)


def _bits(bags: DataFrame, known: list[int], keys: list[int]) -> np.ndarray:
    """Which of the sample's documents, at most ``SAMPLE``, have which of the known terms."""
    found = np.zeros((len(keys), len(known)), bool)
    if known:
        used = bags.join(F.broadcast(_terms_table(bags, known)), "term", "left_semi").select("key", "term").toArrow()
        rows = np.searchsorted(np.array(keys, np.int64), used.column("key").to_numpy())
        found[rows, np.searchsorted(np.array(known, np.int64), used.column("term").to_numpy())] = True
    return found


def _frequent(bags: DataFrame, n: int) -> DataFrame:
    """The terms that part the documents most evenly: at most ``PAIR_TERMS``."""
    counts = bags.groupBy("term").agg(F.count("*").alias("d"))
    even = F.least(F.col("d"), n - F.col("d"))
    return counts.where(even >= LEAST_DOCUMENTS).orderBy(F.desc(even), "term").limit(PAIR_TERMS).select("term")


def _entropy_gain(count: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-likelihood of a cell's labels at the cell's own share."""
    log = lambda k: k * np.log(np.maximum(k, 1))
    return log(ones) + log(count - ones) - log(count)


def _paired(bits: np.ndarray, y: np.ndarray, known: list[int]) -> list[int]:
    """The terms of pairs that say more than their terms, the best pairs first.

    A pair cuts the documents into four cells; what counts is by how much the labels'
    log-likelihood ratio of the four exceeds those of both cuts into two. Copied words,
    which stand in the same documents, so gain nothing by each other.
    """
    n, total = len(y), float(y.sum())
    # summed over documents in blocks, so that only the counts of all pairs are held whole
    pairs, pair_ones = (np.zeros((len(known), len(known)), np.float32) for _ in range(2))
    for at in range(0, n, 1024):
        x, ones = bits[at : at + 1024].astype(np.float32), y[at : at + 1024] > 0
        pairs += x.T @ x
        pair_ones += x[ones].T @ x[ones]
    d, a = np.diag(pairs).astype(float), np.diag(pair_ones).astype(float)
    base = float(_entropy_gain(np.array(float(n)), np.array(total)))
    alone = 2 * (_entropy_gain(d, a) + _entropy_gain(n - d, total - a) - base)
    best = []
    for at in range(0, len(known), 64):
        some = slice(at, at + 64)
        both, hits = pairs[some].astype(float), pair_ones[some].astype(float)
        ds, as_ = d[some, None], a[some, None]
        four = (
            _entropy_gain(both, hits) + _entropy_gain(ds - both, as_ - hits) + _entropy_gain(d - both, a - hits)
            + _entropy_gain(n - ds - d + both, total - as_ - a + hits)
        )
        gain = 2 * (four - base) - alone[some, None] - alone
        gain[np.arange(len(gain)), at + np.arange(len(gain))] = -np.inf
        # a term's best pair: any pair that matters is the best one of a term of its own
        best += [(-g, at + i, j) for i, (g, j) in enumerate(zip(gain.max(1), gain.argmax(1), strict=True)) if g >= PAIR_GAIN]
    chosen: dict[int, None] = {}
    for _, i, j in sorted(best):
        if len({known[i], known[j]} | chosen.keys()) <= PAIRED:
            chosen |= {known[i]: None, known[j]: None}
    return list(chosen)


def _terms_table(docs: DataFrame, known: list[int]) -> DataFrame:
    return docs.sparkSession.createDataFrame([(t,) for t in known], "term long")


def _screened(bags: DataFrame, n: int, ones: int) -> DataFrame:
    """The terms that say most about the label: at most ``TERMS``."""
    counts = bags.groupBy("term").agg(F.count("*").alias("d"), F.sum("label").alias("a"))
    part = lambda k, of, share: F.when(k > 0, k * F.log(k / (of * share))).otherwise(0.0)
    d, a = F.col("d"), F.col("a")
    gain = 2 * (
        part(a, d, F.lit(ones / n)) + part(d - a, d, F.lit(1 - ones / n))
        + part(ones - a, n - d, F.lit(ones / n)) + part(n - ones - d + a, n - d, F.lit(1 - ones / n))
    )
    return (
        counts.where(d >= LEAST_DOCUMENTS)
        .withColumn("gain", gain)
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "term")
        .limit(TERMS)
        .select("term")
    )


def score(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with one more column: the score of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return docs.withColumn(out, scored(column(text_col)))


def assess(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``.

    A null text counts as empty, and an empty one gets the score of the bias. Repeated
    rows and ids keep all their rows. Null labels and labels of unknown ids teach
    nothing. Label, language, source and id are no inputs of the score.
    """
    out = fresh(docs, "toxicity")
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, out)
    return scored.select(
        column(id_col),
        (fold(column(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        column(out).alias("score"),
        (column(out) >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """``docs`` without the rows that are likelier toxic than not."""
    out = fresh(docs, "toxicity")
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, out)
    return scored.where(column(out) < THRESHOLD).select(*[column(c) for c in docs.columns])
