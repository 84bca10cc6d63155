"""Quality rules: gradient-boosted trees over statistics of documents.

Each text becomes a row of statistics. Trees are grown level by level with second-order
gains from histograms of gradients and Hessians; a split on a constrained feature must
not let the score rise with it, and its children inherit the middle of both values as a
bound, so that a whole tree is monotonic. All trees lie in flat node arrays, and a batch
of texts walks down all of them at once.

The trees are fitted on at most ``SAMPLE`` labelled rows. Of those the driver gets the
statistics alone, never a text.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.common import column, fold, fresh

SAMPLE = 20_000  # labelled documents that the trees are fitted on, chosen by hash
FOLDS = 5
HELD_OUT = 0
ROUNDS = 60
DEPTH = 4
RATE = 0.2
BINS = 64
LAMBDA = 1.0
LEAST_HESSIAN = 0.3  # in each child
THRESHOLD = 0.5

LEAST_WORDS = 50
MOST_REPEATED = 50  # of a hundred words
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = (".", "!", "?", '"')
COUNTED_AT_ONCE = 1 << 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees, and how the score may change with them: -1 never up, 0 freely.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "upper_share": 0,
    "digit_share": 0,
    "marks_per_word": 0,
    "words_per_line": 0,
    "ended_line_share": 0,
    "non_ascii_share": 0,
}


def _byte_counts(data: bytes) -> np.ndarray:
    found = np.zeros(256, np.int64)
    for start in range(0, len(data), COUNTED_AT_ONCE):
        found += np.bincount(np.frombuffer(data[start : start + COUNTED_AT_ONCE], np.uint8), minlength=256)
    return found


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that stand in a window that occurs twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    if distinct < 1 << 21:  # three word numbers fit one long
        windows = (ids[:n] * distinct + ids[1 : n + 1]) * distinct + ids[2:]
        _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        rows = np.stack([ids[:n], ids[1 : n + 1], ids[2:]], axis=1)
        _, place, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    again = count[place.ravel()] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the values of ``FEATURES``. A null text is empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # blanks of ASCII only
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    of = _byte_counts(data)
    chars = len(data) - int(of[128:192].sum())  # without the bytes that continue a character
    blanks = int(of[list(BLANKS.encode())].sum())
    symbols = int(of[list(SYMBOLS)].sum())
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    duplicates = len(lines) - len(set(lines))
    repeated = _repeated(ids, len(number))
    upper, lower, digits = int(of[65:91].sum()), int(of[97:123].sum()), int(of[48:58].sum())
    marks = int(of[33:127].sum()) - upper - lower - digits - symbols
    ended = sum(line.rstrip(BLANKS).endswith(ENDINGS) for line in lines)
    per_word, per_line, shown = 1 / max(n, 1), 1 / max(len(lines), 1), 1 / max(chars - blanks, 1)
    features = [
        float(np.log1p(n)),
        (chars - blanks) * per_word,
        symbols * per_word,
        duplicates * per_line,
        repeated * per_word,
        len(number) * per_word,
        float(np.bincount(ids).max()) * per_word if n else 0.0,
        upper / max(upper + lower, 1),
        digits * shown,
        marks * per_word,
        n * per_line,
        ended * per_line,
        int(of[192:].sum()) * shown,
    ]
    return [n, chars - blanks, symbols, duplicates, repeated], features


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees in flat arrays; a leaf is its own child on both sides."""

    bias: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray  # up to here a value goes left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The sum of all leaves that each row of ``x`` reaches, as log odds."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.bias + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1: how likely the label is 1."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -35, 35)))


def _cuts(values: np.ndarray) -> np.ndarray:
    """Thresholds between the bins of a feature: midpoints, at quantiles if there are many."""
    distinct = np.unique(values)
    middle = (distinct[1:] + distinct[:-1]) / 2
    if len(middle) < BINS:
        return middle
    return np.unique(middle[np.linspace(0, len(middle) - 1, BINS - 1).astype(int)])


def _histograms(bins: np.ndarray, node: np.ndarray, nodes: int, weights: np.ndarray) -> np.ndarray:
    """Sums of the weights by node, feature and bin."""
    return np.stack(
        [np.bincount(node * BINS + b, weights, nodes * BINS).reshape(nodes, BINS) for b in bins.T], axis=1
    )


def grow(
    x: np.ndarray, y: np.ndarray, signs: Sequence[int], rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE
) -> Trees:
    """Boost trees on log loss. Rows, features and bins in order decide ties: the first wins."""
    cuts = [_cuts(column) for column in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    sign = np.asarray(signs)[None, :, None]
    open_cut = np.array([[b < len(c) for b in range(BINS)] for c in cuts])[None]
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    raw = np.full(len(y), bias)
    nodes: list[tuple] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        roots.append(len(nodes))
        at = np.full(len(y), len(nodes))  # the node of each row
        nodes.append((0, 0.0, len(nodes), len(nodes), 0.0))
        level = [(roots[-1], -np.inf, np.inf)]
        for _ in range(depth):
            place = np.full(len(nodes), -1)
            place[[n for n, *_ in level]] = np.arange(len(level))
            live = np.flatnonzero(place[at] >= 0)
            own = place[at[live]]
            gl = _histograms(bins[live], own, len(level), g[live]).cumsum(axis=2)
            hl = _histograms(bins[live], own, len(level), h[live]).cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            low, high = (np.array([n[k] for n in level])[:, None, None] for k in (1, 2))
            wl = np.clip(-gl / (hl + LAMBDA), low, high)
            wr = np.clip(-(gt - gl) / (ht - hl + LAMBDA), low, high)
            gain = _loss(gt, ht, np.clip(-gt / (ht + LAMBDA), low, high)) - _loss(gl, hl, wl)
            gain = gain - _loss(gt - gl, ht - hl, wr)
            fine = open_cut & (hl >= LEAST_HESSIAN) & (ht - hl >= LEAST_HESSIAN) & (sign * (wr - wl) >= 0)
            gain = np.where(fine, gain, -np.inf).reshape(len(level), -1)
            best = gain.argmax(axis=1)
            following = []
            for i, (n, lower, upper) in enumerate(level):
                if gain[i, best[i]] <= 1e-9:
                    continue
                f, b = divmod(int(best[i]), BINS)
                left, right = len(nodes), len(nodes) + 1
                values = float(wl[i, f, b]), float(wr[i, f, b])
                middle = sum(values) / 2
                nodes[n] = (f, float(cuts[f][b]), left, right, nodes[n][4])
                nodes += [(0, 0.0, c, c, rate * v) for c, v in zip((left, right), values, strict=True)]
                bounds = {0: [(lower, upper)] * 2, 1: [(lower, middle), (middle, upper)]}
                bounds[-1] = [(middle, upper), (lower, middle)]
                for child, (lo, hi) in zip((left, right), bounds[signs[f]], strict=True):
                    following.append((child, lo, hi))
                rows = np.flatnonzero(at == n)
                at[rows] = np.where(bins[rows, f] <= b, left, right)
            level = following
            if not level:
                break
        raw += np.array([n[4] for n in nodes])[at]
    kinds = (np.int64, float, np.int64, np.int64, float)
    flat = [np.array(c, k) for c, k in zip(zip(*nodes, strict=True), kinds, strict=True)]
    return Trees(bias, np.array(roots), *flat, depth)


def _loss(g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a node of gradient sum g and Hessian sum h loses at the value w."""
    return g * w + 0.5 * (h + LAMBDA) * w * w


def _constant(bias: float) -> Trees:
    """One leaf alone."""
    zero = np.zeros(1, np.int64)
    return Trees(bias, zero, zero, np.zeros(1), zero, zero, np.zeros(1), 0)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Trees:
    """Learn from at most ``SAMPLE`` labelled rows outside the held-out fold.

    An id's labels are averaged; null labels, null ids and unknown ids teach nothing.
    Without any label every text scores 1, and with labels of one kind that kind's
    smoothed share.
    """
    known = (
        labels.where(column(label_col).isNotNull() & column(id_col).isNotNull())
        .groupBy(column(id_col).alias("id"))
        .agg((F.avg(column(label_col)) >= 0.5).cast("double").alias("label"))
        .where(fold(F.col("id"), FOLDS) != HELD_OUT)
    )
    chosen = known.orderBy(F.xxhash64("id", F.lit(12)), "id").limit(SAMPLE)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t)[1] for t in texts])

    texts = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    # at most SAMPLE rows of an id and a number go to the texts, so that no text is shuffled.
    # Copies of an id teach once; the driver gets numbers only
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", features("text").alias("x"))
    found = rows.groupBy("id").agg(F.first("label").alias("label"), F.min("x").alias("x")).toPandas()
    if not len(found):
        return _constant(35.0)
    found = found.sort_values("id")
    y = found["label"].to_numpy(float)
    ones = y.sum()
    if ones in (0, len(y)):
        return _constant(float(np.log((ones + 0.5) / (len(y) - ones + 0.5))))
    return grow(np.stack(found["x"].to_numpy()).astype(float), y, list(FEATURES.values()))


def score(docs: DataFrame, trees: Trees, text_col: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with one more column, a struct of the counts and the score of the whole text."""
    kind = ", ".join(f"{c} long" for c in COUNTS) + ", score double"

    @F.pandas_udf(kind)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [statistics(t) for t in texts]
            made = pd.DataFrame([f[0] for f in found], columns=list(COUNTS))
            x = np.array([f[1] for f in found], float).reshape(len(found), len(FEATURES))
            parts = [trees.score(x[k : k + 2048]) for k in range(0, len(x), 2048)]
            yield made.assign(score=np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out, scored(column(text_col)))


def assess(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``score`` and ``kept`` for every row of ``docs``.

    Counts are of words between ASCII blanks: their number and code points, symbols,
    lines equal to an earlier one, and words in three-word windows that occur again.
    base_failed: under 50 words, or over half of them in such windows. kept: not
    base_failed, and the trees score 0.5 or more. A null or empty text has no words and
    so fails. Repeated rows and ids keep all their rows, a null id too. An empty table
    gives an empty table. Other columns are left out, whatever they are called.
    """
    out = fresh(docs, "quality")
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, out)
    stats = scored.select(column(id_col).alias("id"), f"`{out}`.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (F.col("score") >= THRESHOLD)
    return stats.select(
        F.col("id").alias(id_col), *COUNTS, failed.alias("base_failed"), "score", kept.alias("kept")
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that :func:`assess` keeps, with their own columns."""
    out = fresh(docs, "quality")
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, out)
    q = column(out)
    failed = (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED * q["n_words"])
    return scored.where(~failed & (q["score"] >= THRESHOLD)).select(*[column(c) for c in docs.columns])
