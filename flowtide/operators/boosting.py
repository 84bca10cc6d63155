"""Boosted regression trees with second-order gains, for inputs that may be missing.

Inputs are cut into bins once, and the rows dealt evenly to as many tasks as there are
cores, in blocks: a level reads all of them and would else spend its time on unpacking rows. A level of all trees that grow is one Spark aggregate: tasks walk their rows down
the trees that their predictions do not hold yet and add up gradients and Hessians by
node, input and bin; Spark merges these sums, and the best split of every node is found
where the node's sums are: in a task, or on the driver while nodes and bins bound their
number. So bounded, a task holds its sums too, and sends each once. Many models (settings
and folds of a search) grow in the same passes, with the model as one more key.

A missing input is a bin of its own, tried on both sides of every cut. The categories of
a node are put in the order of their gradients and cut like numbers, so that a split
is a set of categories. No row is left unscored because an input is missing.
"""

import json
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.constants import (
    CATEGORICAL_FEATURES,
    GBT_DEPTH,
    GBT_RATE,
    GBT_ROUNDS,
    MODEL_INPUTS,
    SEARCH_DEPTHS,
    SEARCH_DRAWS,
    SEARCH_FOLDS,
    SEARCH_RATES,
    SEARCH_ROUNDS,
    SEED,
    TARGET,
)
from flowtide.operators.split import ordered_folds
from flowtide.session import drop_table, materialize, scratch, write_table

BINS = 256
PENALTY = 1.0  # on the square of a leaf's value
LEAST_GAIN = 1e-6
#: Sums of a level, by what its nodes and bins allow at most, that a task may hold and the driver
#: search for splits itself; beyond that tasks send sums by block of rows, and each node is
#: searched in a task, by the same function.
DRIVER_SUMS = 1 << 20
STORED_EVERY = 10  # rounds after which the predictions so far are written
TASK_ROWS = 1 << 14  # fewer are not worth another task
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 18  # a block has no more than either
#: Rows a task from which every round's predictions are written: walking its tree again on every
#: level of the rounds after it costs more.
STORED_ROWS = 1 << 16


@dataclass(frozen=True)
class Inputs:
    """How the inputs are cut: ``cuts`` of a number, the values of a category."""

    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...] | None, ...]
    kinds: tuple[tuple[str, ...] | None, ...]

    @property
    def width(self) -> int:
        """Bins of an input; the last one is for what is missing or was not seen."""
        sizes = [len(k) if k is not None else len(c) + 1 for c, k in zip(self.cuts, self.kinds, strict=True)]
        return max(sizes) + 1

    def bins(self, rows: pd.DataFrame) -> np.ndarray:
        """A row of bins for every row: bin b of a number holds values up to cut b."""
        found = np.empty((len(rows), len(self.names)), np.int32)
        for f, name in enumerate(self.names):
            if self.kinds[f] is not None:
                place = {v: i for i, v in enumerate(self.kinds[f])}
                found[:, f] = [place.get(v, self.width - 1) for v in rows[name]]
            else:
                values = rows[name].to_numpy(float)
                binned = np.searchsorted(np.array(self.cuts[f]), values, side="left")
                found[:, f] = np.where(np.isnan(values), self.width - 1, binned)
        return found


@dataclass
class Tree:
    """Nodes in flat arrays; a leaf is its own child. ``goes_left`` is by node and bin."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    goes_left: np.ndarray

    @classmethod
    def root(cls, width: int) -> "Tree":
        zero = np.zeros(1, np.int64)
        return cls(zero, zero.copy(), zero.copy(), np.zeros(1), np.zeros(1), np.zeros((1, width), bool))

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of bins."""
        at, first, x = np.zeros(len(x), np.int64), np.arange(len(x)) * x.shape[1], x.ravel()
        width, goes_left = self.goes_left.shape[1], self.goes_left.ravel()
        while True:
            left = goes_left.take(at * width + x.take(first + self.feature.take(at)))
            after = np.where(left, self.left.take(at), self.right.take(at))
            if (after == at).all():
                return at
            at = after

    def split(self, splits: pd.DataFrame, penalty: float) -> list[int]:
        """Grow two children under every node of ``splits``. Returns the children."""
        first = len(self.feature)
        n = len(splits)
        children = np.arange(first, first + 2 * n)
        parents = splits["node"].to_numpy()
        self.feature[parents] = splits["feature"]
        self.left[parents], self.right[parents] = children[::2], children[1::2]
        self.gain[parents] = splits["gain"]
        self.goes_left[parents] = np.stack(splits["goes_left"]) if n else False
        sums = splits[["gl", "nl", "gr", "nr"]].to_numpy().reshape(-1, 2)
        self.feature = np.r_[self.feature, np.zeros(2 * n, np.int64)]
        self.left, self.right = np.r_[self.left, children], np.r_[self.right, children]
        self.value = np.r_[self.value, -sums[:, 0] / (sums[:, 1] + penalty)]
        self.gain = np.r_[self.gain, np.zeros(2 * n)]
        self.goes_left = np.r_[self.goes_left, np.zeros((2 * n, self.goes_left.shape[1]), bool)]
        return [int(c) for c, rows in zip(children, sums[:, 1], strict=True) if rows > 1]


@dataclass(frozen=True)
class Setting:
    rounds: int = GBT_ROUNDS
    depth: int = GBT_DEPTH
    rate: float = GBT_RATE
    without_fold: int | None = None


@dataclass
class BoostedTrees:
    """A fitted model: :func:`score` applies it, :meth:`save` and :func:`load` keep it."""

    inputs: Inputs
    setting: Setting
    base: float
    trees: list[Tree]

    def predict(self, rows: pd.DataFrame) -> np.ndarray:
        x = self.inputs.bins(rows)
        return self.base + self.setting.rate * sum((t.value[t.nodes(x)] for t in self.trees), np.zeros(len(x)))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the nodes as a table, one row each, and the rest beside it."""
        rows = [
            (t, n, int(tree.feature[n]), int(tree.left[n]), int(tree.right[n]), float(tree.value[n]),
             float(tree.gain[n]), tree.goes_left[n].tolist())
            for t, tree in enumerate(self.trees)
            for n in range(len(tree.feature))
        ]
        kind = "tree int, node int, feature int, left int, right int, value double, gain double, goes_left array<boolean>"
        spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{path}/nodes")
        rest = {"inputs": self.inputs.__dict__, "setting": self.setting.__dict__, "base": self.base}
        spark.createDataFrame([(json.dumps(rest),)], "model string").write.mode("overwrite").parquet(f"{path}/model")


def load(spark: SparkSession, path: str) -> BoostedTrees:
    rest = json.loads(spark.read.parquet(f"{path}/model").first()["model"])
    nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
    trees = [
        Tree(*(own[c].to_numpy() for c in ("feature", "left", "right", "value", "gain")), np.stack(own["goes_left"]))
        for _, own in nodes.groupby("tree")
    ]
    fixed = {k: tuple(tuple(p) if p is not None else None for p in v) for k, v in rest["inputs"].items() if k != "names"}
    inputs = Inputs(tuple(rest["inputs"]["names"]), **fixed)
    return BoostedTrees(inputs, Setting(**rest["setting"]), rest["base"], trees)


def learn_inputs(
    features: DataFrame, names: Sequence[str] = MODEL_INPUTS, categories: Sequence[str] = CATEGORICAL_FEATURES,
    bins: int = BINS,
) -> Inputs:
    """Cut the inputs: numbers at up to ``bins`` quantiles, each category by itself.

    One aggregate. The driver gets the cuts and the distinct categories.
    """
    shares = [i / bins for i in range(1, bins)]
    asked = []
    for name in names:
        if name in categories:
            asked.append(F.sort_array(F.collect_set(F.col(name).cast("string"))).alias(name))
        else:
            number = F.col(name).cast("double")
            asked.append(F.percentile_approx(F.when(~F.isnan(number), number), shares, 100 * bins).alias(name))
    found = features.agg(*asked).first()
    cuts = tuple(None if n in categories else tuple(sorted(set(found[n] or []))) for n in names)
    kinds = tuple(tuple(found[n]) if n in categories else None for n in names)
    return Inputs(tuple(names), cuts, kinds)


def _input_columns(inputs: Inputs) -> list:
    kind = {n: "double" if c is not None else "string" for n, c in zip(inputs.names, inputs.cuts, strict=True)}
    return [F.col(n).cast(kind[n]).alias(n) for n in inputs.names]


def _binned(features: DataFrame, inputs: Inputs, target: str, models: int) -> DataFrame:
    """Blocks of the rows with a target: ``y, fold, x, raw``, their bins and the models' predictions.

    Dealt evenly: how the rows lie, a file a series, does not bound the tasks of a level.
    """
    kind = _bin_type(inputs)
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (12 + 4 * len(inputs.names) + 8 * models)))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), size):
                rows = batch[start : start + size]
                x, raw = inputs.bins(rows).astype(kind), np.zeros((len(rows), models))
                # a row of no fold is left out of none
                fold = rows["fold"].fillna(-1).to_numpy("<i4")
                yield pd.DataFrame([[a.tobytes() for a in (rows["y"].to_numpy("<f8"), fold, x, raw)]], columns=BLOCK)

    fold = F.col("fold").cast("int") if "fold" in features.columns else F.lit(-1)
    rows = features.where(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("y"), fold.alias("fold"), *_input_columns(inputs)
    )
    most = -(-rows.count() // TASK_ROWS) or 1
    dealt = rows.repartition(min(most, features.sparkSession.sparkContext.defaultParallelism))
    return dealt.mapInPandas(cut, _BLOCKS)


BLOCK = ["y", "fold", "x", "raw"]
_BLOCKS = ", ".join(f"{c} binary" for c in BLOCK)


def _bin_type(inputs: Inputs) -> str:
    return "<u2" if inputs.width <= 1 << 16 else "<i4"


_SUMS = "model int, node int, feature int, bin int, g double, n bigint"
_SPLITS = (
    "model int, node int, gain double, feature int, goes_left array<boolean>, gl double, nl bigint, gr double, nr bigint"
)


class _Forest:
    """All models while they grow, as the tasks see them."""

    def __init__(self, settings: list[Setting], bases: list[float], inputs: Inputs):
        self.settings, self.inputs = settings, inputs
        self.bases = np.array(bases)
        self.trees: list[list[Tree]] = [[] for _ in settings]
        self.stored = 0  # trees of every model that ``raw`` holds
        self.open: dict[int, list[int]] = {}  # of the tree that grows: nodes to be split

    def __getstate__(self) -> dict:
        """Tasks get only trees that the stored predictions lack, so what a level sends does not grow with the rounds."""
        trees = [[None] * min(self.stored, len(own)) + own[self.stored :] for own in self.trees]
        return self.__dict__ | {"trees": trees}

    def cells(self, model: int) -> int:
        """The most sums that a level of the model has."""
        return len(self.open[model]) * len(self.inputs.names) * self.inputs.width

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        """``y, fold, x, raw`` of one block after the other."""
        kinds = ("<f8", "<i4", _bin_type(self.inputs), "<f8")
        for batch in batches:
            for block in zip(*(batch.column(c) for c in BLOCK), strict=True):
                y, fold, x, raw = (np.frombuffer(b.as_buffer(), k) for b, k in zip(block, kinds, strict=True))
                yield [y, fold, x.reshape(len(y), -1).astype(np.int32), raw.reshape(len(y), -1)]

    def predicted(self, model: int, x: np.ndarray, raw: np.ndarray, upto: int) -> np.ndarray:
        """What the model's first ``upto`` trees predict."""
        later = self.trees[model][self.stored : upto]
        made = sum((t.value[t.nodes(x)] for t in later), np.zeros(len(x)))
        return raw[:, model] + self.settings[model].rate * made

    def sums(self, batches: Iterator[pa.RecordBatch], held: bool) -> Iterator[pd.DataFrame]:
        """Gradients of the squared error by model, node, input and bin; Hessians are 1.

        ``held``: one sum of a kind for all blocks, else for each.
        """
        inputs, width = len(self.inputs.names), self.inputs.width
        if held:
            total = {m: (np.zeros(self.cells(m)), np.zeros(self.cells(m), np.int64)) for m in self.open}
        for y, fold, all_x, raw in self.blocks(batches):
            for model, nodes in self.open.items():
                own = np.flatnonzero(fold != self.settings[model].without_fold)
                x, tree = all_x[own], self.trees[model][-1]
                place = np.full(len(tree.feature), -1)
                place[nodes] = np.arange(len(nodes))
                at = place[tree.nodes(x)]
                live = np.flatnonzero(at >= 0)
                before = len(self.trees[model]) - 1
                g = self.bases[model] + self.predicted(model, x[live], raw[own[live]], before) - y[own[live]]
                keys = ((at[live, None] * inputs + np.arange(inputs)) * width + x[live]).ravel()
                if held:
                    gradients, rows = total[model]
                    gradients += np.bincount(keys, np.repeat(g, inputs), len(rows))
                    rows += np.bincount(keys, minlength=len(rows))
                elif len(keys):
                    keys, where = np.unique(keys, return_inverse=True)
                    yield self.summed(model, keys, np.bincount(where, np.repeat(g, inputs)), np.bincount(where))
        if held:
            for model, (gradients, rows) in total.items():
                keys = np.flatnonzero(rows)
                yield self.summed(model, keys, gradients[keys], rows[keys])

    def summed(self, model: int, keys: np.ndarray, g: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        inputs, width = len(self.inputs.names), self.inputs.width
        nodes = np.array(self.open[model])[keys // (inputs * width)]
        return pd.DataFrame(
            {"model": model, "node": nodes, "feature": keys // width % inputs, "bin": keys % width, "g": g, "n": n}
        )

    def best_split(self, sums: pd.DataFrame, penalty: float) -> pd.DataFrame:
        """The split of one node with the largest gain: a row, with no gain if there is none."""
        width, inputs = self.inputs.width, self.inputs
        g, n = np.zeros((len(inputs.names), width)), np.zeros((len(inputs.names), width), np.int64)
        g[sums["feature"], sums["bin"]], n[sums["feature"], sums["bin"]] = sums["g"], sums["n"]
        all_g, all_n = g[0].sum(), int(n[0].sum())
        loss = lambda a, b: a * a / (b + penalty)
        best = (0.0, 0, [False] * width, 0.0, 0)
        for f, kinds in enumerate(inputs.kinds):
            order = np.arange(width - 1)
            if kinds is not None:
                seen = np.flatnonzero(n[f, :-1])
                order = seen[np.argsort(g[f, seen] / n[f, seen], kind="stable")]
            gl, nl = g[f, order].cumsum(), n[f, order].cumsum()
            for missing_left in (False, True):
                a, b = gl + missing_left * g[f, -1], nl + missing_left * n[f, -1]
                if not len(a):
                    continue
                with np.errstate(invalid="ignore"):
                    gain = 0.5 * (loss(a, b) + loss(all_g - a, all_n - b) - loss(all_g, all_n))
                gain = np.where((b > 0) & (b < all_n), gain, -np.inf)
                k = int(gain.argmax())
                # a gain by rounding alone does not count
                if gain[k] > best[0] + LEAST_GAIN:
                    side = missing_left if n[f, -1] else 2 * b[k] >= all_n
                    goes_left = np.full(width, bool(side))
                    goes_left[order] = np.arange(len(order)) <= k
                    best = (float(gain[k]), f, goes_left.tolist(), float(a[k]), int(b[k]))
        gain, f, goes_left, a, b = best
        key = {c: sums[c].iloc[0] for c in ("model", "node")}
        row = key | {"gain": gain, "feature": f, "goes_left": goes_left, "gl": a, "nl": b, "gr": all_g - a, "nr": all_n - b}
        return pd.DataFrame([row])


def _grow_round(table: DataFrame, forest: _Forest, number: int, penalty: float, alive: Sequence[int]) -> None:
    """One more tree for every model that has rounds left."""
    growing = [m for m in alive if forest.settings[m].rounds > number]
    for m in growing:
        forest.trees[m].append(Tree.root(forest.inputs.width))
    forest.open = {m: [0] for m in growing}
    level = 0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in forest.sums(batches, few):
            yield pa.RecordBatch.from_pandas(found.astype(_SUM_TYPES), preserve_index=False)

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        return forest.best_split(rows, penalty)

    while forest.open:
        few = sum(map(forest.cells, forest.open)) <= DRIVER_SUMS
        partial = table.mapInArrow(sums, _SUMS)
        merged = partial.groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        if few:
            nodes = merged.toArrow().to_pandas().groupby(["model", "node"])
            found = pd.concat([best(own) for _, own in nodes]) if len(nodes) else pd.DataFrame(columns=["model", "node"])
        else:
            found = merged.groupBy("model", "node").applyInPandas(best, _SPLITS).toPandas()
        level += 1
        following = {}
        for m, own in found.sort_values("node").groupby("model"):
            tree = forest.trees[m][-1]
            if level == 1:
                root = own.iloc[0]
                tree.value[0] = -(root["gl"] + root["gr"]) / (root["nl"] + root["nr"] + penalty)
            children = tree.split(own[own["gain"] > 0], penalty)
            if children and level < forest.settings[m].depth:
                following[int(m)] = children
        forest.open = following


_SUM_TYPES = {"model": "int32", "node": "int32", "feature": "int32", "bin": "int32", "g": "float64", "n": "int64"}


def _stored(spark: SparkSession, path: str, forest: _Forest) -> str:
    """The table with all trees so far added to the predictions; the one before goes."""
    upto = max(map(len, forest.trees))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, fold, x, raw in forest.blocks(batches):
            made = np.stack([forest.predicted(m, x, raw, upto) for m in range(len(forest.settings))], axis=1)
            block = (y, fold, x.astype(_bin_type(forest.inputs)), made)
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in block], names=BLOCK)

    table = spark.read.parquet(path)
    after = write_table(table.mapInArrow(add, _BLOCKS), "boosting")
    drop_table(spark, path)
    forest.stored = upto
    return after


def _bases(rows: DataFrame, target: str, settings: list[Setting]) -> list[float]:
    """The mean target of every model's rows."""
    y, fold = F.col(target).cast("double"), F.col("fold").cast("int") if "fold" in rows.columns else F.lit(-1)
    by_fold = rows.groupBy(fold.alias("fold")).agg(F.sum(y).alias("s"), F.count(y).alias("n"))
    of = {r["fold"]: (r["s"], r["n"]) for r in by_fold.collect()}
    bases = []
    for s in settings:
        sums = [v for fold, v in of.items() if fold != s.without_fold]
        bases.append(sum(a for a, _ in sums) / max(sum(n for _, n in sums), 1))
    return bases


def held_out_errors(table: DataFrame, forest: _Forest) -> dict[int, float]:
    """Mean squared error of every model on the fold that it has not seen."""

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, fold, _, raw in forest.blocks(batches):
            for m, s in enumerate(forest.settings):
                own = fold == s.without_fold
                if own.any():
                    e = y[own] - (forest.bases[m] + raw[own, m])
                    yield pa.RecordBatch.from_pydict({"model": [m], "s": [float(e @ e)], "n": [len(e)]})

    sums = table.mapInArrow(errors, "model bigint, s double, n bigint").groupBy("model")
    found = sums.agg((F.sum("s") / F.sum("n")).alias("mse"))
    return {r["model"]: r["mse"] for r in found.collect()}


def fit_many(
    features: DataFrame, settings: Sequence[Setting], names: Sequence[str] = MODEL_INPUTS,
    categories: Sequence[str] = CATEGORICAL_FEATURES, target: str = TARGET, bins: int = BINS,
    penalty: float = PENALTY, on_stored=None,
) -> list[BoostedTrees]:
    """Fit all settings in the same passes over ``features``.

    Rows without a target teach nothing; a setting leaves out the rows of its own fold
    (column ``fold``). No rows give trees of one leaf that predict 0. ``on_stored(table,
    forest, rounds)`` may look at the predictions whenever they are written, and returns
    the models that go on.
    """
    spark, settings = features.sparkSession, list(settings)
    used = dict.fromkeys([*names, target, *(["fold"] if "fold" in features.columns else [])])
    known = write_table(features.where(F.col(target).isNotNull()).select(*used), "boosting-rows")
    rows = spark.read.parquet(known)
    inputs = learn_inputs(rows, names, categories, bins)
    path = write_table(_binned(rows, inputs, target, len(settings)), "boosting")
    every_round = rows.count() > STORED_ROWS * spark.sparkContext.defaultParallelism
    forest = _Forest(settings, _bases(rows, target, settings), inputs)
    drop_table(spark, known)
    alive: Sequence[int] = range(len(settings))
    most = max(s.rounds for s in settings)
    for number in range(most):
        if not any(settings[m].rounds > number for m in alive):
            break
        _grow_round(spark.read.parquet(path), forest, number, penalty, alive)
        last = number + 1 == most
        due = (number + 1) % STORED_EVERY == 0 and not last or last and on_stored
        if due or every_round and not last:
            path = _stored(spark, path, forest)
            if due and on_stored:
                alive = on_stored(spark.read.parquet(path), forest, number + 1)
    drop_table(spark, path)
    return [BoostedTrees(inputs, s, float(b), t) for s, b, t in zip(settings, forest.bases, forest.trees, strict=True)]


def fit_boosted(features: DataFrame, rounds: int = GBT_ROUNDS, depth: int = GBT_DEPTH, rate: float = GBT_RATE, **options):
    """One model on all rows that have a target. The defaults are the registered model's."""
    return fit_many(features.drop("fold"), [Setting(rounds, depth, rate)], **options)[0]


def score(model: BoostedTrees, features: DataFrame, out: str = "prediction") -> DataFrame:
    """``features`` with a prediction for every row, whatever inputs it lacks."""

    @F.pandas_udf("double")
    def predicted(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(model.predict(rows))

    return features.withColumn(out, predicted(F.struct(*_input_columns(model.inputs))))


def importance(model: BoostedTrees, spark: SparkSession) -> DataFrame:
    """Share of the model's gain per input, largest first."""
    gains = np.zeros(len(model.inputs.names))
    for tree in model.trees:
        np.add.at(gains, tree.feature, tree.gain)
    shares = gains / gains.sum() if gains.sum() else gains
    rows = list(zip(model.inputs.names, map(float, shares), strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def draw_settings(
    draws: int = SEARCH_DRAWS, rounds=SEARCH_ROUNDS, depths=SEARCH_DEPTHS, rates=SEARCH_RATES, seed: int = SEED
) -> list[Setting]:
    """Random settings: rounds and depths below their upper bound, rates up to it."""
    draw = random.Random(seed)
    return [Setting(draw.randrange(*rounds), draw.randrange(*depths), draw.uniform(*rates)) for _ in range(draws)]


def search(
    features: DataFrame, settings: Sequence[Setting] | None = None, folds: int = SEARCH_FOLDS, keep: float = 1 / 3,
    rungs: Sequence[int] = (10, 30), **options,
) -> tuple[BoostedTrees, DataFrame]:
    """The best of ``settings`` by mean squared error over ``folds`` folds, fitted on all rows.

    Folds are contiguous blocks of rows in time order; ``features`` has its ``time``. All
    settings and folds grow together. After each of the ``rungs`` (multiples of 10 rounds)
    only the best ``keep`` of the settings still growing go on, with those that have
    ended; ``keep=1`` lets all of them finish. Returns the model and a table of all
    settings with the rounds they were grown for and their error then.
    """
    settings = list(settings if settings is not None else draw_settings())
    spark = features.sparkSession
    errors: dict[int, tuple[int, float]] = {}

    def judge(table: DataFrame, forest: _Forest, rounds: int) -> list[int]:
        mse = held_out_errors(table, forest)
        growing = []
        for i, s in enumerate(settings):
            own = [mse[i * folds + k] for k in range(folds) if i * folds + k in mse]
            grown = len(forest.trees[i * folds])
            if own and (i not in errors or errors[i][0] < grown):
                errors[i] = (grown, float(np.mean(own)))
            if grown == rounds and s.rounds > rounds:
                growing.append(i)
        if rounds in rungs and growing:
            growing = sorted(growing, key=lambda i: (errors[i][1], i))[: max(1, round(keep * len(growing)))]
        return [i * folds + k for i in growing for k in range(folds)]

    with scratch(spark):
        stored = materialize(features, "search")
        blocks = materialize(ordered_folds(stored, folds), "folds")
        every = [Setting(s.rounds, s.depth, s.rate, k) for s in settings for k in range(folds)]
        fit_many(blocks, every, on_stored=judge, **options)
        best = min(errors, key=lambda i: (errors[i][1], i))
        model = fit_many(stored, [settings[best]], **options)[0]
    rows = [(i, s.rounds, s.depth, float(s.rate), *errors[i], i == best) for i, s in enumerate(settings)]
    kind = "draw int, rounds int, depth int, rate double, grown int, mse double, is_best boolean"
    return model, spark.createDataFrame(rows, kind)
