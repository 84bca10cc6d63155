"""Boosted trees against trees grown row by row in plain Python."""

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.operators import boosting

KIND = "time timestamp_ntz, station string, rideable_type string, a double, b int, fold int, y double"
NAMES, CATEGORIES = ["station", "a", "b"], ["station"]


def draw_rows(n=400, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        station = draw.choice(["x", "y", "z", "w", None])
        a = draw.choice([None, float("nan"), *[k / 2 for k in range(8)]])
        b = draw.choice([None, 0, 1, 2, 3])
        known = a is not None and a == a
        y = {"x": 3, "y": -2, "z": 3, "w": -1, None: 0}[station] + (a if known else 5) * (b or -1) + draw.gauss(0, 0.1)
        rows.append((station, a if known else None, b, y, draw.randrange(3), a))
    return rows


@pytest.fixture(scope="module")
def rows():
    return draw_rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    made = [
        (start + timedelta(minutes=i), r[0], "t", r[5], r[2], r[4], r[3]) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(made, KIND).repartition(3)


def gain(g, h):
    return sum(g) ** 2 / (h + 1)


def candidates(rows, values):
    """All splits: a test for the left side, by input, cut and side of the missing."""
    for f in range(3):
        seen = {r[f] for r in rows} - {None}
        if f == 0:
            mean = lambda v: np.mean([g for r, g in zip(rows, values, strict=True) if r[0] == v])
            order = sorted(seen, key=mean)
        else:
            order = sorted(seen)
        for left_missing in (False, True):
            for k in range(1, len(order) + 1):
                yield f, set(order[:k]), left_missing


def grow(rows, g, depth):
    """A leaf's value, or (input, values to the left, side of the missing, left, right)."""
    leaf = -sum(g) / (len(g) + 1)
    best, chosen = boosting.LEAST_GAIN, None
    if depth:
        for f, left, missing in candidates(rows, g):
            goes = [missing if r[f] is None else r[f] in left for r in rows]
            if not 0 < sum(goes) < len(goes):
                continue
            a, b = ([x for x, l in zip(g, goes, strict=True) if l is side] for side in (True, False))
            found = 0.5 * (gain(a, len(a)) + gain(b, len(b)) - gain(g, len(g)))
            if found > best + 1e-9:
                best, chosen = found, (f, left, missing, goes)
    if chosen is None:
        return leaf
    f, left, missing, goes = chosen
    if all(r[f] is not None for r in rows):
        missing = 2 * sum(goes) >= len(goes)
    sides = [[(r, x) for r, x, l in zip(rows, g, goes, strict=True) if l is side] for side in (True, False)]
    # categories that the node has not seen go with the missing
    seen = {r[f] for r in rows} if f == 0 else None
    return f, left, missing, seen, *[grow([r for r, _ in s], [x for _, x in s], depth - 1) for s in sides]


def walk(tree, row):
    while isinstance(tree, tuple):
        f, left, missing, seen, yes, no = tree
        unknown = row[f] is None or seen is not None and row[f] not in seen
        tree = yes if (missing if unknown else row[f] in left if f == 0 else row[f] <= max(left)) else no
    return tree


def plain(rows, asked, rounds, depth, rate):
    base = np.mean([r[3] for r in rows])
    own, out = np.full(len(rows), base), np.full(len(asked), base)
    for _ in range(rounds):
        tree = grow(rows, [p - r[3] for p, r in zip(own, rows, strict=True)], depth)
        own += [rate * walk(tree, r) for r in rows]
        out += [rate * walk(tree, r) for r in asked]
    return out


def predictions(model, table):
    found = boosting.score(model, table).orderBy("time").select("prediction").collect()
    return [r["prediction"] for r in found]


def fit(table, **options):
    return boosting.fit_boosted(table, names=NAMES, categories=CATEGORIES, target="y", **options)


def test_equals_plain_python(table, rows):
    model = fit(table, rounds=3, depth=3, rate=0.5)
    assert predictions(model, table) == pytest.approx(list(plain(rows, rows, 3, 3, 0.5)))


def test_splits_found_in_tasks_are_the_same(table, monkeypatch):
    here = predictions(fit(table, rounds=2, depth=3, rate=0.5), table)
    monkeypatch.setattr(boosting, "DRIVER_SUMS", 0)
    # sums come in another order
    assert predictions(fit(table, rounds=2, depth=3, rate=0.5), table) == pytest.approx(here)


def test_predictions_stored_between_rounds(table, rows, monkeypatch):
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    model = fit(table, rounds=5, depth=2, rate=0.3)
    assert predictions(model, table) == pytest.approx(list(plain(rows, rows, 5, 2, 0.3)))


def test_predictions_stored_every_round_of_many_rows(table, rows, monkeypatch):
    monkeypatch.setattr(boosting, "STORED_ROWS", 10)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 7)
    stored, calls = boosting._stored, []
    monkeypatch.setattr(boosting, "_stored", lambda *args: calls.append(1) or stored(*args))
    model = fit(table, rounds=4, depth=2, rate=0.3)
    assert len(calls) == 3
    assert predictions(model, table) == pytest.approx(list(plain(rows, rows, 4, 2, 0.3)))


def test_rows_of_one_file_are_dealt_to_all_tasks(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "TASK_ROWS", 16)
    grow, parts = boosting._grow_round, []

    def watched(blocks, *args):
        sizes = [sum(len(r["y"]) // 8 for r in part) for part in blocks.rdd.glom().collect()]
        parts.append([n for n in sizes if n])
        return grow(blocks, *args)

    monkeypatch.setattr(boosting, "_grow_round", watched)
    fit(table.coalesce(1), rounds=1, depth=1)
    assert sum(parts[0]) == 400 and len(parts[0]) == spark.sparkContext.defaultParallelism


def test_a_task_sends_each_sum_once():
    inputs = boosting.Inputs(("a", "b"), ((1.0, 2.0), (5.0,)), (None, None))
    forest = boosting._Forest([boosting.Setting(1, 1)], [0.0], inputs)
    forest.trees, forest.open = [[boosting.Tree.root(inputs.width)]], {0: [0]}
    arrays = (np.array([1.0, 2.0]), np.array([-1, -1], "<i4"), np.array([[0, 1], [2, 1]], "<u2"), np.zeros((2, 1)))
    block = boosting.pa.RecordBatch.from_arrays([boosting.pa.array([a.tobytes()]) for a in arrays], names=boosting.BLOCK)
    for held, n in ((True, 3), (False, 9)):
        found = boosting.pd.concat(forest.sums(iter([block] * 3), held))
        assert len(found) == n
        merged = found.groupby(["feature", "bin"])[["g", "n"]].sum()
        assert merged.to_dict("index") == {
            (0, 0): {"g": -3.0, "n": 3}, (0, 2): {"g": -6.0, "n": 3}, (1, 1): {"g": -9.0, "n": 6},
        }


def test_every_row_is_scored(spark, table):
    model = fit(table, rounds=2, depth=2)
    asked = table.limit(1).select("time", "rideable_type", "fold", "y").crossJoin(
        spark.createDataFrame([("new", 1.0, 1), (None, None, None), ("x", float("nan"), 99)], "station string, a double, b int")
    )
    scored = boosting.score(model, asked)
    assert scored.where("prediction IS NOT NULL").count() == 3
    assert boosting.score(model, table.limit(0)).count() == 0


def test_save_and_load(spark, table, tmp_path):
    model = fit(table, rounds=3, depth=3)
    model.save(spark, str(tmp_path / "model"))
    again = boosting.load(spark, str(tmp_path / "model"))
    assert again.inputs == model.inputs and again.setting == model.setting
    assert predictions(again, table) == predictions(model, table)


def test_targets_that_are_missing_and_no_rows(table):
    gone = table.withColumn("y", F.when(F.col("b") == 0, F.col("y")))
    assert predictions(fit(gone, rounds=1, depth=1), table) == pytest.approx(
        predictions(fit(table.where("b = 0"), rounds=1, depth=1), table)
    )
    none = fit(table.withColumn("y", F.lit(None).cast("double")), rounds=1, depth=2)
    assert set(predictions(none, table)) == {0.0}


def test_importance(spark, table):
    found = boosting.importance(fit(table, rounds=3, depth=3), spark).collect()
    assert {r["feature"] for r in found} == set(NAMES)
    assert sum(r["importance"] for r in found) == pytest.approx(1) and found[-1]["importance"] > 0


def test_settings_and_folds_grow_together(table, rows):
    settings = [boosting.Setting(2, 2, 0.5, 0), boosting.Setting(3, 1, 0.2, 1), boosting.Setting(1, 3, 0.5, None)]
    made = boosting.fit_many(table, settings, names=NAMES, categories=CATEGORIES, target="y")
    for s, model in zip(settings, made, strict=True):
        own = [r for r in rows if r[4] != s.without_fold]
        assert len(model.trees) == s.rounds
        assert predictions(model, table) == pytest.approx(list(plain(own, rows, s.rounds, s.depth, s.rate)))


def test_search(table, rows, monkeypatch):
    options = {"names": NAMES, "categories": CATEGORIES, "target": "y"}
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    settings = [boosting.Setting(4, 2, 0.5), boosting.Setting(4, 1, 0.01), boosting.Setting(2, 3, 0.5)]
    monkeypatch.setattr(boosting, "ordered_folds", _folds_by_time)
    model, tried = boosting.search(table, settings, folds=2, rungs=(2,), keep=0.5, **options)
    found = {r["draw"]: r for r in tried.collect()}
    assert (found[0]["grown"], found[1]["grown"], found[2]["grown"]) == (4, 2, 2)
    assert [i for i, r in found.items() if r["is_best"]] == [min(found, key=lambda i: found[i]["mse"])]
    for i, s in enumerate(settings):
        errors = []
        for fold in range(2):
            own = rows[200:] if fold == 0 else rows[:200]
            held = rows[:200] if fold == 0 else rows[200:]
            p = plain(own, held, found[i]["grown"], s.depth, s.rate)
            errors.append(np.mean([(x - r[3]) ** 2 for x, r in zip(p, held, strict=True)]))
        assert found[i]["mse"] == pytest.approx(np.mean(errors))
    best = next(i for i, r in found.items() if r["is_best"])
    s = settings[best]
    assert predictions(model, table) == pytest.approx(list(plain(rows, rows, s.rounds, s.depth, s.rate)))


def _folds_by_time(df, folds):
    """Two halves by time, as ordered_folds makes them of rows without ties."""
    middle = df.selectExpr("timestampadd(MINUTE, 200, min(time)) AS m").first()["m"]
    return df.withColumn("fold", (F.col("time") >= F.lit(middle)).cast("int"))


def test_tasks_get_no_trees_that_are_stored():
    inputs = boosting.Inputs(("a",), (tuple(map(float, range(200))),), (None,))
    sizes = []
    for stored in (0, 50):
        forest = boosting._Forest([boosting.Setting()], [0.0], inputs)
        for k in range(stored + 2):
            tree = boosting.Tree.root(inputs.width)
            tree.value[0] = k
            forest.trees[0].append(tree)
        forest.stored = stored
        sent = pickle.dumps(forest)
        sizes.append(len(sent))
        x, raw = np.zeros((3, 1), np.int32), np.ones((3, 1))
        found = pickle.loads(sent).predicted(0, x, raw, stored + 2)
        assert found.tolist() == forest.predicted(0, x, raw, stored + 2).tolist()
        assert len(forest.trees[0]) == stored + 2 and None not in forest.trees[0]
    assert sizes[1] < sizes[0] + 200
