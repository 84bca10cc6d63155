"""Vector codes against Lloyd rounds that compare every part with every entry."""

import hashlib
from pathlib import Path

import numpy as np
import pytest

from flowtide.llm import ball_codes, queries

KIND = "vec_id long, embedding array<float>, label int, codes string, balls int, id long, error string"


def plain(vectors, parts=8, entries=16, rounds=6):
    """Codes and errors in the order of the rows, which is that of their ids; the codebooks."""
    cut = np.floor(4096 * np.asarray(vectors, float)).astype(np.int64).reshape(len(vectors), parts, -1)
    books = cut[:entries].swapaxes(0, 1).copy()
    for step in range(rounds + 1):
        apart = ((cut[:, :, None] - books[None]) ** 2).sum(axis=3)
        codes, errors = apart.argmin(axis=2), apart.min(axis=2).sum(axis=1)
        if step == rounds:
            return codes, errors, books
        for p in range(parts):
            for e in range(books.shape[1]):
                own = codes[:, p] == e
                if own.any():
                    books[p, e] = cut[own, p].sum(axis=0) // own.sum()


def table(spark, vectors, labels=None, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    labels = [i % 3 or None for i in range(len(vectors))] if labels is None else labels
    made = [
        (i, None if v is None else [None if x is None else float(x) for x in v], label, "c", 1, 5, "e")
        for i, v, label in zip(ids, vectors, labels, strict=True)
    ]
    return spark.createDataFrame(made, KIND)


def compare(found, vectors, labels):
    codes, errors, books = plain(vectors)
    found = found.toPandas().sort_values("vec_id")
    assert found["code"].tolist() == ["".join(f"{c:02x}" for c in row) for row in codes]
    assert found["error"].tolist() == errors.tolist()
    sums = {k: sum(e for e, o in zip(errors, labels, strict=True) if o == k) for k in set(labels)}
    assert found["label_error"].tolist() == [sums[k] for k in labels]
    written = ",".join(map(str, books.ravel().tolist()))
    assert set(found["codebooks_sha256"]) == {hashlib.sha256(written.encode()).hexdigest()}


@pytest.mark.parametrize("kind", ["noise", "clusters", "ties", "few", "equal"])
def test_equals_full_search(spark, kind):
    rng = np.random.default_rng(5)
    vectors = {
        "noise": lambda: rng.normal(size=(400, 32)),
        "clusters": lambda: rng.normal(size=(12, 32))[rng.integers(0, 12, 500)] + rng.normal(0, 0.02, (500, 32)),
        "ties": lambda: rng.integers(-2, 3, (600, 16)) / 4096,
        "few": lambda: rng.normal(size=(5, 8)),
        "equal": lambda: np.ones((40, 8)),
    }[kind]().astype(np.float32)
    labels = [i % 3 or None for i in range(len(vectors))]
    data = table(spark, vectors.tolist(), labels).repartition(3)
    compare(ball_codes.digest(data), vectors, labels)


def test_most_parts_need_no_full_search():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    codes = rng.integers(0, 16, 2000)
    x = centres[codes] + rng.integers(-50, 50, (2000, 8))
    radii = np.array([[int(((x[codes == e] - centres[e]) ** 2).sum(axis=1).max()) for e in range(16)]])
    balls = ball_codes.Balls.around(centres[None], centres[None] + 1, radii)
    assert sum(map(len, balls.neighbours[0])) == 0  # balls far apart have no neighbours
    assert ball_codes.Balls.around(centres[None], centres[None], radii).settled.all()
    at, errors = ball_codes.move(x, codes, balls, 0)
    assert (at == ball_codes.search(x, centres)[0]).all() and (errors == ball_codes.search(x, centres)[1]).all()


def test_rows_that_drop_out(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(40, 8)).astype(np.float32)
    bad = [None, [], [None] * 8, [float("nan")] * 8, [float("inf"), *[0.0] * 7], [1.0] * 16]
    labels = [i % 3 or None for i in range(40)]
    data = table(spark, [*good.tolist(), *bad], [*labels, *[1] * len(bad)], range(40 + len(bad)))
    compare(ball_codes.digest(data), good, labels)


def test_null_and_repeated_ids_and_empty_tables(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(20, 8)).astype(np.float32)
    data = table(spark, [*vectors.tolist(), *vectors.tolist()], [1] * 40, [*range(19), None] * 2)
    found = ball_codes.digest(data).toPandas()
    assert len(found) == 40 and found["vec_id"].isna().sum() == 2
    assert (found.groupby("vec_id", dropna=False)["code"].nunique() == 1).all()
    assert found["label_error"].unique().tolist() == [found["error"].sum()]
    nothing = ball_codes.digest(data.limit(0))
    assert nothing.count() == 0 and nothing.columns == found.columns.tolist()
    assert ball_codes.digest(table(spark, [None])).count() == 0


def test_unsuited_vectors(spark):
    with pytest.raises(ValueError, match="equal parts"):
        ball_codes.encode(table(spark, [[1.0] * 9]))
    with pytest.raises(ValueError, match="beyond"):
        ball_codes.encode(table(spark, [[1e30] * 8]))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    if not Path(folder).exists():
        pytest.skip("no test tables")
    data = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas().sort_values("vec_id")
    compare(queries.op11_ball_codes(spark, folder), np.stack(data.embedding), data.label.tolist())
