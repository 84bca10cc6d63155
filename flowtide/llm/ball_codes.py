"""Vector codes of a few bytes, by product quantization with ball k-means.

Components become integers, so that every distance and every mean is exact and the
codes do not depend on the order of rows. A vector is cut into equal parts; each part
position has a codebook of its own, improved by Lloyd rounds without full searches:

* The members of an entry form a ball around it. Entries whose distance is at most
  twice the ball's radius are its neighbours; no other can take a member over.
* A member nearer to its entry than half the way to the nearest neighbour is in the
  stable core and stays. If neither the entry nor a neighbour has moved since the
  round before, the whole ball is stable.
* The rest of the ball is cut into rings by half the distances to the neighbours in
  their order. A member in ring k is compared with the first k neighbours only.

Radii come from the round before, widened by what the entry has moved since, so a
round is one pass: it writes the vectors with their new codes, and with them, a row
per batch, the counts, sums and radii that Spark adds up to the next codebooks. Those
are the only numbers that reach the driver: entries x dimension of them.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.common import column
from flowtide.session import drop_table, write_table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 26  # of a component's integer: sums of squares then fit a long


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` are the integers of an entry."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all components by part, entry and position, decimal, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class Balls:
    """What a round knows of the balls of its entries, for every part position."""

    books: np.ndarray  # part x entry x position
    neighbours: list  # of each part and entry: the neighbours, nearest first
    reach: list  # of each part and entry: squared distances to them
    settled: np.ndarray  # neither the entry nor a neighbour has moved

    @classmethod
    def around(cls, books: np.ndarray, before: np.ndarray, radii: np.ndarray) -> "Balls":
        """``radii``: squared, around the entries ``before`` moved to ``books``; -1 for none."""
        parts, entries, _ = books.shape
        shift = ((books - before) ** 2).sum(axis=2)
        neighbours, reach = [], []
        settled = np.zeros((parts, entries), bool)
        for p in range(parts):
            apart = ((books[p][:, None] - books[p][None]) ** 2).sum(axis=2)
            near_of, reach_of = [], []
            for e in range(entries):
                # roots rounded up: the ball is never too small
                radius = isqrt(max(int(radii[p, e]), 0)) + 1 + (isqrt(int(shift[p, e])) + 1 if shift[p, e] else 0)
                near = [j for j in np.argsort(apart[e], kind="stable") if j != e and apart[e, j] <= 4 * radius**2]
                near_of.append(np.array(near, np.int64))
                reach_of.append(apart[e, near])
                settled[p, e] = not shift[p, e] and not shift[p, near].any()
            neighbours.append(near_of)
            reach.append(reach_of)
        return cls(books, neighbours, reach, settled)


def _distances(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return ((x - entry) ** 2).sum(axis=1)


def search(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row and its squared distance; ties to the lower index."""
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    for e, entry in enumerate(book):
        found = _distances(x, entry)
        closer = found < best
        best[closer], at[closer] = found[closer], e
    return at, best


def move(x: np.ndarray, codes: np.ndarray, balls: Balls, p: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from the codes of the round before: cores stay, rings are searched."""
    best, at = _distances(x, balls.books[p][codes]), codes.copy()
    for e in range(balls.books.shape[1]):
        near, reach = balls.neighbours[p][e], balls.reach[p][e]
        if balls.settled[p, e] or not len(near):
            continue
        rows = np.flatnonzero(codes == e)
        # of the neighbours by distance: how many are within twice the way to the own entry
        ring = np.searchsorted(reach, 4 * best[rows], side="right")
        for k in range(len(near)):
            inside = ring > k
            rows, ring = rows[inside], ring[inside]
            if not len(rows):
                break
            found, j = _distances(x[rows], balls.books[p][near[k]]), near[k]
            closer = (found < best[rows]) | ((found == best[rows]) & (j < at[rows]))
            best[rows[closer]], at[rows[closer]] = found[closer], j
    return at, best


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _lists(matrix: np.ndarray) -> pa.Array:
    """A row of the matrix a list."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * width, matrix.ravel().astype(np.int32))


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    found = np.floor(x.astype(np.float64) * scale)
    if len(found) and np.abs(found).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / scale:g}: squared distances would not fit a long")
    return found.astype(np.int64)


def _usable(vector: Column, dimension: int | None = None) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    right = F.size(vector) > 0 if dimension is None else F.size(vector) == dimension
    return vector.isNotNull() & right & F.coalesce(finite, F.lit(False))


_KINDS = {
    "codes": "array<int>",
    "vector": "array<int>",
    "balls": "array<struct<part:int,entry:int,n:bigint,radius:bigint,sums:array<bigint>>>",
    "error": "bigint",
}


def _ball_rows(x: np.ndarray, codes: np.ndarray, errors: np.ndarray, entries: int) -> list[dict]:
    """The members of this batch's balls, added up. ``x``: row x part x position."""
    rows = []
    for p in range(x.shape[1]):
        for e in range(entries):
            own = codes[:, p] == e
            n = int(own.sum())
            if n:
                sums = x[own, p].sum(axis=0).tolist()
                rows.append({"part": p, "entry": e, "n": n, "radius": int(errors[own, p].max()), "sums": sums})
    return rows


def _round(df: DataFrame, balls: Balls | None, books: np.ndarray, scale: int, last: bool) -> DataFrame:
    """One assignment of all rows. ``df``: id, label and vector, or codes too after the first."""
    parts, entries, width = books.shape
    names = ["id", "label", "codes", *(["error"] if last else ["vector", "balls"])]
    kinds = {c: df.schema[c].dataType.simpleString() for c in ("id", "label")} | _KINDS
    ball_type = pa.list_(
        pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()),
                   ("radius", pa.int64()), ("sums", pa.list_(pa.int64()))])
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("vector"), parts * width)
            whole = _whole(matrix, scale) if balls is None else matrix.astype(np.int64)
            x = whole.reshape(-1, parts, width)
            if balls is None:
                found = [search(x[:, p], books[p]) for p in range(parts)]
            else:
                codes = _matrix(batch.column("codes"), parts)
                found = [move(x[:, p], codes[:, p], balls, p) for p in range(parts)]
            codes, errors = (np.stack(c, axis=1) for c in zip(*found, strict=True))
            columns = [batch.column("id"), batch.column("label"), _lists(codes)]
            if last:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(errors.sum(axis=1))], names=names)
                continue
            # the first row of a batch carries what the batch adds to the balls
            rows = [_ball_rows(x, codes, errors, entries), *[None] * (len(x) - 1)]
            yield pa.RecordBatch.from_arrays([*columns, _lists(whole), pa.array(rows, ball_type)], names=names)

    return df.mapInArrow(assign, ", ".join(f"{c} {kinds[c]}" for c in names))


def _added_up(table: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next codebooks and the squared radii of the balls that they come from."""
    balls = table.where(F.col("balls").isNotNull()).select(F.explode("balls").alias("b")).select("b.*")
    numbers = balls.select("part", "entry", "n", "radius", F.posexplode("sums").alias("position", "s"))
    found = numbers.groupBy("part", "entry", "position").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"), F.max("radius").alias("radius")
    )
    after, radii = books.copy(), np.full(books.shape[:2], -1, np.int64)
    for row in found.collect():  # as many as the codebooks have components
        after[row["part"], row["entry"], row["position"]] = int(row["s"]) // row["n"]
        radii[row["part"], row["entry"]] = row["radius"]
    return after, radii


def encode(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``id, label, codes, error`` of every usable row, and the codebooks.

    Components become floor(scale * x). The codebooks start as the rows of the
    ``entries`` smallest ids (null ids last, equal ids by their vectors; fewer rows give
    fewer entries) and go through ``rounds`` rounds. codes has an index a part, ties to
    the lower one; error is the squared distance over all parts.

    Rows drop out whose vector is null, empty, of another length than that of the
    smallest id, or holds null or non-finite components. Repeated rows and ids keep all
    their rows and weigh as often. Labels pass through, null ones too. An empty table
    gives an empty table. Other columns are left out, whatever they are called. Length
    not divisible by ``parts``, or components beyond ``LARGEST / scale``: ValueError.

    Every round writes one table into the shared folder and drops that of the round
    before; the codes stay there.
    """
    rows = vectors.select(
        column(id_col).alias("id"), column(label_col).alias("label"), column(vector_col).alias("vector")
    )
    spark = vectors.sparkSession
    order = [F.col("id").asc_nulls_last(), "vector"]
    smallest = rows.where(_usable(F.col("vector"))).orderBy(*order).first()
    if smallest is None:
        nothing = rows.limit(0).select(
            "id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("bigint").alias("error")
        )
        return nothing, Codebooks(np.zeros((parts, 0, 0), np.int64))
    dimension = len(smallest["vector"])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    usable = rows.where(_usable(F.col("vector"), dimension))
    first = [r["vector"] for r in usable.orderBy(*order).limit(entries).select("vector").collect()]
    books = _whole(np.array(first, float), scale).reshape(len(first), parts, -1).swapaxes(0, 1).copy()
    now, balls, path = usable, None, None
    for _ in range(rounds):
        after = write_table(_round(now, balls, books, scale, last=False), "ball-codes")
        if path:
            drop_table(spark, path)
        path = after
        now = spark.read.parquet(path)
        moved, radii = _added_up(now, books)
        balls, books = Balls.around(moved, books, radii), moved
    codes = write_table(_round(now, balls, books, scale, last=True), "codes")
    if path:
        drop_table(spark, path)
    return spark.read.parquet(codes), Codebooks(books)


def hex_code(codes: Column) -> Column:
    """Two lowercase hex digits for every index."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def digest(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256`` of every row of :func:`encode`.

    label_error: the errors of all rows with an equal label, null labels together.
    """
    coded, books = encode(vectors, id_col, **options)
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).select(
        F.col("id").alias(id_col),
        hex_code(F.col("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )

