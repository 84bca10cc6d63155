"""Near copies by SimHash fingerprints, compared with the help of pivot distances.

Two fingerprints link if they differ in at most ``RADIUS`` bits. Linear in the
number of distinct fingerprints but for random collisions:

1. Copies have equal fingerprints, so only distinct fingerprints are compared.
2. A fingerprint is cut into blocks of bits. Two that differ in three bits agree on
   all but three blocks, so they meet under one of their keys (the bits of some
   blocks). More rows get more blocks, and so longer keys; any number is exact.
3. Rows stream through a task in the order of their keys. Each has its row of the
   pivot table: its Hamming distances to reference fingerprints. Two rows whose
   distances to one pivot differ by more than the radius cannot link (triangle
   inequality); only what is left is compared bit by bit.
4. Of a run of equal keys only the links of a spanning forest leave the task: a
   component that has been found is not compared again, and no pairs are listed.
5. The links' connected components are found by distributed star steps.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from flowtide.llm.common import column, fresh
from flowtide.llm.components import connected_components
from flowtide.session import materialize

RADIUS = 3
SHINGLE = 3
SEED = 42
PIVOTS = 24
HASHED_AT_ONCE = 1 << 16
# blocks of a fingerprint, and up to how many distinct fingerprints they serve
BLOCKS = ((4, 1_000_000), (5, 50_000_000), (6, 5_000_000_000), (7, None))
SHORT_RUN = 48


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of 0, 1, 2 ..., as good as random."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(count)], np.uint64)


def fingerprint(text: str | None) -> int:
    """The majority of every bit over the hashes of all shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # both know A-Z and ASCII blanks only
    n = len(words)
    if not n:
        return 0
    if n < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = n - SHINGLE + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, HASHED_AT_ONCE):
        part = words[start : start + HASHED_AT_ONCE + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(SHINGLE)), strict=False))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    values = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return pd.Series(values.view(np.int64))


def fingerprint_of(text: Column) -> Column:
    """The fingerprint as a signed long. A null text is empty."""
    return _fingerprints(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _blocks_for(n: int) -> int:
    return next(blocks for blocks, most in BLOCKS if most is None or n <= most)


def _keys(fp: Column, blocks: int) -> Column:
    """All keys of a fingerprint: the bits of every choice of blocks - RADIUS blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    whole = (1 << 64) - 1
    masks = []
    for chosen in combinations(range(blocks), blocks - RADIUS):
        mask = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen) & whole
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(
        *[F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)]
    )


def _within(values: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows ``a`` and ``b``: which pairs link. Pivots first, bits for the rest."""
    left = np.arange(len(a))
    for pivot in table:
        left = left[np.abs(pivot[a[left]] - pivot[b[left]]) <= RADIUS]
        if not len(left):
            return left
    return left[np.bitwise_count(values[a[left]] ^ values[b[left]]) <= RADIUS]


def _forest_of_run(values: np.ndarray, table: np.ndarray, start: int, stop: int):
    """Links that connect what a long run of equal keys connects, one a row at most."""
    free = np.arange(start, stop)
    while len(free) > 1:
        reached, free = [free[0]], free[1:]
        while reached and len(free):
            row = reached.pop()
            near = _within(values, table, np.full(len(free), row), free)
            if len(near):
                yield np.full(len(near), row), free[near]
                reached.extend(free[near])
                free = np.delete(free, near)


def _links_of_runs(choice: np.ndarray, bits: np.ndarray, values: np.ndarray):
    """Links within runs of rows that agree in choice and bits. Rows come sorted."""
    table = np.bitwise_count(values[None, :] ^ pivots()[:, None]).astype(np.int8)
    new = np.r_[True, (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])]
    starts = np.flatnonzero(new)
    stops = np.r_[starts[1:], len(values)]
    sizes = stops - starts
    for start, stop in zip(starts[sizes > SHORT_RUN], stops[sizes > SHORT_RUN], strict=True):
        yield from _forest_of_run(values, table, start, stop)
    stop_of = np.repeat(np.where(sizes > SHORT_RUN, 0, stops), sizes)
    rows = np.arange(len(values))
    for step in range(1, SHORT_RUN):
        rows = rows[rows + step < stop_of[rows]]
        if not len(rows):
            return
        near = rows[_within(values, table, rows, rows + step)]
        if len(near):
            yield near, near + step


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links among rows that come sorted by key; a run may span several batches."""
    held: list[np.ndarray] = []

    def found(parts):
        choice, bits, values = (np.concatenate(c) for c in zip(*parts, strict=True))
        values = values.view(np.uint64)
        for a, b in _links_of_runs(choice, bits, values):
            yield pd.DataFrame({"a": values[a].view(np.int64), "b": values[b].view(np.int64)})

    for batch in batches:
        part = tuple(batch[c].to_numpy() for c in ("choice", "bits", "fp"))
        if not len(part[0]):
            continue
        # the last run of a batch may go on in the next one
        earlier = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
        if len(earlier):
            cut = earlier[-1] + 1
            yield from found([*held, tuple(c[:cut] for c in part)])
            held = [tuple(c[cut:] for c in part)]
        else:
            if held and (held[-1][0][-1] != part[0][0] or held[-1][1][-1] != part[1][0]):
                yield from found(held)
                held = []
            held.append(part)
    if held:
        yield from found(held)


def links(distinct: DataFrame, blocks: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that keep all connections."""
    keyed = distinct.select("fp", F.explode(_keys(F.col("fp"), blocks)).alias("k")).select(
        F.col("k.choice").alias("choice"), F.col("k.bits").alias("bits"), "fp"
    )
    runs = keyed.repartition("choice", "bits").sortWithinPartitions("choice", "bits")
    return runs.mapInPandas(_links, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fingerprint, component_id``: one row for every row of ``docs``.

    component_id is the least id that is reachable over links of at most three
    differing bits, its own included. A null or empty text, or one of blanks alone,
    has fingerprint zero and is linked like any other. Repeated rows and ids keep
    all their rows. A row with a null id takes part and gets the least id of its
    component, null if that has none. An empty table gives an empty table; other
    columns are left out.
    """
    fps = materialize(
        docs.select(column(id_col).alias("id"), fingerprint_of(column(text_col)).alias("fp")), "fingerprints"
    )
    classes = _classes(fps)
    return fps.join(classes, "fp", "left").select(
        F.col("id").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


def _classes(fps: DataFrame) -> DataFrame:
    """``fp, root, component_id`` for every distinct fingerprint."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = links(distinct.select("fp"), _blocks_for(distinct.count()))
    roots = connected_components(found, "a", "b")
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    joined = materialize(joined, "rooted")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(least, "root").select("fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near copies: of every component of links the row with the least id stays.

    Links are those of :func:`near_duplicates`. If several rows have that id, one of
    them stays: the one with the least text, null texts first. Of a component whose ids
    are all null one row with the least text stays. Columns are those of ``docs``,
    whatever they are called. An empty table gives an empty table.
    """
    fps = materialize(
        docs.select(column(id_col).alias("id"), fingerprint_of(column(text_col)).alias("fp")), "fingerprints"
    )
    classes = _classes(fps)
    # an id names its component, so mostly ids alone meet the texts: those that stay
    of = fresh(docs, "stays")
    stay = (
        fps.join(classes, "fp")
        .groupBy(F.col("id").alias(of))
        .agg(F.count("*").alias("rows"), F.max(F.col("id").eqNullSafe(F.col("component_id"))).alias("least"))
        .where("least")
    )
    stay = materialize(stay, "stay")
    single = (F.col("rows") == 1) & F.col(of).isNotNull()
    # nearly as many ids as documents: always a merge, never a broadcast while they are few
    alone = docs.join(stay.where(single).select(of).hint("merge"), column(id_col) == F.col(of), "left_semi")
    several = stay.where(~single).select(of)
    if several.isEmpty():
        return alone
    # rows that share an id, or have none, are told apart by their texts
    again = materialize(docs.join(several, column(id_col).eqNullSafe(F.col(of)), "left_semi"), "repeated")
    rows = again.select(F.struct(*[column(c) for c in docs.columns]).alias("row"))
    value = {c: F.col("row")[c] for c in (id_col, text_col)}
    first = W.partitionBy("root").orderBy(value[text_col])
    again = (
        rows.withColumn("fp", fingerprint_of(value[text_col]))
        .join(classes, "fp")
        .where(value[id_col].eqNullSafe(F.col("component_id")))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") == 1)
    )
    return alone.unionByName(again.select("row.*"))
