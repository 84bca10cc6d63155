"""Approximate nearest neighbours by a forest of random-projection trees.

1. Vectors that are equal are one entry of the index, with the smallest of their ids.
2. Each tree halves the vectors again and again at the median along the difference of
   two random ones. The trees are fitted on a bounded sample; every vector is indexed.
   A further coordinate makes the largest inner product the nearest direction.
3. A query goes down all trees from one shared priority queue: the next leaf is the
   one, of whatever tree, that it misses by the smallest margin.
4. Queries and vectors meet by leaf, in blocks of bounded size, and are ranked by
   their exact inner product. Each block gives a few candidates a query, and the
   best of all blocks are the result.
"""

import heapq
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.llm.common import column
from flowtide.session import materialize

NEAREST = 20
TREES = 12
SAMPLE = 16_384  # vectors that the trees are fitted on, chosen by hash
LEAST_SAMPLED = 16  # of them in a leaf
LEAF = 200  # vectors in a leaf at least
LEAVES = 64  # of a tree at most: a query that looks at much of the index gains nothing by more
# Part of all vectors that a query looks at. Without structure in the vectors, as in
# noise of 64 dimensions, recall of 0.9 takes this much; clustered ones need far less.
SHARE = 0.78
ROWS = 4096  # vectors of a leaf in one block
QUERIES = 4096  # queries of a leaf in one block


class Forest:
    """Trees as arrays. Inner nodes are numbered from 0; a leaf k is stored as -1 - k."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], norm: float):
        self.trees = trees  # planes, offsets, children, part of the sample in each leaf
        self.norm = norm

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """With the coordinate that makes all vectors equally long."""
        rest = np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        lifted = self.lifted(vectors)
        found = np.zeros((len(vectors), len(self.trees)), np.int32)
        for t, (planes, offsets, children, _) in enumerate(self.trees):
            if not len(planes):
                continue
            side = (lifted @ planes.T >= offsets).astype(np.int8)
            node, rows = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
            while len(rows):
                node[rows] = children[node[rows], side[rows, node[rows]]]
                rows = rows[node[rows] >= 0]
            found[:, t] = -1 - node
        return found

    def search(self, query: np.ndarray, share: float) -> list[tuple[int, int]]:
        """Leaves of all trees, the least missed first, until they hold ``share``.

        Vectors found in several trees count once: a tree's leaves are looked at as
        one part of the whole, and the trees' parts as independent of each other.
        """
        lifted = np.append(query, 0.0)
        heap = [(-np.inf, t, 0) for t in range(len(self.trees))]
        margins = [planes @ lifted - offsets for planes, offsets, _, _ in self.trees]
        seen, found = np.zeros(len(self.trees)), []
        while heap:
            miss, t, node = heapq.heappop(heap)
            planes, _, children, parts = self.trees[t]
            if node < 0 or not len(planes):
                leaf = -1 - node if node < 0 else 0
                found.append((t, leaf))
                seen[t] += parts[leaf]
                if 1 - np.prod(1 - np.minimum(seen, 1)) >= share:
                    break
                continue
            margin = margins[t][node]
            for side, missed in ((0, margin), (1, -margin)):
                heapq.heappush(heap, (max(miss, missed), t, int(children[node, side])))
        return found


def grow(sample: np.ndarray, norm: float, count: int, trees: int = TREES) -> Forest:
    """Trees for ``count`` vectors, fitted on a sample of them."""
    leaves = max(1, min(ceil(count / LEAF), LEAVES, len(sample) // LEAST_SAMPLED))
    depth = round(log2(leaves)) if leaves > 1 else 0
    rng = np.random.default_rng(0)
    forest = Forest([], norm)
    lifted = forest.lifted(sample)

    def tree():
        planes, offsets, children, parts = [], [], [], []

        def split(rows, level):
            if level == depth or len(rows) < 2 * LEAST_SAMPLED:
                parts.append(len(rows) / max(len(lifted), 1))
                return -len(parts)
            a, b = lifted[rng.choice(rows, 2, replace=False)]
            plane = a - b if (a != b).any() else rng.standard_normal(lifted.shape[1])
            plane /= np.linalg.norm(plane)
            along = lifted[rows] @ plane
            node = len(planes)
            planes.append(plane)
            offsets.append(np.median(along))
            children.append(None)
            right = along >= offsets[node]
            children[node] = (split(rows[~right], level + 1), split(rows[right], level + 1))
            return node

        split(np.arange(len(lifted)), 0)
        dims = lifted.shape[1]
        return (np.array(planes).reshape(-1, dims), np.array(offsets),
                np.array(children, np.int64).reshape(-1, 2), np.array(parts))

    forest.trees = [tree() for _ in range(trees)]
    return forest


def _usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float)


def _entries(rows: DataFrame, keep: int) -> DataFrame:
    """``entry, vector, ids, asked``: the distinct vectors, named by their least id.

    A vector that a third of all rows share is cut to its least ids before and after
    the shuffle; more of them can be in no result.
    """
    first = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    least = rows.select("vector", "id").withColumn("rank", first).where(F.col("rank") <= keep)
    ids = least.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("vector").agg(F.max("asked").alias("asked"))
    return ids.join(asked, "vector").select(F.col("ids")[0].alias("entry"), "vector", "ids", "asked")


def _indexed(forest, blocks: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaves = forest.value.leaves(_matrix(batch["vector"])) if len(batch) else np.zeros((0, 0))
            for t in range(leaves.shape[1]):
                block = (batch["entry"].to_numpy() * 2654435761 >> 7) % blocks
                yield pd.DataFrame(
                    {"tree": t, "leaf": leaves[:, t], "row_block": block, "entry": batch["entry"], "vector": batch["vector"]}
                )

    return run


def _probes(forest, share: float, query_blocks: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for entry, vector in zip(batch["entry"], batch["vector"], strict=True):
                found = forest.value.search(np.asarray(vector, float), share)
                trees, leaves = zip(*found, strict=True)
                yield pd.DataFrame(
                    {"tree": trees, "leaf": leaves, "query_block": (entry * 2654435761 >> 7) % query_blocks,
                     "query": entry, "vector": [vector] * len(found)}
                )

    return run


def _best(query: np.ndarray, entry: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
    """Rows of the best ``keep`` distinct entries of each query; ties to the least."""
    order = np.lexsort((entry, -score, query))
    query, entry = query[order], entry[order]
    again = np.r_[False, (query[1:] == query[:-1]) & (entry[1:] == entry[:-1])]
    order, query = order[~again], query[~again]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    return order[place < keep]


def _ranked(keep: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query": [], "entry": [], "score": []})
        scores = _matrix(asked["vector"]) @ _matrix(rows["vector"]).T
        entries, queries = rows["entry"].to_numpy(), asked["query"].to_numpy()
        few = min(keep, len(rows))
        top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
        least = np.take_along_axis(scores, top, 1).min(axis=1)
        # all that tie with the last of them, so that ties can go to the least id
        q, e = np.nonzero(scores >= least[:, None])
        chosen = _best(queries[q], entries[e], scores[q, e], keep)
        return pd.DataFrame({"query": queries[q][chosen], "entry": entries[e][chosen], "score": scores[q, e][chosen]})

    return run


def nearest(
    vectors: DataFrame,
    asked: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    share: float = SHARE,
) -> DataFrame:
    """``query_id, rank, id_col, score``: for every row for which ``asked`` holds, its
    nearest other rows by inner product, nearest first, ties to the smaller id.

    Vectors that are null, empty, zero, or hold nulls or what is not finite take no
    part, nor do rows with a null id, nor vectors of another length than most have.
    A query whose index leaves hold fewer than ``nearest`` others gets as many as
    there are. Rows that share an id are one: the one with the least vector. Ids are
    whole numbers. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    exact = F.transform(column(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(column(id_col).alias("id"), exact.alias("vector"), asked.alias("asked")).where(
        F.col("id").isNotNull()
    )
    rows = materialize(rows.where(_usable(F.col("vector"))).withColumn("dims", F.size("vector")), "vectors")
    usual = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").limit(1).collect()
    dims = usual[0]["dims"] if usual else 0
    rows = rows.where(F.col("dims") == dims)
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked"))
    keep = nearest + 1
    entries = materialize(_entries(rows, keep), "entries")
    count = entries.count()
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    norm = entries.agg(F.max(length)).first()[0] or 0.0
    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(min(SAMPLE, max(1, (1 << 22) // max(dims, 1))))
    sampled = _matrix(sample.select("vector").toPandas()["vector"]).reshape(-1, max(dims, 1))
    forest = spark.sparkContext.broadcast(grow(sampled, norm, count))

    leaves = max(1, len(forest.value.trees[0][3]))
    queries = entries.where("asked")
    row_blocks = ceil(count / leaves / ROWS) or 1
    query_blocks = ceil(queries.count() / QUERIES) or 1
    kind = entries.schema["entry"].dataType.simpleString()
    index = entries.select("entry", "vector").mapInPandas(
        _indexed(forest, row_blocks), f"tree int, leaf int, row_block int, entry {kind}, vector array<double>"
    )
    index = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    probes = queries.select("entry", "vector").mapInPandas(
        _probes(forest, share, query_blocks), f"tree int, leaf int, query_block int, query {kind}, vector array<double>"
    )
    probes = probes.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    block = ["tree", "leaf", "row_block", "query_block"]
    found = (
        index.groupBy(*block)
        .cogroup(probes.groupBy(*block))
        .applyInPandas(_ranked(keep), f"query {kind}, entry {kind}, score double")
    )
    found = found.groupBy("query", "entry").agg(F.max("score").alias("score"))
    best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "entry"))
    found = found.withColumn("rank", best).where(F.col("rank") <= keep)
    # from distinct vectors back to rows: a result's ids are the best of its entries' ids
    one = F.struct((-F.col("score")).alias("worse"), F.col("id").alias("id"))
    lists = (
        found.join(entries.select("entry", "ids"), "entry")
        .select("query", "score", F.explode("ids").alias("id"))
        .withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id")))
        .where(F.col("place") <= keep)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(one)).alias("list"))
    )
    named = queries.select("vector", F.col("entry").alias("query"))
    asking = rows.where("asked").select("id", "vector").join(named, "vector").select(F.col("id").alias("query_id"), "query")
    return (
        asking.join(lists, "query")
        .select("query_id", F.posexplode(F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, nearest)))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias(id_col), (-F.col("col.worse")).alias("score"))
    )
