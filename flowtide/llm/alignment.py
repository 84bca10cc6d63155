"""Alignment of two tokenizers' tokens by the bytes that they cover.

A text's tokens by A and by B cover the same bytes. Where tokens of both end, a group
ends; all pairs of an A and a B token of one group are linked. Corpus-wide, a pair of
ids counts in how many documents it is linked.

Tasks work on chunks of documents as Arrow tables, without a row in Python: lists of ids
are flattened and keep their parents' numbers; ends are cumulative sums of token sizes
less the sum where the document starts; a hash join on (document, end) finds the shared
ends; joins on the group make the pairs, in bounded slices; ``Table.group_by`` counts a
chunk's pairs. Spark merges these partial counts, and joins them back to the chunks: one
row per pair and chunk is shuffled, not one per link.
"""

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.llm.common import column
from flowtide.session import materialize

CHUNK_BYTES = 2 << 20  # of text in one Arrow table; a longer text is a chunk of its own
PAIRS_AT_ONCE = 4 << 20  # of a chunk, expanded in one join
B_BITS = 32  # a pair of ids is a << B_BITS | b
LATIN = 0x250
#: How byte-level vocabularies cut a text into words (a fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(256)}


class ByteLevel:
    """Ids by a byte-level vocabulary file. Texts are taken as they are, special tokens as text.

    If the vocabulary is numbered in the order of its merges, a rank is all there is to
    merge by, and a faster library gives the same ids. It is used for Latin texts; the
    two may know other characters' classes from different versions of Unicode.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, special = _byte_of_letter(), set(self.tokenizer.get_added_tokens_decoder())
        parts: list[bytes] = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            if number not in special:
                parts[number] = bytes(byte_of[c] for c in token)
        self.parts = pa.array(parts, pa.binary())
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ordered = [model["vocab"].get(m) for m in made] == list(range(256, 256 + len(made)))
        self.fast = _by_ranks(parts, special) if ordered else None

    def ids(self, text: str) -> np.ndarray:
        if self.fast and (text.isascii() or ord(max(text)) < LATIN):
            return np.array(self.fast.encode_ordinary(text), np.int32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)


def _by_ranks(parts: list[bytes], special: set[int]):
    import tiktoken

    ranks = {part: number for number, part in enumerate(parts) if part and number not in special}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """Ids by a sentence-piece model, which puts a space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.parts = pa.array(
            [
                bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
                for i, name in enumerate(names)
            ],
            pa.binary(),
        )

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int32)


@lru_cache(2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    starts = np.r_[0, np.cumsum([len(r) for r in rows], dtype=np.int64)].astype(np.int32)
    return pa.ListArray.from_arrays(starts, pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def _joined(lists: pa.ListArray, parts: pa.Array) -> pa.Array:
    """The bytes of every list's tokens."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, pc.take(parts, lists.values)), b"")


def _ends(lists: pa.ListArray, parts: pa.Array) -> pa.Table:
    """Every token of the lists: ``doc`` (its list), ``end`` in bytes of the text, ``at``."""
    doc = pc.list_parent_indices(lists).cast(pa.int32())
    sizes = pc.take(pc.binary_length(parts), lists.values).cast(pa.int64())
    upto = pc.cumulative_sum(sizes)
    before = pa.concat_arrays([pa.array([0], pa.int64()), upto])
    start = pc.take(before, lists.offsets.slice(0, len(lists)))
    end = pc.subtract(upto, pc.take(start, doc))
    return pa.table({"doc": doc, "end": end, "at": pa.array(np.arange(len(doc), dtype=np.int32))})


class Aligned:
    """The groups of a chunk of texts. Texts without tokens have no groups."""

    def __init__(self, texts: pa.Array, a: ByteLevel, b: Pieces):
        spaced = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "").cast(pa.binary())
        nothing = np.zeros(0, np.int32)
        values = texts.to_pylist()
        in_a = _lists([a.ids(" " + t) if t else nothing for t in values])
        in_b = _lists([b.ids(t) if t else nothing for t in values])
        same = pc.and_(pc.equal(_joined(in_a, a.parts), spaced), pc.equal(_joined(in_b, b.parts), spaced))
        empty = pa.array([], pa.int32())
        # a text whose bytes do not come back has no tokens
        self.a, self.b = (pc.if_else(same, x, pa.scalar(empty, pa.list_(pa.int32()))) for x in (in_a, in_b))
        ends_a, ends_b = _ends(self.a, a.parts), _ends(self.b, b.parts).rename_columns(["doc", "end", "at_b"])
        shared = ends_a.join(ends_b, ["doc", "end"], join_type="inner", use_threads=False).sort_by("at")
        shared = shared.combine_chunks()
        self.doc = _column(shared, "doc")  # of every group
        self.groups_a = _cut(self.a.values, _column(shared, "at"))
        self.groups_b = _cut(self.b.values, _column(shared, "at_b"))
        found = np.bincount(self.doc.to_numpy(), minlength=len(texts))
        self.starts = np.r_[0, found.cumsum()].astype(np.int32)  # of every text's groups

    def groups(self) -> pa.Array:
        """Of every text: its groups, each with the ids of both sides."""
        both = pa.StructArray.from_arrays([self.groups_a, self.groups_b], ["a", "b"])
        return pa.ListArray.from_arrays(self.starts, both)

    def written(self) -> list[str]:
        """Of every text: ``a1,a2|b1;a3|b2``, empty without tokens."""
        sides = (
            pc.binary_join(pa.ListArray.from_arrays(g.offsets, g.values.cast(pa.string())), ",")
            for g in (self.groups_a, self.groups_b)
        )
        return pc.binary_join(
            pa.ListArray.from_arrays(self.starts, pc.binary_join_element_wise(*sides, "|")), ";"
        ).to_pylist()

    def links(self) -> pa.Table:
        """``doc, pair, times``: how often each text links a pair of ids."""
        a, b = (_counted(g, name) for g, name in ((self.groups_a, "a"), (self.groups_b, "b")))
        per_group = np.bincount(_column(b, "group").to_numpy(), minlength=len(self.doc))
        upto = per_group[_column(a, "group").to_numpy()].cumsum()
        slices = np.searchsorted(upto, np.arange(PAIRS_AT_ONCE, upto[-1] + PAIRS_AT_ONCE, PAIRS_AT_ONCE), "right")
        tables, start = [], 0
        for stop in [*slices.tolist(), len(upto)]:
            stop = min(max(stop, start + 1), len(upto))
            if start < stop:
                tables.append(self._pairs(a.slice(start, stop - start), b))
            start = stop
        merged = pa.concat_tables(tables)
        if len(tables) > 1:
            merged = _summed(merged)
        return merged.sort_by("doc").combine_chunks()

    def _pairs(self, a: pa.Table, b: pa.Table) -> pa.Table:
        both = a.join(b, "group", join_type="inner", use_threads=False).combine_chunks()
        pair = pc.bit_wise_or(
            pc.shift_left(_column(both, "a").cast(pa.int64()), B_BITS), _column(both, "b").cast(pa.int64())
        )
        times = pc.multiply(_column(both, "times_a"), _column(both, "times_b"))
        return _summed(pa.table({"doc": pc.take(self.doc, _column(both, "group")), "pair": pair, "times": times}))


def _column(table: pa.Table, name: str) -> pa.Array:
    """A column as one array."""
    found = table.column(name).combine_chunks()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def _cut(ids: pa.Array, last: pa.Array) -> pa.ListArray:
    """The ids in lists that end at the given places."""
    return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), pc.add(last, 1).cast(pa.int32())]), ids)


def _counted(groups: pa.ListArray, name: str) -> pa.Table:
    """``group, <name>, times_<name>``: the distinct ids of every group."""
    rows = pa.table({"group": pc.list_parent_indices(groups).cast(pa.int32()), name: groups.values})
    found = rows.group_by(["group", name], use_threads=False).aggregate([([], "count_all")])
    return found.rename_columns({"count_all": f"times_{name}"}).combine_chunks()


def _summed(links: pa.Table) -> pa.Table:
    found = links.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return found.rename_columns({"times_sum": "times"}).select(["doc", "pair", "times"])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``CHUNK_BYTES`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    start, upto = 0, np.r_[0, sizes.cumsum()]
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(upto, upto[start] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(column(id_col).alias("id"), column(text_col).alias("text"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, groups`` for every row: array of ``a`` and ``b``, the ids of each group in order.

    ``path_a`` is a byte-level vocabulary, ``path_b`` a sentence-piece model. A text that
    is null or empty, or that either does not give back byte by byte, has no groups.
    Repeated rows and ids keep all their rows. An empty table gives an empty table.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a), pieces(path_b)
        for batch in batches:
            for chunk in _chunks(batch):
                found = Aligned(chunk.column("text"), a, b)
                yield pa.RecordBatch.from_arrays([chunk.column("id"), found.groups()], names=["id", "groups"])

    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(aligned, f"id {kind}, groups array<struct<a:array<int>,b:array<int>>>")
    return made.withColumnRenamed("id", id_col)


_CHUNKED = {
    "chunk": "bigint",
    "n_a": "bigint",
    "n_b": "bigint",
    "n_groups": "bigint",
    "n_links": "bigint",
    "groups_sha256": "string",
    "links": "array<int>",  # places in the chunk's pairs
    "times": "array<bigint>",
    "pairs": "array<bigint>",  # in the first row of a chunk: its pairs,
    "counts": "array<bigint>",  # and in how many of its documents each is linked
}


def _offsets(doc: np.ndarray, n: int) -> np.ndarray:
    return np.r_[0, np.bincount(doc, minlength=n).cumsum()].astype(np.int32)


def _first_only(values: pa.Array, n: int) -> pa.Array:
    """A list array of n rows: the values in the first, null in the others."""
    starts = np.r_[0, np.full(n, len(values))].astype(np.int32)
    gone = np.r_[False, np.ones(n - 1, bool)]
    return pa.ListArray.from_arrays(pa.array(starts), values, mask=pa.array(gone))


def _chunk_rows(chunk: pa.RecordBatch, number: int, a: ByteLevel, b: Pieces) -> pa.RecordBatch:
    found, n = Aligned(chunk.column("text"), a, b), chunk.num_rows
    if len(found.doc):
        links = found.links()
    else:
        links = pa.table({"doc": pa.array([], pa.int32()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
    partial = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    doc, times = _column(links, "doc").to_numpy(), _column(links, "times")
    starts = _offsets(doc, n)
    upto = np.r_[0, times.to_numpy().cumsum()]
    place = pc.index_in(_column(links, "pair"), value_set=_column(partial, "pair"))
    sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.written()]
    return pa.RecordBatch.from_arrays(
        [
            chunk.column("id"),
            pa.array(np.full(n, number, np.int64)),
            pc.list_value_length(found.a).cast(pa.int64()),
            pc.list_value_length(found.b).cast(pa.int64()),
            pa.array(np.diff(found.starts).astype(np.int64)),
            pa.array((upto[starts[1:]] - upto[starts[:-1]]).astype(np.int64)),
            pa.array(sha, pa.string()),
            pa.ListArray.from_arrays(starts, place),
            pa.ListArray.from_arrays(starts, times),
            _first_only(_column(partial, "pair"), n),
            _first_only(_column(partial, "count_all"), n),
        ],
        names=["id", *_CHUNKED],
    )


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one chunk with the counts of its pairs, which come by their places."""
    counts = counts.sort_by("place")
    of, best = (counts.column(c).combine_chunks() for c in ("n", "best"))
    lists = docs.column("links").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    parent, place = pc.list_parent_indices(lists), lists.flatten()
    times = docs.column("times").combine_chunks().flatten()
    sums = pa.table(
        {
            "row": parent,
            "count_sum": pc.multiply(times, pc.take(of, place)),
            "n_best": pc.multiply(times, pc.take(best, place).cast(pa.int64())),
        }
    )
    added = sums.group_by("row", use_threads=False).aggregate([("count_sum", "sum"), ("n_best", "sum")])
    total = {c: np.zeros(docs.num_rows, np.int64) for c in ("n_best", "count_sum")}
    for c, values in total.items():
        values[added.column("row").to_numpy()] = added.column(f"{c}_sum").to_numpy()
    kept = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    for c, values in total.items():
        kept = kept.append_column(c, pa.array(values))
    return kept.append_column("groups_sha256", docs.column("groups_sha256"))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that link a pair; whether none of its A id has more."""
    partial = chunks.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = partial.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    # an A id has at most as many pairs as B has ids
    highest = F.max("n").over(W.partitionBy(F.shiftright("pair", B_BITS)))
    return totals.select("pair", "n", (F.col("n") == highest).alias("best"))


def chunked(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's links, and every chunk's partial counts: see ``_CHUNKED``. Store it before use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a), pieces(path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in _chunks(batch):
                yield _chunk_rows(chunk, number, a, b)
                number += 1

    rows = _rows(docs, id_col, text_col)
    kinds = {"id": rows.schema["id"].dataType.simpleString()} | _CHUNKED
    return rows.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    n_links counts pairs of token occurrences; n_best those whose pair of ids is linked
    in as many documents as any of its A id; count_sum adds up these numbers of
    documents. groups_sha256 is of the groups' ids as :meth:`Aligned.written` puts them.

    A text that is null or empty, or that either tokenizer does not give back byte by
    byte, has no tokens: zeros, and an empty digest. Repeated rows and ids keep all their
    rows and count as documents each; null ids stay null. An empty table gives an empty
    table. Other columns are left out, whatever they are called.

    Stores the links of all rows and the counts of all pairs in the shared folder.
    """
    stored = materialize(chunked(docs, path_a, path_b, id_col, text_col), "links")
    totals = materialize(pair_counts(stored), "pair-counts")
    places = stored.where(F.col("pairs").isNotNull()).select("chunk", F.posexplode("pairs").alias("place", "pair"))
    counts = places.join(totals, "pair").select(F.col("chunk").alias("of"), "place", "n", "best")
    rows = stored.drop("pairs", "counts")
    kind = stored.schema["id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    scored = rows.groupBy("chunk").cogroup(counts.groupBy("of")).applyInArrow(
        _scored, f"id {kind}, {', '.join(f'{c} bigint' for c in names)}, groups_sha256 string"
    )
    return scored.withColumnRenamed("id", id_col)

