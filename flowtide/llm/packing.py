"""Packing documents into sequences of bounded length, by sums of squares.

Of the open sequences only their gaps count. A piece goes where the sum over all gaps
of the squared number of open sequences with that gap becomes smallest: into an open
sequence, or a new one. So no gap piles up that later pieces do not fill. Long pieces
come first. Documents are only cut if they are longer than a sequence.

Tasks tokenize the rows where they are and write narrow pieces, without ids of tokens.
A hash spreads the pieces into blocks of about ``BLOCK``, each packed as a whole. So
the sequences depend on the documents and not on how they are stored, memory is
bounded, no text is shuffled, and a lost task packs the same block again.
"""

import string
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from flowtide.llm.common import column
from flowtide.session import materialize

CAPACITY = 4096
END = 1
BLOCK = 50_000
KNOWN = 400_000  # words whose ids a worker keeps, and as many small forms
LONGEST_KNOWN = 48
MARKS = string.punctuation.replace("'", "")  # behind letters they are one piece; the other one may begin a piece
LATIN = 0x250  # below this code point letters are lower-cased one by one alike everywhere


class _Known(dict):
    """Ids by word. A word that is not held is looked up; whether it is kept is up to that."""

    def __init__(self, look_up: Callable[[bytes], bytes]):
        self.look_up = look_up

    def __missing__(self, word: bytes) -> bytes:
        return self.look_up(word)


class WordTokenizer:
    """The ids of a text, from a vocabulary file; equal words are looked up once.

    The tokenizer drops blanks and never joins across them, so a text's ids are those
    of its words. Within a word of plain letters there is nothing to split either, and
    the model alone gives the ids; marks behind it are a piece of their own. All other
    words go through the whole tokenizer.

    Most words of a corpus are rare. So a word is kept by its small letters first, whatever
    its capitals and marks, and as it stands from the second time on.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = _Known(self._ids)
        self.once: dict[str, bytes] = {}
        self.bytes = dict(enumerate(_byte_letters()))

    def _letters(self, small: str) -> bytes:
        shown = small if small.isascii() else small.encode().decode("latin-1").translate(self.bytes)
        return _packed([t.id for t in self.model.tokenize(shown)])

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _looked_up(self, part: str, ids: Callable[[str], bytes]) -> bytes:
        found = ids(part)
        if len(part) <= LONGEST_KNOWN:
            if len(self.once) >= KNOWN:
                self.once.clear()  # what is frequent is known by now
            self.once[part] = found
        return found

    def _ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        letters = text.rstrip(MARKS)
        part, ids, marks = letters.lower(), self._letters, text[len(letters) :]
        if not (part.isalpha() and (letters.isascii() or max(map(ord, letters)) < LATIN)):
            part, ids, marks = text, self._whole, ""
        found = self.once.get(part)
        again = found is not None
        if not again:
            found = self._looked_up(part, ids)
        if marks:
            found += self.once.get(marks) or self._looked_up(marks, self._whole)
        if again and len(word) <= LONGEST_KNOWN and len(self.known) < KNOWN:
            self.known[word] = found
        return found

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids, the end mark last."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        return b"".join(map(self.known.__getitem__, words)) + END.to_bytes(4, "little")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others take the code points from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """For every length: the number of its sequence and its place there."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = defaultdict(list)
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    used = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # what the sum of squares grows by if a sequence with gap size + k takes the piece
        gaps, after = counts[size:capacity], counts[: capacity - size]
        growth = np.where(gaps > 0, 2 * (after - gaps) + 2, np.iinfo(np.int64).max)
        if len(growth) and gaps[0] > 0:
            growth[0] = 1 - 2 * gaps[0]  # filled: it has no gap any more
        fresh = 2 * counts[capacity - size] + 1 if size < capacity else 0
        best = int(growth.argmin()) if len(growth) else 0
        if len(growth) and growth[best] <= fresh:
            gap = size + best
            chosen = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, chosen = capacity, used
            used += 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(chosen)
    return bins, offsets


_COLUMNS = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _pieces(doc_id, ids: bytes, capacity: int) -> Iterator[tuple]:
    total = len(ids) // 4
    for piece, start in enumerate(range(0, total, capacity)):
        part = ids[4 * start : 4 * (start + capacity)]
        yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every row: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is its end mark alone. Repeated rows and ids are packed as
    often as they occur; null ids stay null. Pieces of a sequence follow each other
    from offset 0 without a gap. The same documents give the same sequences, however
    they are stored. An empty table gives an empty table; other columns are left out.
    Writes the pieces into the shared folder before it packs them.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_tokenizer(tokenizer)
        for batch in batches:
            pairs = zip(batch["id"].astype(object), batch["text"], strict=True)
            found = [p for doc_id, text in pairs for p in _pieces(doc_id, words.ids(text), capacity)]
            yield pd.DataFrame(found, columns=["id", *_COLUMNS[:4]])

    def packed(rows: pd.DataFrame, first: int) -> tuple[pd.DataFrame, int]:
        bins, offsets = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        made = rows.assign(sequence_id=(rows["block"].to_numpy(np.int64) << 40) + first + bins, offset=offsets)
        return made[["id", *_COLUMNS]], first + int(bins.max()) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block; a block may span several batches."""
        held, size, first = [], 0, 0
        for batch in batches:
            for block, rows in batch.groupby("block", sort=False):
                if held and held[0]["block"].iloc[0] != block:
                    yield packed(pd.concat(held), first)[0]
                    held, size, first = [], 0, 0
                held.append(rows)
                size += len(rows)
                if size >= 2 * BLOCK:  # only rows repeated without end fill a block so far
                    made, first = packed(pd.concat(held), first)
                    yield made
                    held, size = [], 0
        if held:
            yield packed(pd.concat(held), first)[0]

    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kinds = {"piece": IntegerType()}
    fields = [rows.schema["id"], *[StructField(c, kinds.get(c, LongType())) for c in _COLUMNS]]
    pieces = materialize(rows.mapInPandas(cut, StructType(fields[:5])), "pieces")
    blocks = max(1, -(-pieces.count() // BLOCK))
    spread = pieces.withColumn("mixed", F.xxhash64("id", "piece", "start", "length", "ids_crc32"))
    spread = spread.withColumn("block", F.pmod("mixed", F.lit(blocks)))
    order = ["block", "mixed", "id", "piece", "ids_crc32"]
    ready = spread.repartition(blocks, "block").sortWithinPartitions(*order).drop("mixed")
    return ready.mapInPandas(run, StructType(fields)).withColumnRenamed("id", id_col)
