"""Document fingerprints from prefix polynomial hashes.

The hash of a text's first p characters is the sum of c(i) * B^i over i < p, modulo a
prime. From two such values follows the hash of any span, so equal spans are found
without reading them again, and the longest common extension of two places by binary
search, since prefixes agree up to a point and never after it.

A fingerprint keeps the prefix and suffix hashes at lengths that grow by a fixed
ratio, a few dozen for any text. The likeness of two fingerprints is the part of the
longer text that a common prefix and a common suffix are known to cover.
"""

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

from flowtide.llm.common import column
from flowtide.operators.bucketed import running_over_buckets
from flowtide.session import materialize

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_000_003, 998_244_353)
BLOCK = 4096  # so many products of a code point and a power add up below 2 ** 64
DENSE = 8  # lengths up to which each has its own check point
RATIO = 1.19


@lru_cache(1)
def _powers() -> tuple[np.ndarray, ...]:
    found = []
    for base, prime in zip(BASES, PRIMES, strict=True):
        powers = [1]
        for _ in range(BLOCK - 1):
            powers.append(powers[-1] * base % prime)
        found.append(np.array(powers, np.uint64))
    return tuple(found)


@lru_cache(1)
def _grid() -> np.ndarray:
    lengths = list(range(1, DENSE + 1))
    while lengths[-1] < 1 << 40:
        lengths.append(int(lengths[-1] * RATIO) + 1)
    return np.array(lengths, np.int64)


def _codes(text: str) -> np.ndarray:
    """Code points, plus one so that no character is nothing."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


def _prefixes(codes: np.ndarray, lengths: np.ndarray, which: int) -> np.ndarray:
    """Hashes of the prefixes of the given lengths, ascending, in bounded memory."""
    prime, base, powers = PRIMES[which], BASES[which], _powers()[which]
    found = np.zeros(len(lengths), np.uint64)
    before, shift = 0, 1
    step = pow(base, BLOCK, prime)
    for start in range(0, max(len(codes), 1), BLOCK):
        block = codes[start : start + BLOCK]
        low, high = np.searchsorted(lengths, (start, start + len(block)), side="right")
        if start == 0:
            low = np.searchsorted(lengths, 0, side="right")
        sums = np.cumsum(block * powers[: len(block)])
        at = sums[lengths[low:high] - start - 1] % np.uint64(prime)
        found[low:high] = (np.uint64(before) + at * np.uint64(shift)) % np.uint64(prime)
        if len(sums):
            before = (before + int(sums[-1]) % prime * shift) % prime
        shift = shift * step % prime
    return found


class PrefixHashes:
    """All prefix hashes of a text: any span's hash, and common extensions."""

    def __init__(self, text: str):
        codes = _codes(text)
        self.length = len(codes)
        every = np.arange(self.length + 1)
        self.values = [_prefixes(codes, every, k) for k in range(len(PRIMES))]

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        """Equal for equal spans, wherever they stand, in whatever text."""
        return tuple(
            (int(v[stop]) - int(v[start])) * pow(base, -start, prime) % prime
            for v, base, prime in zip(self.values, BASES, PRIMES, strict=True)
        )


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many characters from ``i`` in one text and ``j`` in the other agree."""
    low, high = 0, min(a.length - i, b.length - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _packed(first: np.ndarray, second: np.ndarray) -> str:
    mixed = (first * np.uint64(0x9E3779B1) + second) & np.uint64(0xFFFFFFFF)
    return base64.b64encode(mixed.astype("<u4").tobytes()).decode()


def fingerprint(text: str | None) -> str:
    """Length, hash of the whole, and the check points of prefixes and suffixes."""
    codes = _codes(text or "")
    n = len(codes)
    grid = _grid()[: np.searchsorted(_grid(), n)]
    cuts = np.unique(np.concatenate([grid, n - grid, [n]])).astype(np.int64)
    whole, heads, tails = [], [], []
    for which, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
        values = _prefixes(codes, cuts, which)
        at = lambda lengths: values[np.searchsorted(cuts, lengths)]  # noqa: E731, B023
        total = int(values[-1])
        whole.append(total)
        heads.append(at(grid))
        back = _inverse_powers(n - grid, which)
        tails.append((np.uint64(total + prime) - at(n - grid)) % np.uint64(prime) * back % np.uint64(prime))
    marks = "".join(f"{w:08x}" for w in whole)
    return f"{n}:{marks}:{_packed(*heads)}:{_packed(*tails)}"


@lru_cache(4)
def _inverse_block(which: int) -> tuple[np.ndarray, np.ndarray]:
    """B^-i for i < BLOCK, and for multiples of BLOCK."""
    prime = PRIMES[which]
    tables = []
    for step in (pow(BASES[which], -1, prime), pow(BASES[which], -BLOCK, prime)):
        powers = [1]
        for _ in range(BLOCK - 1):
            powers.append(powers[-1] * step % prime)
        tables.append(np.array(powers, np.uint64))
    return tables[0], tables[1]


def _inverse_powers(exponents: np.ndarray, which: int) -> np.ndarray:
    prime = PRIMES[which]
    if len(exponents) and exponents.max() >= BLOCK * BLOCK:
        return np.array([pow(BASES[which], -int(e), prime) for e in exponents], np.uint64)
    small, large = _inverse_block(which)
    return small[exponents % BLOCK] * large[exponents // BLOCK] % np.uint64(prime)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """The longest length of the grid up to which two rows of check points agree."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return int(_grid()[low - 1]) if low else 0


def likeness(one: str, other: str) -> float:
    """1 for equal texts; else what a common prefix and suffix cover of the longer one."""
    if one == other:
        return 1.0
    (n, _, *a), (m, _, *b) = one.split(":"), other.split(":")
    n, m = int(n), int(m)
    rows = [[np.frombuffer(base64.b64decode(x), "<u4") for x in side] for side in (a, b)]
    covered = sum(_agreeing(x, y) for x, y in zip(*rows, strict=True))
    return min(covered, n, m) / max(n, m)


# Texts travel compressed between tasks: they are read and cut in Python anyway.
def _pack(text: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text.encode("utf-8", "surrogatepass"))


def _unpack(packed: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass")


@F.pandas_udf(StructType([StructField("fingerprint", StringType()), StructField("packed", BinaryType())]))
def _prepared(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        {"fingerprint": [fingerprint(t) for t in texts], "packed": [_pack(t) for t in texts]}, dtype=object
    )


@F.pandas_udf(BinaryType())
def _first_part(packed: pd.Series, length: pd.Series) -> pd.Series:
    return pd.Series([_pack(_unpack(p)[:n]) for p, n in zip(packed, length, strict=True)], dtype=object)


_EDITED = StructType(
    [
        StructField("edited_sha256", StringType()),
        StructField("edited_fingerprint", StringType()),
        StructField("near_edited", DoubleType()),
        StructField("near_next", DoubleType()),
    ]
)


@F.pandas_udf(_EDITED)
def _edited(packed: pd.Series, kept: pd.Series, given: pd.Series, own: pd.Series, after: pd.Series) -> pd.DataFrame:
    """All that is said of the edited text, in one pass through one Python worker."""
    rows = []
    for p, n, g, mine, following in zip(packed, kept, given, own, after, strict=True):
        text = _unpack(p)[:n] + _unpack(g)
        made = fingerprint(text)
        digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        rows.append((digest, made, likeness(mine, made), likeness(mine, following)))
    return pd.DataFrame(rows, columns=_EDITED.names)


def _neighbours(rows: DataFrame) -> DataFrame:
    """``key, hash, n_chars`` of the distinct documents, and ``next_`` key, hash and
    nameless, in a ring.

    Along ascending ids, null last, then hashes. The ids are dealt out by range, and
    only one row for each range enters a window of its own.
    """
    order = ["nameless", "key", "hash"]
    ids = rows.select(*order, "n_chars").distinct()
    dealt = ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    led = running_over_buckets(dealt, [], "part", order, {}, {f"next_{c}": c for c in order})
    first = dealt.orderBy(*order).select(*order).limit(1).collect()
    last = F.col("next_hash").isNull()
    after = {c: F.col(f"next_{c}") for c in order}
    if first:
        kinds = dealt.schema
        after = {c: F.when(last, F.lit(first[0][c]).cast(kinds[c].dataType)).otherwise(after[c]) for c in order}
    return led.select("key", "hash", "n_chars", *[value.alias(f"next_{c}") for c, value in after.items()])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited texts, for every row of ``docs``.

    Columns: ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. In the edited text the last half of the characters,
    rounded down, gives way to the first as many of the next document, by ascending id;
    after the last comes the first. A null text is empty. Rows that agree in id and
    text are one document and get equal results; rows that agree in the id alone are
    ordered by the hash of their text; a null id comes last. A single document is its
    own next one. An empty table gives an empty table.

    The texts are shuffled once by id, compressed, and of each the part that its
    predecessor needs goes on to it.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), text.alias("text"))
    # keys without nulls, so that all joins and shuffles are by the same plain columns
    nameless = F.col("id").isNull()
    rows = rows.withColumns(
        {
            "nameless": nameless,
            "key": F.coalesce("id", F.lit(0).cast(rows.schema["id"].dataType)),
            "hash": F.xxhash64("text", nameless),
            "n_chars": F.length("text").cast("long"),
        }
    )
    ring = materialize(_neighbours(rows), "ring")
    # seen from the document that comes next: who needs how many of its characters
    needed = ring.select(
        F.col("next_key").alias("key"), F.col("next_hash").alias("hash"), F.col("next_nameless").alias("nameless"),
        F.col("key").alias("before_key"), F.col("hash").alias("before_hash"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("need"),
    )
    # both uses of this join take the same columns of the texts, so they are shuffled once
    whole = rows.select("key", "hash", "n_chars", _prepared("text").alias("made")).select(
        "key", "hash", "n_chars", "made.fingerprint", "made.packed"
    )
    met = whole.join(needed, ["key", "hash"])
    own = met.select(
        "key", "hash", F.when(~F.col("nameless"), F.col("key")).alias("id"), "n_chars", "fingerprint", "packed"
    )
    given = (
        met.select(
            F.col("before_key").alias("key"), F.col("before_hash").alias("hash"),
            _first_part("packed", F.least("need", "n_chars")).alias("given"),
            F.col("fingerprint").alias("next_fingerprint"),
        )
        .groupBy("key", "hash")
        .agg(F.first("given").alias("given"), F.first("next_fingerprint").alias("next_fingerprint"))
    )
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 2)
    made = _edited("packed", kept, "given", "fingerprint", "next_fingerprint")
    paired = own.join(given, ["key", "hash"]).select("id", "n_chars", "fingerprint", made.alias("edited"))
    return paired.select(
        F.col("id").alias(id_col), "n_chars", "edited.edited_sha256", "fingerprint",
        "edited.edited_fingerprint", "edited.near_edited", "edited.near_next",
    )
