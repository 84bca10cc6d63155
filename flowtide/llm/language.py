"""Language identification by n-gram filters whose slots are bitmasks of languages.

One Bloom filter serves all languages: a slot holds one bit for each language, so
the slots of an n-gram, ANDed, say at once in which languages it occurs. A text's
language is the one with the largest number of n-grams found, each count corrected
for the false positives that the filling of that language's bits leads to expect.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.llm.common import column, fold, fresh
from flowtide.session import materialize

UNDETERMINED = "und"
SIZES = (2, 3, 4)  # letters of an n-gram, blanks at the ends of a word included
SLOTS = 1 << 21
PROBES = 3
SAMPLE = 1500  # documents of a language that the filter is fitted on, chosen by hash
SHARE = 0.03  # of these documents in which an n-gram has to occur
AT_ONCE = 1 << 18  # letters of a text that are worked on at once
HELD_OUT = 2
FOLDS = 4
BITS = 64

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point its own value if it is a letter, else a blank."""
    points = np.arange(0x110000, dtype=np.uint32)
    is_letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, len(points))
    return np.where(is_letter, points, np.uint32(32))


def _runs(text: str) -> Iterator[np.ndarray]:
    """The letters of a text, lower case, all else blank, in blocks that cut no n-gram."""
    overlap = max(SIZES) - 1
    for start in range(0, len(text), AT_ONCE):
        part = text[max(0, start - overlap) : start + AT_ONCE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        letters = _letters()[codes]
        if start == 0:
            letters = np.r_[np.uint32(32), letters]
        if start + AT_ONCE >= len(text):
            letters = np.r_[letters, np.uint32(32)]
        yield letters


def _grams(letters: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every n-gram that has blanks at its ends only."""
    blank = letters == 32
    found = []
    for n in SIZES:
        count = len(letters) - n + 1
        if count <= 0:
            continue
        inner = np.zeros(count, bool)
        for k in range(1, n - 1):
            inner |= blank[k : k + count]
        if n == 2:
            inner = blank[:count] & blank[1:]
        keep = np.flatnonzero(~inner)
        value = np.full(len(keep), n, np.uint64)
        for k in range(n):
            value = (value ^ letters[keep + k].astype(np.uint64)) * _MIX
            value ^= value >> np.uint64(29)
        found.append(value)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def ngrams(text: str) -> Iterator[np.ndarray]:
    for letters in _runs(text):
        yield _grams(letters)


def _places(grams: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    for odd in _ODD[:PROBES]:
        mixed = grams * odd
        yield ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(slots - 1)).astype(np.int64)


class LanguageFilter:
    """Bitmasks of languages by slot. ``masks`` has a word for each 64 languages."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages = languages
        self.masks = masks  # (words, slots)
        self.slots = masks.shape[1]
        filled = self._per_language(masks) / self.slots
        self.false = np.minimum(filled**PROBES, 1 - 1e-9)

    def _per_language(self, words: np.ndarray) -> np.ndarray:
        """How many of the masks have each language's bit."""
        counts = np.zeros(len(self.languages))
        for i in range(len(self.languages)):
            bit = np.uint64(1) << np.uint64(i % BITS)
            counts[i] = np.count_nonzero(words[i // BITS] & bit)
        return counts

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """N-grams of a text found for each language, corrected, and all its n-grams."""
        hits, total = np.zeros(len(self.languages)), 0
        for grams in ngrams(text):
            masks = None
            for places in _places(grams, self.slots):
                got = self.masks[:, places]
                masks = got if masks is None else masks & got
            hits += self._per_language(masks)
            total += len(grams)
        return np.maximum(0.0, (hits - total * self.false) / (1 - self.false)), total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, the first by name among equals, and its share of all n-grams.

        ``und`` and 0 if the text is null or without a letter, or nothing was learned.
        """
        if not text or not self.languages:
            return UNDETERMINED, 0.0
        counts, total = self.counts(text)
        if not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        best = int(np.argmax(counts))
        return self.languages[best], float(min(1.0, counts[best] / max(total, 1)))


def _document_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct n-grams of each document."""
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            grams = np.unique(np.concatenate([np.empty(0, np.uint64), *ngrams(text or "")]))
            yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64)})


def _slot_rows(languages: list[str]):
    """The slots of every n-gram, with the bit of its language."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.uint64)
            masks = (np.uint64(1) << (number % np.uint64(BITS))).view(np.int64)
            word = (number // np.uint64(BITS)).astype(np.int32)
            for places in _places(batch["gram"].to_numpy().view(np.uint64), SLOTS):
                yield pd.DataFrame({"word": word, "slot": places, "mask": masks})

    return rows


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", sample: int = SAMPLE) -> LanguageFilter:
    """Learn a filter from labelled rows: at most ``sample`` of each language.

    Rows with a null language or text teach nothing. The n-grams are counted by Spark;
    the driver gets no more than one mask for each slot, whatever the number of rows.
    """
    labelled = docs.select(column(lang_col).alias("lang"), column(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    # the rows are chosen by hash alone, so that no text is sorted
    chosen = (
        labelled.select("lang", F.xxhash64("text", F.lit(7)).alias("order"))
        .distinct()
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("order")))
        .where(F.col("rank") <= sample)
        .select("lang", "order")
    )
    # bounded by the sample; as a table Spark knows its size before it plans the join
    chosen = materialize(chosen, "chosen")
    texts = labelled.withColumn("order", F.xxhash64("text", F.lit(7))).join(chosen, ["lang", "order"], "left_semi")
    texts = texts.groupBy("lang", "order").agg(F.first("text").alias("text"))
    sizes = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    masks = np.zeros(((len(languages) + BITS - 1) // BITS or 1, SLOTS), np.uint64)
    if not languages:
        return LanguageFilter([], masks)
    needed = F.greatest(F.lit(2.0), F.ceil(F.lit(SHARE) * F.col("n")).cast("double"))
    needed = F.when(F.col("n") < 3, F.lit(1.0)).otherwise(needed)
    known = chosen.groupBy("lang").agg(F.count("*").alias("n"))
    grams = (
        texts.select("lang", "text")
        .mapInPandas(_document_grams, "lang string, gram long")
        .groupBy("lang", "gram")
        .agg(F.count("*").alias("documents"))
        .join(known, "lang")
        .where(F.col("documents") >= needed)
        .select("lang", "gram")
    )
    slots = (
        grams.mapInPandas(_slot_rows(languages), "word int, slot long, mask long")
        .groupBy("word", "slot")
        .agg(F.bit_or("mask").alias("mask"))
    )
    table = slots.toPandas()
    masks[table["word"].to_numpy(), table["slot"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, masks)


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with one more column, a struct of ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks))

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = LanguageFilter(*shared.value)
        for texts in batches:
            yield pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn(out, guess(column(text_col)))


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that may teach: all but the fold that is held out."""
    return docs.where(fold(column(id_col), FOLDS) != HELD_OUT)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` for every row, learned from ``docs`` itself.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text
    if no row teaches. Ties go to the first language by name. Repeated rows and ids
    keep all their rows; a null id is held out or not as the empty text would be.
    """
    model = fit(learnable(docs, id_col), lang_col, text_col)
    out = fresh(docs, "language")
    held = fold(column(id_col), FOLDS) == HELD_OUT
    return predict(docs, model, text_col, out).select(
        column(id_col), held.alias("held_out"), column(out)["lang_pred"].alias("lang_pred"),
        column(out)["score"].alias("score"),
    )


#: Least share of n-grams that a text must have in its language to be kept.
LEAST_SCORE = 0.2


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that have no language, or hardly any of their n-grams in it."""
    model = fit(learnable(docs, id_col), lang_col, text_col)
    out = fresh(docs, "language")
    kept = predict(docs, model, text_col, out).where(
        (column(out)["lang_pred"] != UNDETERMINED) & (column(out)["score"] >= LEAST_SCORE)
    )
    return kept.select(*[column(c) for c in docs.columns])
