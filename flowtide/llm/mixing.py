"""Mixing sources to target weights, cut at exact budgets.

Every document has a hash-random key. Along its source's keys the sizes are added up,
and the source's budget cuts that line at one place: whole passes over the source
first (epochs), then the documents before the cut once more, and of the document at
the cut the words that still fit. Only DataFrame functions; no UDF.

A source with a third of all rows is no single task's work: the line is cut into
``4096`` stretches by the leading digits of the key, sums of stretches are narrow and
pre-aggregated, and only the stretch that holds the cut is ever added up row by row.
What reaches the documents is one row for each source.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.llm.common import column, fresh
from flowtide.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
DIGITS = 3  # leading hex digits of a key that name its stretch: 16 ** 3 stretches
SALTS = 64


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixing_key(doc_id: Column) -> Column:
    """A key as good as random that any engine can repeat: md5 of the id."""
    return F.md5(F.concat(F.lit("mix "), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def targets(sources: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum of
    all sizes; no target exceeds three times its source's size. What is above it is
    shared again by weight, which ends at one level: a target is the weight times the
    level, or the limit where that is less. The sources with the lowest limit a
    weight reach theirs first, so one running sum along that order finds the level.
    The windows hold one row a source, never one a document.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    everything = W.partitionBy()
    # both windows run over the per-source sums only
    placed = sources.withColumn(
        "place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", weight.cast("long"))
    limit = F.col("source_size") * MOST_EPOCHS
    order = W.orderBy(limit / F.col("weight"), "place")
    ranked = (
        placed.withColumn("below", F.sum(limit).over(order) - limit)
        .withColumn("heavier", F.sum("weight").over(everything) - F.sum("weight").over(order) + F.col("weight"))
        .withColumn("all", F.sum("source_size").over(everything))
    )
    # along the order, the level if all sources before are at their limit and no other
    level = (F.col("all") - F.col("below")) / F.col("heavier")
    first_free = F.min(F.when(limit / F.col("weight") >= level, F.struct("place_free", "below", "heavier", "all")))
    ranked = ranked.withColumn("place_free", F.row_number().over(order)).withColumn(
        "free", first_free.over(everything)
    )
    share = (
        (F.col("free.all") - F.col("free.below")).cast("double")
        * F.col("weight").cast("double")
        / F.col("free.heavier").cast("double")
    )
    target = F.when(F.col("place_free") < F.col("free.place_free"), limit.cast("double")).otherwise(
        F.least(share, limit.cast("double"))
    )
    return ranked.select("source", "source_size", target.alias("target"))


def cuts(sized: DataFrame) -> DataFrame:
    """One row a source: ``source, source_size, target, epochs, cut_key, cut_words, cut_size``.

    ``sized`` has ``source, key, size``. Documents with a key below ``cut_key`` are
    taken ``epochs + 1`` times, those above ``epochs`` times; at the cut, ``cut_words``
    of ``cut_size`` words more (rows with equal keys share them).
    """
    stretch = F.substring("key", 1, DIGITS)
    sums = materialize(
        sized.groupBy("source", stretch.alias("stretch")).agg(F.sum("size").alias("size")), "stretches"
    )
    goals = materialize(
        targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")))
        .withColumn("budget", F.floor("target").cast("long"))
        .withColumn(
            "epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"),
        )
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")),
        "goals",
    )
    along = W.partitionBy("source").orderBy("stretch")
    named = F.col("s.source").eqNullSafe(F.col("g.source"))
    upto = F.col("upto")
    held = (
        sums.withColumn("upto", F.sum("size").over(along))
        .alias("s")
        .join(goals.alias("g"), named)
        .where((F.col("rest") > 0) & (upto >= F.col("rest")) & (upto - F.col("s.size") < F.col("rest")))
        .select("g.*", "stretch", (upto - F.col("s.size")).alias("before"))
    )
    rows = sized.withColumn("stretch", stretch).alias("r")
    inside = (
        rows.join(held.alias("h"), F.col("r.source").eqNullSafe(F.col("h.source")) & (F.col("r.stretch") == F.col("h.stretch")))
        .groupBy("h.source", "h.rest", "h.before", "r.key")
        .agg(F.sum("r.size").alias("size"))
    )
    upto = F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("key"))
    at = (
        inside.withColumn("upto", upto)
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
        .select(
            F.col("source").alias("of"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"),
            (F.col("rest") - F.col("upto") + F.col("size")).alias("cut_words"),
        )
    )
    found = goals.join(at, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "epochs", "cut_key", "cut_words", "cut_size"
    )
    # as a table Spark knows its size before it plans the join with the documents
    return materialize(found, "cuts")


def taken(size: Column, key: Column, at: str = "_cut") -> Column:
    """Words that the mix takes of a document, from the cut of its source."""
    more = (
        F.when(key < F.col(f"{at}.cut_key"), size)
        .when(key == F.col(f"{at}.cut_key"), F.floor(size * F.col(f"{at}.cut_words") / F.col(f"{at}.cut_size")))
        .otherwise(0)
    )
    return (F.col(f"{at}.epochs") * size + F.coalesce(more, F.lit(0))).cast("long")


def _with_cuts(rows: DataFrame, source: Column, salt: Column, found: DataFrame, cut: str = "_cut") -> DataFrame:
    """Rows with a column ``cut``: their source's cut. Salted, so that no source is one task."""
    at = fresh(rows, "_at")
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        F.struct("source", "salt").alias(at),
        F.struct("source_size", "target", "epochs", "cut_key", "cut_words", "cut_size").alias(cut),
    )
    on = F.struct(source.alias("source"), salt.cast("int").alias("salt"))
    return rows.join(salted, on.eqNullSafe(F.col(at))).drop(at)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``id_col, source, size, source_size, target, taken`` for every row of ``docs``.

    Sizes are words. A null or blank text has size 0 and is taken 0 times; a source of
    such texts has target 0. A null source is a source, the last one. Each source's
    taken words add up to its target, rounded down, but for rows with equal ids: they
    have equal keys and are cut alike. Empty tables give empty tables.
    """
    sized = materialize(
        docs.select(
            column(id_col).alias("id"),
            column(source_col).alias("source"),
            word_count(column(text_col)).alias("size"),
            mixing_key(column(id_col)).alias("key"),
        ),
        "sized",
    )
    salt = F.pmod(F.hash("key"), F.lit(SALTS))
    rows = _with_cuts(sized.alias("r"), F.col("r.source"), salt, cuts(sized))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("r.source").alias("source"),
        "size",
        "_cut.source_size",
        "_cut.target",
        taken(F.col("size"), F.col("key")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str = "n_chars",
) -> DataFrame:
    """The mix itself: ``docs`` with every row as often as it is taken.

    Of a document that a budget cuts, the last copy keeps the words taken, and its
    ``chars_col`` is set to its length. Texts are read twice and not shuffled unless
    the sources are too many for Spark to broadcast their cuts. Null and blank texts are
    taken 0 times; null sources and ids, and empty tables, are as in :func:`mix`. Columns
    are those of ``docs``, whatever they are called.
    """
    names = {n: fresh(docs, n) for n in ("size", "key", "cut", "part")}
    size, key = column(names["size"]), column(names["key"])
    text = column(text_col)
    source = column(source_col)
    sized = docs.select(source.alias("source"), word_count(text).alias("size"), mixing_key(column(id_col)).alias("key"))
    found = cuts(materialize(sized, "sized"))
    rows = docs.withColumns({names["size"]: word_count(text), names["key"]: mixing_key(column(id_col))})
    rows = _with_cuts(rows, source, F.pmod(F.hash(key), F.lit(SALTS)), found, names["cut"])
    words = taken(size, key, names["cut"])
    whole = F.when(size > 0, F.floor(words / size)).otherwise(0).cast("int")
    left = words - whole * size
    parts = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), whole), F.when(left > 0, F.array(left)).otherwise(F.array())
    )
    rows = rows.withColumn(names["part"], F.explode(parts))
    part = column(names["part"])
    # the first words with all blanks between them
    first = F.array_join(
        F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), part.cast("int")), ""
    )
    kept = F.when(part < 0, text).otherwise(first)
    out = []
    for name in docs.columns:
        value = column(name)
        if name == text_col:
            value = kept
        elif name == chars_col:
            value = F.when(part < 0, value).otherwise(F.length(first).cast(docs.schema[name].dataType))
        out.append(value.alias(name))
    return rows.select(*out)
