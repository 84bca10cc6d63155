"""Cut an ordered table by row position, without sorting it as a whole."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import SERIES, TRAIN_FRACTION


def _rows_at(df: DataFrame, cuts, time: str, ties: Sequence[str]) -> Column:
    """The (time, ties) keys of the rows at some positions, as one sorted array.

    ``cuts`` makes an array of positions from the number of rows. The rows are
    counted per time slot, the slots that hold a position are found from the
    running counts, and only the rows of those slots are ranked.
    """
    per_slot = df.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
    # slots are summed per day first: the running sum over days is a short table
    day = F.to_date(time).alias("day")
    by_day = per_slot.groupBy(day).agg(F.sum("n").alias("day_n"))
    before = F.sum("day_n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, -1))
    before_day = by_day.select("day", F.coalesce(before, F.lit(0)).alias("before_day"))
    within_day = W.partitionBy("day").orderBy(time).rowsBetween(W.unboundedPreceding, 0)
    total = by_day.agg(F.sum("day_n")).scalar()
    running = (
        per_slot.select(time, "n", day)
        .join(before_day, "day")
        .select(
            time,
            (F.col("before_day") + F.sum("n").over(within_day)).alias("upto"),
            "n",
            cuts(total).alias("cuts"),
        )
    )
    first = F.col("upto") - F.col("n")
    inside = F.filter("cuts", lambda c: (c >= first) & (c < F.col("upto")))
    slots = running.select(time, F.explode(inside).alias("cut"), first.alias("first")).select(
        F.col(time), (F.col("cut") - F.col("first") + 1).alias("rank_wanted")
    )
    wanted = slots.groupBy(time).agg(F.collect_set("rank_wanted").alias("ranks"))
    rank = F.row_number().over(W.partitionBy(time).orderBy(*ties))
    key = F.struct(time, *ties)
    ranked = df.join(wanted, time).select(key.alias("key"), rank.cast("bigint").alias("rank"), "ranks")
    keys = ranked.where(F.array_contains("ranks", F.col("rank"))).select("key")
    return keys.agg(F.array_sort(F.collect_list("key"))).scalar()


def ordered_split(
    df: DataFrame,
    fraction: float = TRAIN_FRACTION,
    time: str = "time",
    ties: Sequence[str] = SERIES,
) -> DataFrame:
    """Add ``is_train``: the first int(fraction * n) rows by (time, ties).

    A row is compared with the first row after the cut, so nothing is sorted.
    (time, ties) must be unique. ``df`` is passed over three times: store it first.
    """
    cut = _rows_at(df, lambda n: F.array(F.floor(n * F.lit(float(fraction)))), time, ties)
    key = F.struct(time, *ties)
    # no such row: all of them are training rows
    return df.select("*", F.coalesce(key < F.get(cut, 0), F.lit(True)).alias("is_train"))


def ordered_folds(
    df: DataFrame, folds: int, time: str = "time", ties: Sequence[str] = SERIES
) -> DataFrame:
    """Add ``fold``: contiguous blocks of rows by (time, ties), numbered from 0.

    Sizes differ by at most one; the larger blocks come first.
    """

    def starts(n: Column) -> Column:
        size, extra = F.floor(n / F.lit(folds)), n % F.lit(folds)
        return F.array(
            *[(size * F.lit(i) + F.least(F.lit(i), extra)).cast("bigint") for i in range(1, folds)]
        )

    keys = _rows_at(df, starts, time, ties)
    key = F.struct(time, *ties)
    fold = F.size(F.filter("_starts", lambda k: k <= key))
    return df.select("*", keys.alias("_starts")).select(*df.columns, fold.alias("fold"))


def train_rows(df: DataFrame, fraction: float = TRAIN_FRACTION, **keys) -> DataFrame:
    return ordered_split(df, fraction, **keys).where("is_train").drop("is_train")


def test_rows(df: DataFrame, fraction: float = TRAIN_FRACTION, **keys) -> DataFrame:
    """The held-out rows; also the reference rows of performance monitoring."""
    return ordered_split(df, fraction, **keys).where(~F.col("is_train")).drop("is_train")


test_rows.__test__ = False  # not a pytest case
