"""Running totals over groups that may be far too large for one task.

A plain window sorts a whole group in one task. Here every group is cut along its
sort order into buckets, and the window over the rows only ever holds one bucket.
The first row of each bucket carries the bucket's totals; among these rows, far
fewer and narrow, a second window finds what came before a bucket and what comes
after it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_over_buckets(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[str],
    sums: dict[str, Column],
    leads: dict[str, str],
) -> DataFrame:
    """Add running sums and next-row values per ``group`` along (bucket, order).

    ``bucket`` must not decrease along ``order``. ``sums`` maps an output name to
    the expression that is added up to and including the row. ``leads`` maps an
    output name to the column whose value in the next row is wanted. ``order``
    must be unique within a group.
    """
    # the keys as one struct: a NULL key is a group like any other, in the window
    # and in the join, and one shuffle of the rows serves both sides of the join
    keys = [*group, bucket]
    rest = [c for c in df.columns if c not in keys]
    keyed = df.select(F.struct(*keys).alias("_key"), *rest)
    within = W.partitionBy("_key").orderBy(*order)
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    head = list(dict.fromkeys([*order, *leads.values()]))
    firsts = keyed.select(
        "_key",
        *head,
        F.row_number().over(within).alias("_rank"),
        *[F.sum(v).over(W.partitionBy("_key")).alias(f"_sum_{n}") for n, v in sums.items()],
    ).where(F.col("_rank") == 1)
    firsts = firsts.select(
        "_key", F.struct(*head).alias("_first"), *[f"_sum_{n}" for n in sums]
    )
    along = W.partitionBy(*[F.col("_key")[g] for g in group]).orderBy(F.col("_key")[bucket])
    before = along.rowsBetween(W.unboundedPreceding, -1)
    around = firsts.select(
        "_key",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        F.lead("_first").over(along).alias("_after"),
    )
    rows = keyed.select(
        "*",
        *[F.sum(value).over(upto).alias(f"_upto_{n}") for n, value in sums.items()],
        *[F.lead(source).over(within).alias(f"_lead_{n}") for n, source in leads.items()],
        F.lead(F.lit(1)).over(within).isNull().alias("_last"),
    )
    columns = {c: F.col("_key")[c] if c in keys else F.col(c) for c in df.columns}
    columns |= {n: F.col(f"_before_{n}") + F.col(f"_upto_{n}") for n in sums}
    columns |= {
        n: F.when(F.col("_last"), F.col("_after")[source]).otherwise(F.col(f"_lead_{n}"))
        for n, source in leads.items()
    }
    return rows.join(around, "_key").select(*[c.alias(n) for n, c in columns.items()])
