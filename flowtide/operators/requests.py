"""Scoring requests: parsing, validation, the history they need, alerts."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.constants import (
    ALERT_STEP,
    INITIAL_STOCK,
    LAGS,
    LOOKBACK_HOURS,
    MODEL_INPUTS,
    REQUEST_STATIONS,
    REQUEST_YEAR,
    RIDEABLE_TYPES,
    SERIES,
    SLOT_MINUTES,
    lag_column,
)
from flowtide.functions.calendar import floor_day, minutes
from flowtide.operators.features import calendar_features
from flowtide.schemas import REQUEST


def parse_requests(raw: DataFrame, body: str = "body") -> DataFrame:
    """Requests from a JSON text column, or from plain columns where it is NULL.

    A body that is no JSON object yields NULL fields, which validation rejects.
    """
    names = [f.name for f in REQUEST]
    parsed = F.from_json(body, REQUEST)
    plain = F.struct(*[F.col(n) if n in raw.columns else F.lit(None).cast("string").alias(n) for n in names])
    request = F.when(F.col(body).isNotNull(), parsed).otherwise(plain)
    return raw.select(
        *[c for c in raw.columns if c not in (body, *names)], request.alias("r")
    ).select("*", "r.*").drop("r")


def validate_requests(
    requests: DataFrame,
    stations: Sequence[str] | DataFrame = REQUEST_STATIONS,
    types: Sequence[str] = RIDEABLE_TYPES,
    year: int = REQUEST_YEAR,
    max_month: int | None = None,
) -> DataFrame:
    """Add ``target_day`` and ``reject_reason`` (NULL for a valid request).

    ``stations`` is a list, or a table with a ``station`` column.
    ``max_month=11`` also rejects December.
    """
    if isinstance(stations, DataFrame):
        known = stations.select("station").distinct().withColumn("known", F.lit(True))
        requests = requests.join(known, "station", "left").select(*requests.columns, "known")
        known_station = F.coalesce(F.col("known"), F.lit(False))
    else:
        known_station = F.coalesce(F.col("station").isin(list(stations)), F.lit(False))
    # year-month-day with or without leading zeros, nothing around it
    shaped = F.col("target_date").rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z")
    day = F.when(shaped, F.col("target_date").try_cast("date"))
    reason = (
        F.when(~known_station, "unknown station")
        .when(~F.coalesce(F.col("rideable_type").isin(list(types)), F.lit(False)), "unknown type")
        .when(F.col("target_day").isNull(), "bad date")
        .when(F.year("target_day") != year, "wrong year")
    )
    if max_month is not None:
        reason = reason.when(F.month("target_day") > max_month, "wrong month")
    checked = requests.select("*", day.alias("target_day"))
    return checked.select("*", reason.alias("reject_reason")).drop("known")


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason")


def score_slice(
    requests: DataFrame,
    history: DataFrame,
    lags: int = LAGS,
    rush: str = "half_open",
    slot_minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """Model inputs for every slot of each requested (station, type, day), once each.

    ``requests`` are valid ones with ``target_day``; equal requests share their
    rows. A lag reaches back at most two hours before the day and is NULL where
    the history starts. The history is keyed by day (its ``day`` column, if it has
    one), so requests meet it in plain equi-joins, with no range condition.
    """
    wanted = requests.select(*SERIES, "target_day").distinct()
    # only the wanted days and the last hours before them are sorted; where the
    # history is stored by day, the others are not even read
    before, whole = (F.col("target_day"), F.lit(True)), (F.date_sub("target_day", 1), F.lit(False))
    sides = F.array(*[F.struct(day.alias("day"), all_of.alias("whole")) for day, all_of in (before, whole)])
    needed = wanted.select(*SERIES, F.explode(sides).alias("d")).select(*SERIES, "d.*")
    needed = needed.groupBy(*SERIES, "day").agg(F.max("whole").alias("whole"))
    stored_day = F.col("day") if "day" in history.columns else F.to_date("time")
    evening = F.hour("time") >= 24 - LOOKBACK_HOURS
    near = history.select("time", *SERIES, "stock", stored_day.alias("day")).join(needed, [*SERIES, "day"])
    near = near.where(F.col("whole") | evening).drop("whole")
    along = W.partitionBy(*SERIES).orderBy("time")
    earliest = floor_day("time") - F.expr(f"INTERVAL {LOOKBACK_HOURS} HOURS")
    lagged = near.select(
        "time",
        *SERIES,
        "stock",
        *[
            F.when(F.lag("time", k).over(along) >= earliest, F.lag("stock", k).over(along)).alias(
                lag_column(k, slot_minutes)
            )
            for k in range(1, lags + 1)
        ],
        F.col("day").alias("target_day"),
    )
    rows = lagged.join(wanted, [*SERIES, "target_day"], "left_semi")
    inputs = [c for c in MODEL_INPUTS if not c.startswith("lag_")]
    return calendar_features(rows, rush).select(
        "target_day",
        "time",
        *inputs,
        *[lag_column(k, slot_minutes) for k in range(1, lags + 1)],
    )


def fill_lags(rows: DataFrame, lags: int = LAGS, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Unknown lags, at the start of the history, become the nearest later stock.

    A model without a rule for missing values can then score every slot.
    """
    names = [lag_column(k, slot_minutes) for k in range(1, lags + 1)]
    nearest = {n: F.coalesce(*reversed(names[: i + 1]), "stock") for i, n in enumerate(names)}
    return rows.select(*[nearest.get(c, F.col(c)).alias(c) for c in rows.columns])


def alert_times(
    scored: DataFrame,
    initial_stock: int = INITIAL_STOCK,
    step: int = ALERT_STEP,
    slot_minutes: int = SLOT_MINUTES,
) -> DataFrame:
    """Stock-out alerts per (station, type, day): an array of times as text.

    A prediction made at a slot is about the next one. Going through the day, a
    prediction below the limit is an alert and lowers the limit by ``step``, at
    most once per slot. The day's predictions are one array of a day's slots.
    """
    due = (F.col("time") + minutes(slot_minutes)).alias("due")
    day = F.array_sort(F.collect_list(F.struct(due, F.col("prediction").cast("double").alias("p"))))
    start = F.struct(
        F.lit(float(initial_stock - step)).alias("limit"),
        F.array().cast("array<timestamp_ntz>").alias("alerts"),
    )

    def visit(state, row):
        low = row["p"] < state["limit"]
        return F.when(
            low,
            F.struct(
                (state["limit"] - F.lit(float(step))).alias("limit"),
                F.array_append(state["alerts"], row["due"]).alias("alerts"),
            ),
        ).otherwise(state)

    times = F.aggregate("day", start, visit, lambda s: s["alerts"])
    return (
        scored.groupBy(*SERIES, "target_day")
        .agg(day.alias("day"), (F.count("prediction") == 0).alias("unscored"))
        .select(
            *SERIES,
            "target_day",
            "unscored",
            # a slot as text is year to second, with no fraction, whatever the session zone
            F.transform(times, lambda t: t.cast("string")).alias("prediction"),
        )
    )


def answer_requests(requests: DataFrame, alerts: DataFrame) -> DataFrame:
    """Each valid request with its alerts and a warning flag.

    ``no_history``: the history does not hold the day. ``unscored``: it does, but the
    model gave no prediction, as for a station that it has not seen.
    """
    joined = requests.join(alerts, [*SERIES, "target_day"], "left")
    times = F.coalesce("prediction", F.array().cast("array<string>"))
    return joined.select(
        *requests.columns,
        times.alias("prediction"),
        (F.size(times) > 0).alias("warning"),
        F.col("prediction").isNull().alias("no_history"),
        F.coalesce("unscored", F.lit(False)).alias("unscored"),
    )


def score_error(scored: DataFrame) -> DataFrame:
    """Actual stock, predicted stock, and actual minus predicted, per slot."""
    return scored.select(
        "target_day",
        "time",
        *SERIES,
        F.col("stock").alias("actual_stock"),
        F.col("prediction").alias("predicted_stock"),
        (F.col("stock") - F.col("prediction")).alias("error"),
    )
