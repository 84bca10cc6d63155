"""Operators against plain Python or NumPy on small inputs."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import ts
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowtide.operators import drift, features, forecast, profile, requests, reshape, split, upsert
from flowtide.operators.bucketed import running_over_buckets
from flowtide.sources.events import trips_from_events

STOCK = "time timestamp_ntz, station string, rideable_type string, stock long"


def stock_frame(spark, series: dict[tuple[str, str], list[int]], start="2024-01-02 00:00:00"):
    first = ts(start)
    rows = [
        (first + timedelta(minutes=15 * i), s, k, v)
        for (s, k), values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, STOCK)


def walk(seed, n):
    return [int(v) for v in 10 + np.random.default_rng(seed).integers(-2, 3, n).cumsum()]


# --- bucketed windows -----------------------------------------------------------


def test_bucketed_window_equals_plain_window_with_a_hot_group(spark):
    draw = random.Random(5)
    hot = [("hot", draw.randrange(500), i) for i in range(2000)]
    rows = hot + [(f"g{draw.randrange(50)}", draw.randrange(500), 10_000 + i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, t int, id int").withColumn("b", F.floor(F.col("t") / 20))
    got = running_over_buckets(
        df, ["g"], "b", ["t", "id"], {"total": F.col("t"), "n": F.lit(1)}, {"next": "id"}
    )
    w = W.partitionBy("g").orderBy("t", "id")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    plain = df.select(
        "*", F.sum("t").over(upto).alias("total"), F.sum(F.lit(1)).over(upto).alias("n"),
        F.lead("id").over(w).alias("next"),
    )
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_events_pair_up_within_a_hot_user(spark):
    start = datetime(2024, 1, 1)
    events = [(i, start + timedelta(seconds=17 * i), 1, f"e{i % 3}") for i in range(1001)]
    events += [(2000 + i, start + timedelta(seconds=i), 2 + i, "x") for i in range(5)]
    frame = spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    trips = trips_from_events(frame).orderBy("started_at").collect()
    assert len(trips) == 500
    for i, t in enumerate(trips):
        assert (t.ride_id, t.ended_at) == (str(2 * i), start + timedelta(seconds=17 * (2 * i + 1)))
        assert (t.start_station_name, t.end_station_name) == (f"e{2 * i % 3}", f"e{(2 * i + 1) % 3}")


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5), (None, 30)], "g string, t int")
    df = df.withColumn("b", F.floor(F.col("t") / 10))
    got = running_over_buckets(df, ["g"], "b", ["t"], {"total": F.col("t")}, {"next": "t"})
    assert {(r.g, r.t, r.total, r.next) for r in got.collect()} == {
        (None, 1, 1, 2), (None, 2, 3, 30), (None, 30, 33, None), ("a", 5, 5, None),
    }


# --- split ------------------------------------------------------------------------


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.5, 0.8, 0.97, 1.0])
def test_split_equals_sorting_all_rows(spark, fraction):
    stock = stock_frame(spark, {("a", "x"): walk(1, 131), ("b", "x"): walk(2, 131), ("b", "y"): walk(3, 97)})
    rows = [tuple(r) for r in split.ordered_split(stock, fraction).collect()]
    rows.sort(key=lambda r: r[:3])
    cut = int(len(rows) * fraction)
    assert [r[-1] for r in rows] == [i < cut for i in range(len(rows))]
    assert split.train_rows(stock, fraction).count() == cut
    assert split.test_rows(stock, fraction).count() == len(rows) - cut


@pytest.mark.parametrize("folds", [2, 5, 7])
def test_folds_are_contiguous_blocks(spark, folds):
    stock = stock_frame(spark, {("a", "x"): walk(1, 131), ("b", "x"): walk(2, 131), ("b", "y"): walk(3, 97)})
    rows = sorted(tuple(r) for r in split.ordered_folds(stock, folds).collect())
    blocks = np.array_split(np.arange(len(rows)), folds)
    assert [r[-1] for r in rows] == [i for i, block in enumerate(blocks) for _ in block]


# --- forecasts --------------------------------------------------------------------


def test_naive_rmse_uses_held_out_slots(spark):
    a, b = walk(1, 200), walk(2, 200)
    stock = stock_frame(spark, {("a", "x"): a, ("b", "x"): b})
    test = np.array([a[160:], b[160:]])
    errors = test[:, 1:] - test[:, :-1]
    naive = forecast.naive_forecast(stock)
    overall = forecast.overall_rmse(naive).first()
    assert overall.rmse == pytest.approx(np.sqrt((errors**2).mean()))
    assert overall.n == errors.size
    per = {r.station: r.rmse for r in forecast.rmse_by_series(naive).collect()}
    assert per["a"] == pytest.approx(np.sqrt((errors[0] ** 2).mean()))
    assert forecast.overall_rmse(forecast.naive_forecast(stock, fraction=None)).first().n == 2 * 199


@pytest.mark.parametrize("period", [4, 5])
def test_decomposition_recovers_trend_and_season(spark, period):
    season = np.array([3, -1, -4, 2, 0][:period])
    season = season - int(season.mean())
    n = period * 8
    values = [int(100 + 2 * i + season[i % period]) for i in range(n)]
    stock = stock_frame(spark, {("a", "x"): values})
    rows = forecast.seasonal_decompose(stock, period).orderBy("time").collect()
    centred = season - season.mean()
    half = period // 2
    for i, r in enumerate(rows):
        assert r.seasonal == pytest.approx(centred[i % period])
        if half <= i < n - half:
            assert r.trend == pytest.approx(100 + 2 * i + season.mean())
            assert r.residual == pytest.approx(0, abs=1e-9)
        else:
            assert r.trend is None and r.residual is None


def test_var_equals_least_squares_in_numpy(spark):
    n, max_lags = 240, 3
    a, b = walk(11, n), walk(12, n)
    stock = stock_frame(spark, {("a", "x"): a, ("b", "x"): b})
    model = forecast.fit_var(stock, max_lags=max_lags, fraction=0.8)
    levels = np.array([a, b], float).T
    d = np.diff(levels[: int(0.8 * n)], axis=0)

    def fit(p, first):
        y = d[first:]
        z = np.hstack([np.ones((len(y), 1))] + [d[first - k : len(d) - k] for k in range(1, p + 1)])
        beta = np.linalg.lstsq(z, y, rcond=None)[0]
        resid = y - z @ beta
        return beta, np.log(np.linalg.det(resid.T @ resid / len(y))), len(y)

    for p, aic, bic in model.criteria:
        _, log_det, rows = fit(p, max_lags)
        free = p * 4 + 2
        assert aic == pytest.approx(log_det + 2 * free / rows)
        assert bic == pytest.approx(log_det + np.log(rows) * free / rows)
    order = min(model.criteria, key=lambda c: c[1])[0]
    assert model.lag_order == order
    beta, _, _ = fit(order, order)
    assert np.allclose(model.intercept, beta[0]) and np.allclose(model.coefficients, beta[1:].T)

    predicted = {(r.time, r.station): r.predicted for r in forecast.var_forecast(stock, model, 0.8).collect()}
    diffs = np.diff(levels, axis=0)
    for i in range(int(0.8 * n), n):
        z = np.concatenate([[1.0]] + [diffs[i - 1 - k] for k in range(1, order + 1)])
        expected = levels[i - 1] + z @ beta
        time = ts("2024-01-02 00:00:00") + timedelta(minutes=15 * i)
        assert predicted[time, "a"] == pytest.approx(expected[0])
        assert predicted[time, "b"] == pytest.approx(expected[1])
    assert len(predicted) == 2 * (n - int(0.8 * n))


def test_var_of_order_zero(spark):
    stock = stock_frame(spark, {("a", "x"): walk(1, 60), ("b", "x"): walk(2, 60)})
    model = forecast.fit_var(stock, max_lags=0)
    assert model.lag_order == 0
    assert forecast.var_forecast(stock, model).count() == 2 * 12


# --- features ----------------------------------------------------------------------


def test_scaling_and_its_inverse(spark):
    df = spark.createDataFrame([(1, 5), (3, 5), (9, 5)], "a int, b int")
    scaled = features.min_max_scale(df, ["a", "b"])
    assert [tuple(r) for r in scaled.collect()] == [(0.0, 0.0), (0.25, 0.0), (1.0, 0.0)]
    assert features.min_max_restore(scaled, ["a", "b"], df).collect() == [(1.0, 5.0), (3.0, 5.0), (9.0, 5.0)]


def test_one_hot(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    out = features.one_hot(df, {"k": None})
    assert out.columns == ["v", "k_x", "k_y"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    many = spark.range(1200).select(F.concat(F.lit("k"), "id").alias("k"))
    assert features.categories(many, "k") == sorted(f"k{i}" for i in range(1200))


def test_an_unlisted_series_is_not_dropped(spark):
    stock = stock_frame(spark, {("a", "x"): [1, 2], ("b", "x"): [3, 4]})
    assert reshape.long_to_wide(stock, ["a|x", "b|x"]).count() == 2
    with pytest.raises(Exception, match="series without a column: b|x"):
        reshape.long_to_wide(stock, ["a|x"]).collect()


def test_sequences_hold_the_rows_before(spark):
    stock = stock_frame(spark, {("a", "x"): list(range(10)), ("b", "x"): list(range(100, 104))})
    rows = features.sequences(stock, ["stock"], target="stock", lookback=4).orderBy("time").collect()
    assert [([w.stock for w in r.window], r.target) for r in rows] == [
        (list(range(i - 4, i)), i) for i in range(4, 10)
    ]


# --- profiles ----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_histogram_equals_numpy(spark, seed):
    values = np.random.default_rng(seed).integers(0, 97, 400) / 4.0
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = profile.histogram(df, "v", bins=24).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=24)
    assert [r.n for r in rows] == counts.tolist()
    assert np.allclose([r.lower_edge for r in rows], edges[:-1])


def test_histogram_of_equal_values_and_of_widths(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    rows = profile.histogram(df, "v", bins=3).orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram([2.0, 2.0], bins=3)[0].tolist()
    wide = spark.createDataFrame([(-1.0,), (0.0,), (25.0,)], "v double")
    rows = profile.histogram(wide, "v", width=10.0).orderBy("bin").collect()
    assert [(r.lower_edge, r.n) for r in rows] == [(-10.0, 1), (0.0, 1), (10.0, 0), (20.0, 1)]
    with pytest.raises(ValueError):
        profile.histogram(df, "v")


def test_unique_check_and_types(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "2"), (None, "z")], "a string, b string")
    assert tuple(profile.unique_check(df, "b").first()) == (3, 3, True)
    assert tuple(profile.unique_check(df, "a").first()) == (3, 1, False)
    kinds = {r.column_name: (r.n_missing, r.n_numeric, r.n_text) for r in profile.mixed_types(df, ["a", "b"]).collect()}
    assert kinds == {"a": (1, 2, 0), "b": (0, 1, 2)}
    assert profile.rows_with_nulls(df).count() == 1


# --- requests ------------------------------------------------------------------------


def test_validation_reasons(spark):
    good = "2025-05-01"
    cases = [
        ("s", "classic_bike", good, None),
        ("s", "classic_bike", "2025-5-1", None),
        ("?", "classic_bike", good, "unknown station"),
        (None, "classic_bike", good, "unknown station"),
        ("s", "scooter", good, "unknown type"),
        ("s", "classic_bike", "2024-05-01", "wrong year"),
        ("s", "classic_bike", "2025-02-30", "bad date"),
        ("s", "classic_bike", "2025-05-01 10:00", "bad date"),
        ("s", "classic_bike", " 2025-05-01", "bad date"),
        ("s", "classic_bike", "2025-05-01\n", "bad date"),
        ("s", "classic_bike", "soon", "bad date"),
        ("s", "classic_bike", None, "bad date"),
    ]
    frame = spark.createDataFrame(
        [(i, *c[:3]) for i, c in enumerate(cases)],
        "i int, station string, rideable_type string, target_date string",
    )
    table = spark.createDataFrame([("s",), ("t",)], "station string")
    for known in (["s", "t"], table):
        checked = requests.validate_requests(frame, known).orderBy("i").collect()
        assert [r.reject_reason for r in checked] == [c[3] for c in cases]
    assert requests.valid_requests(requests.validate_requests(frame, ["s"])).count() == 2


def test_december_is_an_option(spark):
    frame = spark.createDataFrame([("s", "classic_bike", "2025-12-01")], "station string, rideable_type string, target_date string")
    assert requests.validate_requests(frame, ["s"]).first().reject_reason is None
    assert requests.validate_requests(frame, ["s"], max_month=11).first().reject_reason == "wrong month"


def test_requests_from_bodies_and_fields(spark):
    body = '{"station": "s", "rideable_type": "classic_bike", "target_date": "2025-05-01"}'
    rows = [(1, body, None, None, None), (2, None, "t", "electric_bike", "2025-06-01"), (3, "{oops", None, None, None)]
    raw = spark.createDataFrame(rows, "i int, body string, station string, rideable_type string, target_date string")
    assert [tuple(r) for r in requests.parse_requests(raw).orderBy("i").collect()] == [
        (1, "s", "classic_bike", "2025-05-01"), (2, "t", "electric_bike", "2025-06-01"), (3, None, None, None),
    ]


def alerts_by_loop(rows, limit=0.0, step=10):
    fired = []
    for time, prediction in rows:
        if prediction < limit:
            fired.append(f"{time + timedelta(minutes=15):%Y-%m-%d %H:%M:%S}")
            limit -= step
    return fired


def scored_day(spark, predictions, day="2024-01-02", station="a"):
    first = ts(f"{day} 00:00:00")
    rows = [
        (first + timedelta(minutes=15 * i), station, "x", float(p), first.date())
        for i, p in enumerate(predictions)
    ]
    return spark.createDataFrame(
        rows, "time timestamp_ntz, station string, rideable_type string, prediction double, target_day date"
    )


def test_the_limit_moves_one_step_per_slot(spark):
    alerts = requests.alert_times(scored_day(spark, [-35, -5, -12])).first()
    assert alerts.prediction == ["2024-01-02 00:15:00", "2024-01-02 00:45:00"]


@pytest.mark.parametrize("seed", range(5))
def test_alerts_equal_a_loop(spark, seed):
    predictions = np.random.default_rng(seed).normal(-1, 2, 96).cumsum()
    scored = scored_day(spark, predictions)
    expected = alerts_by_loop([(r.time, r.prediction) for r in scored.orderBy("time").collect()])
    assert requests.alert_times(scored).first().prediction == expected


def test_slices_equal_cut_then_shift(spark):
    values = {("a", "x"): walk(1, 300), ("b", "x"): walk(2, 300)}
    history = stock_frame(spark, values)
    # a gap in the history: lags go by row, but not further back than two hours
    history = history.where("time NOT BETWEEN '2024-01-02 20:00:00' AND '2024-01-02 22:30:00'")
    asked = spark.createDataFrame(
        [("a", "x", date(2024, 1, d)) for d in (2, 3, 3, 9)] + [("b", "x", date(2024, 1, 4))],
        "station string, rideable_type string, target_day date",
    )
    got = {
        (r.station, r.time): [r.stock, r.lag_15m_stock, r.lag_30m_stock, r.lag_45m_stock, r.lag_60m_stock]
        for r in requests.score_slice(asked, history).collect()
    }
    rows = sorted(history.collect(), key=lambda r: r.time)
    expected = {}
    for s, d in {("a", 2), ("a", 3), ("b", 4)}:
        day = datetime(2024, 1, d)
        cut = [r for r in rows if r.station == s and day - timedelta(hours=2) <= r.time <= day + timedelta(hours=24)]
        for i, r in enumerate(cut):
            if day <= r.time <= day + timedelta(hours=23, minutes=45):
                expected[s, r.time] = [r.stock] + [cut[i - k].stock if i >= k else None for k in range(1, 5)]
    assert got == expected


def test_answers_tell_a_day_without_history(spark):
    asked = spark.createDataFrame(
        [("a", "x", date(2024, 1, 2)), ("a", "x", date(2024, 1, 2)), ("a", "x", date(2024, 1, 1))],
        "station string, rideable_type string, target_day date",
    )
    alerts = requests.alert_times(scored_day(spark, [-5]))
    rows = sorted(requests.answer_requests(asked, alerts).collect(), key=lambda r: r.target_day)
    assert [(r.prediction, r.warning, r.no_history) for r in rows] == [
        ([], False, True), (["2024-01-02 00:15:00"], True, False), (["2024-01-02 00:15:00"], True, False),
    ]


# --- monitoring -------------------------------------------------------------------------


def test_drift_equals_numpy(spark):
    rng = np.random.default_rng(3)
    ref = rng.integers(-30, 60, 500) / 2.0
    ref_labels = rng.choice(["a", "b", "c"], 500, p=[0.6, 0.3, 0.1])
    days = {date(2024, 2, 1): (rng.normal(5, 9, 200), ["a", "d"]), date(2024, 2, 2): (np.array([7.0]), ["b"])}
    reference = spark.createDataFrame(
        [(float(v), str(k), 4.0) for v, k in zip(ref, ref_labels, strict=True)], "v double, k string, same double"
    )
    rows = [
        (day, float(v), labels[i % len(labels)], 4.0)
        for day, (values, labels) in days.items()
        for i, v in enumerate(values)
    ]
    current = spark.createDataFrame(rows, "day date, v double, k string, same double")
    got = {
        (r.timestamp.date(), r.column_name): (r.drift_score, r.is_drift)
        for r in drift.column_drift(reference, current, ["v", "same"], ["k"]).collect()
    }
    for day, (values, labels) in days.items():
        grid = np.sort(np.concatenate([ref, values]))
        share = lambda x: np.searchsorted(np.sort(x), grid[:-1], side="right") / len(x)
        wasserstein = (np.abs(share(ref) - share(values)) * np.diff(grid)).sum() / ref.std()
        score, flag = got[day, "v"]
        assert score == pytest.approx(wasserstein)
        assert flag == (score > 0.1)
        assert got[day, "same"] == (0.0, False)
        used = [labels[i % len(labels)] for i in range(len(values))]
        p = np.array([np.mean(ref_labels == k) for k in "abcd"])
        q = np.array([np.mean(np.array(used) == k) for k in "abcd"])
        kl = lambda a: sum(x * np.log(2 * x / (x + y)) for x, y in zip(a, p + q - a, strict=True) if x > 0)
        assert got[day, "k"][0] == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    summary = drift.drift_summary(drift.column_drift(reference, current, ["v", "same"], ["k"])).collect()
    for r in summary:
        flags = [f for (d, _), (_, f) in got.items() if d == r.timestamp.date()]
        assert (r.number_of_drifted_columns, r.share_of_drifted_columns) == (sum(flags), sum(flags) / 3)
        assert r.dataset_drift == (sum(flags) / 3 > 0.5)


def test_upserts(spark):
    old = spark.createDataFrame([(1, 10, 100), (2, 20, None)], "k int, a int, b int")
    rows = [(2, 21, 201, 1), (3, 9, 309, 1), (3, 3, 303, 2), (3, 7, 307, 3)]
    new = spark.createDataFrame(rows, "k int, a int, b int, at int")
    first = upsert.upsert_keep_first(old, new, ["k"], order="at")
    assert sorted(map(tuple, first.collect())) == [(1, 10, 100), (2, 20, None), (3, 9, 309)]
    partial = upsert.upsert_partial(old, new, ["k"], ["a"], order="at")
    assert sorted(map(tuple, partial.collect())) == [(1, 10, 100), (2, 21, None), (3, 7, 309)]
    single = upsert.upsert_partial(old, new.where("k = 2"), ["k"], ["a"])
    assert sorted(map(tuple, single.collect())) == [(1, 10, 100), (2, 21, None)]
    for merge in (upsert.upsert_keep_first, lambda *a: upsert.upsert_partial(*a, ["a"])):
        with pytest.raises(Exception, match="repeated keys"):
            merge(old, new, ["k"]).collect()


def test_drift_of_a_long_tail_against_every_value(spark):
    """Against the plain area between both shares; no bucket holds most of the tail."""
    rng = np.random.default_rng(8)
    reference, current = rng.lognormal(0, 3, 3000).round(3), rng.lognormal(0.3, 3, (3, 400)).round(3)
    frame = spark.createDataFrame([(float(v),) for v in reference], "v double")
    rows = [(date(2024, 1, 1 + d), float(v)) for d in range(3) for v in current[d]]
    days = spark.createDataFrame(rows, "day date, v double")
    counts = drift.value_counts_by_day(frame, days, ["v"], [])
    got = {r.day.day - 1: r.drift_score for r in drift.numeric_drift(counts).collect()}
    for d in range(3):
        every = np.sort(np.concatenate([reference, current[d]]))
        shares = [np.searchsorted(np.sort(x), every[:-1], side="right") / len(x) for x in (reference, current[d])]
        plain = (np.abs(shares[0] - shares[1]) * np.diff(every)).sum() / reference.std()
        assert got[d] == pytest.approx(plain, rel=1e-9)
    held, asked = drift._areas(counts, 64)
    assert held.count() == len(set(reference)) and asked.count() <= 1200
    fullest = held.unionByName(asked).groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert fullest < 200


def test_days_of_a_leap_february(spark):
    months = spark.createDataFrame([(date(2024, 2, 10),)], "month date")
    rows = drift.month_days(months).orderBy("day").collect()
    assert len(rows) == 29 and rows[0].day == date(2024, 2, 1) and rows[-1].days_in_month == 29
