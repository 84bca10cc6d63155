"""The same results in SQL, written from the definitions and not from the plans.

Each entry may use the named steps below; ``sql`` puts the needed ones in front.
"""

import re

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
TYPES = ("classic_bike", "electric_bike")
TEXT_COLUMNS = (
    "ride_id", "rideable_type", "start_station_name", "start_station_id",
    "end_station_name", "end_station_id", "member_casual",
)


# Doubles are compared to six digits. Averages over 96 slots are often exact binary
# fractions that lie on a rounding tie, where the last bit would decide: both sides
# are shifted off the ties first.
SHIFT = 3e-8


def rounded(expression: str) -> str:
    return f"round(({expression}) + {SHIFT}, 6)"


TRIP_COLUMNS = (
    "ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, "
    "end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual"
)
NUMERIC = (
    "stock hour dayofweek is_rush_hour lag_15m_stock lag_30m_stock lag_45m_stock "
    "lag_60m_stock target_next_stock date"
).split()

STEPS = {
    "gappy": """
        SELECT time, station, rideable_type, target_next_stock,
               CASE WHEN stock >= 0 THEN is_rush_hour END AS rush FROM features""",
    "trips": """
        SELECT event_id::VARCHAR AS ride_id,
               CASE WHEN user_id % 2 = 0 THEN 'classic_bike' ELSE 'electric_bike' END AS rideable_type,
               ts AS started_at, next_ts AS ended_at,
               event_type AS start_station_name, event_type AS start_station_id,
               next_type AS end_station_name, next_type AS end_station_id,
               40e0 + length(event_type) / 100e0 AS start_lat,
               -73e0 - length(event_type) / 100e0 AS start_lng,
               CASE WHEN event_id % 50 <> 0 THEN 40e0 + length(next_type) / 100e0 END AS end_lat,
               -73e0 - length(next_type) / 100e0 AS end_lng,
               CASE WHEN event_id % 2 = 0 THEN 'member' ELSE 'casual' END AS member_casual
        FROM (SELECT *, row_number() OVER w AS rn, lead(ts) OVER w AS next_ts,
                     lead(event_type) OVER w AS next_type
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE rn % 2 = 1 AND next_ts IS NOT NULL""",
    "complete": "SELECT * FROM trips WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in TRIP_COLUMNS.split(", ")),
    "timed": """
        SELECT rideable_type, started_at, ended_at, start_station_name, end_station_name,
               hour(started_at) + minute(started_at) / 60e0 + second(started_at) / 3600e0 AS start_time,
               hour(ended_at) + minute(ended_at) / 60e0 + second(ended_at) / 3600e0 AS end_time,
               (epoch_us(ended_at) - epoch_us(started_at)) / 6e7 AS duration
        FROM complete""",
    "stats": """
        SELECT count(*) AS n_trips, avg(duration) AS mean_duration,
               stddev_samp(duration) AS std_duration FROM timed""",
    "kept": """
        SELECT timed.* FROM timed, stats
        WHERE abs((duration - mean_duration) / std_duration) <= 2""",
    "top_starts": """
        SELECT start_station_name AS station, count(*) AS n_trips FROM kept
        GROUP BY 1 ORDER BY n_trips DESC, station LIMIT 3""",
    "top_both": """
        SELECT station, count(*) AS n_trips
        FROM (SELECT start_station_name AS station FROM trips WHERE start_station_name IS NOT NULL
              UNION ALL
              SELECT end_station_name FROM trips WHERE end_station_name IS NOT NULL)
        GROUP BY 1 ORDER BY n_trips DESC, station LIMIT 3""",
    "all_flows": """
        SELECT started_at AS time, start_station_name AS station, rideable_type, -1 AS flow FROM kept
        UNION ALL
        SELECT ended_at, end_station_name, rideable_type, 1 FROM kept""",
    "flows": "SELECT * FROM all_flows WHERE station IN (SELECT station FROM top_starts)",
    "net": """
        SELECT time_bucket(INTERVAL 15 MINUTE, time) AS time, station, rideable_type,
               sum(flow)::BIGINT AS net_flow
        FROM flows GROUP BY ALL""",
    "bounds": """
        SELECT date_trunc('day', min(time))::TIMESTAMP AS grid_start,
               CASE WHEN max(time) = date_trunc('day', max(time)) THEN max(time)
                    ELSE date_trunc('day', max(time))::TIMESTAMP + INTERVAL 1 DAY END AS grid_end
        FROM net""",
    "grid": """
        SELECT unnest(generate_series(grid_start, grid_end - INTERVAL 15 MINUTE,
                                      INTERVAL 15 MINUTE)) AS time FROM bounds""",
    "dense": """
        SELECT grid.time, p.station, p.rideable_type, coalesce(net.net_flow, 0)::BIGINT AS net_flow
        FROM grid CROSS JOIN (SELECT DISTINCT station, rideable_type FROM net) p
        LEFT JOIN net ON net.time = grid.time AND net.station = p.station
                     AND net.rideable_type = p.rideable_type""",
    "stock": """
        SELECT time, station, rideable_type, stock
        FROM (SELECT time, station, rideable_type,
                     (10 + sum(net_flow) OVER (PARTITION BY station, rideable_type, time::DATE
                                               ORDER BY time))::BIGINT AS stock
              FROM dense), bounds
        WHERE time >= grid_start + INTERVAL 1 DAY""",
    "net_all": """
        SELECT time_bucket(INTERVAL 15 MINUTE, time) AS time, station, rideable_type,
               sum(flow)::BIGINT AS net_flow
        FROM all_flows GROUP BY ALL""",
    "bounds_all": """
        SELECT date_trunc('day', min(time))::TIMESTAMP AS grid_start,
               CASE WHEN max(time) = date_trunc('day', max(time)) THEN max(time)
                    ELSE date_trunc('day', max(time))::TIMESTAMP + INTERVAL 1 DAY END AS grid_end
        FROM net_all""",
    "stock_all": """
        SELECT time, station, rideable_type, stock
        FROM (SELECT g.time, p.station, p.rideable_type,
                     (10 + sum(coalesce(n.net_flow, 0))
                         OVER (PARTITION BY p.station, p.rideable_type, g.time::DATE
                               ORDER BY g.time))::BIGINT AS stock
              FROM (SELECT unnest(generate_series(grid_start, grid_end - INTERVAL 15 MINUTE,
                                                  INTERVAL 15 MINUTE)) AS time FROM bounds_all) g
              CROSS JOIN (SELECT DISTINCT station, rideable_type FROM net_all) p
              LEFT JOIN net_all n ON n.time = g.time AND n.station = p.station
                                 AND n.rideable_type = p.rideable_type), bounds_all
        WHERE time >= grid_start + INTERVAL 1 DAY""",
    "calendar": """
        SELECT *, hour(time) + minute(time) / 60e0 AS hour,
               (isodow(time) - 1)::INTEGER AS dayofweek,
               date_diff('day', DATE '2024-01-01', time::DATE) / 366e0 AS date
        FROM stock""",
    "lagged": """
        SELECT *, lag(stock, 1) OVER w AS lag_15m_stock, lag(stock, 2) OVER w AS lag_30m_stock,
               lag(stock, 3) OVER w AS lag_45m_stock, lag(stock, 4) OVER w AS lag_60m_stock,
               lead(stock, 1) OVER w AS target_next_stock
        FROM stock WINDOW w AS (PARTITION BY station, rideable_type ORDER BY time)""",
    "features": """
        SELECT l.time, l.station, l.rideable_type, l.stock, c.hour, c.dayofweek,
               ((c.hour >= 8 AND c.hour <= 10) OR (c.hour >= 17 AND c.hour <= 19))::INTEGER AS is_rush_hour,
               lag_15m_stock, lag_30m_stock, lag_45m_stock, lag_60m_stock, target_next_stock, c.date
        FROM lagged l JOIN calendar c USING (time, station, rideable_type)
        WHERE lag_60m_stock IS NOT NULL AND target_next_stock IS NOT NULL""",
    "split": """
        SELECT *, row_number() OVER (ORDER BY time, station, rideable_type)
                  <= floor(0.8e0 * (SELECT count(*) FROM features)) AS is_train
        FROM features""",
    "held_out": """
        SELECT * FROM stock
        WHERE time >= (SELECT min(time) + INTERVAL 15 MINUTE
                              * floor(0.8e0 * count(DISTINCT time))::INTEGER FROM stock)""",
    "requested": """
        SELECT DISTINCT start_station_name AS station, rideable_type,
               started_at::DATE AS target_day FROM kept
        WHERE start_station_name IN (SELECT station FROM top_starts)""",
    "sliced": """
        SELECT r.target_day, s.time, s.station, s.rideable_type, s.stock,
               lag(s.stock, 1) OVER w AS lag_15m_stock, lag(s.stock, 2) OVER w AS lag_30m_stock,
               lag(s.stock, 3) OVER w AS lag_45m_stock, lag(s.stock, 4) OVER w AS lag_60m_stock
        FROM requested r JOIN stock s ON s.station = r.station AND s.rideable_type = r.rideable_type
             AND s.time >= r.target_day::TIMESTAMP - INTERVAL 2 HOUR
             AND s.time <= r.target_day::TIMESTAMP + INTERVAL 24 HOUR
        WINDOW w AS (PARTITION BY r.station, r.rideable_type, r.target_day ORDER BY s.time)""",
    "slice": """
        SELECT target_day, time, station, rideable_type, stock,
               hour(time) + minute(time) / 60e0 AS hour, (isodow(time) - 1)::INTEGER AS dayofweek,
               (hour(time) IN (8, 9, 17, 18))::INTEGER AS is_rush_hour,
               lag_15m_stock, lag_30m_stock, lag_45m_stock, lag_60m_stock,
               date_diff('day', DATE '2024-01-01', time::DATE) / 366e0 AS date
        FROM sliced WHERE time::DATE = target_day""",
    "ordered_slice": """
        SELECT station, rideable_type, target_day, time + INTERVAL 15 MINUTE AS due, stock AS p,
               row_number() OVER (PARTITION BY station, rideable_type, target_day ORDER BY time) AS i
        FROM slice""",
    "fold": """
        SELECT station, rideable_type, target_day, 0 AS i, 0 AS lim, []::VARCHAR[] AS times
        FROM (SELECT DISTINCT station, rideable_type, target_day FROM ordered_slice)
        UNION ALL
        SELECT f.station, f.rideable_type, f.target_day, o.i::INTEGER,
               CASE WHEN o.p < f.lim THEN f.lim - 10 ELSE f.lim END,
               CASE WHEN o.p < f.lim THEN list_append(f.times, strftime(o.due, '%Y-%m-%d %H:%M:%S'))
                    ELSE f.times END
        FROM fold f JOIN ordered_slice o
          ON o.station = f.station AND o.rideable_type = f.rideable_type
         AND o.target_day = f.target_day AND o.i = f.i + 1""",
    "alerts": """
        SELECT station, rideable_type, target_day, arg_max(times, i) AS fired
        FROM fold GROUP BY ALL""",
    "every_slot": """
        SELECT station, rideable_type, time::DATE AS target_day, time + INTERVAL 15 MINUTE AS due,
               stock AS p,
               row_number() OVER (PARTITION BY station, rideable_type, time::DATE ORDER BY time) AS i
        FROM stock""",
    "every_fold": """
        SELECT station, rideable_type, target_day, 0 AS i, 0 AS lim, []::VARCHAR[] AS times
        FROM (SELECT DISTINCT station, rideable_type, target_day FROM every_slot)
        UNION ALL
        SELECT f.station, f.rideable_type, f.target_day, o.i::INTEGER,
               CASE WHEN o.p < f.lim THEN f.lim - 10 ELSE f.lim END,
               CASE WHEN o.p < f.lim THEN list_append(f.times, strftime(o.due, '%Y-%m-%d %H:%M:%S'))
                    ELSE f.times END
        FROM every_fold f JOIN every_slot o
          ON o.station = f.station AND o.rideable_type = f.rideable_type
         AND o.target_day = f.target_day AND o.i = f.i + 1""",
    "middle": """
        SELECT min(time::DATE) + ((max(time::DATE) - min(time::DATE)) // 2)::INTEGER AS middle_day FROM features""",
    "reference": """
        SELECT *, time::DATE AS day FROM features WHERE time::DATE <= (SELECT middle_day FROM middle)""",
    "current": """
        SELECT *, time::DATE AS day FROM features WHERE time::DATE > (SELECT middle_day FROM middle)""",
    "ref_values": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c}::DOUBLE AS value FROM reference" for c in NUMERIC
    ),
    "cur_values": " UNION ALL ".join(
        f"SELECT day, '{c}' AS column_name, {c}::DOUBLE AS value FROM current" for c in NUMERIC
    ),
    "deviations": """
        SELECT column_name, greatest(stddev_pop(value), 0.001) AS std, count(*) AS total
        FROM ref_values GROUP BY 1""",
    "shares": """
        SELECT day, column_name, value, sum(r) AS r, sum(c) AS c
        FROM (SELECT d.day, v.column_name, v.value, 1e0 / s.total AS r, 0e0 AS c
              FROM (SELECT DISTINCT day FROM current) d, ref_values v
              JOIN deviations s ON s.column_name = v.column_name
              UNION ALL
              SELECT v.day, v.column_name, v.value, 0e0,
                     1e0 / count(*) OVER (PARTITION BY v.day, v.column_name)
              FROM cur_values v)
        GROUP BY ALL""",
    "numeric_scores": """
        SELECT day, column_name, coalesce(sum(area), 0) / any_value(std) AS drift_score
        FROM (SELECT day, s.column_name, d.std,
                     abs(sum(r) OVER w - sum(c) OVER w) * (lead(value) OVER w - value) AS area
              FROM shares s JOIN deviations d ON d.column_name = s.column_name
              WINDOW w AS (PARTITION BY day, s.column_name ORDER BY value))
        GROUP BY ALL""",
    "category_scores": """
        SELECT day, column_name,
               sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
                        + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS drift_score
        FROM (SELECT day, column_name, value, sum(p) AS p, sum(q) AS q
              FROM (SELECT d.day, v.column_name, v.value,
                           1e0 / (SELECT count(*) FROM reference) AS p, 0e0 AS q
                    FROM (SELECT DISTINCT day FROM current) d,
                         (SELECT 'station' AS column_name, station AS value FROM reference
                          UNION ALL SELECT 'rideable_type', rideable_type FROM reference) v
                    UNION ALL
                    SELECT day, column_name, value, 0e0,
                           1e0 / count(*) OVER (PARTITION BY day, column_name)
                    FROM (SELECT day, 'station' AS column_name, station AS value FROM current
                          UNION ALL SELECT day, 'rideable_type', rideable_type FROM current))
              GROUP BY ALL)
        GROUP BY ALL""",
    "drift": """
        SELECT day::TIMESTAMP AS timestamp, column_name, drift_score, drift_score > 0.1 AS is_drift
        FROM (SELECT * FROM numeric_scores UNION ALL SELECT * FROM category_scores)""",
    "performance": """
        SELECT time::DATE::TIMESTAMP AS timestamp,
               sqrt(avg((target_next_stock - stock)::DOUBLE * (target_next_stock - stock))) AS rmse,
               avg(abs(target_next_stock - stock)) AS mae,
               max(abs(target_next_stock - stock))::DOUBLE AS abs_error_max
        FROM features GROUP BY 1""",
    "total": "SELECT time, sum(stock)::BIGINT AS stock FROM stock GROUP BY 1",
    "total_changes": """
        SELECT time, stock, lag(stock) OVER (ORDER BY time) AS previous,
               (stock - lag(stock) OVER (ORDER BY time))::DOUBLE AS y,
               time < (SELECT min(time) + INTERVAL 15 MINUTE * floor(0.8e0 * count(*))::INTEGER FROM total) AS in_training
        FROM total""",
    "total_diffs": "SELECT *, lag(y) OVER (ORDER BY time) AS x FROM total_changes",
    # least squares of a change on the one before it, and the mean alone
    "var_sums": """
        SELECT count(*)::DOUBLE AS n, avg(y) AS y_mean, avg(x) AS x_mean, var_pop(y) AS sigma0,
               covar_pop(y, x) / var_pop(x) AS slope, var_pop(y) - covar_pop(y, x) ** 2 / var_pop(x) AS sigma1
        FROM total_diffs WHERE in_training AND x IS NOT NULL AND y IS NOT NULL""",
    "var_fits": """
        SELECT *, ln(sigma1) + 2e0 / n * 2 AS aic1, ln(sigma0) + 2e0 / n AS aic0,
               (SELECT avg(y) FROM total_diffs WHERE in_training) AS every_mean,
               (SELECT var_pop(y) FROM total_diffs WHERE in_training) AS every,
               (SELECT count(y)::DOUBLE FROM total_diffs WHERE in_training) AS n_every
        FROM var_sums""",
    "slots": """
        SELECT time, max(is_rush_hour) AS is_rush_hour, sum(target_next_stock)::DOUBLE AS target
        FROM features GROUP BY 1""",
    "slot_split": """
        SELECT *, row_number() OVER (ORDER BY time) <= floor(0.8e0 * (SELECT count(*) FROM slots)) AS is_train
        FROM slots""",
    # a tree of one split on a flag predicts the mean of either group
    "rush_means": "SELECT is_rush_hour, avg(target) AS p FROM slots GROUP BY 1",
    "train_means": "SELECT is_rush_hour, avg(target) AS p FROM slot_split WHERE is_train GROUP BY 1",
    "slot_scores": """
        SELECT s.*, m.p FROM slot_split s JOIN train_means m ON s.is_rush_hour = m.is_rush_hour""",
    "old_performance": """
        SELECT timestamp, rmse + 1 AS rmse, mae + 1 AS mae, abs_error_max + 1 AS abs_error_max
        FROM performance WHERE timestamp < TIMESTAMP '2024-01-21'""",
    "new_performance": "SELECT * FROM performance WHERE timestamp >= TIMESTAMP '2024-01-15'",
    "old_orders": """
        SELECT * REPLACE (o_orderdate::TIMESTAMP AS o_orderdate) FROM orders WHERE o_orderstatus = 'F'""",
    "new_orders": """
        SELECT * REPLACE (o_orderdate::TIMESTAMP AS o_orderdate, 'N' AS o_orderstatus,
                          o_totalprice + 1 AS o_totalprice) FROM orders""",
    "arriving": """
        SELECT started_at AS time, start_station_name AS station, rideable_type, -1 AS flow FROM complete
        UNION ALL
        SELECT ended_at, end_station_name, rideable_type, 1 FROM complete""",
    "arriving_net": """
        SELECT time_bucket(INTERVAL 15 MINUTE, time) AS time, station, rideable_type,
               sum(flow)::BIGINT AS net_flow
        FROM arriving GROUP BY ALL""",
    "trend": """
        SELECT time, station, rideable_type, stock, (row_number() OVER w - 1) % 96 AS phase,
               CASE WHEN lag(1, 48) OVER w IS NOT NULL AND lead(1, 48) OVER w IS NOT NULL THEN
                 (sum(stock) OVER (PARTITION BY station, rideable_type ORDER BY time
                                   ROWS BETWEEN 48 PRECEDING AND 48 FOLLOWING)
                  - 0.5e0 * (lag(stock, 48) OVER w + lead(stock, 48) OVER w)) / 96e0 END AS trend
        FROM stock WINDOW w AS (PARTITION BY station, rideable_type ORDER BY time)""",
    "phase_means": """
        SELECT station, rideable_type, phase, avg(stock - trend) AS m FROM trend GROUP BY ALL""",
    "naive_runs": " UNION ALL ".join(
        f"""SELECT 'naive_lag_{k}' AS run_id, sqrt(avg((stock - p)::DOUBLE * (stock - p))) AS test_rmse
            FROM (SELECT stock, lag(stock, {k}) OVER (PARTITION BY station, rideable_type
                                                      ORDER BY time) AS p FROM held_out)
            WHERE p IS NOT NULL"""
        for k in range(1, 5)
    ),
}


def sql(final: str) -> str:
    """``final`` with the steps it needs, directly or not, as a WITH clause."""
    needed: list[str] = []

    def visit(text: str, inside: str = "") -> None:
        for name in STEPS:
            if name != inside and name not in needed and re.search(rf"(?<![.'\w]){name}(?![\w'(])", text):
                visit(STEPS[name], name)
                needed.append(name)

    visit(final)
    steps = ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed)
    recursive = "RECURSIVE " if any(n.endswith("fold") for n in needed) else ""
    return f"WITH {recursive}{steps}\n{final}" if needed else final


def _profile(table: str, columns: dict[str, str], measure: str, with_type: bool) -> str:
    rows = [
        f"SELECT '{c}' AS column_name, "
        + (f"'{t}' AS data_type, " if with_type else "")
        + f"{measure.format(c=c)}, count(*) AS row_count FROM {table}"
        for c, t in columns.items()
    ]
    return " UNION ALL ".join(rows)


TRIP_TYPES = {
    "ride_id": "string",
    "rideable_type": "string",
    "started_at": "timestamp_ntz",
    "ended_at": "timestamp_ntz",
    "start_station_name": "string",
    "start_station_id": "string",
    "end_station_name": "string",
    "end_station_id": "string",
    "start_lat": "double",
    "start_lng": "double",
    "end_lat": "double",
    "end_lng": "double",
    "member_casual": "string",
}
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _histogram(table: str, column: str, bins: int) -> str:
    return f"""
        SELECT bin, {rounded("lo + bin * (hi - lo) / " + str(bins) + "e0")} AS lower_edge,
               {rounded("lo + (bin + 1) * (hi - lo) / " + str(bins) + "e0")} AS upper_edge,
               coalesce(n, 0) AS n
        FROM (SELECT unnest(generate_series(0, {bins - 1})) AS bin, min({column}) AS lo,
                     max({column}) AS hi FROM {table}) e
        LEFT JOIN (SELECT least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1})::BIGINT AS bin,
                          count(*) AS n
                   FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
                   GROUP BY 1) USING (bin)"""


def _correlation(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rounded(f'corr({a}, {b})')} AS correlation "
        f"FROM {table}"
        for i, a in enumerate(columns)
        for b in columns[:i]
    )


FEATURE_COLUMNS = (
    "station, rideable_type, stock, hour, dayofweek, is_rush_hour, lag_15m_stock, lag_30m_stock, "
    "lag_45m_stock, lag_60m_stock, target_next_stock, date"
)
PERFORMANCE = (
    f"timestamp, {rounded('rmse')} AS rmse, {rounded('mae')} AS mae, "
    f"{rounded('abs_error_max')} AS abs_error_max"
)
DRIFT = f"timestamp, column_name, {rounded('drift_score')} AS drift_score, is_drift"

# One valid request per key and one for each way to be wrong
REQUEST_ROWS = """
    SELECT unnest([station, 'nowhere', station, station, station]) AS station,
           unnest([rideable_type, rideable_type, 'hovercraft', rideable_type, rideable_type]) AS rideable_type,
           unnest([strftime(target_day, '%Y-%m-%d'), strftime(target_day, '%Y-%m-%d'),
                   strftime(target_day, '%Y-%m-%d'), '2023-' || strftime(target_day, '%m-%d'),
                   'not-a-date']) AS target_date,
           unnest([target_day, target_day, target_day, NULL, NULL]) AS day_or_null,
           unnest([NULL, 'unknown station', 'unknown type', 'wrong year', 'bad date']) AS reject_reason
    FROM (SELECT DISTINCT start_station_name AS station, rideable_type,
                 started_at::DATE AS target_day FROM trips)"""

def _boosted(depth: int) -> str:
    """One tree over a flag that may be missing and two types, by all splits there can be.

    Cells are all inputs that occur. A split is a set of cells to the left: by the flag
    with missing ones right or left, and by the type.
    """
    splits = ["rush = 0", "rush IS NOT NULL", "rush = 0 OR rush IS NULL", "rideable_type = 'classic_bike'"]
    chosen = splits[:3] if depth == 1 else splits
    gain = """0.5 * (gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) - g * g / (n + 1))"""
    options = " UNION ALL ".join(
        f"SELECT *, {i} AS id, coalesce({split}, false) AS is_left FROM cells" for i, split in enumerate(chosen)
    )
    return f"""
        SELECT rush, rideable_type, n AS n_rows, {rounded('base - 0.2089 * g_leaf / (n_leaf + 1)')} AS prediction
        FROM (
            WITH base AS (SELECT avg(target_next_stock) AS base FROM gappy),
            cells AS (
                SELECT rush, rideable_type, count(*) AS n, sum(base - target_next_stock) AS g, any_value(base) AS base
                FROM gappy, base GROUP BY 1, 2
            ), options AS ({options}),
            first AS (
                SELECT id FROM (
                    SELECT id, sum(g) AS g, sum(n) AS n, sum(g) FILTER (WHERE is_left) AS gl,
                           sum(n) FILTER (WHERE is_left) AS nl
                    FROM options GROUP BY id)
                WHERE nl > 0 AND nl < n ORDER BY {gain} DESC, id LIMIT 1
            ), sided AS (
                SELECT a.*, b.is_left AS side FROM options a JOIN options b
                    ON a.rush IS NOT DISTINCT FROM b.rush AND a.rideable_type = b.rideable_type
                WHERE b.id = (SELECT id FROM first)
            ), second AS (
                SELECT side, id FROM (
                    SELECT side, id, sum(g) AS g, sum(n) AS n, sum(g) FILTER (WHERE is_left) AS gl,
                           sum(n) FILTER (WHERE is_left) AS nl
                    FROM sided GROUP BY side, id)
                WHERE nl > 0 AND nl < n AND {gain} > 1e-6 AND {depth} = 2
                QUALIFY row_number() OVER (PARTITION BY side ORDER BY {gain} DESC, id) = 1
            ), leaves AS (
                SELECT s.rush, s.rideable_type, s.n, s.g, s.base, s.side,
                       coalesce(s.is_left AND second.id IS NOT NULL, false) AS part
                FROM sided s LEFT JOIN second ON s.side = second.side
                WHERE s.id = coalesce(second.id, 0)
            )
            SELECT rush, rideable_type, n, base, sum(g) OVER (PARTITION BY side, part) AS g_leaf,
                   sum(n) OVER (PARTITION BY side, part) AS n_leaf
            FROM leaves)"""


# Two series a station, two lags: columns 1, lag 1 of both, lag 2 of both, and both values.
# Their products, then Gauss-Jordan elimination, a column a step.
_VAR_GROUPS = """
    WITH RECURSIVE changes AS (
        SELECT time, station, rideable_type AS name, stock, lag(stock) OVER w AS previous,
               (stock - lag(stock) OVER w)::DOUBLE AS y
        FROM stock WINDOW w AS (PARTITION BY station, rideable_type ORDER BY time)
    ), wide AS (
        SELECT time, station, list(name ORDER BY name) AS names, list(y ORDER BY name) AS y,
               list(stock ORDER BY name) AS stock, list(previous ORDER BY name) AS previous
        FROM changes GROUP BY 1, 2
    ), design AS (
        SELECT *, [1e0, lag(y[1], 1) OVER w, lag(y[2], 1) OVER w, lag(y[1], 2) OVER w, lag(y[2], 2) OVER w] AS x
        FROM wide WINDOW w AS (PARTITION BY station ORDER BY time)
    ), cut AS (
        SELECT min(time) + to_seconds(900 * floor(0.8e0 * (date_diff('second', min(time), max(time)) / 900 + 1))::BIGINT) AS t
        FROM stock
    ), z AS (
        SELECT station, list_concat(x, y) AS z FROM design, cut
        WHERE time < t AND list_count(x) = 5 AND list_count(y) = 2
    ), cells AS (
        SELECT station, i, j, sum(z[i] * z[j]) AS s
        FROM z, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(1, 8)) AS j) GROUP BY 1, 2, 3
    ), rows_ AS (
        SELECT station, i, list(s ORDER BY j) AS r FROM cells GROUP BY 1, 2
    ), solved AS (
        SELECT station, 1 AS k, list(r ORDER BY i) AS m FROM rows_ GROUP BY 1
        UNION ALL
        SELECT station, k + 1, list_transform(range(1, 6), lambda i: list_transform(range(1, 8), lambda j:
            CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END))
        FROM solved WHERE k <= 5
    ), beta AS (SELECT station, m FROM solved WHERE k = 6)"""

ORACLES = {
    "var_groups_fit": f"""SELECT * FROM ({_VAR_GROUPS}, series AS (
            SELECT station, list(name ORDER BY name) AS names FROM (SELECT DISTINCT station, name FROM changes) GROUP BY 1
        )
        SELECT station, names[e] AS rideable_type, i // 2 AS lag,
               CASE WHEN i > 1 THEN names[1 + i % 2] END AS source,
               {rounded('m[i][5 + e]')} AS weight
        FROM beta JOIN series USING (station), (SELECT unnest([1, 2]) AS e),
             (SELECT unnest([1, 2, 3, 4, 5]) AS i))""",
    "var_groups_forecast": f"""SELECT * FROM ({_VAR_GROUPS}
        SELECT time, station, names[e] AS rideable_type, stock[e] AS actual,
               {rounded('previous[e] + m[1][5 + e] + x[2] * m[2][5 + e] + x[3] * m[3][5 + e] + x[4] * m[4][5 + e] + x[5] * m[5][5 + e]')} AS predicted
        FROM design JOIN beta USING (station), cut, (SELECT unnest([1, 2]) AS e)
        WHERE time >= t AND list_count(x) = 5)""",
    "boosted_stump": _boosted(1),
    "boosted_depth2": _boosted(2),
    "scan_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "append_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "refresh_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "publish_models": f"""
        SELECT {TRIP_COLUMNS} FROM trips
        WHERE start_station_name IN (SELECT station FROM top_both)
           OR end_station_name IN (SELECT station FROM top_both)""",
    "publish_next_year": "SELECT "
    + re.sub(r"\b(started_at|ended_at)\b", r"\1 + INTERVAL 366 DAYS AS \1", TRIP_COLUMNS)
    + f""" FROM trips
        WHERE start_station_name IN (SELECT station FROM top_both)
           OR end_station_name IN (SELECT station FROM top_both)""",
    "published_stations": "SELECT * FROM top_both",
    "published_staging": f"SELECT {TRIP_COLUMNS} FROM trips",
    "validate_months": f"""
        SELECT station, rideable_type, target_date, TRY_CAST(target_date AS DATE) AS target_day,
               coalesce(CASE WHEN station NOT IN (SELECT station FROM top_both)
                             THEN 'unknown station' END, reject_reason) AS reject_reason
        FROM (SELECT station, rideable_type, target_date, reject_reason FROM ({REQUEST_ROWS})
              UNION ALL
              SELECT station, rideable_type, '2024-12-' || substr(target_date, 9, 2),
                     coalesce(reject_reason, 'wrong month')
              FROM ({REQUEST_ROWS}) WHERE target_date LIKE '2024-%')""",
    "var_total": f"""
        SELECT CASE WHEN aic1 < aic0 THEN 1 ELSE 0 END AS lag_order, 1 AS n_series,
               {rounded('CASE WHEN aic1 < aic0 THEN aic1 ELSE ln(every) + 2e0 / n_every END')} AS aic,
               {rounded('CASE WHEN aic1 < aic0 THEN ln(sigma1) + ln(n) / n * 2 ELSE ln(every) + ln(n_every) / n_every END')} AS bic
        FROM var_fits""",
    "var_total_forecast": f"""
        SELECT time, 'all' AS station, 'all' AS rideable_type, stock AS actual,
               {rounded('CASE WHEN aic1 < aic0 THEN previous + slope * x + y_mean - slope * x_mean ELSE previous + every_mean END')} AS predicted
        FROM total_diffs, var_fits
        WHERE NOT in_training AND y IS NOT NULL AND (x IS NOT NULL OR aic1 >= aic0)""",
    "grown_models": "SELECT start_station_name, count(*) AS n_trips FROM trips WHERE started_at IS NOT NULL GROUP BY 1",
    "stored_stock": "SELECT *, time::DATE AS day FROM stock",
    "stored_features": f"SELECT {FEATURE_COLUMNS} FROM features",
    "wide_csv": "SELECT * FROM stock_all",
    "metric_table": f"""
        SELECT {PERFORMANCE} FROM (
          SELECT * FROM old_performance
          UNION ALL
          SELECT * FROM new_performance
          WHERE timestamp NOT IN (SELECT timestamp FROM old_performance))""",
    "stg_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "parse_ts": """
        SELECT event_id, unnest(['fraction', 'plain', 'zone', 'bad']) AS form,
               unnest([ts, date_trunc('second', ts)::TIMESTAMP, ts, NULL]) AS parsed
        FROM events""",
    "drop_nulls": f"SELECT {TRIP_COLUMNS} FROM complete",
    "drop_nulls_subset": f"SELECT {TRIP_COLUMNS} FROM trips WHERE start_station_name IS NOT NULL AND end_lat IS NOT NULL",
    "preprocess": "SELECT rideable_type, started_at, ended_at, start_station_name, end_station_name FROM complete",
    "duration_stats": f"""
        SELECT n_trips, {rounded('mean_duration')} AS mean_duration,
               {rounded('std_duration')} AS std_duration FROM stats""",
    "remove_outlier": "SELECT * FROM kept",
    "duration_outliers": """
        SELECT timed.* FROM timed, stats WHERE abs((duration - mean_duration) / std_duration) > 2""",
    "starts_by_station": "SELECT start_station_name, count(*) AS n_trips FROM trips GROUP BY 1",
    "ends_by_station": "SELECT end_station_name, count(*) AS n_trips FROM trips GROUP BY 1",
    "top_stations_both": "SELECT * FROM top_both",
    "top_stations_starts": "SELECT * FROM top_starts",
    "top_station_trips": f"""
        SELECT {TRIP_COLUMNS} FROM trips
        WHERE start_station_name IN (SELECT station FROM top_both)
           OR end_station_name IN (SELECT station FROM top_both)""",
    "station_flows": "SELECT * FROM flows",
    "net_flow": "SELECT * FROM net",
    "net_flow_all_stations": "SELECT * FROM net_all",
    "grid_bounds": "SELECT * FROM bounds",
    "time_grid": "SELECT * FROM grid",
    "dense_net_flow": "SELECT * FROM dense",
    "stock_series": "SELECT * FROM stock",
    "stock_all_stations": "SELECT * FROM stock_all",
    "stock_wide": "SELECT time, "
    + ", ".join(
        f"coalesce(sum(stock) FILTER (WHERE station = '{s}' AND rideable_type = '{t}'), 0)::BIGINT"
        f' AS "{s}|{t}"'
        for s in EVENT_TYPES
        for t in TYPES
    )
    + " FROM stock_all GROUP BY time",
    "wide_to_long": "SELECT * FROM stock_all",
    "calendar_features": """
        SELECT *, ((hour >= 8 AND hour <= 10) OR (hour >= 17 AND hour <= 19))::INTEGER AS is_rush_hour
        FROM calendar""",
    "calendar_features_scoring": """
        SELECT *, ((hour >= 8 AND hour < 10) OR (hour >= 17 AND hour < 19))::INTEGER AS is_rush_hour
        FROM calendar""",
    "lag_features": "SELECT * FROM lagged",
    "features": f"SELECT {FEATURE_COLUMNS} FROM features",
    "time_split": f"SELECT time, {FEATURE_COLUMNS}, is_train FROM split",
    "stock_diff": """
        SELECT *, stock - lag(stock) OVER (PARTITION BY station, rideable_type ORDER BY time) AS stock_diff
        FROM stock""",
    "naive_rmse": f"""
        SELECT {rounded('sqrt(avg((stock - p)::DOUBLE * (stock - p)))')} AS rmse, count(*) AS n
        FROM (SELECT stock, lag(stock) OVER (PARTITION BY station, rideable_type ORDER BY time) AS p
              FROM held_out) WHERE p IS NOT NULL""",
    "naive_rmse_by_series": f"""
        SELECT station, rideable_type,
               {rounded('sqrt(avg((stock - p)::DOUBLE * (stock - p)))')} AS rmse, count(*) AS n
        FROM (SELECT station, rideable_type, stock,
                     lag(stock) OVER (PARTITION BY station, rideable_type ORDER BY time) AS p
              FROM held_out) WHERE p IS NOT NULL GROUP BY ALL""",
    "best_run": f"""
        SELECT run_id, {rounded('test_rmse')} AS test_rmse FROM naive_runs
        ORDER BY test_rmse, run_id LIMIT 1""",
    "seasonal_decompose": f"""
        SELECT time, station, rideable_type, stock, {rounded('trend')} AS trend,
               {rounded('seasonal')} AS seasonal, {rounded('stock - trend - seasonal')} AS residual
        FROM (SELECT t.*, m - avg(m) OVER (PARTITION BY station, rideable_type, time::DATE) AS seasonal
              FROM trend t JOIN phase_means USING (station, rideable_type, phase))""",
    "sequences": """
        SELECT time, station, rideable_type, array_to_string(w, ',') AS stocks, """
    + f"{rounded('hours')} AS hours, {rounded('dates')} AS dates," + """
               target_next_stock AS target
        FROM (SELECT *, list(stock) OVER before AS w, sum(hour) OVER before AS hours, sum(date) OVER before AS dates
              FROM features WINDOW before AS (PARTITION BY station, rideable_type ORDER BY time
                                              ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING)) WHERE len(w) = 96""",
    "one_hot": "SELECT started_at, ended_at, "
    + ", ".join(f"(start_station_name = '{s}')::INTEGER AS start_station_name_{s}" for s in EVENT_TYPES)
    + ", "
    + ", ".join(f"(rideable_type = '{t}')::INTEGER AS rideable_type_{t}" for t in TYPES)
    + " FROM complete",
    "minmax_scale": f"""
        SELECT time, station, rideable_type,
               {rounded('(stock - min(stock) OVER ()) / (max(stock) OVER () - min(stock) OVER ())::DOUBLE')} AS stock,
               {rounded('(hour - min(hour) OVER ()) / (max(hour) OVER () - min(hour) OVER ())')} AS hour
        FROM calendar""",
    "minmax_restore": "SELECT time, station, rideable_type, stock::DOUBLE AS stock FROM stock",
    "checked_trips": """
        SELECT reason, reason <> 'good' AS has_line, count(*) AS n
        FROM (SELECT unnest(['good', 'columns', CASE WHEN rideable_type = 'classic_bike' THEN 'started_at'
                                                     ELSE 'end_lng' END]) AS reason FROM trips)
        GROUP BY 1, 2""",
    "feature_corr": _correlation("features", NUMERIC),
    "daily_corr": _correlation("features", NUMERIC),
    "unique_check": """
        SELECT count(*) AS n_rows, count(DISTINCT ride_id) AS n_distinct,
               count(*) = count(DISTINCT ride_id) AS is_unique FROM trips""",
    "type_counts": "SELECT rideable_type, count(*) AS n FROM complete GROUP BY 1",
    "hist_start_time": _histogram("timed", "start_time", 24),
    "hist_end_time": _histogram("timed", "end_time", 24),
    "hist_duration": """
        SELECT b AS bin, b * 60e0 AS lower_edge, (b + 1) * 60e0 AS upper_edge, coalesce(n, 0) AS n
        FROM (SELECT unnest(generate_series(floor(min(duration) / 60e0)::BIGINT,
                                            floor(max(duration) / 60e0)::BIGINT)) AS b FROM kept)
        LEFT JOIN (SELECT floor(duration / 60e0)::BIGINT AS b, count(*) AS n FROM kept GROUP BY 1)
        USING (b)""",
    "profile": _profile("trips", TRIP_TYPES, "count({c}) AS non_null_count", True),
    "null_counts": _profile("trips", TRIP_TYPES, "count(*) FILTER (WHERE {c} IS NULL) AS null_count", False),
    "rows_with_nulls": f"SELECT {TRIP_COLUMNS} FROM trips WHERE end_lat IS NULL",
    "mixed_types": _profile(
        "trips",
        {c: "" for c in TEXT_COLUMNS},
        "count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
        "count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NOT NULL) AS n_numeric, "
        "count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS n_text",
        False,
    ),
    "validate_requests": f"""
        SELECT station, rideable_type, target_date,
               TRY_CAST(target_date AS DATE) AS target_day, reject_reason
        FROM (SELECT station, rideable_type, target_date,
                     coalesce(CASE WHEN station NOT IN (SELECT station FROM top_both)
                                   THEN 'unknown station' END, reject_reason) AS reject_reason
              FROM ({REQUEST_ROWS}))""",
    "parse_requests": f"""
        SELECT unnest(['json', 'fields', 'broken']) AS form,
               unnest([station, station, NULL]) AS station,
               unnest([rideable_type, rideable_type, NULL]) AS rideable_type,
               unnest([target_date, target_date, NULL]) AS target_date
        FROM ({REQUEST_ROWS})""",
    "score_slice": "SELECT * FROM slice",
    "score_error": """
        SELECT target_day, time, station, rideable_type, stock AS actual_stock,
               lag_15m_stock AS predicted_stock, stock - lag_15m_stock AS error FROM slice""",
    "stockout_alerts": """
        SELECT r.station, r.rideable_type, r.target_day,
               coalesce(array_to_string(a.fired, ','), '') AS prediction,
               coalesce(len(a.fired), 0) > 0 AS warning, a.fired IS NULL AS no_history, false AS unscored
        FROM requested r LEFT JOIN alerts a ON a.station = r.station
             AND a.rideable_type = r.rideable_type AND a.target_day = r.target_day""",
    "daily_features": f"""
        SELECT time::DATE AS day, count(*) AS n_rows, {rounded('avg(stock)')} AS mean_stock
        FROM features GROUP BY 1""",
    "month_days": """
        SELECT m AS month, day(last_day(m))::INTEGER AS days_in_month,
               unnest(generate_series(m::TIMESTAMP, last_day(m)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day
        FROM (SELECT DISTINCT date_trunc('month', started_at)::DATE AS m FROM trips)""",
    "drift_numeric": f"SELECT day, column_name, {rounded('drift_score')} AS drift_score FROM numeric_scores",
    "drift_sketches": "SELECT day, column_name, true AS is_near FROM numeric_scores",
    "drift_categorical": f"SELECT day, column_name, {rounded('drift_score')} AS drift_score FROM category_scores",
    "column_drift": f"SELECT {DRIFT} FROM drift",
    "drift_summary": f"""
        SELECT timestamp, sum(is_drift::INTEGER)::INTEGER AS number_of_drifted_columns,
               {rounded('avg(is_drift::INTEGER)')} AS share_of_drifted_columns,
               avg(is_drift::INTEGER) > 0.5 AS dataset_drift
        FROM drift GROUP BY 1""",
    "daily_performance": f"SELECT {PERFORMANCE} FROM performance",
    "zip_trips": f"SELECT {TRIP_COLUMNS} FROM trips",
    "naive_metrics": f"""
        SELECT count(*) AS n, 0::BIGINT AS n_unscored, {rounded('sqrt(avg(e * e))')} AS rmse,
               {rounded('avg(e * e)')} AS mse, {rounded('avg(abs(e))')} AS mae, {rounded('max(abs(e))')} AS max_error,
               {rounded('1 - avg(e * e) / var_pop(target_next_stock)')} AS r2
        FROM (SELECT target_next_stock, (target_next_stock - stock)::DOUBLE AS e FROM features)""",
    "gbt_stump": f"""
        SELECT s.is_rush_hour, count(*) AS n_rows, {rounded('avg(p)')} AS prediction,
               {rounded('sqrt(avg((target - p) * (target - p)))')} AS rmse
        FROM slots s JOIN rush_means m ON s.is_rush_hour = m.is_rush_hour GROUP BY 1""",
    "gbt_stump_importance": """
        SELECT feature, CASE WHEN feature = 'is_rush_hour' AND
                   (SELECT max(p) > min(p) FROM rush_means) THEN 1.0 ELSE 0.0 END::DOUBLE AS importance
        FROM (SELECT unnest(['station', 'rideable_type', 'is_rush_hour']) AS feature)""",
    "champion_scores": f"""
        SELECT is_rush_hour, count(*) AS n_rows, {rounded('avg(p)')} AS prediction,
               {rounded('sqrt(avg((target - p) * (target - p)))')} AS rmse
        FROM slot_scores WHERE NOT is_train GROUP BY 1""",
    "run_log": f"""
        SELECT {rounded('sqrt(avg((target - p) * (target - p)))')} AS test_rmse,
               '1' AS rounds, '1' AS depth, true AS has_model
        FROM slot_scores WHERE NOT is_train""",
    "backfill_column_drift": f"SELECT {DRIFT} FROM drift",
    "backfill_drift_summary": f"""
        SELECT timestamp, sum(is_drift::INTEGER)::INTEGER AS number_of_drifted_columns,
               {rounded('avg(is_drift::INTEGER)')} AS share_of_drifted_columns,
               avg(is_drift::INTEGER) > 0.5 AS dataset_drift
        FROM drift GROUP BY 1""",
    "backfill_performance": f"""
        SELECT time::DATE::TIMESTAMP AS timestamp, {rounded('sqrt(avg((target - p) * (target - p)))')} AS rmse,
               {rounded('avg(abs(target - p))')} AS mae, {rounded('max(abs(target - p))')} AS abs_error_max
        FROM slot_scores GROUP BY 1""",
    "upsert_keep_first": f"""
        SELECT {PERFORMANCE} FROM (
          SELECT * FROM old_performance
          UNION ALL
          SELECT * FROM new_performance
          WHERE timestamp NOT IN (SELECT timestamp FROM old_performance))""",
    "upsert_partial": f"""
        SELECT {PERFORMANCE} FROM (
          SELECT coalesce(o.timestamp, n.timestamp) AS timestamp, coalesce(n.rmse, o.rmse) AS rmse,
                 coalesce(o.mae, n.mae) AS mae,
                 coalesce(o.abs_error_max, n.abs_error_max) AS abs_error_max
          FROM old_performance o FULL JOIN new_performance n ON o.timestamp = n.timestamp)""",
    "upsert_orders_keep_first": """
        SELECT * REPLACE (round(o_totalprice, 6) AS o_totalprice) FROM (
          SELECT * FROM old_orders
          UNION ALL
          SELECT * FROM new_orders
          WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old_orders))""",
    "upsert_orders_partial": """
        SELECT o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
               round(coalesce(o.o_totalprice, n.o_totalprice), 6) AS o_totalprice,
               coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(o.o_orderdate, n.o_orderdate) AS o_orderdate,
               coalesce(o.o_orderpriority, n.o_orderpriority) AS o_orderpriority
        FROM old_orders o FULL JOIN new_orders n USING (o_orderkey)""",
    "keyed_orders": """
        SELECT o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
               round(coalesce(o.o_totalprice, n.o_totalprice), 6) AS o_totalprice,
               coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(o.o_orderdate, n.o_orderdate) AS o_orderdate,
               coalesce(o.o_orderpriority, n.o_orderpriority) AS o_orderpriority
        FROM old_orders o FULL JOIN new_orders n USING (o_orderkey)""",
    "dash_drift": f"""
        SELECT timestamp AS time, {rounded('drift_score')} AS drift_score, column_name FROM drift
        WHERE column_name = 'stock'""",
    "dash_performance": f"""
        SELECT timestamp AS time, {rounded('rmse')} AS rmse, {rounded('mae')} AS mae FROM performance""",
    "day_series": """
        SELECT time, rideable_type, stock FROM stock_all
        WHERE time::DATE = DATE '2024-01-04' AND station = 'view'""",
    # windows that end before the last event less the delay
    "stream_net_flow": "SELECT * FROM arriving_net",
    "stream_closed_slots": "SELECT * FROM arriving_net",
    "stream_daily_stock": """
        SELECT time::DATE AS day, time, station, rideable_type,
               (10 + sum(net_flow) OVER (PARTITION BY station, rideable_type, time::DATE
                                         ORDER BY time))::BIGINT AS stock
        FROM arriving_net""",
    "stream_alerts": """
        SELECT station, rideable_type, target_day AS day, unnest(fired) AS alert
        FROM (SELECT station, rideable_type, target_day, arg_max(times, i) AS fired
              FROM every_fold GROUP BY ALL)""",
    "stateful_daily_stock": """
        SELECT time::DATE AS day, time, station, rideable_type,
               (10 + sum(net_flow) OVER (PARTITION BY station, rideable_type, time::DATE
                                         ORDER BY time))::BIGINT AS stock
        FROM arriving_net""",
    "stateful_alerts": """
        SELECT station, rideable_type, target_day AS day, unnest(fired) AS alert
        FROM (SELECT station, rideable_type, target_day, arg_max(times, i) AS fired
              FROM every_fold GROUP BY ALL)""",
    "profile_lines": _profile(
        "lineitem",
        {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
         **{c: "double" for c in LINE_NUMBERS}, "l_returnflag": "string", "l_linestatus": "string",
         "l_shipdate": "timestamp_ntz"},
        "count({c}) AS non_null_count",
        True,
    ),
    "hist_line_prices": _histogram("lineitem", "l_extendedprice", 50),
    "corr_lines": _correlation("lineitem", LINE_NUMBERS),
}


# Dates are compared as text, and whole numbers that may be missing as doubles, so
# that both results look the same to whatever reads them.
DATES = {
    "daily_features": ["day"],
    "drift_categorical": ["day"],
    "drift_numeric": ["day"],
    "drift_sketches": ["day"],
    "month_days": ["month", "day"],
    "score_error": ["target_day"],
    "score_slice": ["target_day"],
    "stockout_alerts": ["target_day"],
    "stored_stock": ["day"],
    "stateful_alerts": ["day"],
    "stateful_daily_stock": ["day"],
    "stream_alerts": ["day"],
    "stream_daily_stock": ["day"],
    "validate_months": ["target_day"],
    "validate_requests": ["target_day"],
}
LAGS = ["lag_15m_stock", "lag_30m_stock", "lag_45m_stock", "lag_60m_stock"]
MAY_BE_MISSING = {
    "lag_features": [*LAGS, "target_next_stock"],
    "score_error": ["predicted_stock", "error"],
    "score_slice": LAGS,
    "stock_diff": ["stock_diff"],
}


def oracle_sql() -> dict[str, str]:
    finals = {}
    for name, text in ORACLES.items():
        casts = [f"{c}::VARCHAR AS {c}" for c in DATES.get(name, [])]
        casts += [f"{c}::DOUBLE AS {c}" for c in MAY_BE_MISSING.get(name, [])]
        if casts:
            text = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({text})"
        finals[name] = sql(text)
    return finals
