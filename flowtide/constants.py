"""Results only match when these are kept as they are."""

# --- fixed values -----------------------------------------------------------

# Series
TOP_STATIONS = 3
SLOT_MINUTES = 15
INITIAL_STOCK = 10
SKIP_DAYS = 1
LAGS = 4
MAX_Z = 2.0

# Rush hours, as hours of the day: morning and evening
RUSH_HOURS = ((8, 10), (17, 19))

# The ``date`` feature counts from this day and is 1.0 one (leap) year later
DATE_ORIGIN = "2024-01-01"
DATE_SPAN_DAYS = 366.0

# Requests
REQUEST_STATIONS = ("W 21 St & 6 Ave", "University Pl & E 14 St", "8 Ave & W 31 St")
RIDEABLE_TYPES = ("classic_bike", "electric_bike")
REQUEST_YEAR = 2025
LOOKBACK_HOURS = 2
ALERT_STEP = 10

# Training
TRAIN_FRACTION = 0.8
GBT_ROUNDS = 58
GBT_DEPTH = 6
GBT_RATE = 0.2089
SEED = 42
EXPERIMENT_ROUNDS = 30
EXPERIMENT_DEPTH = 20
EXPERIMENT_RATE = 0.1
SEARCH_DRAWS = 30
SEARCH_FOLDS = 5
SEARCH_PARALLELISM = 4
SEARCH_ROUNDS = (5, 100)
SEARCH_DEPTHS = (3, 20)
SEARCH_RATES = (0.001, 1.001)
VAR_MAX_LAGS = 16
SEASON_PERIOD = 96
SEQUENCE_LOOKBACK = 96

# Monitoring
COLUMN_DRIFT_THRESHOLD = 0.1
DATASET_DRIFT_SHARE = 0.5

# Feature columns
LAG_COLUMNS = ("lag_15m_stock", "lag_30m_stock", "lag_45m_stock", "lag_60m_stock")
TARGET = "target_next_stock"
CATEGORICAL_FEATURES = ("station", "rideable_type")
NUMERICAL_FEATURES = (
    "stock",
    "hour",
    "dayofweek",
    "is_rush_hour",
    "lag_15m_stock",
    "lag_30m_stock",
    "lag_45m_stock",
    "lag_60m_stock",
    "target_next_stock",
    "date",
)
# ----------------------------------------------------------------------------

MODEL_INPUTS = CATEGORICAL_FEATURES + tuple(c for c in NUMERICAL_FEATURES if c != TARGET)
SERIES = CATEGORICAL_FEATURES
SLOTS_PER_DAY = 24 * 60 // SLOT_MINUTES


def lag_column(k: int, slot_minutes: int = SLOT_MINUTES) -> str:
    return f"lag_{k * slot_minutes}m_stock"
