"""Requests to stock-out alerts."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from flowtide.constants import ALERT_STEP, INITIAL_STOCK
from flowtide.operators.models import score
from flowtide.operators.requests import (
    alert_times,
    answer_requests,
    fill_lags,
    score_error,
    score_slice,
)


def stockout_alerts(
    requests: DataFrame,
    history: DataFrame,
    model: PipelineModel,
    initial_stock: int = INITIAL_STOCK,
    step: int = ALERT_STEP,
    fill: bool = False,
) -> DataFrame:
    """Valid requests with the times at which a stock-out is to be expected.

    Equal requests are scored once. The slots before the history is long enough for
    their lags have no prediction; ``fill`` makes up their lags from later slots.
    """
    rows = score_slice(requests, history)
    scored = score(model, fill_lags(rows) if fill else rows)
    return answer_requests(requests, alert_times(scored, initial_stock, step))


def one_step_forecast(
    requests: DataFrame, history: DataFrame, model: PipelineModel, fill: bool = False
) -> DataFrame:
    """Actual and predicted stock and the error per slot of each requested day."""
    rows = score_slice(requests, history)
    return score_error(score(model, fill_lags(rows) if fill else rows))
