"""Forecast error measures; each is one aggregate, so groups may be of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 1e-8
FLOAT_EPS = 2.220446049250313e-16


def _diff(y: str, y_hat: str) -> Column:
    return F.col(y) - F.col(y_hat)


def mape(y: str = "y", y_hat: str = "y_hat") -> Column:
    """Percentage error; the small constant keeps a zero actual from dividing by zero."""
    return F.avg(F.abs(_diff(y, y_hat) / (F.col(y) + EPSILON))) * 100


def mape_fraction(y: str = "y", y_hat: str = "y_hat") -> Column:
    return F.avg(F.abs(_diff(y, y_hat)) / F.greatest(F.abs(F.col(y)), F.lit(FLOAT_EPS)))


def mae(y: str = "y", y_hat: str = "y_hat") -> Column:
    return F.avg(F.abs(_diff(y, y_hat)))


def mbe(y: str = "y", y_hat: str = "y_hat") -> Column:
    """Mean of actual minus predicted; positive when the model predicts too little."""
    return F.avg(_diff(y, y_hat))


def bias_label(value: Column) -> Column:
    return F.when(value > 0, "under-predicts").when(value < 0, "over-predicts").otherwise("unbiased")


def huber(delta: float = 1.0, y: str = "y", y_hat: str = "y_hat") -> Column:
    e = F.abs(_diff(y, y_hat))
    return F.avg(F.when(e <= delta, 0.5 * e * e).otherwise(delta * (e - 0.5 * delta)))


def mse(y: str = "y", y_hat: str = "y_hat") -> Column:
    return F.avg(_diff(y, y_hat) * _diff(y, y_hat))


def metric_rows(predictions: DataFrame, by: Sequence[str] = ("model_name", "horizon")) -> DataFrame:
    """One row per model, horizon and metric."""
    wide = predictions.groupBy(*by).agg(mape().alias("mape"), mae().alias("mae"))
    return wide.unpivot(list(by), ["mape", "mae"], "metric_name", "metric_value")


def detection_metrics(flagged: DataFrame, model_name: str) -> DataFrame:
    """The threshold of a detection run and how many windows it flagged, as metric rows."""
    run = flagged.agg(F.max("threshold").alias("threshold"), F.count_if("is_anomaly").cast("double").alias("test_anomalies"))
    return (run.where(F.col("threshold").isNotNull()).withColumn("model_name", F.lit(model_name))
            .unpivot(["model_name"], ["threshold", "test_anomalies"], "metric_name", "metric_value"))


def hub_notes(metrics: DataFrame, hub: str = "settlement_point") -> DataFrame:
    """Metric rows of models per hub, which say in their notes which hub it is."""
    return metrics.withColumn("notes", F.concat(F.lit("settlement_point="), F.col(hub))).drop(hub)


def residual_table(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.select(
        *keys, F.col("y").alias("actual"), F.col("y_hat").alias("predicted"),
        _diff("y", "y_hat").alias("residual"))
