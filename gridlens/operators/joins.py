"""Alignment joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.scalars import hour_of


def align_outer(*frames: DataFrame, on: Sequence[str] = ("ts",)) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, list(on), "full_outer")
    return out


def align_inner(load: DataFrame, weather: DataFrame, forecast: DataFrame | None = None,
                on: Sequence[str] = ("ts",)) -> DataFrame:
    """Inner alignment; an absent or empty forecast is left out.

    A count of the forecast's rows, one row, says whether unmatched rows stay: all do
    when there is no forecast at all, with its columns missing.
    """
    out = load.join(weather, list(on), "inner")
    if forecast is None:
        return out
    marked = out.join(forecast.withColumn("_given", F.lit(True)), list(on), "left")
    absent = forecast.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    return marked.where(F.col("_given").isNotNull() | absent).drop("_given")


def hour_join(load: DataFrame, weather: DataFrame, zone: str = "houston") -> DataFrame:
    """Pair rows of the same hour, one zone; every pair of the hour is kept."""
    left = load.withColumn("_hour", hour_of("ts"))
    right = (weather.where((F.col("zone") == zone) | F.col("zone").isNull())
             .withColumn("_hour", hour_of("ts")).drop("ts"))
    return left.join(right, "_hour", "inner").drop("_hour")


def without_known(batch: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key the table does not hold yet."""
    return batch.join(known.select(*keys), list(keys), "left_anti")


def align_predictions(left: DataFrame, right: DataFrame,
                      on: Sequence[str] = ("series", "ts", "horizon")) -> DataFrame:
    """Two models' predictions for the same target, matched by key."""
    return left.join(right, list(on), "inner")
