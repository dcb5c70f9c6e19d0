"""Ordering, limits and assembled comparison tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How many rows each report shows.
REPORT_ROWS = {"recent": 200, "outages": 100, "anomalies_shown": 30, "anomalies_stored": 50,
               "banner": 3, "week_of_hours": 168}


def time_ordered(df: DataFrame, ts: str = "ts", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(ts, *ties)


def recent_top(df: DataFrame, n: int = REPORT_ROWS["recent"], ts: str = "ts",
               ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows; Spark keeps ``n`` per task and merges those."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in ties]).limit(n)


def oldest_top(df: DataFrame, n: int, ts: str = "ts", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(ts, *ties).limit(n)


def union_records(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_absent(records: DataFrame, names: Sequence[str], column: str = "model_name") -> DataFrame:
    """One row per wanted name; names without a record are kept, empty."""
    one = records.sparkSession.range(1)
    wanted = one.select(F.explode(F.array(*[F.lit(n) for n in names])).alias(column))
    return wanted.join(records, column, "left")


def compare_models(forecasts: DataFrame, names: Sequence[str], order: Sequence[str] = ("ts",)) -> DataFrame:
    """The latest forecast of each model side by side."""
    rest = [c for c in forecasts.columns if c != "model_name"]
    latest = (forecasts.where(F.col("model_name").isin(list(names))).groupBy("model_name")
              .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
              .select("model_name", "_row.*"))
    return with_absent(latest, names)


def ensemble(aligned: DataFrame, weights: Mapping[str, float], name: str = "y_hat") -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in weights.items()])
    return aligned.withColumn(name, total)
