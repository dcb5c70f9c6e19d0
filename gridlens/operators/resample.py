"""Hourly grids: spine, first value per hour, forward fill, training frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.scalars import hour_index, hour_of
from gridlens.operators.ordered import SLICE_ROWS, forward_fill, over_slices


def hour_spine(df: DataFrame, series: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Every hour between the first and last row of each series.

    Days are laid out first and hours second, so no task expands a whole range.
    """
    spans = df.groupBy(*series).agg(
        hour_of(F.min(ts)).alias("_first"), hour_of(F.max(ts)).alias("_last"))
    return _hours(spans.where(F.col("_first").isNotNull()), series)


def _hours(spans: DataFrame, series: Sequence[str]) -> DataFrame:
    day = F.expr("interval 1 day")
    hour = F.expr("interval 1 hour")
    days = spans.withColumn("_day", F.explode(F.sequence(
        F.date_trunc("day", "_first"), F.date_trunc("day", "_last"), day)))
    hours = days.withColumn("ts", F.explode(F.sequence(
        F.col("_day"), F.col("_day") + F.expr("interval 23 hours"), hour)))
    return hours.where(F.col("ts").between(F.col("_first"), F.col("_last"))).select(*series, "ts")


def first_per_hour(df: DataFrame, columns: Sequence[str], series: Sequence[str] = (),
                   ts: str = "ts", order: Sequence[str] = ()) -> DataFrame:
    """Per hour and column, the first value present in time order."""
    at = F.struct(ts, *order)
    picks = [F.min_by(c, F.when(F.col(c).isNotNull() & ~_nan(df, c), at)).alias(c) for c in columns]
    return df.groupBy(*series, hour_of(ts).alias("ts")).agg(*picks)


def _nan(df: DataFrame, column: str):
    kind = df.schema[column].dataType.typeName()
    return F.isnan(column) if kind in ("double", "float") else F.lit(False)


def resample_first(df: DataFrame, columns: Sequence[str], series: Sequence[str] = (),
                   ts: str = "ts", order: Sequence[str] = ()) -> DataFrame:
    """``first_per_hour`` on the full grid: hours without rows are kept, empty.

    Each hour also lays out the empty hours up to the next one, so the input is read
    once and nothing is joined. The window sees one row per hour, a number the
    calendar bounds.
    """
    hourly = first_per_hour(df, columns, series, ts, order)
    following = F.lead("ts").over(Window.partitionBy(*series).orderBy("ts"))
    hour = F.expr("interval 1 hour")
    last = F.coalesce(F.col("_next") - hour, F.col("_at"))
    laid = (hourly.withColumn("_next", following).withColumnRenamed("ts", "_at")
            .where(F.col("_at").isNotNull())
            .withColumn("ts", F.explode(F.sequence(F.col("_at"), last, hour))))
    held = F.col("ts") == F.col("_at")
    return laid.select(*series, "ts", *[F.when(held, F.col(c)).alias(c) for c in columns])


def ffill_hourly(grid: DataFrame, columns: Sequence[str], series: Sequence[str] = (),
                 limit: int = 3, size: int = SLICE_ROWS) -> DataFrame:
    """Carry the last value over at most ``limit`` hours of a gap-free hourly grid.

    On such a grid the hour number is the position: nothing has to be counted.
    """
    placed = grid.withColumn("_at", hour_index("ts"))
    filled = over_slices(placed, series, "_at",
                         lambda w: {c: forward_fill(w, c, limit) for c in columns},
                         back=limit, size=size)
    return filled.drop("_at")


def stack_aligned(*frames: DataFrame) -> DataFrame:
    """All frames under one header; columns a frame lacks stay empty.

    Followed by ``first_per_hour`` this equals a full outer join on ``ts`` and then
    resampling, with one shuffle that aggregates before it sends.
    """
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def build_training_frame(load: DataFrame, weather: DataFrame, prices: DataFrame,
                         limit: int = 3, size: int = SLICE_ROWS) -> DataFrame:
    """Load, weather and price on one hourly grid, small gaps carried forward."""
    stacked = stack_aligned(load, weather, prices)
    columns = [c for c in stacked.columns if c != "ts"]
    grid = resample_first(stacked, columns)
    return ffill_hourly(grid, columns, limit=limit, size=size)
