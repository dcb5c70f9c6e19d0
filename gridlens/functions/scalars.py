"""Projections, filters and scalar functions."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.schemas import SEVERITY_RANK


def moment(as_of: datetime | str | Column | None) -> Column:
    """A query's reference time; the clock only when none is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def days_before(as_of: datetime | str | Column | None, days: int) -> Column:
    return moment(as_of) - F.make_dt_interval(days=F.lit(int(days)))


def since(df: DataFrame, start: Column, grain: str = "day", dt: str = "dt") -> DataFrame:
    """The partition predicate of ``ts >= start``, which Spark cannot derive itself.

    ``grain`` is that of the table's ``dt`` column; tables without one pass through.
    """
    return df.where(F.col(dt) >= F.to_date(F.date_trunc(grain, start))) if dt in df.columns else df


def recent(df: DataFrame, days: int, as_of=None, ts: str = "ts", grain: str = "day") -> DataFrame:
    """Rows strictly newer than ``as_of`` minus ``days``; old partitions are never listed."""
    start = days_before(as_of, days)
    return since(df.where(F.col(ts) > start), start, grain)


def date_range(df: DataFrame, first, last, ts: str = "ts") -> DataFrame:
    return df.where(F.col(ts).between(moment(first), moment(last)))


def matching(df: DataFrame, **values) -> DataFrame:
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def above(df: DataFrame, column: str, floor: float) -> DataFrame:
    """Rows above ``floor``; missing values never pass, nor does NaN."""
    return df.where((F.col(column) > F.lit(float(floor))) & ~F.isnan(column))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in the columns.

    One condition a column: of a single one over all columns, the optimizer derives a copy for every combination of
    their later names.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    whole = F.lit(True)
    for c in dict.fromkeys(subset or kinds):
        if c in kinds:
            whole = whole & F.col(f"`{c}`").isNotNull()
            if kinds[c] in ("double", "float"):
                whole = whole & ~F.isnan(f"`{c}`")
    return df.where(whole)


def select_available(df: DataFrame, wanted: Iterable[str], keys: Sequence[str] = ()) -> DataFrame:
    have = set(df.columns)
    picked = [c for c in dict.fromkeys([*keys, *wanted]) if c in have]
    return df.select(*picked)


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts)


def hour_index(ts: str | Column) -> Column:
    """Whole hours since the epoch."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(ts) / 3600)


def calendar(df: DataFrame, ts: str = "ts", iso_week: bool = False, date: bool = False) -> DataFrame:
    """Hour, Monday-based weekday, month and weekend flag."""
    weekday = F.weekday(ts)
    parts = {
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "month": F.month(ts),
        "is_weekend": (weekday >= 5).cast("int"),
    }
    if iso_week:
        parts["week_of_year"] = F.weekofyear(ts)
    if date:
        parts["date"] = F.to_date(ts)
    return df.withColumns(parts)


def cyclic(column: str | Column, period: int) -> tuple[Column, Column]:
    column = F.col(column) if isinstance(column, str) else column
    angle = F.lit(2 * math.pi) * column / F.lit(period)
    return F.sin(angle), F.cos(angle)


def with_cyclic(df: DataFrame, **spec: tuple[str, int]) -> DataFrame:
    """``with_cyclic(df, hour=("hour", 24))`` adds ``hour_sin`` and ``hour_cos``."""
    added = {}
    for prefix, (column, period) in spec.items():
        added[f"{prefix}_sin"], added[f"{prefix}_cos"] = cyclic(column, period)
    return df.withColumns(added)


def derived(df: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Optional features, each added only when its inputs are present."""
    have = set(df.columns)
    added: dict[str, Column] = {}
    if {"load_mw", "forecast_mw"} <= have:
        added["grid_stress"] = F.col("load_mw") - F.col("forecast_mw")
    if "temperature_2m" in have:
        added["temp_squared"] = F.col("temperature_2m") * F.col("temperature_2m")
    if "wind_speed_10m" in have:
        added["wind_power_proxy"] = wind_proxy("wind_speed_10m")
    if {"temperature_2m", "month_sin"} <= have:
        added["temp_x_month"] = F.col("temperature_2m") * F.col("month_sin")
    if {"Wind", "Solar"} <= have:
        renewables = or_zero("Wind") + or_zero("Solar")
        added["Renewables"] = renewables
        if "load_mw" in have:
            added["Net_Load"] = F.col("load_mw") - renewables
    if only is not None:
        added = {name: column for name, column in added.items() if name in set(only)}
    return df.withColumns(added) if added else df


def wind_proxy(column: str) -> Column:
    speed = F.col(column)
    return speed * speed * speed


def zero_as_missing(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != 0, column)


def nan_as_null(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(column), column)


def or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0.0))


def sanitize(column: str | Column) -> Column:
    """Missing, NaN and infinite values become zero."""
    column = F.col(column) if isinstance(column, str) else column
    finite = ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))
    return F.when(finite, column).otherwise(F.lit(0.0))


def stress_sign(df: DataFrame, column: str = "grid_stress", strong: float = 2000.0) -> DataFrame:
    stress = F.col(column)
    return df.withColumns({
        "stress_label": F.when(stress > 0, "Over-forecast").when(stress < 0, "Under-forecast"),
        "stress_positive": F.coalesce(stress, F.lit(0.0)) > 0,
        "stress_strong": F.coalesce(F.abs(stress) > strong, F.lit(False)),
    })


def severity_rank(column: str = "severity") -> Column:
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(F.col(column) == name, value).otherwise(rank)
    return rank


# Decimals shown per kind of figure.
REPORT_DECIMALS = {"mw": 1, "price": 2, "score": 4}


def round_report(column: str | Column, kind: str) -> Column:
    return F.round(column, REPORT_DECIMALS[kind])


def assign_alert_id(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fill missing ids from the row's own values, so that a retried task agrees."""
    made = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), 256)
    given = F.col("alert_id") if "alert_id" in df.columns else F.lit(None).cast("string")
    return df.withColumn("alert_id", F.coalesce(given, made))


# Texts of alerts.
CAPACITY_TITLE = "Grid Capacity Alert: %.1f%% reserve"
CAPACITY_TEXT = ("Demand %,.0f MW vs Capacity %,.0f MW (%.1f%% utilization). "
                 "Wind: %,.0f MW, Solar: %,.0f MW, Freq: %.3f Hz")
FREQUENCY_TITLE = "Frequency Deviation: %.3f Hz"
FREQUENCY_TEXT = "Grid frequency at %.3f Hz (nominal %.3f Hz). Deviation: %.1f mHz"


def _filled(text: str, *values: Column) -> Column:
    """The text with its numbers; missing where a number is."""
    numbers = [v.cast("double") for v in values]
    known = F.lit(True)
    for v in numbers:
        known = known & v.isNotNull()
    return F.when(known, F.format_string(text, *numbers))


def capacity_text() -> tuple[Column, Column]:
    """Title and description of a capacity alert."""
    ratio = F.col("ratio")
    return _filled(CAPACITY_TITLE, (1 - ratio) * 100), _filled(
        CAPACITY_TEXT, F.col("demand"), F.col("capacity"), ratio * 100, or_zero("wind"), or_zero("solar"), or_zero("freq"))


def frequency_text(nominal: float = 60.0) -> tuple[Column, Column]:
    """Title and description of a frequency alert."""
    freq = F.col("freq")
    return _filled(FREQUENCY_TITLE, freq), _filled(FREQUENCY_TEXT, freq, F.lit(nominal), (freq - nominal) * 1000)
