"""Grouped and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.functions.scalars import above, nan_as_null, or_zero


def price_rollup(prices: DataFrame, bucket: str = "hour") -> DataFrame:
    price = "price_usd_mwh"
    return (prices.groupBy(F.date_trunc(bucket, "ts").alias("bucket"), "settlement_point", "market_type")
            .agg(F.avg(price).alias("avg_price_usd_mwh"),
                 F.max(price).alias("max_price_usd_mwh"),
                 F.min(price).alias("min_price_usd_mwh")))


def zone_average(weather: DataFrame, humidity: bool = True) -> DataFrame:
    """Mean over zones. A missing humidity counts as zero, other gaps are skipped."""
    means = [F.avg(c).alias(c) for c in ("temperature_2m", "wind_speed_10m", "direct_radiation")]
    if humidity:
        means.append(F.avg(or_zero("relative_humidity")).alias("relative_humidity"))
    return weather.groupBy("ts").agg(*means)


def dedupe_mean(df: DataFrame, keys: Sequence[str] = ("ts",), floor: float | None = 10_000,
                value: str = "load_mw") -> DataFrame:
    """Mean of every numeric column per key, then the plausibility filter."""
    numeric = [f.name for f in df.schema.fields
               if f.name not in keys and f.dataType.typeName() in
               ("double", "float", "integer", "long", "short", "byte")]
    out = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric])
    return out if floor is None else above(out, value, floor)


def load_heatmap(load: DataFrame, dates: Sequence | None = None) -> DataFrame:
    """Mean load per hour of day and date; one column per date when they are named."""
    parts = load.select(F.hour("ts").alias("hour"), F.to_date("ts").alias("date"), "load_mw")
    if dates:
        return parts.groupBy("hour").pivot("date", list(dates)).agg(F.avg("load_mw"))
    return parts.groupBy("hour", "date").agg(F.avg("load_mw").alias("load_mw"))


def _pairwise(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; empty for a constant.

    Constants are found by max = min: merged variances need not be exactly zero.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    px, py = F.when(both, F.col(x)), F.when(both, F.col(y))
    flat = (F.max(px) == F.min(px)) | (F.max(py) == F.min(py))
    ratio = F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(~flat, ratio)


def corr_matrix(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All pairs as rows ``(i, j, r)``, both orders and the diagonal, from one pass.

    Meant for the handful of columns of a report; the variable graph of a model has
    its own operator.
    """
    pairs = list(combinations(range(len(columns)), 2))
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    moments = [_pairwise(columns[a], columns[b]).alias(f"_r{a}_{b}") for a, b in pairs]
    own = [F.when(F.max(c) != F.min(c), F.lit(1.0)).alias(f"_d{k}") for k, c in enumerate(columns)]
    row = doubles.groupBy(*by).agg(*moments, *own)
    cells = []
    for a, b in pairs:
        cells.append(F.struct(F.lit(columns[a]).alias("i"), F.lit(columns[b]).alias("j"),
                              F.col(f"_r{a}_{b}").alias("r")))
        cells.append(F.struct(F.lit(columns[b]).alias("i"), F.lit(columns[a]).alias("j"),
                              F.col(f"_r{a}_{b}").alias("r")))
    for k, c in enumerate(columns):
        cells.append(F.struct(F.lit(c).alias("i"), F.lit(c).alias("j"), F.col(f"_d{k}").alias("r")))
    return row.select(*by, F.inline(F.array(*cells)))


def ols_trend(df: DataFrame, y: str, xs: Sequence[str], min_rows: int = 10) -> DataFrame:
    """Straight line of ``y`` on each ``x``; empty for a constant or too few rows."""
    cells = []
    for x in xs:
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        px, py = F.when(both, F.col(x)), F.when(both, F.col(y))
        usable = (F.count(px) > min_rows) & (F.max(px) != F.min(px))
        slope = F.try_divide(F.covar_pop(px, py), F.var_pop(px))
        r2 = F.try_divide(F.covar_pop(px, py) * F.covar_pop(px, py), F.var_pop(px) * F.var_pop(py))
        cells.append(F.struct(
            F.lit(x).alias("x"), F.count(px).alias("n"),
            F.when(usable, slope).alias("slope"),
            F.when(usable, F.avg(py) - slope * F.avg(px)).alias("intercept"),
            F.when(usable & (F.max(py) != F.min(py)), r2).alias("r2")))
    return df.agg(F.array(*cells).alias("_lines")).select(F.inline("_lines"))


def table_stats(tables: Mapping[str, DataFrame], ts: str = "ts") -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
             .withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def severity_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def stress_counts(outages: DataFrame) -> DataFrame:
    stressed = F.coalesce(F.col("status") == "high_stress", F.lit(False))
    return outages.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(stressed).alias("high_stress"),
                       F.count_if(~stressed).alias("normal"))


def distinct_zones(weather: DataFrame) -> DataFrame:
    return (weather.agg(F.count_distinct("zone").alias("zones"))
            .withColumn("several", F.col("zones") > 1))


# How much data each consumer needs before it may run.
READINESS = {
    "training_frame": ("rows", 100),
    "load_windows": ("rows", 72),
    "tree_baseline": ("rows", 51),
    "price_training": ("values", 100),
    "price_serving": ("values", 24),
    "anomaly_training": ("rows", 73),
    "anomaly_serving": ("rows", 48),
    "latest_window": ("rows", 24),
}


def readiness(df: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """Per series, which consumers have enough rows or values."""
    counted = df.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"))
    gates = {name: F.col(f"n_{unit}") >= need for name, (unit, need) in READINESS.items()}
    return counted.withColumns(gates)




# Features and rows that a price model needs.
LEAST_FEATURES, LEAST_FEATURE_ROWS = 3, 72


def feature_gate(df: DataFrame, series: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Per series, how many of the wanted features are there with at least one value, how many rows have all
    of those, and whether both are enough to fit on. A feature that the table lacks is not there."""
    present = [c for c in dict.fromkeys(features) if c in df.columns]
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    gone = [(nan_as_null(c) if kinds[c] in ("double", "float") else F.col(c)).isNull() for c in present]
    pattern = sum((g.cast("long") * (1 << i) for i, g in enumerate(gone)), F.lit(0).cast("long"))
    patterns = df.groupBy(*series, pattern.alias("_gone")).agg(F.count(F.lit(1)).alias("_n"))
    # A feature without any value in a series is left out there, so its nulls make no row incomplete.
    seen = patterns.groupBy(*series).agg(F.bit_and("_gone").alias("_never"),
                                         F.collect_list(F.struct("_gone", "_n")).alias("_rows"))
    whole = F.filter("_rows", lambda r: r["_gone"].bitwiseAND(F.bitwise_not("_never")) == 0)
    out = seen.select(*series, (F.lit(len(present)) - F.bit_count("_never")).cast("long").alias("n_features"),
                      F.aggregate(whole, F.lit(0).cast("long"), lambda total, r: total + r["_n"]).alias("n_rows"))
    return out.withColumn("ready", (F.col("n_features") >= LEAST_FEATURES) & (F.col("n_rows") >= LEAST_FEATURE_ROWS))
