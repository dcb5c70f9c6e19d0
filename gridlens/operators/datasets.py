"""Feature frames, splits, scaling, sliding windows and the variable graph."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.scalars import (
    above, calendar, derived, drop_missing, nan_as_null, sanitize, wind_proxy, with_cyclic, zero_as_missing)
from gridlens.operators.aggregates import dedupe_mean
from gridlens.operators.blocks import products
from gridlens.operators.ordered import (
    SLICE_ROWS, interpolate_numbered, lags, number_rows, over_slices, past_rolling_mean,
    positional, renumber, rolling_mean, rolling_mean_full)
from gridlens.session import materialise

PLAUSIBLE_MW = 10_000
SEQ_LEN = 24
STD_FLOOR = 1e-8
TARGET_STD_FLOOR = 1e-6


def engineer_load(df: DataFrame, min_load_mw: float = 20_000, series: Sequence[str] = (),
                  order: Sequence[str] = ("ts",), size: int = SLICE_ROWS) -> DataFrame:
    """Load features: repair, filter, calendar, lags by position, interactions."""
    repaired = df.withColumn("load_mw", zero_as_missing(nan_as_null("load_mw")))
    # Written twice, before and after the gaps are filled: edges and counts of slices are taken
    # from the written rows, and no plan runs the steps before them again.
    numbered = materialise(number_rows(repaired, series, order, rn="_rn"), "numbered")
    filled = interpolate_numbered(numbered, series, "load_mw", "_rn", size)
    kept = renumber(materialise(above(filled, "load_mw", PLAUSIBLE_MW), "filled"), series, "_rn", size)
    dated = with_cyclic(calendar(kept), hour=("hour", 24), dow=("day_of_week", 7), month=("month", 12))
    lagged = over_slices(
        dated, series, "_rn",
        lambda w: lags(w, "load_mw", [1, 24, 168], "load_lag") | {
            "load_rolling_6h": rolling_mean(w, "load_mw", 6),
            "load_rolling_24h": rolling_mean(w, "load_mw", 24)},
        back=168, size=size)
    out = derived(lagged, only=["grid_stress", "temp_squared", "Renewables", "Net_Load"])
    out = above(out, "load_mw", min_load_mw).drop("_rn")
    return drop_missing(out, ["load_mw", "hour", "day_of_week", "load_lag_1h", "load_lag_24h"])


def engineer_price(df: DataFrame, series: Sequence[str] = (), order: Sequence[str] = ("ts",),
                   size: int = SLICE_ROWS) -> DataFrame:
    """Price features; a row with any missing value is dropped."""
    dated = with_cyclic(calendar(df).drop("month"), hour=("hour", 24))

    def build(w):
        return lags(w, "price_usd_mwh", [1, 24, 168], "price_lag") | {
            "price_rolling_24h": rolling_mean(w, "price_usd_mwh", 24),
            "load_lag_1h": F.lag("load_mw", 1).over(w)}

    return drop_missing(positional(dated, series, order, build, back=168, size=size))


def _season(df: DataFrame) -> DataFrame:
    return with_cyclic(calendar(df, iso_week=True), month=("month", 12), week=("week_of_year", 52),
                       hour=("hour", 24), day=("day_of_week", 7))


def engineer_seasonal(df: DataFrame, series: Sequence[str] = (), order: Sequence[str] = ("ts",),
                      size: int = SLICE_ROWS) -> DataFrame:
    """Seasonal features on top of the load features."""
    rolled = positional(
        _season(df), series, order,
        lambda w: {"load_rolling_mean_24h": past_rolling_mean(w, "load_mw", 24)}, back=24, size=size)
    return drop_missing(derived(rolled, only=["temp_x_month"]))


def engineer_renewable(df: DataFrame, series: Sequence[str] = (), order: Sequence[str] = ("ts",),
                       size: int = SLICE_ROWS) -> DataFrame:
    """Seasonal features plus wind and radiation, then one clean row per hour."""
    def build(w):
        return lags(w, "load_mw", [1, 24], "load_lag") | {
            "load_rolling_mean_24h": past_rolling_mean(w, "load_mw", 24),
            "solar_rolling_24h": rolling_mean_full(w, "direct_radiation", 24),
            "wind_rolling_24h": rolling_mean_full(w, "wind_speed_10m", 24)}

    rolled = positional(_season(df), series, order, build, back=24, size=size)
    rolled = rolled.withColumn("wind_power_proxy", wind_proxy("wind_speed_10m"))
    complete = drop_missing(derived(rolled, only=["temp_x_month"]))
    return dedupe_mean(complete, [*series, "ts"], PLAUSIBLE_MW)


# Scaling ------------------------------------------------------------------------

@dataclass(frozen=True)
class Scaler:
    """Mean and deviation per column: two numbers per feature, held by the driver."""

    mean: Mapping[str, float]
    std: Mapping[str, float]

    @property
    def columns(self) -> list[str]:
        return list(self.mean)

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for c in self.columns:
            std = self.std[c] if self.std[c] >= STD_FLOOR else 1.0
            scaled[c] = sanitize((F.col(c) - F.lit(self.mean[c])) / F.lit(std))
        return df.withColumns(scaled)


def fit_scaler(train: DataFrame, columns: Sequence[str], at_once: int | None = None) -> Scaler:
    """Population mean and deviation; a constant column gets deviation 1.

    A written table of many columns is read ``at_once`` columns at a time: the code that Spark makes of one aggregate
    over all of them is too long for the JVM to compile, and takes thrice as long a row.
    """
    columns = list(columns)
    aggs = []
    for c in columns:
        value = F.col(c).cast("double")
        aggs += [F.avg(value), F.when(F.max(value) == F.min(value), F.lit(1.0)).otherwise(F.stddev_pop(value))]
    step = 2 * (at_once or len(columns) or 1)
    row = [x for k in range(0, len(aggs), step) for x in train.agg(*aggs[k : k + step]).first()]
    mean = {c: row[2 * k] if row[2 * k] is not None else 0.0 for k, c in enumerate(columns)}
    std = {c: row[2 * k + 1] if row[2 * k + 1] is not None else 1.0 for k, c in enumerate(columns)}
    return Scaler(mean, std)


@dataclass(frozen=True)
class TargetScale:
    mean: float
    std: float

    def scaled(self, column: str):
        return (F.col(column) - F.lit(self.mean)) / F.lit(self.std)

    def restored(self, column: str):
        return F.col(column) * F.lit(self.std) + F.lit(self.mean)


def fit_target(train: DataFrame, column: str) -> TargetScale:
    mean, std, flat = train.agg(
        F.avg(column), F.stddev_pop(column), F.max(column) == F.min(column)).first()
    return TargetScale(mean or 0.0, max(0.0 if flat or std is None else std, TARGET_STD_FLOOR))


# Windows ------------------------------------------------------------------------

def sliding_windows(df: DataFrame, features: Sequence[str], target: str = "load_mw",
                    series: Sequence[str] = (), order: Sequence[str] = ("ts",),
                    seq_len: int = SEQ_LEN, horizon: int = 1, size: int = SLICE_ROWS) -> DataFrame:
    """Rows ``i .. i+seq_len-1`` as one array and the target ``horizon`` rows later.

    ``n_windows`` is the count per series, so splits need no second pass. Columns:
    series, window_id, window_ts (last row), target_ts, x, y, n_windows.
    """
    columns = list(dict.fromkeys([*series, *order, *features, target]))
    complete = drop_missing(df.select(*columns))
    numbered = number_rows(complete, series, order, rn="window_id", total="_total")
    reach = seq_len - 1 + horizon

    def build(w):
        frame = w.rowsBetween(0, seq_len - 1)
        return {
            "x": F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(frame),
            "window_ts": F.lead(order[0], seq_len - 1).over(w),
            "target_ts": F.lead(order[0], reach).over(w),
            "y": F.lead(target, reach).over(w)}

    built = over_slices(numbered, series, "window_id", build, ahead=reach, size=size)
    whole = built.where(F.col("window_id") + reach < F.col("_total"))
    return whole.select(*series, "window_id", "window_ts", "target_ts", "x", "y",
                        (F.col("_total") - reach).alias("n_windows"))


def scoring_windows(df: DataFrame, features: Sequence[str], series: Sequence[str] = (),
                    order: Sequence[str] = ("ts",), seq_len: int = SEQ_LEN,
                    size: int = SLICE_ROWS) -> DataFrame:
    """Windows without a target, labelled by their last row; the newest row included."""
    numbered = number_rows(df.select(*series, *order, *features), series, order, rn="window_id")

    def build(w):
        frame = w.rowsBetween(1 - seq_len, 0)
        return {"x": F.collect_list(F.array(*[F.col(c).cast("double") for c in features])).over(frame)}

    built = over_slices(numbered, series, "window_id", build, back=seq_len - 1, size=size)
    return (built.where(F.size("x") == seq_len)
            .select(*series, F.col(order[0]).alias("window_ts"), *order[1:], "x"))


def window_split(windows: DataFrame, ratio: float = 0.85) -> DataFrame:
    """Split on the window index; windows near the cut share rows with both sides."""
    return windows.withColumn("is_train", F.col("window_id") < F.floor(F.col("n_windows") * F.lit(ratio)))


def latest_window(df: DataFrame, features: Sequence[str], series: Sequence[str] = (),
                  ts: str = "ts", seq_len: int = SEQ_LEN, ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``seq_len`` rows of each series as one array, oldest first.

    Rows of equal time are ordered by ``ties`` and then by the features themselves,
    so that the same rows are picked every time.
    """
    order = list(dict.fromkeys([ts, *ties, *features]))
    rows = df.select(*dict.fromkeys([*series, *order]))
    if series:
        newest = Window.partitionBy(*series).orderBy(*[F.col(c).desc() for c in order])
        rows = rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= seq_len)
    else:
        rows = rows.orderBy(*[F.col(c).desc() for c in order]).limit(seq_len)
    cells = F.array(*[F.col(c).cast("double") for c in features])
    keys = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    packed = rows.groupBy(*series).agg(F.sort_array(F.collect_list(F.struct(
        keys.alias("k"), F.col(ts).alias("t"), cells.alias("c")))).alias("_rows"))
    return (packed.where(F.size("_rows") == seq_len)
            .select(*series, F.element_at("_rows", -1)["t"].alias("window_ts"),
                    F.transform("_rows", lambda r: r["c"]).alias("x")))


# Variable graph -------------------------------------------------------------------

Graph = Mapping[str, Mapping[str, float]]


def correlation_graph(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absolute correlations of complete rows as edges ``(i, j, w)``, diagonal 1.

    Means first, then the products about them, one matrix a task. A constant column, found by
    max = min, has no edges.
    """
    columns = list(columns)
    rows = drop_missing(df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]))
    names = rows.columns
    first = rows.agg(*[F.avg(c) for c in names], *[F.coalesce(F.max(c) != F.min(c), F.lit(False)) for c in names]).first()
    varying = [i for i, moves in enumerate(first[len(names) :]) if moves]
    product = products(rows.select(*[names[i] for i in varying]), [first[i] for i in varying]) if varying else []
    place = {i: k for k, i in enumerate(varying)}

    def weight(i: int, j: int) -> float:
        if i == j:
            return 1.0
        if i not in place or j not in place:
            return 0.0
        i, j = place[i], place[j]
        spread = (product[i, i] * product[j, j]) ** 0.5
        return float(min(1.0, abs(product[i, j]) / spread)) if spread > 0 else 0.0

    edges = [(a, b, weight(i, j)) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(edges, "i string, j string, w double")


def collect_graph(edges: DataFrame) -> dict[str, dict[str, float]]:
    """The graph on the driver: features squared numbers, whatever the data size."""
    graph: dict[str, dict[str, float]] = {}
    for i, j, w in edges.collect():
        graph.setdefault(i, {})[j] = w
    return graph


def graph_smooth(df: DataFrame, graph: Graph, prefix: str = "nb_") -> DataFrame:
    """Next to each feature, the weighted mean of all features along its edges."""
    added = {}
    for i, row in graph.items():
        total = sum(row.values()) + 1e-8
        terms = [F.col(j) * F.lit(w / total) for j, w in sorted(row.items())]
        added[f"{prefix}{i}"] = sum(terms[1:], terms[0])
    return df.withColumns(added)
