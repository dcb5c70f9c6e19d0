"""Load and price forecasts on MLlib and on grouped Gram sums, and the model registry."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.operators import blocks
from gridlens.operators.blocks import over_windows, read
from gridlens.operators.datasets import (
    SEQ_LEN, Graph, Scaler, TargetScale, fit_target, graph_smooth, latest_window)
from gridlens.operators.ordered import SLICE_ROWS, positional
from gridlens.session import path_exists

# Sizes of the boosted baseline.
BOOSTED = {"maxIter": 400, "maxDepth": 8, "stepSize": 0.04, "subsamplingRate": 0.85,
           "featureSubsetStrategy": "0.85", "minInstancesPerNode": 3}
HORIZONS = (1, 24)


# Boosted baseline -----------------------------------------------------------------------

@dataclass
class BoostedLoad:
    model: object
    features: list[str]

    def predict(self, rows: DataFrame, name: str = "y_hat") -> DataFrame:
        packed = _assemble(rows, self.features)
        return self.model.transform(packed).withColumnRenamed("prediction", name).drop("_features")


def _assemble(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Complete rows only; trees here have no branch for missing values."""
    complete = rows.dropna(subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(complete)


def fit_boosted_load(rows: DataFrame, features: Sequence[str], target: str = "load_mw",
                     is_train: str = "is_train", early_stop: bool = True, seed: int = 42,
                     **params) -> BoostedLoad:
    """Boosted trees with the later rows as validation for stopping early."""
    settings = BOOSTED | params
    if early_stop:
        settings |= {"validationIndicatorCol": "_validation", "validationTol": 0.001}
    packed = _assemble(rows.dropna(subset=[target]), features)
    trees = GBTRegressor(featuresCol="_features", labelCol=target, seed=seed, **settings)
    if early_stop:
        packed = packed.withColumn("_validation", ~F.col(is_train))
    else:
        packed = packed.where(is_train)
    return BoostedLoad(trees.fit(packed), list(features))


# Window regression on the variable graph -----------------------------------------------------

@dataclass
class GraphLoad:
    """Linear model of a flattened, graph-smoothed window."""

    model: object
    scale: TargetScale
    horizon: int

    def predict(self, windows: DataFrame, name: str = "y_hat") -> DataFrame:
        packed = windows.withColumn("_features", array_to_vector(F.flatten("x")))
        scored = self.model.transform(packed)
        return (scored.withColumn(name, self.scale.restored("prediction"))
                .drop("_features", "prediction"))


def smoothed_features(rows: DataFrame, scaler: Scaler, graph: Graph) -> tuple[DataFrame, list[str]]:
    """Scaled features with their neighbour means; the names to build windows from."""
    smooth = graph_smooth(scaler.transform(rows), graph)
    return smooth, [*scaler.columns, *[f"nb_{c}" for c in graph]]


def fit_graph_load(windows: DataFrame, horizon: int, loss: str = "huber", delta: float = 1.35,
                   penalty: float = 1e-4, max_iter: int = 50) -> GraphLoad:
    """Robust or plain linear regression of the scaled target; ``windows`` carry ``is_train``.

    The robust loss of Spark needs a width above 1.
    """
    train = windows.where("is_train")
    scale = fit_target(train, "y")
    packed = train.select(array_to_vector(F.flatten("x")).alias("_features"), scale.scaled("y").alias("_label"))
    settings = {"loss": "huber", "epsilon": max(delta, 1.0001)} if loss == "huber" else {"loss": "squaredError"}
    model = LinearRegression(featuresCol="_features", labelCol="_label", regParam=penalty,
                             maxIter=max_iter, **settings).fit(packed)
    return GraphLoad(model, scale, horizon)


# Window regression on packed rows ---------------------------------------------------------------

#: Rounds of the robust fit at most, rounds without a better validation error that end it, and the
#: change of a standardised coefficient that counts as none.
ROUNDS, PATIENCE, SETTLED = 60, 12, 1e-5


@dataclass(frozen=True)
class WindowLoad:
    """Linear model of a window of ``features``: coefficients window row by window row, in units of the target."""

    features: list[str]
    scale: TargetScale
    horizon: int
    intercept: float
    coefficients: np.ndarray
    sigma: float
    errors: list[float]  # validation loss of each round
    best: int  # the round whose coefficients these are

    def predict(self, windows: DataFrame, name: str = "y_hat") -> DataFrame:
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        terms = F.zip_with(F.flatten("x"), weights, lambda a, b: a * b)
        return windows.withColumn(name, F.lit(self.intercept) + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))

    def residuals(self, packed: blocks.Blocks, target: str):
        """Per block, inside tasks: places of the targets, windows' numbers, targets and forecasts."""
        return _residuals(packed, self.features, target, self.horizon, self.intercept, self.coefficients)


def _residuals(packed: blocks.Blocks, features: Sequence[str], target: str, horizon: int, intercept: float,
               coefficients: np.ndarray):
    at, y, length = packed.at(features), packed.columns.index(target), packed.seq_len
    weights = coefficients.reshape(length, len(at), 1)

    def of_block(b: blocks.Block):
        place, seen = over_windows(b, at, weights, length, horizon)
        return place, b.first + place - (length - 1 + horizon), b.z[place, y], seen[:, 0] + intercept
    return of_block


class _Fit:
    """The regression of one horizon, on the driver: sums over the windows, and where its rounds have got to."""

    def __init__(self, sums: blocks.Sums, horizon: int, length: int, d: int, penalty: float):
        self.horizon, self.n, self.penalty = horizon, float(sums.n), penalty
        moved = np.tile(sums.moved[:d], length)
        self.mean = moved + sums.column / self.n
        product = sums.product - np.outer(sums.column, sums.column) / self.n
        spread = np.sqrt(np.maximum(np.diag(product) / self.n, 0.0))
        self.varies = spread > 1e-9 * np.maximum(1.0, np.abs(moved))
        self.unit = np.where(self.varies, spread, 1.0)
        self.system = product / np.outer(self.unit, self.unit) / self.n * np.outer(self.varies, self.varies)
        self.centre = float(sums.moved[-1] + sums.target / self.n)
        self.cross = (sums.cross - sums.column * sums.target / self.n) / self.unit / self.n * self.varies
        self.scale = TargetScale(self.centre, 1.0)
        self.b0, self.b, self.sigma = 0.0, np.zeros(len(self.unit)), 1.0
        self.errors: list[float] = []
        self.best, self.at_best, self.done, self.loss, self.share = (0.0, self.b, 1.0), 0, False, np.inf, 1.0

    def start(self, squares: float) -> None:
        """Least squares, with the deviation of the targets as their unit."""
        deviation = float(np.sqrt(squares / self.n))
        flat = deviation <= 1e-12 * max(1.0, abs(self.centre))
        self.scale = TargetScale(self.centre, max(0.0 if flat else deviation, 1e-6))
        eye = np.eye(len(self.unit))
        self.b = np.linalg.lstsq(self.system + self.penalty * eye, self.cross / self.scale.std, rcond=1e-12)[0]
        self.best = (self.b0, self.b, self.sigma)

    def raw(self, b0: float, b: np.ndarray) -> tuple[float, np.ndarray]:
        """Intercept and coefficients in the features' and the target's own units."""
        own = b / self.unit * self.scale.std
        return self.scale.mean + b0 * self.scale.std - float(own @ self.mean), own

    def step(self, got: np.ndarray, delta: float, patience: int | None, settled: float) -> None:
        """One round on the sums of a pass: pulled residuals, their squares inside the bound, how many lie outside,
        loss and number of the later windows, loss of these, and the residuals' products with the windows."""
        pulled, inside, outside, later, n_later, loss = got[:6]
        error = float(later / n_later) if n_later else 0.0
        if not self.errors or error < min(self.errors) - 1e-12:
            self.best, self.at_best = (self.b0, self.b, self.sigma), len(self.errors)
        self.errors.append(error)
        if patience is not None and n_later and len(self.errors) - 1 - self.at_best >= patience:
            self.done = True
            return
        # Only rows inside the bound resist a step; should the loss rise for it, steps are as short as is safe.
        self.share = max(1.0 - outside / self.n, 0.05) if loss <= self.loss * (1 + 1e-9) else 1.0
        self.loss = loss
        pull = (got[6:] - self.mean * pulled) / self.unit / self.n * self.varies
        shrink = self.penalty * self.sigma / 2
        move = np.linalg.solve(self.share * self.system + (shrink + 1e-12) * np.eye(len(pull)), pull - shrink * self.b)
        shift = pulled / self.n / self.share
        free = self.n - delta ** 2 * outside
        sigma = float(np.sqrt(max(inside, 1e-18) / free)) if free > 0 else self.sigma
        moved_by = max(float(np.abs(move).max()), abs(shift), abs(sigma - self.sigma))
        self.b, self.b0, self.sigma = self.b + move, self.b0 + shift, sigma
        if patience is None or not n_later:
            self.best, self.at_best = (self.b0, self.b, self.sigma), len(self.errors)
        self.done = moved_by < settled


def fit_window_loads(packed: blocks.Blocks, features: Sequence[str], target: str, horizons: Sequence[int],
                     ratio: float = 0.85, loss: str = "huber", delta: float = 1.35, penalty: float = 1e-4,
                     rounds: int = ROUNDS, patience: int | None = PATIENCE, settled: float = SETTLED) -> list[WindowLoad]:
    """Robust or plain linear regressions of the scaled target on the first ``ratio`` of each series' windows, one
    for each horizon.

    The robust loss is that of Spark's robust regression: squares within ``delta`` deviations, straight lines beyond,
    the deviation fitted with the coefficients. Each round is one pass over the packed rows for all horizons:
    residuals beyond the bound are pulled back to it and regressed on the windows. The matrix of that regression is
    the same in every round, it comes from `blocks.pooled` once. The later windows are the validation: after
    ``patience`` rounds without a smaller loss there, the best round's coefficients are taken; None fits until
    nothing moves.
    """
    features, length, d = list(features), packed.seq_len, len(features)
    wide, at, y_at = length * d, packed.at(features), packed.columns.index(target)
    sums = blocks.pooled(packed, features, target, horizons, ratio)
    if any(not s.n for s in sums.values()):
        raise ValueError("no windows to fit")
    fits = [_Fit(sums[h], h, length, d, penalty) for h in horizons]
    delta = max(delta, 1.0001)

    def passed(now: list[_Fit], bounded: bool) -> list[np.ndarray]:
        """The sums of a round for each fit; not ``bounded``, only the squares, whatever their size."""
        state = [(f.horizon, *f.raw(f.b0, f.b), f.scale.std, delta * f.sigma if bounded else np.inf) for f in now]

        def of_block(block: blocks.Block) -> np.ndarray:
            out = np.zeros((len(state), 6 + wide))
            z = block.z[:, at]
            for row, (horizon, intercept, own, std, bound) in zip(out, state):
                place, seen = over_windows(block, at, own.reshape(length, d, 1), length, horizon)
                if not len(place):
                    continue
                window = block.first + place - (length - 1 + horizon)
                r = (block.z[place, y_at] - seen[:, 0] - intercept) / std
                train = window < np.floor(block.windows(length, horizon) * ratio)
                far = np.abs(r) > bound
                pulled = np.where(train, np.clip(r, -bound, bound), 0.0)
                costs = np.where(far, 2 * bound * np.abs(r) - bound ** 2, r ** 2) if bounded else r ** 2
                row[:6] = (pulled.sum(), (r[train & ~far] ** 2).sum(), (train & far).sum(), costs[~train].sum(),
                           (~train).sum(), costs[train].sum())
                if bounded:
                    for t in range(length):
                        rows = place[0] - (length - 1 + horizon) + t
                        row[6 + t * d : 6 + (t + 1) * d] = pulled @ z[rows : rows + len(place)]
            return out.ravel()
        return list(blocks.total(packed, of_block).reshape(len(now), -1))

    for f, got in zip(fits, passed(fits, False)):  # with no coefficients: the targets about their mean
        f.start(got[1])
    if loss == "huber":
        for f, got in zip(fits, passed(fits, False)):
            f.sigma = float(np.sqrt(got[1] / f.n)) or 1e-9
            f.best = (f.b0, f.b, f.sigma)
        for _ in range(rounds):
            now = [f for f in fits if not f.done]
            if not now:
                break
            for f, got in zip(now, passed(now, True)):
                f.step(got, delta, patience, settled)
    return [WindowLoad(features, f.scale, f.horizon, *f.raw(*f.best[:2]), f.best[2], f.errors, f.at_best) for f in fits]


def fit_window_load(packed: blocks.Blocks, features: Sequence[str], target: str, horizon: int, **settings) -> WindowLoad:
    """`fit_window_loads` for one horizon."""
    return fit_window_loads(packed, features, target, [horizon], **settings)[0]


def window_forecasts(packed: blocks.Blocks, model: WindowLoad, target: str, ratio: float = 0.85) -> DataFrame:
    """Target and forecast of every window: (``y``, ``y_hat``, ``is_train``)."""
    of_block = model.residuals(packed, target)
    n_series, wide, length, horizon = len(packed.series), len(packed.columns), packed.seq_len, model.horizon

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b in read(batch, n_series, wide):
                _, window, y, y_hat = of_block(b)
                train = window < np.floor(b.windows(length, horizon) * ratio)
                yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(y_hat), pa.array(train)], names=["y", "y_hat", "is_train"])

    return packed.table.mapInArrow(task, "y double, y_hat double, is_train boolean")


# Price regression per hub and horizon ----------------------------------------------------------

def with_targets(rows: DataFrame, target: str, series: Sequence[str], order: Sequence[str] = ("ts",),
                 horizons: Sequence[int] = HORIZONS, size: int = SLICE_ROWS) -> DataFrame:
    """The value ``h`` rows ahead as ``y_<h>`` for each horizon."""
    return positional(rows, series, order,
                      lambda w: {f"y_{h}": F.lead(target, h).over(w) for h in horizons},
                      ahead=max(horizons), size=size)


def fit_price(rows: DataFrame, features: Sequence[str], by: Sequence[str],
              horizons: Sequence[int] = HORIZONS, penalty: float = 0.0,
              min_rows: int = 72) -> DataFrame:
    """Ridge regression per group and horizon: rows ``(by, horizon, n, intercept, coefficients)``.

    Spark sums the products per group, so a group may be of any size; only those
    sums, one short row per group, reach the solver. Features are shifted by their
    overall mean first, which keeps the sums well conditioned.
    """
    features = list(features)
    d = len(features)
    columns = [F.col(c).cast("double").alias(c) for c in features]
    base = rows.select(*by, *columns, *[F.col(f"y_{h}").cast("double").alias(f"y_{h}") for h in horizons])
    base = base.dropna(subset=features)
    means = base.agg(*[F.avg(c) for c in features]).first()
    shift = [m if m is not None else 0.0 for m in means]
    moved = base.select(*by, *[(F.col(c) - F.lit(shift[k])).alias(f"_x{k}") for k, c in enumerate(features)],
                        F.inline(F.array(*[
                            F.struct(F.lit(h).alias("horizon"), F.col(f"y_{h}").alias("_y")) for h in horizons])))
    moved = moved.where(F.col("_y").isNotNull())
    sums = [F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_sy")]
    sums += [F.sum(f"_x{a}").alias(f"_s{a}") for a in range(d)]
    sums += [F.sum(F.col(f"_x{a}") * F.col("_y")).alias(f"_c{a}") for a in range(d)]
    sums += [F.sum(F.col(f"_x{a}") * F.col(f"_x{b}")).alias(f"_g{a}_{b}") for a in range(d) for b in range(a, d)]
    gram = moved.groupBy(*by, "horizon").agg(*sums).where(F.col("n") >= min_rows)
    groups = [*by, "horizon"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gram.select(*groups).schema.fields)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            n = float(row["n"])
            s = np.array([row[f"_s{a}"] for a in range(d)], dtype=float)
            c = np.array([row[f"_c{a}"] for a in range(d)], dtype=float) - s * row["_sy"] / n
            g = np.zeros((d, d))
            for a in range(d):
                for b in range(a, d):
                    g[a, b] = g[b, a] = row[f"_g{a}_{b}"] - s[a] * s[b] / n
            spread = np.sqrt(np.maximum(np.diag(g) / n, 0.0))
            unit = np.where(spread > 1e-12, spread, 1.0)
            system = g / np.outer(unit, unit) / n + penalty * np.eye(d)
            beta = np.linalg.lstsq(system, c / unit / n, rcond=1e-12)[0] / unit
            intercept = (row["_sy"] - s @ beta) / n - float(np.dot(beta, shift))
            out.append({**{k: row[k] for k in groups}, "n": int(n), "intercept": float(intercept),
                        "coefficients": beta.tolist()})
        return pd.DataFrame(out, columns=[*groups, "n", "intercept", "coefficients"])

    return gram.groupBy(*groups).applyInPandas(
        lambda pdf: solve(pdf), f"{kinds}, n bigint, intercept double, coefficients array<double>")


def predict_price(rows: DataFrame, models: DataFrame, features: Sequence[str], by: Sequence[str],
                  name: str = "y_hat") -> DataFrame:
    """Every row with every horizon its group has a model for. Spark picks the join."""
    joined = rows.join(models.select(*by, "horizon", "intercept", "coefficients"), list(by), "inner")
    terms = [F.col(c) * F.col("coefficients")[k] for k, c in enumerate(features)]
    return (joined.withColumn(name, sum(terms, F.col("intercept")))
            .drop("intercept", "coefficients"))


# Registry ---------------------------------------------------------------------------------------

REGISTRY = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("hub", T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("version", T.LongType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("scaler_mean", T.ArrayType(T.DoubleType())),
    T.StructField("scaler_std", T.ArrayType(T.DoubleType())),
    T.StructField("graph", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("target_mean", T.DoubleType()),
    T.StructField("target_std", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("weights_path", T.StringType()),
])


def registry_row(model_id: str, kind: str, version: int, hub: str | None = None,
                 horizon: int | None = None, scaler: Scaler | None = None, graph: Graph | None = None,
                 scale: TargetScale | None = None, threshold: float | None = None,
                 features: Sequence[str] | None = None, weights: Sequence[float] | None = None,
                 weights_path: str | None = None) -> tuple:
    names = list(features or (scaler.columns if scaler else []))
    return (model_id, kind, hub, horizon, version, names,
            [scaler.mean[c] for c in scaler.columns] if scaler else None,
            [scaler.std[c] for c in scaler.columns] if scaler else None,
            [[graph[i].get(j, 0.0) for j in names] for i in names] if graph else None,
            scale.mean if scale else None, scale.std if scale else None, threshold,
            list(weights) if weights is not None else None, weights_path)


def write_registry(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append rows; only rows whose weights are given are ever resolved."""
    spark.createDataFrame(list(rows), REGISTRY).coalesce(1).write.mode("append").parquet(path)


def registry_of(models: DataFrame, kind: str, version: int, hub: str,
                features: Sequence[str]) -> DataFrame:
    """Fitted group models as registry rows: sample size, intercept, coefficients."""
    given = {
        "model_id": F.concat_ws("_", F.lit(kind), F.col(hub), F.concat(F.col("horizon").cast("string"), F.lit("h"))),
        "kind": F.lit(kind), "hub": F.col(hub), "horizon": F.col("horizon"), "version": F.lit(version),
        "features": F.array(*[F.lit(c) for c in features]),
        "weights": F.concat(F.array(F.col("n").cast("double"), F.col("intercept")), F.col("coefficients"))}
    return models.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REGISTRY.fields])


def append_registry(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete row of each model."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REGISTRY)
    rows = spark.read.schema(REGISTRY).parquet(path)
    complete = rows.where(F.col("weights").isNotNull() | F.col("weights_path").isNotNull())
    rest = [c for c in rows.columns if c != "model_id"]
    return (complete.groupBy("model_id").agg(F.max_by(F.struct(*rest), "version").alias("_row"))
            .select("model_id", "_row.*"))


def save_model(model: GraphLoad | BoostedLoad | WindowLoad, folder: str, model_id: str, kind: str, version: int,
               hub: str | None = None, scaler: Scaler | None = None, graph: Graph | None = None) -> tuple:
    """Store a fitted model and return the registry row that finds it again."""
    if isinstance(model, WindowLoad):  # short enough for the row itself
        return registry_row(model_id, kind, version, hub, model.horizon, scaler, graph, model.scale,
                            weights=[model.sigma, model.intercept, *model.coefficients.tolist()],
                            features=None if scaler else model.features)
    path = f"{folder.rstrip('/')}/{model_id}-v{version}"
    model.model.write().overwrite().save(path)
    if isinstance(model, BoostedLoad):
        return registry_row(model_id, kind, version, hub, features=model.features, weights_path=path)
    return registry_row(model_id, kind, version, hub, model.horizon, scaler, graph, model.scale, weights_path=path)


def load_model(row: Mapping) -> GraphLoad | BoostedLoad | WindowLoad:
    """The model of a registry row: with weights of its own a window model on packed rows, with a target scale one of
    Spark's library, else boosted trees."""
    if row["weights"] and row["target_mean"] is not None:
        names = list(row["features"])
        names += [f"nb_{c}" for c in names] if row["graph"] else []
        scale = TargetScale(row["target_mean"], row["target_std"])
        return WindowLoad(names, scale, row["horizon"], row["weights"][1], np.array(row["weights"][2:]),
                          row["weights"][0], [], 0)
    if row["target_mean"] is None:
        return BoostedLoad(GBTRegressionModel.load(row["weights_path"]), list(row["features"]))
    scale = TargetScale(row["target_mean"], row["target_std"])
    return GraphLoad(LinearRegressionModel.load(row["weights_path"]), scale, row["horizon"])


def graph_of(row: Mapping) -> Graph:
    names = row["features"]
    return {i: dict(zip(names, weights)) for i, weights in zip(names, row["graph"])}


def forecast_latest(row: Mapping, rows: DataFrame, series: Sequence[str] = (), ties: Sequence[str] = (),
                    seq_len: int = SEQ_LEN) -> DataFrame:
    """The forecast of a stored window model from each series' newest rows: (series, window_ts, y_hat, horizon).

    Scaler, graph and target scale come with the registry row, so that nothing but the row
    and the newest ``seq_len`` rows is needed.
    """
    smooth, names = smoothed_features(rows, scaler_of(row), graph_of(row))
    windows = latest_window(smooth, names, series, seq_len=seq_len, ties=ties)
    return load_model(row).predict(windows).drop("x").withColumn("horizon", F.lit(row["horizon"]))


def scaler_of(row: Mapping) -> Scaler:
    return Scaler(dict(zip(row["features"], row["scaler_mean"])), dict(zip(row["features"], row["scaler_std"])))


def resolve_model(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Most specific model per request: hub and horizon, then horizon, then the default.

    Each request asks by three keys at once, so one join finds all candidates.
    """
    def key(kind, hub, horizon):
        return F.concat_ws("|", kind, F.coalesce(hub, F.lit("")), F.coalesce(horizon.cast("string"), F.lit("")))

    nothing, no_horizon = F.lit(None).cast("string"), F.lit(None).cast("int")
    kind, hub, horizon = F.col("kind"), F.col("hub"), F.col("horizon")
    asked = [key(kind, hub, horizon), key(kind, nothing, horizon), key(kind, nothing, no_horizon)]
    wanted = requests.select("kind", "hub", "horizon").distinct()
    candidates = wanted.select("*", F.posexplode(F.array(*asked)).alias("_rank", "_key"))
    models = registry.select(key(kind, hub, horizon).alias("_key"), "model_id")
    found = candidates.join(models, "_key", "left")
    best = F.min_by("model_id", F.when(F.col("model_id").isNotNull(), F.struct("_rank", "model_id")))
    return found.groupBy("kind", "hub", "horizon").agg(best.alias("model_id"))
