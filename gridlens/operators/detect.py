"""Anomaly detection and grid rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.scalars import capacity_text, frequency_text, or_zero
from gridlens.operators import blocks
from gridlens.operators.blocks import over_windows
from gridlens.operators.ordered import exact_percentile
from gridlens.session import materialise

THRESHOLD_PERCENT = 98.0
HIGH_FACTOR = 1.5
CAPACITY_ALERT = 0.90
CAPACITY_CRITICAL = 0.95
FREQ_LOW, FREQ_HIGH, FREQ_NOMINAL, FREQ_WARNING = 59.95, 60.05, 60.0, 0.1
MIN_WINDOWS = 32
HOLD_OUT = 0.12
HOLD_OUT_ROWS = 8

# Texts of events, of the alert on a run, and of snapshots.
TRAINING_TEXT = "Reconstruction error %.4f > threshold %.4f"
SCORE_TEXT = "Score %s (%s)"
RUN_TITLE = "%d high-severity anomalies detected"
RUN_TEXT = "Reconstruction error exceeded 1.5x threshold for %d windows. Max score: %.4f"
FACILITY_TEXT = "%s (demand=%.0f, capacity=%.0f, wind=%.0f, solar=%.0f)"
NATURE_TEXT = "reserve_ratio=%.3f"
NATURE_FREQ_TEXT = "reserve_ratio=%.3f, freq=%.3f"


# Reconstruction error ---------------------------------------------------------------

@dataclass(frozen=True)
class Reconstruction:
    """Linear encoder and decoder of flattened windows; its size is that of a window."""

    mean: np.ndarray
    components: np.ndarray
    hold_out_error: dict[int, float]

    @property
    def k(self) -> int:
        return self.components.shape[1]


def _flat(windows: DataFrame) -> DataFrame:
    return windows.withColumn("_flat", F.flatten("x"))


def _errors(mean: np.ndarray, components: np.ndarray, ks: Sequence[int]):
    """Vectorised squared error per window for each number of components."""
    @F.pandas_udf("array<double>")
    def errors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for flat in batches:
            if not len(flat):
                yield pd.Series([], dtype=object)
                continue
            centred = np.stack(flat.to_numpy()) - mean
            kept = np.cumsum((centred @ components) ** 2, axis=1)
            whole = (centred ** 2).sum(axis=1)
            out = np.stack([whole - kept[:, k - 1] for k in ks], axis=1) / mean.size
            yield pd.Series(list(np.maximum(out, 0.0)))
    return errors


def fit_reconstruction(windows: DataFrame, key: Sequence[str] = ("window_ts",),
                       ks: Sequence[int] = (4, 8, 16), tolerance: float = 1.05,
                       hold_out: float = HOLD_OUT) -> Reconstruction:
    """Principal components of the windows; a hold-out chosen by key hash picks how many.

    The smallest candidate within ``tolerance`` of the best hold-out error is taken.
    """
    n = windows.count()
    if n < MIN_WINDOWS:
        raise ValueError(f"need at least {MIN_WINDOWS} windows, got {n}")
    share = max(hold_out, HOLD_OUT_ROWS / n)
    flat = _flat(windows).withColumn("_out", F.pmod(F.xxhash64(*key), F.lit(1_000_000)) < int(share * 1_000_000))
    vectors = flat.withColumn("_vec", array_to_vector("_flat"))
    train = vectors.where(~F.col("_out")).select("_vec")
    mean = train.select(Summarizer.mean(F.col("_vec"))).first()[0].toArray()
    ks = sorted({min(k, mean.size) for k in ks})
    model = PCA(k=ks[-1], inputCol="_vec", outputCol="_z").fit(train)
    components = model.pc.toArray()
    held = flat.where("_out").select(_errors(mean, components, ks)("_flat").alias("_e"))
    row = held.agg(*[F.avg(F.col("_e")[i]) for i in range(len(ks))]).first()
    found = {k: row[i] if row[i] is not None else float("inf") for i, k in enumerate(ks)}
    best = min(found.values())
    chosen = next(k for k in ks if found[k] <= best * tolerance or found[k] == best)
    return Reconstruction(mean, components[:, :chosen], found)


def hold_out_draw(key: Sequence[str]) -> Column:
    """A number below a million that decides, by the row's key alone, whether its window is held out."""
    return F.pmod(F.xxhash64(*key), F.lit(1_000_000)).cast("double")


def fit_reconstruction_blocks(packed: blocks.Blocks, features: Sequence[str], draw: str, ks: Sequence[int] = (4, 8, 16),
                              tolerance: float = 1.05, hold_out: float = HOLD_OUT) -> Reconstruction:
    """As `fit_reconstruction`, from packed rows: windows end at the row whose ``draw`` holds them out or not.

    Products of all windows come from rows a lag apart, those of the windows held out are taken off.
    """
    length, at, by = packed.seq_len, packed.at(features), packed.columns.index(draw)
    wide = length * len(at)
    sums = blocks.pooled(packed, features, None, [0])[0]
    if sums.n < MIN_WINDOWS:
        raise ValueError(f"need at least {MIN_WINDOWS} windows, got {sums.n}")
    limit = int(max(hold_out, HOLD_OUT_ROWS / sums.n) * 1_000_000)
    moved = np.tile(sums.moved[: len(at)], length)

    def held(b: blocks.Block) -> np.ndarray:
        place = np.arange(max(b.home, length - 1), len(b.z))
        return place[b.z[place, by] < limit]

    def flat(b: blocks.Block, place: np.ndarray) -> np.ndarray:
        return b.z[:, at][place[:, None] + np.arange(1 - length, 1)].reshape(len(place), wide)

    def products(b: blocks.Block) -> np.ndarray:
        out = np.zeros((wide + 1, wide + 1))
        place = held(b)
        for some in np.array_split(place, len(place) // 1024 + 1):
            x = np.column_stack([np.ones(len(some)), flat(b, some) - moved])
            out += x.T @ x
        return out

    off = blocks.total_matrix(packed, products, wide + 1)
    n = sums.n - off[0, 0]
    column = sums.column - off[0, 1:]
    mean = moved + column / n
    covariance = (sums.product - off[1:, 1:] - np.outer(column, column) / n) / max(n - 1, 1)
    ks = sorted({min(k, wide) for k in ks})
    components = np.linalg.eigh(covariance)[1][:, ::-1][:, : ks[-1]]
    errors = _block_errors(length, at, mean, components, ks)

    def held_errors(b: blocks.Block) -> np.ndarray:
        place, values = errors(b)
        out = b.z[place, by] < limit
        return np.concatenate([[out.sum()], values[out].sum(0)])

    found = blocks.total(packed, held_errors)
    by_k = {k: float(found[1 + i] / found[0]) if found[0] else float("inf") for i, k in enumerate(ks)}
    best = min(by_k.values())
    chosen = next(k for k in ks if by_k[k] <= best * tolerance or by_k[k] == best)
    return Reconstruction(mean, components[:, :chosen], by_k)


def _block_errors(length: int, at: Sequence[int], mean: np.ndarray, components: np.ndarray, ks: Sequence[int]):
    """Places of a block's windows and their mean squared errors for each number of components."""
    by_row = mean.reshape(length, len(at))
    weights = components.reshape(length, len(at), -1)

    def errors(b: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
        place, seen = over_windows(b, at, weights, length)
        whole = np.zeros(len(place))
        if len(place):
            z = b.z[:, at]
            for t in range(length):
                rows = place[0] + 1 - length + t
                whole += ((z[rows : rows + len(place)] - by_row[t]) ** 2).sum(1)
        kept = np.cumsum((seen - mean @ components) ** 2, axis=1)
        out = np.stack([whole - kept[:, k - 1] for k in ks], 1) / mean.size
        return place, np.maximum(out, 0.0)
    return errors


def reconstruction_score_blocks(packed: blocks.Blocks, features: Sequence[str], model: Reconstruction,
                                only: str | None = None) -> DataFrame:
    """Mean squared error of every window, stamped with the order columns of its last row; with ``only`` of those
    whose last row is not 0 there."""
    errors = _block_errors(packed.seq_len, packed.at(features), model.mean, model.components, [model.k])
    wanted = packed.columns.index(only) if only else None

    def of_block(b: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
        place, values = errors(b)
        if wanted is not None:
            picked = b.z[place, wanted] != 0
            place, values = place[picked], values[picked]
        return place, values[:, 0]
    return blocks.score(packed, of_block, "score")


def reconstruction_score(windows: DataFrame, model: Reconstruction) -> DataFrame:
    """Mean squared error per window, stamped with the window's last row."""
    errors = _errors(model.mean, model.components, [model.k])
    return (_flat(windows).withColumn("score", errors("_flat")[0])
            .drop("_flat", "x"))


def flag(scores: DataFrame, threshold: float | None = None, percent: float = THRESHOLD_PERCENT,
         score: str = "score") -> DataFrame:
    """Strictly above the saved threshold, or above the batch percentile without one.

    The percentile takes several passes, so scores without a threshold are written first and
    computed once, however dear they are.
    """
    if threshold is None:
        scores = materialise(scores, "scores")
    limit = threshold if threshold is not None else exact_percentile(scores, score, percent / 100)
    return scores.withColumns({
        "threshold": F.lit(limit).cast("double"),
        "is_anomaly": F.coalesce(F.col(score) > F.lit(limit).cast("double"), F.lit(False))})


def anomaly_severity(flagged: DataFrame, score: str = "score") -> DataFrame:
    return flagged.withColumn("severity", F.when(
        F.col("is_anomaly"),
        F.when(F.col(score) > F.col("threshold") * HIGH_FACTOR, "high").otherwise("medium")))


def _plain_decimal(value: Column) -> Column:
    """A number rounded to four places without trailing zeros but the first place, never in powers of ten."""
    return F.regexp_replace(F.format_string("%.4f", value), r"(\.\d+?)0+$", "$1")


def anomaly_events(flagged: DataFrame, ts: str = "window_ts", score: str = "score",
                   training: bool = False) -> DataFrame:
    """Event rows for flagged windows, ready for the store."""
    if training:
        text = F.format_string(TRAINING_TEXT, F.col(score), F.col("threshold"))
        value = F.col(score)
    else:
        value = F.round(score, 4)
        text = F.format_string(SCORE_TEXT, _plain_decimal(value), F.col("severity"))
    rows = anomaly_severity(flagged, score) if "severity" not in flagged.columns else flagged
    return rows.where("is_anomaly").select(
        F.col(ts).alias("ts"), F.col(ts).alias("detected_at"),
        F.lit("reconstruction").alias("anomaly_type"), value.alias("severity"), text.alias("description"))


def anomaly_alert(flagged: DataFrame, ts: str = "window_ts", score: str = "score") -> DataFrame:
    """One warning for the whole run when any window is of high severity."""
    rows = anomaly_severity(flagged, score) if "severity" not in flagged.columns else flagged
    run = rows.where(F.col("severity") == "high").agg(
        F.count(F.lit(1)).alias("_n"), F.max(score).alias("_max"), F.max(ts).alias("ts")).where("_n > 0")
    return run.select(
        "ts", F.lit("anomaly_detection").alias("alert_type"), F.lit("warning").alias("severity"),
        F.format_string(RUN_TITLE, "_n").alias("title"),
        F.format_string(RUN_TEXT, "_n", "_max").alias("description"),
        F.lit(False).alias("acknowledged"), F.lit("anomaly_detector").alias("source"))


def anomaly_overlay(series: DataFrame, flags: dict[str, DataFrame], ts: str = "ts",
                    value: str = "load_mw") -> DataFrame:
    """Flagged rows of each method with the series' value at that time."""
    out = None
    base = series.select(ts, value)
    for method, rows in flags.items():
        part = base.join(rows.select(ts), ts, "left_semi").withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return out


# Isolation forest -----------------------------------------------------------------------

EULER_GAMMA = 0.5772156649015329


def _path_norm(n):
    """Mean depth of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _grow(points: np.ndarray, rng: np.random.RandomState, limit: int) -> dict[str, list]:
    """One random tree as parallel arrays; a leaf has feature -1 and its path length."""
    tree: dict[str, list] = {"feature": [], "split": [], "left": [], "right": [], "depth": []}
    pending = [(points, 0, None, None)]
    while pending:
        rows, depth, parent, side = pending.pop()
        here = len(tree["feature"])
        if parent is not None:
            tree[side][parent] = here
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        leaf = depth >= limit or len(rows) <= 1 or not len(varying)
        column = -1 if leaf else int(rng.choice(varying))
        cut = 0.0 if leaf else float(rng.uniform(low[column], high[column]))
        for name, value in (("feature", column), ("split", cut), ("left", -1), ("right", -1),
                            ("depth", float(depth + _path_norm(len(rows))) if leaf else 0.0)):
            tree[name].append(value)
        if not leaf:
            goes_left = rows[:, column] <= cut
            pending.append((rows[goes_left], depth + 1, here, "left"))
            pending.append((rows[~goes_left], depth + 1, here, "right"))
    return tree


@dataclass(frozen=True)
class IsolationForest:
    """Trees as arrays: at most ``trees`` x 2 x ``sample`` nodes, whatever the data size."""

    features: list[str]
    trees: list[dict[str, np.ndarray]]
    sample: int


def fit_isolation_forest(df: DataFrame, features: Sequence[str], key: Sequence[str],
                         trees: int = 100, sample: int = 256, seed: int = 42) -> IsolationForest:
    """Each tree is grown from ``sample`` rows, a parameter of the method, picked by a hash
    of tree and key; one task per tree.

    A row goes to a tree if that hash is under a bound, which lets about ``2 * sample``
    rows of each tree through to the shuffle, however many there are. Of these the
    ``sample`` of least hash are taken, so the draw is the same rule for any table.
    """
    rows = df.select(*key, *[F.col(c).cast("double").alias(c) for c in features]).dropna()
    n = rows.count()
    if n == 0:
        raise ValueError("no complete rows to fit on")
    size = min(sample, n)
    share = min(1.0, (2.0 * sample + 64.0) / n)
    span = 1 << 40
    own = F.xxhash64(F.lit(seed), *key)
    draws = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"), F.pmod(F.xxhash64(t, own), F.lit(span)).alias("_draw")))
    chosen = F.filter(draws, lambda d: d["_draw"] < int(share * span))
    order = Window.partitionBy("tree").orderBy("_draw", *key)
    picked = (rows.select("*", F.inline(chosen)).withColumn("_k", F.row_number().over(order))
              .where(F.col("_k") <= size).select("tree", *features))
    limit = int(np.ceil(np.log2(max(size, 2))))
    names = list(features)

    def grow(key_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf[names].sort_values(names).to_numpy()
        made = _grow(points, np.random.RandomState(seed + int(key_[0])), limit)
        return pd.DataFrame({"tree": [int(key_[0])], **{k: [v] for k, v in made.items()}})

    grown = picked.groupBy("tree").applyInPandas(
        grow, "tree int, feature array<int>, split array<double>, left array<int>, "
              "right array<int>, depth array<double>")
    made = [{k: np.asarray(row[k]) for k in ("feature", "split", "left", "right", "depth")}
            for row in sorted(grown.collect(), key=lambda r: r["tree"])]
    return IsolationForest(names, made, size)


def isolation_score(df: DataFrame, model: IsolationForest) -> DataFrame:
    """Anomaly score in (0, 1); higher is more isolated."""
    trees, norm = model.trees, float(_path_norm(model.sample)) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            total = np.zeros(len(points))
            for tree in trees:
                node = np.zeros(len(points), dtype=int)
                inner = tree["feature"][node] >= 0
                while inner.any():
                    at = node[inner]
                    value = points[inner, tree["feature"][at]]
                    node[inner] = np.where(value <= tree["split"][at], tree["left"][at], tree["right"][at])
                    inner = tree["feature"][node] >= 0
                total += tree["depth"][node]
            yield pd.Series(2.0 ** (-(total / len(trees)) / norm))

    complete = df.dropna(subset=model.features)
    return complete.withColumn("score", score(*[F.col(c).cast("double") for c in model.features]))


def isolation_forest(df: DataFrame, features: Sequence[str], key: Sequence[str],
                     contamination: float = 0.02, trees: int = 100, sample: int = 256,
                     seed: int = 42) -> DataFrame:
    """Label -1 for the most isolated share of rows, 1 for the rest."""
    model = fit_isolation_forest(df, features, key, trees, sample, seed)
    return isolation_labels(isolation_score(df, model), contamination)


def isolation_labels(scored: DataFrame, contamination: float = 0.02) -> DataFrame:
    """``scored`` rows, written once for the passes of the percentile, with ``label``."""
    scored = materialise(scored, "isolation")
    cut = exact_percentile(scored, "score", 1.0 - contamination)
    return scored.withColumn("label", F.when(F.col("score") > F.lit(cut), F.lit(-1)).otherwise(F.lit(1)))


# Rules on system conditions -----------------------------------------------------------------

def _usable() -> Column:
    return F.coalesce((F.col("demand") != 0) & (F.col("capacity") != 0), F.lit(False))


def _capacity_alert(threshold: float) -> Column:
    ratio = F.col("ratio")
    title, text = capacity_text()
    level = F.when(ratio > CAPACITY_CRITICAL, "critical").otherwise("warning")
    return F.when(ratio > threshold, _alert("capacity_stress", level, title, text))


def _frequency_alert() -> Column:
    freq = F.col("freq")
    title, text = frequency_text(FREQ_NOMINAL)
    level = F.when(F.abs(freq - FREQ_NOMINAL) < FREQ_WARNING, "warning").otherwise("critical")
    off = (freq != 0) & ((freq < FREQ_LOW) | (freq > FREQ_HIGH))
    return F.when(off, _alert("frequency_deviation", level, title, text))


def _alert(kind: str, level: Column, title: Column, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("alert_type"), level.alias("severity"),
                    title.alias("title"), text.alias("description"))


def _raise_alerts(conditions: DataFrame, rules: Sequence[Column], source: str) -> DataFrame:
    """All rules in one pass; texts are made only where a rule holds."""
    rated = conditions.where(_usable()).withColumn("ratio", F.col("demand") / F.col("capacity"))
    raised = F.filter(F.array(*rules), lambda alert: alert.isNotNull())
    return (rated.select(*_keys(conditions), F.inline(raised))
            .withColumns({"acknowledged": F.lit(False), "source": F.lit(source)}))


def capacity_rule(conditions: DataFrame, threshold: float = CAPACITY_ALERT,
                  source: str = "system_conditions") -> DataFrame:
    """An alert per snapshot whose demand comes too close to capacity."""
    return _raise_alerts(conditions, [_capacity_alert(threshold)], source)


def frequency_rule(conditions: DataFrame, source: str = "system_conditions") -> DataFrame:
    """An alert per snapshot with demand and capacity known and frequency off its band."""
    return _raise_alerts(conditions, [_frequency_alert()], source)


def condition_alerts(conditions: DataFrame, threshold: float = CAPACITY_ALERT,
                     source: str = "system_conditions") -> DataFrame:
    return _raise_alerts(conditions, [_capacity_alert(threshold), _frequency_alert()], source)


def _keys(conditions: DataFrame) -> list[str]:
    return [c for c in ("ts", "event_id", "page_id") if c in conditions.columns]


def condition_snapshot(conditions: DataFrame, threshold: float = CAPACITY_ALERT,
                       label: str = "Grid") -> DataFrame:
    """Reserve, load ratio and stress status of every usable snapshot."""
    rated = conditions.where(_usable()).withColumn(
        "ratio", F.when(F.col("capacity") > 0, F.col("demand") / F.col("capacity")).otherwise(F.lit(0.0)))

    facility = F.format_string(
        FACILITY_TEXT, F.lit(label), *[c.cast("double") for c in (F.col("demand"), F.col("capacity"), or_zero("wind"),
                                                                  or_zero("solar"))])
    nature = F.when(F.coalesce(F.col("freq"), F.lit(0.0)) != 0, F.format_string(NATURE_FREQ_TEXT, "ratio", "freq")).otherwise(
        F.format_string(NATURE_TEXT, "ratio"))
    return rated.select(
        *_keys(conditions), F.lit("system_snapshot").alias("outage_type"), facility.alias("facility_name"),
        (F.col("capacity") - F.col("demand")).alias("capacity_mw"),
        nature.alias("nature"),
        F.when(F.col("ratio") > threshold, "high_stress").otherwise("normal").alias("status"),
        F.col("ts").alias("start_time"))
