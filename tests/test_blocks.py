"""Window models on packed rows against the same models on windows written out."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridlens.operators import blocks, detect, forecast
from gridlens.operators import datasets as ds
from gridlens.session import scratch_path


@pytest.fixture(scope="module")
def hubs(spark):
    """Three series of unlike length: one of several blocks, one of few rows, one shorter than a window."""
    return spark.range(700).select(
        F.when(F.col("id") % 7 == 0, "few").when(F.col("id") < 6, "short").otherwise("many").alias("hub"),
        F.col("id").alias("ts"), (F.col("id") % 3).cast("int").alias("k"),
        (F.sin(F.col("id") / 7) * 30 + F.pmod(F.xxhash64("id"), F.lit(97)) / 10 + 50).alias("p"),
        (F.cos(F.col("id") / 11) * 2e4 + 5e4).alias("load"), F.lit(4.0).alias("flat"),
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)).cast("double").alias("draw")).cache()


FEATURES = ["p", "load", "flat"]


def _matrix(df, features, target, seq_len, horizon, ratio=1.0):
    """Windows of one series as numpy, by their plain definition."""
    part = df.toPandas().sort_values(["ts", "k"])
    x, y = part[features].to_numpy(), part[target].to_numpy()
    n = int(np.floor(max(0, len(part) - seq_len + 1 - horizon) * ratio))
    rows = np.array([x[i : i + seq_len].ravel() for i in range(n)])
    return rows, np.array([y[i + seq_len - 1 + horizon] for i in range(n)]), part


@pytest.mark.parametrize("size", [60, 100, 5000])
@pytest.mark.parametrize("ratio", [1.0, 0.85])
def test_sums_equal_those_of_all_windows(hubs, size, ratio):
    packed = blocks.pack(hubs, FEATURES, ["hub"], ["ts", "k"], horizon=24, size=size)
    sums, moved = blocks.window_sums(packed, FEATURES, "p", [1, 24], ratio)
    parts = {}
    for r in sums.collect():
        parts.setdefault((r["hub"], r["horizon"]), {})[r["_kind"], r["_i"]] = np.array(r["_v"])
    assert {h for h, _ in parts} == {"many", "few"}
    for (hub, horizon), own in parts.items():
        got = blocks.assemble(own, 24, moved)
        x, y, _ = _matrix(hubs.where(F.col("hub") == hub), FEATURES, "p", 24, horizon, ratio)
        x, y = x - np.tile(moved[:3], 24), y - moved[3]
        assert got.n == len(x)
        assert np.allclose(got.product, x.T @ x, rtol=1e-9, atol=1e-3)
        assert np.allclose(got.column, x.sum(0), rtol=1e-9, atol=1e-5)
        assert np.allclose(got.cross, x.T @ y, rtol=1e-9, atol=1e-4) and got.target == pytest.approx(y.sum(), abs=1e-7)


def test_ridge_and_forecasts_equal_numpy(hubs):
    packed = blocks.pack(hubs, FEATURES, ["hub"], ["ts", "k"], horizon=24, size=64)
    models = blocks.fit_ridge(packed, FEATURES, "p", [1, 24], ratio=0.85).cache()
    got = blocks.predict(packed, FEATURES, models).toPandas()
    assert sorted((m.hub, m.horizon) for m in models.collect()) == [("few", 24)][:0] + [
        (h, n) for h in ("many",) for n in (1, 24)]
    for m in models.collect():
        x, y, part = _matrix(hubs.where(F.col("hub") == m.hub), FEATURES, "p", 24, m.horizon, 0.85)
        spread = x.std(axis=0)
        unit = np.where(spread > 1e-9, spread, 1.0)
        z = (x - x.mean(axis=0)) / unit
        beta = np.linalg.solve(z.T @ z / len(z) + 1e-4 * np.eye(72), z.T @ (y - y.mean()) / len(z))
        assert m.n == len(x) and np.allclose(np.array(m.coefficients) * unit, beta, atol=1e-6)
        every = np.array([part[FEATURES].to_numpy()[i : i + 24].ravel() for i in range(len(part) - 23)])
        mine = got[(got["hub"] == m.hub) & (got["horizon"] == m.horizon)].sort_values(["window_ts", "k"])
        assert np.allclose(mine["y_hat"], (every - x.mean(axis=0)) / unit @ beta + y.mean(), atol=1e-6)
        assert mine["window_ts"].tolist() == part["ts"].tolist()[23:]


def test_no_rows_and_short_series_have_no_model_but_columns(hubs):
    for rows in (hubs.limit(0), hubs.where("hub = 'short'")):
        packed = blocks.pack(rows, FEATURES, ["hub"], ["ts", "k"], horizon=24)
        models = blocks.fit_ridge(packed, FEATURES, "p", [1, 24])
        assert models.count() == 0 and models.columns == ["hub", "horizon", "n", "intercept", "coefficients"]
        assert blocks.predict(packed, FEATURES, models).count() == 0
    with pytest.raises(ValueError):
        blocks.predict(blocks.pack(hubs, FEATURES, [], ["ts", "k"]), FEATURES, models)


def test_rows_with_a_missing_cell_are_left_out(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float("nan") if i == 5 else float(i)) for i in range(9)], "ts int, v double")
    packed = blocks.pack(df, ["v"], seq_len=2, size=4)
    scored = blocks.score(packed, lambda b: (np.arange(b.home, len(b.z)), b.z[b.home :, 0]), "v")
    assert sorted((r.window_ts, r.v) for r in scored.collect()) == [(i, float(i)) for i in (0, 1, 2, 4, 6, 7, 8)]


def test_no_plan_holds_a_window(hubs):
    packed = blocks.pack(hubs, FEATURES, ["hub"], ["ts", "k"], horizon=24, size=100)
    stored = packed.table.selectExpr("sum(length(_z)) AS b").first()["b"]
    rows = hubs.count() * len(FEATURES) * 8
    assert stored <= rows * (1 + 47 / 100) + 47 * 8 * len(FEATURES) * 3
    assert "collect_list" not in packed.table._jdf.queryExecution().toString()


@pytest.mark.parametrize("size", [64, 4096])
def test_robust_fit_agrees_with_the_library(spark, size):
    noise = F.pmod(F.xxhash64("id"), F.lit(1009)) / 1009 - 0.5
    spike = F.when(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(20)) == 0, 8.0).otherwise(0.0)
    df = spark.range(800).select(F.col("id").alias("ts"), (F.sin(F.col("id") / 5) * 3 + noise + spike).alias("v"),
                                 (F.cos(F.col("id") / 9) + F.pmod(F.xxhash64("id", F.lit(8)), F.lit(101)) / 101).alias("t"))
    packed = blocks.pack(df, ["v", "t"], seq_len=3, horizon=1, size=size)
    ours = forecast.fit_window_load(packed, ["v", "t"], "v", 1, penalty=1e-4, patience=None, rounds=200)
    windows = ds.window_split(ds.sliding_windows(df, ["v", "t"], "v", seq_len=3, horizon=1)).where("is_train")
    given = windows.select(array_to_vector(F.flatten("x")).alias("x"), ours.scale.scaled("y").alias("y"))
    theirs = LinearRegression(featuresCol="x", labelCol="y", loss="huber", epsilon=1.35, regParam=1e-4, maxIter=500,
                              tol=1e-12).fit(given)
    assert np.allclose(ours.coefficients / ours.scale.std, theirs.coefficients.toArray(), atol=2e-4)
    assert (ours.intercept - ours.scale.mean) / ours.scale.std == pytest.approx(theirs.intercept, abs=2e-4)
    assert ours.sigma == pytest.approx(theirs.scale, abs=2e-4)


def test_fit_stops_when_the_later_windows_stop_gaining(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(1009)) / 100).alias("v"))
    packed = blocks.pack(df, ["v"], seq_len=2, horizon=1)
    model = forecast.fit_window_load(packed, ["v"], "v", 1, patience=2, rounds=40)
    assert 1 <= len(model.errors) < 40 and model.errors[model.best] == min(model.errors)


def test_a_packed_model_is_stored_in_its_registry_row(spark):
    df = spark.range(300).select(F.col("id").alias("ts"), (F.sin(F.col("id") / 5) * 10 + 50).alias("load_mw"),
                                 F.cos(F.col("id") / 5).alias("t"))
    scaler = ds.fit_scaler(df, ["load_mw", "t"])
    graph = ds.collect_graph(ds.correlation_graph(df, ["load_mw", "t"]))
    smooth, names = forecast.smoothed_features(df.withColumn("target", F.col("load_mw")), scaler, graph)
    packed = blocks.pack(smooth, [*names, "target"], horizon=1)
    model = forecast.fit_window_load(packed, names, "target", 1)
    path = scratch_path(spark, "registry")
    forecast.write_registry(spark, path, [forecast.save_model(model, path, "load_1h", "load", 1, scaler=scaler, graph=graph)])
    row = forecast.read_registry(spark, path).first()
    got = forecast.forecast_latest(row, df).first()
    assert got.y_hat == pytest.approx(np.sin(300 / 5) * 10 + 50, abs=0.5) and got.horizon == 1
    errors = forecast.window_forecasts(packed, model, "target").where("NOT is_train")
    assert errors.agg(F.max(F.abs(F.col("y") - F.col("y_hat")))).first()[0] < 0.5


def test_reconstruction_equals_the_one_on_windows(hubs):
    rows = hubs.where("hub = 'many'")
    packed = blocks.pack(rows, ["p", "load", "draw"], [], ["ts", "k"], size=77)
    model = detect.fit_reconstruction_blocks(packed, ["p", "load"], "draw", ks=(2, 5))
    x, _, part = _matrix(rows, ["p", "load"], "p", 24, 0)
    out = part["draw"].to_numpy()[23:] < int(max(0.12, 8 / len(x)) * 1_000_000)
    train = x[~out]
    mean = train.mean(axis=0)
    vectors = np.linalg.svd(train - mean, full_matrices=False)[2].T
    centred = x - mean
    for k in (2, 5):
        p = vectors[:, :k]
        error = ((centred - centred @ p @ p.T) ** 2).mean(axis=1)
        assert model.hold_out_error[k] == pytest.approx(error[out].mean(), rel=1e-6)
    p = vectors[:, : model.k]
    want = ((centred - centred @ p @ p.T) ** 2).mean(axis=1)
    got = detect.reconstruction_score_blocks(packed, ["p", "load"], model).toPandas().sort_values(["window_ts", "k"])
    assert np.allclose(got["score"], want, rtol=1e-6, atol=1e-6) and got["window_ts"].tolist() == part["ts"].tolist()[23:]
    by_hub = blocks.pack(hubs, ["p", "load", "draw"], ["hub"], ["ts", "k"], size=77)
    assert detect.fit_reconstruction_blocks(by_hub, ["p", "load"], "draw", ks=(2,)).k == 2
    with pytest.raises(ValueError):
        detect.fit_reconstruction_blocks(blocks.pack(rows.limit(40), ["p", "draw"], [], ["ts", "k"]), ["p"], "draw")
