"""Feature frames, scaling, windows, graph and scalar edges."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlens import schemas
from gridlens.functions import scalars as fn
from gridlens.operators import aggregates
from gridlens.operators import datasets as ds
from gridlens.operators import evaluate as ev
from gridlens.operators import joins, reports, resample

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(0)
    load = 30_000 + rng.normal(0, 8_000, 400)
    load[rng.choice(400, 20, replace=False)] = 0.0
    load[5:9] = 0.0
    load[50:60] = 9_000.0
    pdf = pd.DataFrame({"ts": pd.date_range(START, periods=400, freq="h"), "load_mw": load,
                        "temperature_2m": rng.normal(20, 5, 400)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("size", [168, 100_000])
def test_load_features_equal_pandas(hourly, size):
    pdf, df = hourly
    want = pdf.set_index("ts").copy()
    want["load_mw"] = want["load_mw"].replace(0, np.nan).interpolate("linear")
    want = want[want["load_mw"] > 10_000]
    for k in (1, 24, 168):
        want[f"load_lag_{k}h"] = want["load_mw"].shift(k)
    for k in (6, 24):
        want[f"load_rolling_{k}h"] = want["load_mw"].rolling(k, min_periods=1).mean()
    want = want[want["load_mw"] > 20_000].dropna(subset=["load_lag_1h", "load_lag_24h"])
    got = ds.engineer_load(df, size=size).toPandas().set_index("ts").sort_index()
    assert len(got) == len(want)
    for c in want.columns:
        assert np.allclose(got[c], want[c], equal_nan=True), c
    assert set(schemas.LOAD_FEATURES) - set(got.columns) == {"wind_speed_10m", "direct_radiation"}


def test_scaler_constant_and_missing(rows):
    df = rows("a double, b double", (1.0, 7.0), (3.0, 7.0), (None, 7.0))
    scaler = ds.fit_scaler(df, ["a", "b"])
    assert scaler.mean == {"a": 2.0, "b": 7.0} and scaler.std == {"a": 1.0, "b": 1.0}
    assert [tuple(r) for r in scaler.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_scaler_reads_a_few_columns_at_a_time(rows, monkeypatch):
    df = rows("a double, b double, c double", (1.0, 7.0, None), (3.0, 7.5, 0.1), (None, 9.0, 0.2))
    whole, widths, agg = ds.fit_scaler(df, ["a", "b", "c"]), [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *aggs: widths.append(len(aggs)) or agg(self, *aggs))
    assert ds.fit_scaler(df, ["a", "b", "c"], at_once=2) == whole and widths == [4, 2]
    assert ds.fit_scaler(df, ["a", "b", "c"]) == whole and widths == [4, 2, 6]


def test_target_scale_of_a_constant(rows):
    scale = ds.fit_target(rows("y double", (5.0,), (5.0,)), "y")
    assert scale.std == 1e-6


@pytest.mark.parametrize("n, horizon, size", [(60, 1, 30), (60, 24, 50), (47, 24, 1000), (48, 24, 1000), (10, 1, 1000)])
def test_window_count_and_contents(spark, n, horizon, size):
    df = spark.range(n).select(F.col("id").alias("ts"), F.col("id").cast("double").alias("v"))
    out = ds.sliding_windows(df, ["v"], "v", horizon=horizon, size=max(size, 23 + horizon))
    got = out.orderBy("window_id").collect()
    assert len(got) == max(0, n - 24 - horizon + 1)
    for r in got:
        assert [c[0] for c in r.x] == [float(r.window_id + k) for k in range(24)]
        assert r.y == r.window_id + 23 + horizon and r.window_ts == r.window_id + 23
    if got:
        marked = ds.window_split(out)
        assert marked.where("is_train").count() == int(len(got) * 0.85)


def test_windows_skip_incomplete_rows(spark):
    df = spark.range(40).select(F.col("id").alias("ts"), F.when(F.col("id") != 10, F.col("id").cast("double")).alias("v"))
    assert ds.sliding_windows(df, ["v"], "v").count() == 39 - 24


def test_latest_window_needs_enough_rows(rows, spark):
    df = spark.range(60).select(F.when(F.col("id") < 40, "a").otherwise("b").alias("s"), F.col("id").alias("ts"),
                                F.col("id").cast("double").alias("v"))
    got = ds.latest_window(df, ["v"], ["s"]).collect()
    assert [(r.s, r.window_ts, r.x[0][0], len(r.x)) for r in got] == [("a", 39, 16.0, 24)]
    plan = ds.latest_window(df, ["v"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_window_of_equal_times_is_one_choice(rows):
    values = [(1, 10 + k, float(k)) for k in range(4)] + [(2, k, float(10 * k)) for k in (3, 1, 2)]
    for order in (values, values[::-1]):
        got = ds.latest_window(rows("ts int, id int, v double", *order), ["v"], seq_len=5, ties=["id"]).first()
        assert [r[0] for r in got.x] == [2.0, 3.0, 10.0, 20.0, 30.0]


def test_graph_invariants(views):
    columns = ["load_mw", "temperature_2m", "wind_speed_10m"]
    rows = views.readings.withColumn("flat", F.lit(1.0))
    graph = ds.collect_graph(ds.correlation_graph(rows, [*columns, "flat"]))
    expected = rows.select(*columns).toPandas().corr().abs()
    for i, row in graph.items():
        assert row[i] == 1.0 and len(row) == 4
        for j, w in row.items():
            assert 0.0 <= w <= 1.0 and w == graph[j][i]
            assert "flat" in (i, j) or w == pytest.approx(expected.loc[i, j], abs=1e-9)
    assert graph["flat"]["load_mw"] == 0.0


def test_corr_equals_pandas_and_guards_constants(views):
    rows = views.weather.withColumn("flat", F.lit(2.0)).withColumn(
        "holes", F.when(F.col("relative_humidity") > 70, F.col("temperature_2m")))
    columns = ["temperature_2m", "relative_humidity", "holes", "flat"]
    want = rows.select(*columns).toPandas().corr()
    for r in aggregates.corr_matrix(rows, columns).collect():
        expected = want.loc[r.i, r.j]
        assert (r.r is None and math.isnan(expected)) or r.r == pytest.approx(expected, abs=1e-9)


def test_trend_needs_more_than_ten_rows_and_a_spread(spark):
    df = spark.range(11).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"),
                                F.lit(1.0).alias("flat"))
    got = {r.x: r for r in aggregates.ols_trend(df, "y", ["x", "flat"]).collect()}
    assert got["x"].slope == pytest.approx(2.0) and got["x"].intercept == pytest.approx(1.0)
    assert got["flat"].slope is None
    assert aggregates.ols_trend(df.limit(10), "y", ["x"]).first().slope is None


def test_resample_matches_pandas(rows):
    data = [(START + dt.timedelta(minutes=m), v) for m, v in
            [(0, None), (10, 1.0), (59, 2.0), (61, None), (300, 5.0), (301, 6.0), (600, 7.0)]]
    want = pd.DataFrame(data, columns=["ts", "v"]).set_index("ts").resample("1h").first()
    df = rows("ts timestamp, v double", *data)
    got = resample.resample_first(df, ["v"]).toPandas().set_index("ts").sort_index()
    assert np.allclose(got["v"].astype(float), want["v"].astype(float), equal_nan=True) and len(got) == len(want)
    for size in (4, 1000):
        filled = resample.ffill_hourly(resample.resample_first(df, ["v"]), ["v"], size=size)
        filled = filled.toPandas().set_index("ts").sort_index()
        assert np.allclose(filled["v"].astype(float), want.ffill(limit=3)["v"].astype(float), equal_nan=True)
    assert [r.ts for r in resample.hour_spine(df).orderBy("ts").collect()] == list(want.index.to_pydatetime())


def test_outer_alignment_equals_stacked(rows):
    a = rows("ts int, a double", (1, 1.0), (2, 2.0))
    b = rows("ts int, b double", (2, 5.0), (3, 6.0))
    joined = joins.align_outer(a, b)
    stacked = resample.stack_aligned(a, b).groupBy("ts").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    assert joined.exceptAll(stacked).isEmpty() and joined.count() == 3
    assert joins.align_inner(a, b, a.where("ts > 9")).count() == 1


def test_hour_join_keeps_fan_out_and_null_zone(rows):
    load = rows("ts timestamp, load_mw double", (START, 1.0), (START.replace(minute=30), 2.0))
    weather = rows("ts timestamp, zone string, t double", (START, "houston", 1.0), (START.replace(minute=5), None, 2.0),
                   (START, "dallas", 3.0))
    assert joins.hour_join(load, weather).count() == 4


def test_calendar_and_cyclic(rows):
    got = fn.calendar(rows("ts timestamp", (dt.datetime(2024, 12, 30, 5),)), iso_week=True, date=True).first()
    assert (got.hour, got.day_of_week, got.month, got.is_weekend, got.week_of_year) == (5, 0, 12, 0, 1)
    sunday = fn.calendar(rows("ts timestamp", (dt.datetime(2024, 1, 7),))).first()
    assert (sunday.day_of_week, sunday.is_weekend) == (6, 1)


def test_sanitize_and_missing(rows):
    df = rows("v double", (1.0,), (None,), (float("nan"),), (float("inf"),), (-float("inf"),))
    assert [r[0] for r in df.select(fn.sanitize("v")).collect()] == [1.0, 0, 0, 0, 0]
    assert fn.above(df, "v", 0).count() == 2
    assert fn.drop_missing(df, ["v", "absent"]).count() == 3


def test_recent_is_strict(rows):
    df = rows("ts timestamp", (START,), (START + dt.timedelta(microseconds=1),))
    assert fn.recent(df, 1, "2024-01-02 00:00:00").count() == 1
    assert fn.date_range(df, "2024-01-01", "2024-01-01").count() == 1


def test_alert_ids_are_stable_and_keep_given(rows):
    df = rows("alert_id string, k int", ("given", 1), (None, 1), (None, 2))
    first, again = (fn.assign_alert_id(df, ["k"]).collect() for _ in range(2))
    assert first == again and first[0].alert_id == "given" and first[1].alert_id != first[2].alert_id


def test_severity_rank_of_unknown(rows):
    df = rows("severity string", ("critical",), ("warning",), ("info",), ("other",), (None,))
    assert [r[0] for r in df.select(fn.severity_rank()).collect()] == [3, 2, 1, 0, 0]


def test_errors(rows):
    df = rows("y double, y_hat double", (0.0, 1.0), (100.0, 90.0))
    got = df.agg(ev.mape().alias("a"), ev.mape_fraction().alias("b"), ev.mae().alias("c"), ev.mbe().alias("d"),
                 ev.huber(1.0).alias("e"), ev.mse().alias("f")).first()
    assert got.a == pytest.approx((1 / 1e-8 + 0.1) / 2 * 100)
    assert got.b > 1e15 and got.c == 5.5 and got.d == 4.5 and got.e == (0.5 + 9.5) / 2 and got.f == 50.5
    assert rows("m double", (1.0,), (-1.0,), (0.0,)).select(ev.bias_label(F.col("m"))).collect()[1][0] == "over-predicts"


def test_reports(rows):
    df = rows("model_name string, ts int, v double", ("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0))
    got = {r.model_name: r.v for r in reports.compare_models(df, ["a", "c"]).collect()}
    assert got == {"a": 2.0, "c": None}
    assert [r.ts for r in reports.oldest_top(df, 2, ties=["model_name"]).collect()] == [1, 1]


def test_seasonal_and_renewable_names(hourly):
    _, df = hourly
    engineered = ds.engineer_load(df)
    assert set(schemas.SEASONAL_FEATURES) <= set(ds.engineer_seasonal(engineered).columns)
    raw = df.withColumns({"wind_speed_10m": F.lit(3.0) + F.hour("ts"), "direct_radiation": F.lit(1.0) + F.hour("ts")})
    assert set(schemas.RENEWABLE_FEATURES) <= set(ds.engineer_renewable(raw).columns)
    priced = raw.withColumn("price_usd_mwh", F.col("load_mw") / 1000)
    assert set(schemas.PRICE_FEATURES) <= set(ds.engineer_price(priced).columns)
    assert set(schemas.TREE_FEATURES) - {"grid_stress"} <= set(ds.engineer_load(raw).columns)
