"""Rules, thresholds, reconstruction and isolation forest."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.operators import datasets as ds
from gridlens.operators import detect

T0 = dt.datetime(2024, 1, 1)
CONDITIONS = "ts timestamp, demand double, capacity double, wind double, solar double, freq double"


def _alerts(rows, *values):
    return {(r.alert_type, r.severity) for r in detect.condition_alerts(rows(CONDITIONS, *values)).collect()}


@pytest.mark.parametrize("demand, severity", [(90.0, None), (90.1, "warning"), (95.0, "warning"), (95.1, "critical")])
def test_capacity_bounds(rows, demand, severity):
    got = _alerts(rows, (T0, demand, 100.0, 1.0, 1.0, 60.0))
    assert got == ({("capacity_stress", severity)} if severity else set())


@pytest.mark.parametrize("freq, severity", [(59.95, None), (60.05, None), (59.949, "warning"), (60.11, "critical"),
                                            (59.85, "critical"), (None, None), (0.0, None)])
def test_frequency_bounds(rows, freq, severity):
    got = _alerts(rows, (T0, 10.0, 100.0, None, None, freq))
    assert got == ({("frequency_deviation", severity)} if severity else set())


@pytest.mark.parametrize("demand, capacity", [(0.0, 100.0), (100.0, 0.0), (None, 100.0), (100.0, None)])
def test_rules_need_demand_and_capacity(rows, demand, capacity):
    assert _alerts(rows, (T0, demand, capacity, 1.0, 1.0, 50.0)) == set()


def test_texts(rows):
    df = rows(CONDITIONS, (T0, 71_234.0, 75_000.0, 1234.0, None, 60.0612))
    got = {r.alert_type: (r.title, r.description) for r in detect.condition_alerts(df).collect()}
    assert got["capacity_stress"] == (
        "Grid Capacity Alert: 5.0% reserve",
        "Demand 71,234 MW vs Capacity 75,000 MW (95.0% utilization). Wind: 1,234 MW, Solar: 0 MW, Freq: 60.061 Hz")
    assert got["frequency_deviation"] == (
        "Frequency Deviation: 60.061 Hz",
        "Grid frequency at 60.061 Hz (nominal 60.000 Hz). Deviation: 61.2 mHz")


def test_snapshot(rows):
    df = rows(CONDITIONS, (T0, 71_234.0, 75_000.0, 1234.0, None, None), (T0, 10.0, 100.0, 1.0, 1.0, 60.0))
    stressed, normal = detect.condition_snapshot(df).orderBy(F.desc("capacity_mw")).collect()
    assert stressed.status == "high_stress" and stressed.nature == "reserve_ratio=0.950"
    assert stressed.facility_name == "Grid (demand=71234, capacity=75000, wind=1234, solar=0)"
    assert normal.status == "normal" and normal.nature == "reserve_ratio=0.100, freq=60.000"


def test_one_scan_for_all_rules(rows):
    plan = detect.condition_alerts(rows(CONDITIONS, (T0, 1.0, 1.0, 1.0, 1.0, 1.0)))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Scan") == 1


def test_flag_is_strict_and_saved_threshold_wins(rows):
    df = rows("window_ts timestamp, score double", *[(T0, float(i)) for i in range(101)], (T0, None))
    assert [r.score for r in detect.flag(df).where("is_anomaly").collect()] == [99.0, 100.0]
    flagged = detect.anomaly_severity(detect.flag(df, threshold=60.0))
    counts = {r.severity: r["count"] for r in flagged.groupBy("severity").count().collect()}
    assert counts == {"high": 10, "medium": 30, None: 62}
    events = detect.anomaly_events(flagged)
    assert events.count() == 40
    assert events.where("severity = 100").first().description == "Score 100.0 (high)"
    small = flagged.withColumns({"score": F.col("score") * 5e-6, "threshold": F.col("threshold") * 5e-6})
    assert {r.description for r in detect.anomaly_events(small).where("description LIKE '%high%'").collect()} == {"Score 0.0005 (high)"}
    text = detect.anomaly_events(flagged, training=True).where("severity = 100").first().description
    assert text == "Reconstruction error 100.0000 > threshold 60.0000"
    alert = detect.anomaly_alert(flagged).first()
    assert alert.title == "10 high-severity anomalies detected" and "Max score: 100.0000" in alert.description
    assert detect.anomaly_alert(detect.flag(df, threshold=1000.0)).count() == 0


def _waves(spark, n, broken=None):
    df = spark.range(n).select(
        (F.lit(T0) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
        F.sin(F.col("id") / 4).alias("a"), F.cos(F.col("id") / 4).alias("b"))
    return df if broken is None else df.withColumn("a", F.when(F.hour("ts") + F.dayofyear("ts") * 24 == broken, 9.0).otherwise(F.col("a")))


def test_reconstruction_finds_the_spoiled_row(spark):
    windows = ds.scoring_windows(_waves(spark, 300), ["a", "b"])
    model = detect.fit_reconstruction(windows, ks=(2, 4))
    spoiled = ds.scoring_windows(_waves(spark, 300, broken=100), ["a", "b"])
    scores = {r.window_ts: r.score for r in detect.reconstruction_score(spoiled, model).collect()}
    assert len(scores) == 300 - 23
    hit = T0 + dt.timedelta(hours=100 - 24)
    touched = {t for t in scores if hit <= t < hit + dt.timedelta(hours=24)}
    assert min(scores[t] for t in touched) > 100 * max(s for t, s in scores.items() if t not in touched)


def test_reconstruction_error_equals_numpy(spark):
    windows = ds.scoring_windows(_waves(spark, 120), ["a", "b"]).withColumn("x", F.transform(
        "x", lambda r: F.transform(r, lambda c: c * c + c)))
    model = detect.fit_reconstruction(windows, ks=(3,))
    rows = detect.reconstruction_score(windows, model).orderBy("window_ts").collect()
    flat = np.array([np.ravel(r.x) for r in windows.orderBy("window_ts").collect()])
    p = model.components
    centred = flat - model.mean
    want = ((centred - centred @ p @ p.T) ** 2).mean(axis=1)
    assert np.allclose([r.score for r in rows], want, atol=1e-10)


def test_reconstruction_needs_32_windows(spark):
    with pytest.raises(ValueError):
        detect.fit_reconstruction(ds.scoring_windows(_waves(spark, 40), ["a", "b"]))


@pytest.mark.parametrize("n, trees", [(600, 40), (6000, 10)])
def test_isolation_forest_flags_outliers(spark, n, trees):
    df = spark.range(n).select("id", *[F.when(F.col("id") < 5, 50.0 + F.col("id")).otherwise(
        F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000).alias(c) for k, c in enumerate("ab")])
    out = detect.isolation_forest(df, ["a", "b"], ["id"], contamination=0.02, trees=trees)
    flagged = out.where("label = -1")
    assert flagged.count() <= 0.02 * n + 1
    top = {r.id for r in out.orderBy(F.desc("score")).limit(5).collect()}
    assert top == {0, 1, 2, 3, 4}
    again = detect.isolation_forest(df.repartition(3), ["a", "b"], ["id"], contamination=0.02, trees=trees)
    assert again.exceptAll(out).isEmpty()


def test_overlay(rows):
    load = rows("ts timestamp, load_mw double", (T0, 1.0), (T0 + dt.timedelta(hours=1), 2.0))
    flags = load.where("load_mw > 1")
    got = detect.anomaly_overlay(load, {"a": flags, "b": load}).collect()
    assert sorted((r.method, r.load_mw) for r in got) == [("a", 2.0), ("b", 1.0), ("b", 2.0)]
