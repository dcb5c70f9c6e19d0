"""Streaming jobs against the batch operators, with late, replayed and restarted input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens import schemas
from gridlens.functions import scalars as fn
from gridlens.operators import aggregates, blocks, detect
from gridlens.operators import datasets as ds
from gridlens.plans import queries as q
from gridlens.session import scratch_path
from gridlens.sources import store
from gridlens.streaming import jobs

PRICES = "ts timestamp, settlement_point string, price_usd_mwh double, market_type string, event_id long"


def _files(df, folder, cuts):
    """One file per time span, written in order."""
    edges = [None, *cuts, None]
    for k in range(len(edges) - 1):
        part = df
        if edges[k]:
            part = part.where(F.col("ts") >= F.lit(edges[k]).cast("timestamp"))
        if edges[k + 1]:
            part = part.where(F.col("ts") < F.lit(edges[k + 1]).cast("timestamp"))
        part.coalesce(1).write.mode("append").parquet(folder)


CUTS = ["2024-01-10", "2024-01-20"]


@pytest.fixture
def place(spark):
    root = scratch_path(spark, "test-stream")
    return lambda label: f"{root}/{label}"


def test_rollup_in_three_batches_equals_batch(spark, views, place):
    _files(views.prices, place("in"), CUTS)
    table = jobs.rollup_table(spark, place("rollup"))
    stream = jobs.read_stream(spark, place("in"), PRICES, files_per_batch=1)
    job = jobs.stream_rollup(stream, table, place("cp"))
    job.awaitTermination()
    sums = [c for c in schemas.PRICES_HOURLY.fieldNames()]
    want = aggregates.price_rollup(views.prices).select(*sums)
    got = table.latest().select(*sums)
    assert got.count() == want.count()
    key = ["bucket", "settlement_point", "market_type"]
    both = got.alias("g").join(want.alias("w"), key)
    worst = both.select(F.max(F.abs(F.col("g.avg_price_usd_mwh") - F.col("w.avg_price_usd_mwh"))),
                        F.max(F.abs(F.col("g.max_price_usd_mwh") - F.col("w.max_price_usd_mwh")))).first()
    assert both.count() == want.count() and max(worst) < 1e-9
    days = want.select(F.to_date("bucket")).distinct().count()
    assert len(table.log().inputFiles()) <= days + len(CUTS)


def test_late_rows_are_dropped_and_repaired(spark, rows, place):
    t = dt.datetime(2024, 1, 10, 12)
    batches = [[(t, 1.0)], [(t + dt.timedelta(hours=1), 2.0)], [(t - dt.timedelta(days=5), 100.0), (t, 3.0)],
               [(t + dt.timedelta(hours=2), 1.0)]]
    raw = []
    table = jobs.rollup_table(spark, place("rollup"))
    for n, values in enumerate(batches):
        values = [(when, "H", price, "DAM", n) for when, price in values]
        raw += values
        rows(PRICES, *values).coalesce(1).write.mode("append").parquet(place("in"))
        job = jobs.stream_rollup(jobs.read_stream(spark, place("in"), PRICES), table, place("cp"))
        job.awaitTermination()
        if n == 2:
            dropped = sum(int(op["numRowsDroppedByWatermark"]) for p in job.recentProgress for op in p["stateOperators"])
            assert dropped == 1
    assert sorted(r.avg_price_usd_mwh for r in table.latest().collect()) == [1.0, 2.0, 2.0]
    repaired = q.refresh_rollup(rows(PRICES, *raw), t - dt.timedelta(days=4, hours=20))
    assert [r.avg_price_usd_mwh for r in repaired.collect()] == [100.0]


def test_state_stays_bounded(spark, views, place):
    _files(views.prices, place("in"), ["2024-01-06", "2024-01-12", "2024-01-18", "2024-01-24"])
    table = jobs.rollup_table(spark, place("rollup"))
    job = jobs.stream_rollup(jobs.read_stream(spark, place("in"), PRICES, files_per_batch=1), table, place("cp"))
    job.awaitTermination()
    sizes = [op["numRowsTotal"] for p in job.recentProgress for op in p["stateOperators"]]
    assert sizes[-1] < aggregates.price_rollup(views.prices).count() / 2


def test_insert_once_over_batches_and_restart(spark, views, place):
    hourly = views.prices.withColumn("ts", fn.hour_of("ts"))
    table = store.LogTable(spark, place("t"), schemas.SPP_PRICES, schemas.KEYS["spp_prices"])

    def run():
        jobs.stream_insert_ignore(jobs.read_stream(spark, place("in"), PRICES, files_per_batch=1), table,
                                  place("cp"), "event_id").awaitTermination()

    hourly.where("event_id % 2 = 0").coalesce(1).write.parquet(place("in"))
    run()
    hourly.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(place("in"))
    run()
    run()
    first_even = store.insert_ignore(hourly.withColumn("o", F.col("event_id") % 2),
                                     schemas.KEYS["spp_prices"], ["o", "event_id"])
    got = table.rows().drop("dt")
    assert got.count() == first_even.count()
    assert got.exceptAll(first_even.select(*got.columns)).isEmpty()


def test_upsert_over_batches(spark, views, place):
    hourly = views.prices.withColumn("ts", fn.hour_of("ts"))
    _files(hourly, place("in"), CUTS)
    table = store.LogTable(spark, place("t"), schemas.SPP_PRICES, schemas.KEYS["spp_prices"])
    jobs.stream_upsert(jobs.read_stream(spark, place("in"), PRICES, files_per_batch=1), table, place("cp"),
                       "event_id").awaitTermination()
    got = table.latest().drop("dt")
    want = store.upsert_last(hourly, schemas.KEYS["spp_prices"], ["event_id"]).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_alerts_snapshots_and_payloads(spark, views, place):
    _files(views.conditions, place("in"), CUTS)
    alerts = store.LogTable(spark, place("alerts"), schemas.ALERTS)
    outages = store.LogTable(spark, place("outages"), schemas.OUTAGES)
    schema = views.conditions.schema
    jobs.stream_alerts(jobs.read_stream(spark, place("in"), schema, files_per_batch=1), alerts, outages, place("cp"),
                       lambda df: fn.assign_alert_id(df, ["alert_type", "ts"])).awaitTermination()
    assert alerts.rows().count() == detect.condition_alerts(views.conditions).count()
    assert outages.rows().count() == detect.condition_snapshot(views.conditions).count()
    alerts.rows().coalesce(1).write.parquet(place("alert-files"))
    jobs.stream_payloads(jobs.read_stream(spark, place("alert-files"), schemas.ALERTS), place("json"),
                         place("cp2")).awaitTermination()
    assert spark.read.json(place("json")).select("alert_id", "timestamp").count() == alerts.rows().count()


def test_anomalies_across_batches_equal_one_batch(spark, place):
    t0 = dt.datetime(2024, 1, 1)
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    wave = spark.range(240).select((F.lit(t0) + hour).alias("ts"),
                                   (F.sin(F.col("id") / 4) + F.when(F.col("id") == 150, 9.0).otherwise(0.0)).alias("v"))
    model = detect.fit_reconstruction(ds.scoring_windows(wave.where("v < 5"), ["v"]), ks=(2,))
    scores = detect.reconstruction_score(ds.scoring_windows(wave, ["v"]), model)
    want = {r.window_ts for r in scores.where("score > 0.5").collect()}
    assert want
    _files(wave, place("in"), ["2024-01-03", "2024-01-07 03:00:00"])
    schema = schemas.T.StructType([schemas.GRID_LOAD["ts"], schemas.T.StructField("v", schemas.T.DoubleType())])
    events = store.LogTable(spark, place("events"), schemas.ANOMALY_EVENTS)
    jobs.stream_anomaly(jobs.read_stream(spark, place("in"), schema, files_per_batch=1), place("context"), events,
                        place("cp"), model, ["v"], 0.5).awaitTermination()
    assert sorted(r.ts for r in events.rows().collect()) == sorted(want)


def test_slow_series_and_equal_times_get_their_windows(spark, place):
    """Two rows a time, four times a day: windows reach back three days and more."""
    t0 = dt.datetime(2024, 1, 1)
    step = F.make_dt_interval(hours=(F.floor(F.col("id") / 2) * 6).cast("int"))
    wave = spark.range(200).select((F.lit(t0) + step).alias("ts"), F.col("id").alias("k"),
                                   (F.sin(F.col("id") / 4) + F.when(F.col("id") == 171, 9.0).otherwise(0.0)).alias("v"))
    order = ["ts", "k"]
    model = detect.fit_reconstruction(ds.scoring_windows(wave.where("v < 5"), ["v"], order=order), order[1:], ks=(2,))
    scores = detect.reconstruction_score(ds.scoring_windows(wave, ["v"], order=order), model)
    want = sorted(r.window_ts for r in scores.where("score > 0.5").collect())
    assert len(want) > len(set(want))
    _files(wave, place("in"), ["2024-01-11", "2024-01-22 08:00:00"])
    schema = schemas.T.StructType([schemas.GRID_LOAD["ts"], schemas.T.StructField("k", schemas.T.LongType()),
                                   schemas.T.StructField("v", schemas.T.DoubleType())])
    events = store.LogTable(spark, place("events"), schemas.ANOMALY_EVENTS)
    jobs.stream_anomaly(jobs.read_stream(spark, place("in"), schema, files_per_batch=1), place("context"), events,
                        place("cp"), model, ["v"], 0.5, ties=["k"]).awaitTermination()
    assert sorted(r.ts for r in events.rows().collect()) == want


def test_context_keeps_what_windows_reach_and_no_more(spark):
    t0 = dt.datetime(2024, 1, 1)
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    rows = spark.range(100).select(F.when(F.col("id") < 30, "quiet").otherwise("busy").alias("s"),
                                   (F.lit(t0) + hour).alias("ts"), F.col("id").alias("k"))
    kept = jobs.still_reached(rows, ["s"], ["ts", "k"], 5, "2 hours")
    assert sorted((r.s, r.k) for r in kept.collect()) == [("busy", k) for k in range(93, 100)] + [("quiet", k) for k in range(23, 30)]
    assert {r.s for r in jobs.still_reached(rows, ["s"], ["ts", "k"], 5, "2 hours", forget="10 hours").collect()} == {"busy"}
    assert sorted(r.k for r in jobs.still_reached(rows, [], ["ts", "k"], 5, "0 hours").collect()) == list(range(95, 100))


def test_a_replayed_batch_of_two_series_finds_the_same_context(spark, place):
    """The last batch runs twice: its events and its context stay as they were. One row is late but in time, one too late."""
    t0 = dt.datetime(2024, 1, 1)
    hour = F.make_dt_interval(hours=(F.col("id") % 120).cast("int"))
    wave = spark.range(240).select((F.lit(t0) + hour).alias("ts"), F.when(F.col("id") < 120, "a").otherwise("b").alias("s"),
                                   (F.sin(F.col("id") / 4) + F.when(F.col("id") == 230, 9.0).otherwise(0.0)).alias("v"))
    packed = blocks.pack(wave.where("v < 5").withColumn("draw", detect.hold_out_draw(["ts"])), ["v", "draw"], ["s"])
    model = detect.fit_reconstruction_blocks(packed, ["v"], "draw", ks=(2,))
    scores = detect.reconstruction_score_blocks(blocks.pack(wave, ["v"], ["s"]), ["v"], model)
    want = sorted(r.window_ts for r in scores.where("score > 0.5").collect())
    late = (F.col("s") == "b") & (F.col("ts") == F.lit(dt.datetime(2024, 1, 3, 10)))
    _files(wave.where(~late), place("in"), ["2024-01-03 12:00:00"])
    wave.where(late).coalesce(1).write.mode("append").parquet(place("in"))
    old = spark.createDataFrame([(dt.datetime(2023, 12, 1), "b", 99.0)], wave.schema)
    old.coalesce(1).write.mode("append").parquet(place("in"))
    events = store.LogTable(spark, place("events"), schemas.ANOMALY_EVENTS)
    start = lambda: jobs.stream_anomaly(
        jobs.read_stream(spark, place("in"), wave.schema, files_per_batch=1), place("context"), events, place("cp"), model,
        ["v"], 0.5, series=["s"], lateness="3 days").awaitTermination()
    start()
    got = sorted(r.ts for r in events.rows().collect())
    assert want and got == want
    held = jobs.Context(spark, place("context"))
    last = held.batches()[-1]
    assert len(held.batches()) <= 2
    rows_held = lambda: sorted(map(tuple, spark.read.parquet(f"{place('context')}/batch={last}").collect()))
    before = rows_held()
    assert before and min(r[1] for r in before) >= dt.datetime(2024, 1, 1)
    commits = spark._jvm.java.io.File(f"{place('cp')}/commits").listFiles()
    newest = max((f for f in commits if f.getName().isdigit()), key=lambda f: int(f.getName()))
    newest.delete()
    spark._jvm.java.io.File(newest.getParent(), f".{newest.getName()}.crc").delete()
    start()
    assert sorted(r.ts for r in events.rows().collect()) == want and rows_held() == before


def test_rows_of_any_lateness_reach_the_rollup(spark, rows, place):
    t = dt.datetime(2024, 1, 20, 12)
    raw = store.LogTable(spark, place("raw"), schemas.SPP_PRICES)
    table = jobs.rollup_table(spark, place("rollup"))
    for values in ([(t, 1.0), (t - dt.timedelta(days=10), 4.0)], [(t - dt.timedelta(days=10, minutes=-20), 8.0)]):
        rows(PRICES, *[(w, "H", p, "DAM", 0) for w, p in values]).coalesce(1).write.mode("append").parquet(place("in"))
        jobs.stream_refresh(jobs.read_stream(spark, place("in"), PRICES), raw, table, place("cp")).awaitTermination()
    assert sorted((r.bucket, r.avg_price_usd_mwh) for r in table.latest().collect()) == [
        (t - dt.timedelta(days=10), 6.0), (t, 1.0)]


def test_an_interval_trigger_picks_up_new_files(spark, rows, place, monkeypatch):
    import time
    monkeypatch.setitem(jobs.POLL_SECONDS, "load", 1)
    t = dt.datetime(2024, 1, 1)
    table = store.LogTable(spark, place("t"), schemas.SPP_PRICES)
    put = lambda p: rows(PRICES, (t, "H", p, "DAM", 0)).coalesce(1).write.mode("append").parquet(place("in"))
    put(1.0)
    job = jobs.stream_append(jobs.read_stream(spark, place("in"), PRICES), table, place("cp"), feed="load")
    try:
        for n, price in ((1, 2.0), (2, 3.0)):
            until = time.time() + 60
            while table.rows().count() < n and time.time() < until:
                time.sleep(0.3)
            put(price)
        until = time.time() + 60
        while table.rows().count() < 3 and time.time() < until:
            time.sleep(0.3)
    finally:
        job.stop()
    assert sorted(r.price_usd_mwh for r in table.rows().collect()) == [1.0, 2.0, 3.0]


def test_cadence():
    assert jobs.cadence("price") == {"processingTime": "900 seconds"}
    assert jobs.cadence(None) == {"availableNow": True}


def test_refresh_rebuilds_only_whole_buckets(views):
    got = q.refresh_rollup(views.prices, "2024-01-20 12:30:00")
    first, last = got.agg(F.min("bucket"), F.max("bucket")).first()
    assert first >= dt.datetime(2024, 1, 17, 13) and last <= dt.datetime(2024, 1, 20, 10)
    shown = q.visible_rollup(aggregates.price_rollup(views.prices), "2024-01-20 12:30:00")
    assert shown.agg(F.max("bucket")).first()[0] <= dt.datetime(2024, 1, 20, 10)
