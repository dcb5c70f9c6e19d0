"""Append log: upsert, insert-once, replay, compaction, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens import schemas
from gridlens.session import scratch_path
from gridlens.sources import store

TS = dt.datetime


@pytest.fixture
def prices(spark):
    return store.LogTable(spark, scratch_path(spark, "t"), schemas.SPP_PRICES, schemas.KEYS["spp_prices"])


def _batch(rows, *values):
    return rows("ts timestamp, settlement_point string, price_usd_mwh double, market_type string, pos int", *values)


def _values(df):
    return sorted((r.ts.hour, r.price_usd_mwh) for r in df.collect())


def test_empty_table_reads_empty(prices):
    assert prices.rows().count() == 0 and prices.latest().count() == 0
    prices.compact()
    assert prices.rows().count() == 0


def test_last_and_first_write_win(prices, rows):
    t = TS(2024, 1, 1)
    prices.append(_batch(rows, (t, "H", 1.0, "DAM", 1), (t, "H", 2.0, "DAM", 0), (t.replace(hour=1), "H", 5.0, "DAM", 0)),
                  0, "pos")
    prices.append(_batch(rows, (t, "H", None, "DAM", 0)), 1, "pos")
    assert _values(prices.first()) == [(0, 2.0), (1, 5.0)]
    assert _values(prices.latest()) == [(0, None), (1, 5.0)]


def test_replayed_batch_adds_nothing(prices, rows):
    batch = _batch(rows, (TS(2024, 1, 1), "H", 1.0, "DAM", 0))
    for _ in range(2):
        prices.append(batch, 3, "pos")
    assert prices.rows().count() == 1


def test_compaction_keeps_the_answer(prices, rows):
    days = [TS(2024, 1, d) for d in range(1, 6)]
    prices.append(_batch(rows, *[(d, "H", float(d.day), "DAM", 0) for d in days]), 0, "pos")
    prices.append(_batch(rows, (days[0], "H", 100.0, "DAM", 0)), 1, "pos")
    before = prices.latest().collect()
    prices.compact(segment_by=["settlement_point"], older_than_days=2, as_of="2024-01-05 12:00:00")
    assert sorted(prices.latest().collect()) == sorted(before)
    assert prices.rows().count() == 5
    prices.append(_batch(rows, (days[1], "H", 200.0, "DAM", 0)), 2, "pos")
    prices.compact(keep_days=3, as_of="2024-01-05 00:00:00")
    assert sorted(r.price_usd_mwh for r in prices.latest().collect()) == [3.0, 4.0, 5.0, 200.0]


def test_retention_boundary_is_kept(rows):
    df = rows("ts timestamp", (TS(2024, 1, 1),), (TS(2023, 12, 31, 23),))
    assert store.retain(df, 10, "2024-01-11 00:00:00").count() == 1


def test_day_filter_reaches_the_partitions(prices, rows):
    prices.append(_batch(rows, *[(TS(2024, 1, d), "H", 1.0, "DAM", 0) for d in (1, 2, 3)]), 0, "pos")
    from gridlens.functions.scalars import recent
    wanted = recent(prices.latest(), 1, "2024-01-03 12:00:00")
    assert wanted.count() == 1
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all("dt" in f.split("PartitionFilters: [")[1].split("]")[0] for f in filters)


def test_month_grain(spark, rows):
    table = store.LogTable(spark, scratch_path(spark, "t"), schemas.MODEL_METRICS, grain="month")
    table.append(rows("ts timestamp, model_name string", (TS(2024, 1, 20), "m"), (TS(2024, 2, 3), "m")), 0)
    from gridlens.functions.scalars import recent
    assert recent(table.rows(), 5, "2024-01-24 00:00:00", grain="month").count() == 2
    assert table.rows().select("dt").distinct().count() == 2


def test_acknowledge_reports_misses(rows):
    alerts = rows("alert_id string, ts timestamp, acknowledged boolean", ("a", TS(2024, 1, 1), False), ("b", TS(2024, 1, 1), False))
    changed, report = store.acknowledge(alerts, rows("alert_id string", ("a",), ("zz",)))
    assert [(r.alert_id, r.acknowledged) for r in changed.collect()] == [("a", True)]
    assert {r.alert_id: r.matched for r in report.collect()} == {"a": True, "zz": False}


def test_event_defaults(rows):
    got = store.event_record(rows("detected_at timestamp, severity double", (TS(2024, 1, 1), None))).first()
    assert (got.ts, got.anomaly_type, got.severity, got.description) == (TS(2024, 1, 1), "reconstruction", 0.0, "")


def test_metric_record(rows):
    got = store.metric_record(rows("model_name string, metric_name string, metric_value double", ("m", "mae", 1.0)),
                              "2024-01-01 00:00:00").first()
    assert got.ts == TS(2024, 1, 1) and got.horizon is None


def test_cluster_sorts_newest_first_within_segments(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("s"), F.timestamp_seconds("id").alias("ts"))
    parts = store.cluster(df, ["s"]).withColumn("p", F.spark_partition_id()).collect()
    per = {}
    for r in parts:
        per.setdefault(r.p, []).append((r.s, -r.ts.timestamp()))
    assert all(v == sorted(v) for v in per.values())


def test_two_writers_keep_their_batches(prices, rows):
    t = TS(2024, 1, 1)
    prices.append(_batch(rows, (t, "A", 1.0, "DAM", 0)), 0, "pos", writer="live")
    prices.append(_batch(rows, (t, "B", 2.0, "DAM", 0)), 0, "pos", writer="backfill")
    prices.append(_batch(rows, (t, "C", 3.0, "DAM", 0)), position="pos")
    prices.append(_batch(rows, (t, "C", 4.0, "DAM", 0)), position="pos")
    assert sorted(r.settlement_point for r in prices.rows().collect()) == ["A", "B", "C", "C"]
    assert sorted(r.price_usd_mwh for r in prices.latest().collect()) == [1.0, 2.0, 4.0]


def test_a_new_stream_is_read_after_compaction(prices, rows):
    prices.append(_batch(rows, (TS(2024, 1, 1), "A", 1.0, "DAM", 0)), 5, "pos", writer="first")
    prices.compact()
    prices.append(_batch(rows, (TS(2024, 1, 1), "A", 2.0, "DAM", 0)), 0, "pos", writer="second")
    assert [r.price_usd_mwh for r in prices.latest().collect()] == [2.0]


def test_a_write_without_commit_is_not_read(prices, rows, monkeypatch):
    batch = _batch(rows, (TS(2024, 1, 1), "A", 1.0, "DAM", 0))
    with monkeypatch.context() as broken:
        def crash(self, entry, suffix):
            raise OSError("crash before the commit")
        broken.setattr(store.LogTable, "_put", crash)
        with pytest.raises(OSError):
            prices.append(batch, 0, "pos")
    assert prices.rows().count() == 0
    prices.append(batch, 0, "pos")
    assert prices.rows().count() == 1
    assert prices.vacuum(grace_seconds=0) == 1 and prices.rows().count() == 1


def test_only_changed_old_days_are_rewritten_and_the_rest_deleted(prices, rows):
    days = [TS(2024, 1, d) for d in (1, 2, 3)]
    prices.append(_batch(rows, *[(d, "H", float(d.day), "DAM", 0) for d in days]), 0, "pos")
    prices.compact()
    first = dict(prices._state().live)
    prices.append(_batch(rows, (days[1], "H", 20.0, "DAM", 0)), 1, "pos")
    prices.compact()
    second = dict(prices._state().live)
    assert {p for p in first if p in second} == {p for p in first if p[1] != "2024-01-02"}
    assert prices.vacuum(grace_seconds=3600) == 0 and prices.vacuum(grace_seconds=0) > 0
    assert sorted(r.price_usd_mwh for r in prices.rows().collect()) == [1.0, 3.0, 20.0]


def test_expired_days_are_deleted(prices, rows):
    prices.append(_batch(rows, *[(TS(2024, 1, d), "H", float(d), "DAM", 0) for d in range(1, 6)]), 0, "pos")
    prices.expire(2, "2024-01-05 12:00:00")
    assert sorted(r.price_usd_mwh for r in prices.rows().collect()) == [3.0, 4.0, 5.0]
    assert prices.vacuum(grace_seconds=0) == 2


def test_snapshots_stand_for_their_commits(prices, rows, monkeypatch):
    monkeypatch.setattr(store, "SNAPSHOT_EVERY", 3)
    for n in range(7):
        prices.append(_batch(rows, (TS(2024, 1, 1 + n), "H", float(n), "DAM", 0)), n, "pos")
    prices.vacuum(grace_seconds=0)
    assert prices._state().fresh < 3
    prices.append(_batch(rows, (TS(2024, 1, 1), "H", 99.0, "DAM", 0)), 6, "pos")
    assert sorted(r.price_usd_mwh for r in prices.latest().collect()) == [float(n) for n in range(7)]


def test_a_late_commit_of_a_slow_writer_counts(prices, rows, monkeypatch):
    """Its sequence number is older than a snapshot that was made without it."""
    monkeypatch.setattr(store, "SNAPSHOT_EVERY", 2)
    held, put = [], store.LogTable._put
    monkeypatch.setattr(store.LogTable, "_put", lambda self, e, s: held.append(e) if e.get("writer") == "slow" else put(self, e, s))
    prices.append(_batch(rows, (TS(2024, 1, 1), "S", 1.0, "DAM", 0)), 0, "pos", writer="slow")
    for n in range(3):
        prices.append(_batch(rows, (TS(2024, 1, 2), "F", float(n), "DAM", 0)), n, "pos", writer="fast")
    put(prices, held[0], "json")
    assert sorted(r.settlement_point for r in prices.latest().collect()) == ["F", "S"]


def test_keyed_rows_need_a_position(prices, rows):
    with pytest.raises(ValueError):
        prices.append(_batch(rows, (TS(2024, 1, 1), "H", 1.0, "DAM", 0)), 0)


def test_broken_files_are_not_an_empty_table(spark, prices, rows):
    prices.append(_batch(rows, (TS(2024, 1, 1), "H", 1.0, "DAM", 0)), 0, "pos")
    path, fs = prices._at("data")
    fs.delete(path, True)
    with pytest.raises(Exception):
        prices.rows().count()


def test_intermediate_tables_can_be_released(spark):
    from gridlens import session
    table = session.materialise(spark.range(3).toDF("id"), "gone")
    path = table.inputFiles()[0].rsplit("/", 1)[0]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(hadoop)
    session.release([p for p in session._written if path.endswith(p.rsplit("/", 1)[-1])])
    assert not fs.exists(hadoop)


def _random_batches(rows, n=6):
    import random
    rng = random.Random(7)
    for b in range(n):
        keys = [(TS(2024, 1, rng.randint(1, 4), rng.randint(0, 3)), rng.choice(["H", "N", None])) for _ in range(12)]
        yield b, _batch(rows, *[(t, h, float(100 * b + i), "DAM", i) for i, (t, h) in enumerate(keys)])


@pytest.mark.parametrize("mode", ["latest", "first"])
def test_reading_by_merge_equals_grouping_the_whole_log(prices, rows, mode):
    key = lambda df: sorted(map(str, df.select("ts", "settlement_point", "price_usd_mwh").collect()))
    whole = []
    for b, batch in _random_batches(rows):
        prices.append(batch, b, "pos")
        whole.append(batch.withColumn("b", F.lit(b)))
        if b in (1, 3):
            prices.compact(mode, older_than_days=2, as_of=f"2024-01-0{b + 3} 00:00:00")
        every = whole[0]
        for more in whole[1:]:
            every = every.unionByName(more)
        pick = store.upsert_last if mode == "latest" else store.insert_ignore
        assert key(getattr(prices, mode)()) == key(pick(every, schemas.KEYS["spp_prices"], ["b", "pos"]))
    state = prices._state()
    assert any(state.live[p] for p in state.live) and not all(state.live[p] for p in state.live)


def test_rewritten_days_are_read_without_grouping(prices, rows):
    prices.append(_batch(rows, *[(TS(2024, 1, d), "H", float(d), "DAM", 0) for d in (1, 2, 3)]), 0, "pos")
    prices.compact()
    plan = prices.latest()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    prices.append(_batch(rows, (TS(2024, 1, 2), "H", 20.0, "DAM", 0), (TS(2024, 1, 2), "N", 21.0, "DAM", 1)), 1, "pos")
    state = prices._state()
    late = [p for p in state.live if not state.live[p]]
    assert len(late) == 1
    plan = prices.latest()._jdf.queryExecution().optimizedPlan()
    grouped = [line for line in plan.toString().splitlines() if "Aggregate" in line]
    assert len(grouped) >= 1 and "LeftAnti" in plan.toString()
    assert sorted(r.price_usd_mwh for r in prices.latest().collect()) == [1.0, 3.0, 20.0, 21.0]


def test_a_batch_without_doubles_needs_no_grouping(spark, rows):
    table = store.LogTable(spark, scratch_path(spark, "t"), schemas.PRICES_HOURLY, schemas.KEYS["spp_prices_hourly"], ts="bucket")
    row = rows("bucket timestamp, settlement_point string, market_type string, avg_price_usd_mwh double",
               (TS(2024, 1, 1), "H", "DAM", 1.0))
    table.append(row, 0, unique=True)
    assert "Aggregate" not in table.latest()._jdf.queryExecution().optimizedPlan().toString()
    table.append(row.withColumn("avg_price_usd_mwh", F.lit(2.0)), 1, unique=True)
    assert [r.avg_price_usd_mwh for r in table.latest().collect()] == [2.0]


def test_partial_aggregates_merge_to_the_rollup(spark, views):
    from gridlens.operators.aggregates import price_rollup
    log = store.RollupLog(spark, scratch_path(spark, "partials"))
    assert log.rollup().count() == 0
    want = price_rollup(views.prices).withColumn("avg_price_usd_mwh", F.round("avg_price_usd_mwh", 8))
    names = want.columns
    for k in range(3):
        part = views.prices.where(F.col("event_id") % 3 == k)
        log.add(part, k)
        log.add(part, k)  # a replay
        if k == 1:
            log.compact(as_of="2024-01-20 00:00:00", older_than_days=3)
    got = log.rollup().withColumn("avg_price_usd_mwh", F.round("avg_price_usd_mwh", 8)).select(*names)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    log.compact()
    assert log.rollup().withColumn("avg_price_usd_mwh", F.round("avg_price_usd_mwh", 8)).select(*names).exceptAll(want).isEmpty()


def test_sketches_of_days_merge_to_the_percentile(spark):
    hours = F.make_dt_interval(hours=F.floor(F.col("id") / 100).cast("int"))
    scores = spark.range(20000).select((F.lit(TS(2024, 1, 1)) + hours).alias("window_ts"),
                                       F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("score"))
    log = store.SketchLog(spark, scratch_path(spark, "sketches"))
    assert log.threshold(0.9) == (None, 0, store.rank_error())
    for k in range(4):
        log.add(scores.where(F.col("score") % 4 == k), k)
        log.add(scores.where(F.col("score") % 4 == k), k)  # a replay
        if k == 2:
            log.compact(as_of="2024-01-05 00:00:00", older_than_days=1)
    log.add(scores.limit(0).unionByName(spark.createDataFrame([(TS(2024, 1, 2), float("nan")), (TS(2024, 1, 2), None)],
                                                              scores.schema)), 4)
    found, n, error = log.threshold(0.98)
    rank = scores.where(F.col("score") <= found).count() / 20000
    assert n == 20000 and abs(rank - 0.98) <= 3 * error
    part, n, _ = log.threshold(0.5, first="2024-01-02", last="2024-01-03")
    inside = scores.where("window_ts >= '2024-01-02' AND window_ts < '2024-01-04'")
    assert n == inside.count() and abs(inside.where(F.col("score") <= part).count() / n - 0.5) <= 3 * error
    assert log.latest().agg(F.sum("n"), F.count("*")).first()[:] == (20000, 9)
