"""Registered queries: operational reads, streaming jobs and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens import schemas
from gridlens.functions import scalars as fn
from gridlens.operators import aggregates, detect
from gridlens.operators.aggregates import price_rollup
from gridlens.operators.blocks import SEQ_LEN
from gridlens.operators.ordered import exact_percentile
from gridlens.plans import queries as q
from gridlens.plans.catalog_feeds import alert_table
from gridlens.plans.catalog_models import reading_blocks, two_cell_blocks
from gridlens.plans.catalog_series import ROLLUP, SERIES
from gridlens.plans.fixtures import AS_OF, TABLES, VIEWS
from gridlens.plans.registry import helper, query
from gridlens.session import materialise, scratch_path
from gridlens.sources import feeds, store
from gridlens.streaming import jobs

# Reads ------------------------------------------------------------------------------------

_WX = "temperature_2m wind_speed_10m direct_radiation relative_humidity"
_CUT7 = f"TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"
_CUT1 = f"TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY"


@query("r0_read_load", "ts", "load_mw forecast_mw grid_stress", f"""
SELECT ts, load_mw, forecast_mw, load_mw - forecast_mw AS grid_stress FROM fx_grid_load
WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY""")
def _(v):
    return q.read_load(v.load, 14, AS_OF)


@query("r0_read_prices", "ts", "price_usd_mwh", f"""
SELECT ts, price_usd_mwh FROM fx_spp_prices WHERE settlement_point = 'HB_NORTH' AND market_type = 'RTM'
  AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY""")
def _(v):
    return q.read_prices(v.prices, 14, "HB_NORTH", "RTM", AS_OF)


@query("r0_read_weather", "ts", _WX, f"""
SELECT * FROM h_zone_avg WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY""")
def _(v):
    return q.read_weather(v.weather, 14, as_of=AS_OF)


@query("r0_read_weather_zone", "ts", _WX, f"""
SELECT ts, temperature_2m, wind_speed_10m, direct_radiation, coalesce(relative_humidity, 0) AS relative_humidity
FROM fx_weather WHERE zone = 'dallas' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY""")
def _(v):
    return q.read_weather(v.weather, 14, "dallas", AS_OF)


@query("r1_alerts", "alert_id ts alert_type severity acknowledged", "", f"""
SELECT alert_id, ts, alert_type, severity, acknowledged FROM h_alert_ids
WHERE NOT acknowledged AND ts > {_CUT7} ORDER BY ts DESC, alert_id DESC LIMIT 200""")
def _(v):
    return q.alerts(alert_table(v), 7, True, AS_OF)


@query("r2_acknowledge", "alert_id event_id acknowledged matched", "", """
SELECT alert_id, event_id, acknowledged OR event_id % 5 = 0 AS acknowledged, event_id % 5 = 0 AS matched FROM h_alert_ids""")
def _(v):
    schema = T.StructType([*schemas.ALERTS.fields, T.StructField("event_id", T.LongType())])
    log = store.LogTable(v.spark, scratch_path(v.spark, "alerts"), schema, schemas.KEYS["alerts"], grain="month")
    log.append(alert_table(v), 0, "event_id")
    ids = log.latest().where("event_id % 5 = 0").select("alert_id")
    changed, report = store.acknowledge(log.latest(), ids)
    log.append(materialise(changed, "acknowledged"), 1, "event_id")
    return log.latest().join(report, "alert_id", "left").withColumn(
        "matched", F.coalesce("matched", F.lit(False)))


helper("h_events", """
SELECT ts AS detected_at, 'reconstruction' AS anomaly_type,
  CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END AS severity, 'event ' || event_id AS description FROM events""")


def _anomaly_events(v):
    severity = F.when(F.col("event_id") % 10 != 0, F.col("value"))
    return store.event_record(v.table("events").select(
        F.col("ts").alias("detected_at"), severity.alias("severity"),
        F.concat(F.lit("event "), "event_id").alias("description")))


@query("r3_anomaly_history", "detected_at anomaly_type description", "severity", f"""
SELECT * FROM h_events WHERE detected_at > {_CUT7} ORDER BY detected_at DESC, severity DESC, description DESC LIMIT 200""")
def _(v):
    return q.anomaly_history(_anomaly_events(v), 7, AS_OF)


@query("r4_outage_history", "ts outage_type facility_name nature status start_time", "capacity_mw", f"""
SELECT * FROM h_outages WHERE ts > {_CUT7} ORDER BY ts DESC, facility_name DESC, nature DESC LIMIT 100""")
def _(v):
    return q.outage_history(detect.condition_snapshot(v.conditions), 7, AS_OF)


@query("a8_stress_counts", "total high_stress normal", "", """
SELECT count(*) AS total, count(*) FILTER (status = 'high_stress') AS high_stress,
  count(*) FILTER (status <> 'high_stress') AS normal FROM h_outages""")
def _(v):
    return aggregates.stress_counts(detect.condition_snapshot(v.conditions))


@query("r5_grid_status", "load_ts active_alerts alert_type alert_severity stress_events_24h", "current_mw forecast_mw stress", f"""
SELECT l.ts AS load_ts, l.load_mw AS current_mw, l.forecast_mw, l.load_mw - l.forecast_mw AS stress,
  a.n AS active_alerts, a.alert_type, a.severity AS alert_severity, o.n AS stress_events_24h
FROM (SELECT * FROM fx_grid_load WHERE ts > {_CUT1} ORDER BY ts DESC LIMIT 1) l,
  (SELECT count(*) AS n, arg_max(alert_type, (ts, alert_id)) AS alert_type,
          arg_max(severity, (ts, alert_id)) AS severity FROM h_alert_ids WHERE ts > {_CUT1} AND NOT acknowledged) a,
  (SELECT count(*) AS n FROM h_outages WHERE ts > {_CUT1} AND status = 'high_stress') o""")
def _(v):
    return q.grid_status(v.load, alert_table(v), detect.condition_snapshot(v.conditions), AS_OF)


@query("r6_load_vs_forecast", "ts", "load_mw forecast_mw",
       f"SELECT ts, load_mw, forecast_mw FROM fx_grid_load WHERE ts > {_CUT7}")
def _(v):
    return q.load_vs_forecast(v.load, 7, AS_OF)


@query("r7_dam_vs_rtm", "ts", "dam rtm", f"""
SELECT ts, max(price_usd_mwh) FILTER (market_type = 'DAM') AS dam, max(price_usd_mwh) FILTER (market_type = 'RTM') AS rtm
FROM fx_spp_prices WHERE settlement_point = 'HB_WEST' AND ts > {_CUT7} GROUP BY ts""")
def _(v):
    return q.dam_vs_rtm(v.prices, "HB_WEST", 7, AS_OF)


@query("r8_zone_comparison", "ts zone", "temperature_2m",
       f"SELECT ts, zone, temperature_2m FROM fx_weather WHERE ts > {_CUT7}")
def _(v):
    return q.zone_comparison(v.weather, 7, AS_OF)


@query("r9_weather_load_overlay", "ts", "load_mw temperature_2m", f"""
SELECT ts, load_mw, temperature_2m FROM h_load_weather WHERE ts > {_CUT7}""")
def _(v):
    return q.weather_load_overlay(v.load, v.weather, 7, as_of=AS_OF)


# Streaming, drained over the whole table ------------------------------------------------------

def _stream(v, view):
    """The view over the events table, read as a stream."""
    # As a pattern the path may name one file or a folder of files; a plain path only the latter.
    events = jobs.read_stream(v.spark, f"{v.sf_dir}/events.parque[t]", TABLES["events"])
    return v.spark.sql(VIEWS[view], events=events)


def _paths(v, *labels):
    root = scratch_path(v.spark, "stream")
    return [f"{root}/{label}" for label in labels]


#: Stretches of time that a query's rows are put into files by, one micro-batch each.
STRETCHES = 3


def _in_stretches(v, rows, label, newest_first=False):
    """The rows as files written stretch after stretch, and how many files a stretch has at most."""
    folder = f"{scratch_path(v.spark, label)}/rows"
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    files = int(v.spark.conf.get("spark.sql.shuffle.partitions"))
    edges = [first + (last - first) * k / STRETCHES for k in range(1, STRETCHES)]
    spans = list(zip([None, *edges], [*edges, None]))
    for low, high in reversed(spans) if newest_first else spans:
        part = rows.where(F.lit(True) if low is None else F.col("ts") >= F.lit(low).cast(rows.schema["ts"].dataType))
        part = part.where(F.lit(True) if high is None else F.col("ts") < F.lit(high).cast(rows.schema["ts"].dataType))
        part.repartition(files).write.mode("append").parquet(folder)
    return folder, files


@query("x1_stream_rollup", *ROLLUP, "SELECT * FROM h_rollup")
def _(v):
    table, checkpoint = _paths(v, "rollup", "checkpoint")
    rollup = jobs.rollup_table(v.spark, table)
    jobs.stream_rollup(_stream(v, "fx_spp_prices"), rollup, checkpoint).awaitTermination()
    return rollup.latest()


@query("x1_stream_refresh", *ROLLUP, "SELECT * FROM h_rollup")
def _(v):
    """Stretches arrive in reverse: most rows are days late, and their buckets are rebuilt from the raw table."""
    folder, files = _in_stretches(v, v.prices, "late", newest_first=True)
    raw_path, table, checkpoint = _paths(v, "raw", "rollup", "checkpoint")
    rollup, raw = jobs.rollup_table(v.spark, table), store.LogTable(v.spark, raw_path, schemas.SPP_PRICES)
    stream = jobs.read_stream(v.spark, folder, v.prices.schema, files)
    jobs.stream_refresh(stream, raw, rollup, checkpoint).awaitTermination()
    return rollup.latest()


@query("x1_partial_rollup", *ROLLUP, "SELECT * FROM h_rollup")
def _(v):
    """The same by partial aggregates, half of the days rewritten in between."""
    folder, files = _in_stretches(v, v.prices, "late", newest_first=True)
    table, checkpoint = _paths(v, "rollup", "checkpoint")
    rollup = store.RollupLog(v.spark, table)
    stream = jobs.read_stream(v.spark, folder, v.prices.schema, files)
    jobs.stream_partial_rollup(stream, rollup, checkpoint).awaitTermination()
    rollup.compact(as_of="2024-01-18 00:00:00", older_than_days=2)
    return rollup.rollup()


@query("x2_refresh_rollup", *ROLLUP, """
SELECT * FROM h_rollup WHERE bucket >= TIMESTAMP '2024-01-17 12:00:00' AND bucket <= TIMESTAMP '2024-01-20 10:00:00'""")
def _(v):
    rollup = jobs.rollup_table(v.spark, scratch_path(v.spark, "rollup"))
    rollup.append(price_rollup(v.prices).withColumn("avg_price_usd_mwh", F.lit(0.0)), 0, unique=True, small_days=True)
    q.refresh_into(rollup, v.prices, "2024-01-20 12:00:00")
    shown = q.visible_rollup(rollup.latest(), "2024-01-20 12:00:00")
    return shown.where(F.col("bucket") >= q.rollup_range("2024-01-20 12:00:00")[0])


@query("x3_stream_upsert", "ts", "load_mw", """
SELECT ts, value AS load_mw FROM h_demand WHERE type = 'D'
QUALIFY row_number() OVER (PARTITION BY ts ORDER BY pos DESC) = 1""")
def _(v):
    path, checkpoint = _paths(v, "load", "checkpoint")
    table = store.LogTable(v.spark, path, schemas.GRID_LOAD, schemas.KEYS["grid_load"])
    rows = feeds.normalize_demand(_stream(v, "fx_demand_feed"), keep=["pos"])
    jobs.stream_upsert(rows, table, checkpoint, "pos").awaitTermination()
    return table.latest()


@query("x4_stream_insert_ignore", "ts settlement_point market_type", "price_usd_mwh", """
SELECT date_trunc('hour', ts) AS ts, settlement_point, market_type, arg_min(price_usd_mwh, event_id) AS price_usd_mwh
FROM fx_spp_prices GROUP BY ALL""")
def _(v):
    path, checkpoint = _paths(v, "prices", "checkpoint")
    table = store.LogTable(v.spark, path, schemas.SPP_PRICES, schemas.KEYS["spp_prices"])
    rows = _stream(v, "fx_spp_prices").withColumn("ts", fn.hour_of("ts"))
    jobs.stream_insert_ignore(rows, table, checkpoint, "event_id").awaitTermination()
    return table.rows()


@query("x5_stream_alerts", "alert_id ts alert_type severity", "",
       "SELECT alert_id, ts, alert_type, severity FROM h_alert_ids")
def _(v):
    alerts_path, outages_path, checkpoint = _paths(v, "alerts", "outages", "checkpoint")
    alerts = store.LogTable(v.spark, alerts_path, schemas.ALERTS)
    outages = store.LogTable(v.spark, outages_path, schemas.OUTAGES)
    jobs.stream_alerts(
        _stream(v, "fx_conditions"), alerts, outages, checkpoint,
        lambda rows: fn.assign_alert_id(rows, ["alert_type", "event_id"])).awaitTermination()
    return alerts.rows()


def _flagged_stream(v, rows, features, model, threshold, seq_len=SEQ_LEN):
    """Events of the rows, streamed stretch by stretch."""
    folder, files = _in_stretches(v, rows.select("ts", "event_id", *features), "stretches")
    context, events_path, checkpoint = _paths(v, "context", "events", "checkpoint")
    events = store.LogTable(v.spark, events_path, schemas.ANOMALY_EVENTS)
    schema = rows.select("ts", "event_id", *features).schema
    jobs.stream_anomaly(jobs.read_stream(v.spark, folder, schema, files), context, events, checkpoint, model, features,
                        threshold, ties=["event_id"], seq_len=seq_len).awaitTermination()
    return events.rows()


@query("x6_stream_anomaly", "ts anomaly_type", "severity")
def _(v):
    """Windows of 24 rows of all load features, by the model and threshold of the whole table."""
    packed, rows = reading_blocks(v)
    model = detect.fit_reconstruction_blocks(packed, schemas.LOAD_FEATURES, "draw")
    scores = materialise(detect.reconstruction_score_blocks(packed, schemas.LOAD_FEATURES, model), "scores")
    return _flagged_stream(v, rows, schemas.LOAD_FEATURES, model, exact_percentile(scores, "score", 0.98))


@query("x6_stream_two_cells", "ts anomaly_type", "severity", """
SELECT ts, 'reconstruction' AS anomaly_type, round(score, 4) AS severity
FROM h_two_cell_scores, (SELECT quantile_cont(score, 0.98) AS t FROM h_two_cell_scores) WHERE score > t""")
def _(v):
    """The same for windows of two rows of one feature, whose scores have a closed form."""
    packed = two_cell_blocks(v)
    model = detect.fit_reconstruction_blocks(packed, ["price_usd_mwh"], "draw", ks=(1,))
    scores = materialise(detect.reconstruction_score_blocks(packed, ["price_usd_mwh"], model), "scores")
    return _flagged_stream(v, v.prices, ["price_usd_mwh"], model, exact_percentile(scores, "score", 0.98), seq_len=2)


@query("x7_poll_cadence", "settlement_point market_type n", "", """
SELECT settlement_point, market_type, count(*) AS n FROM fx_spp_prices GROUP BY ALL""")
def _(v):
    path, checkpoint = _paths(v, "prices", "checkpoint")
    table = store.LogTable(v.spark, path, schemas.SPP_PRICES)
    jobs.stream_append(_stream(v, "fx_spp_prices"), table, checkpoint, feed=None).awaitTermination()
    return table.rows().groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))


@query("a10_sketch_threshold", "n days near", "", """
SELECT count(*) AS n, count(DISTINCT date_trunc('day', ts)) AS days, true AS near FROM fx_pred""")
def _(v):
    """The threshold of all scores from sketches by day, kept in three batches and rewritten; ``near`` says that its
    rank among the scores is within thrice the error that the sketch states."""
    scores = v.pred.select("l_orderkey", F.col("ts").alias("window_ts"), F.abs(F.col("y") - F.col("y_hat")).alias("score"))
    log = store.SketchLog(v.spark, scratch_path(v.spark, "sketches"), grain="month")
    for k in range(3):
        log.add(scores.where(F.col("l_orderkey") % 3 == k), k)
        if k == 1:
            log.compact()
    threshold, n, error = log.threshold(0.98)
    days = log.latest().agg(F.count(F.lit(1)).alias("days"))
    at = scores.agg((F.count_if(F.col("score") <= threshold) / F.count("score")).alias("rank")).first()["rank"]
    return days.select(F.lit(n).cast("long").alias("n"), "days", F.lit(abs(at - 0.98) <= 3 * error).alias("near"))


# Lifecycle ------------------------------------------------------------------------------------

@query("l1_retain", "metric_id ts model_name", "metric_value", """
SELECT metric_id, ts, model_name, metric_value FROM fx_metrics WHERE ts >= TIMESTAMP '1999-01-01' - INTERVAL 400 DAY""")
def _(v):
    """Months wholly beyond the retention are deleted from a table, the rest of the last month is filtered."""
    schema = T.StructType([T.StructField("metric_id", v.metrics.schema["metric_id"].dataType), *schemas.MODEL_METRICS.fields])
    log = store.LogTable(v.spark, scratch_path(v.spark, "metrics"), schema, grain="month")
    log.append(v.metrics, 0)
    days, as_of = schemas.RETENTION_DAYS["model_metrics"], "1999-01-01 00:00:00"
    log.expire(days, as_of)
    log.vacuum(grace_seconds=0)
    return store.retain(log.rows(), days, as_of, grain="month")


@query("l2_compact", "ts settlement_point market_type", "price_usd_mwh", """
SELECT date_trunc('hour', ts) AS ts, settlement_point, market_type, arg_max(price_usd_mwh, event_id) AS price_usd_mwh
FROM fx_spp_prices GROUP BY ALL""")
def _(v):
    log = store.LogTable(v.spark, scratch_path(v.spark, "prices"), schemas.SPP_PRICES, schemas.KEYS["spp_prices"])
    rows = v.prices.withColumn("ts", fn.hour_of("ts"))
    half = F.lit("2024-01-16").cast("timestamp")
    log.append(rows.where(F.col("ts") < half), 0, "event_id")
    log.compact(segment_by=schemas.SEGMENT_BY["spp_prices"], as_of=AS_OF,
                older_than_days=schemas.COMPACT_AFTER_DAYS["spp_prices"])
    log.append(rows.where(F.col("ts") >= half), 1, "event_id")
    log.vacuum(grace_seconds=0)
    return log.latest()

