"""Registered queries: joins, aggregates, ordered operators, resampling, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions import scalars as fn
from gridlens.operators import aggregates, joins, ordered, reports, resample
from gridlens.operators import evaluate as ev
from gridlens.plans import queries as q
from gridlens.plans.catalog_feeds import alert_table
from gridlens.plans.fixtures import AS_OF
from gridlens.plans.registry import helper, query
from gridlens.sources import feeds

# Joins ------------------------------------------------------------------------------------

helper("h_zone_avg", """
SELECT ts, avg(temperature_2m) AS temperature_2m, avg(wind_speed_10m) AS wind_speed_10m,
  avg(direct_radiation) AS direct_radiation, avg(coalesce(relative_humidity, 0)) AS relative_humidity
FROM fx_weather GROUP BY ts""")
helper("h_houston_dam", """
SELECT ts, price_usd_mwh FROM fx_spp_prices WHERE settlement_point = 'HB_HOUSTON' AND market_type = 'DAM'""")
_WX = "temperature_2m wind_speed_10m direct_radiation relative_humidity"


def _houston_dam(v):
    return fn.matching(v.prices, settlement_point="HB_HOUSTON", market_type="DAM").select("ts", "price_usd_mwh")


@query("j1_align_outer", "ts", f"load_mw forecast_mw {_WX} price_usd_mwh", """
SELECT ts, load_mw, forecast_mw, temperature_2m, wind_speed_10m, direct_radiation, relative_humidity, price_usd_mwh
FROM fx_grid_load FULL JOIN h_zone_avg USING (ts) FULL JOIN h_houston_dam USING (ts)""")
def _(v):
    return joins.align_outer(v.load, aggregates.zone_average(v.weather), _houston_dam(v))


@query("j2_align_inner", "ts", "load_mw temperature_2m forecast", """
SELECT g.ts, g.load_mw, w.temperature_2m, g.forecast_mw AS forecast FROM fx_grid_load g
JOIN (SELECT ts, temperature_2m FROM fx_weather WHERE zone = 'houston') w ON g.ts = w.ts WHERE g.forecast_mw IS NOT NULL""")
def _(v):
    forecast = v.load.where(F.col("forecast_mw").isNotNull()).select("ts", F.col("forecast_mw").alias("forecast"))
    houston = fn.matching(v.weather, zone="houston").select("ts", "temperature_2m")
    return joins.align_inner(v.load.select("ts", "load_mw"), houston, forecast)


@query("j3_hour_join", "ts event_id", "price_usd_mwh temperature_2m", """
SELECT p.ts, p.event_id, p.price_usd_mwh, w.temperature_2m FROM fx_spp_prices p
JOIN fx_weather w ON date_trunc('hour', p.ts) = date_trunc('hour', w.ts) WHERE w.zone = 'houston' OR w.zone IS NULL""")
def _(v):
    return joins.hour_join(v.prices, v.weather)


@query("j4_forecast_lookup", "period n", "forecast_mw", """
SELECT d.period, count(*) AS n, max(f.forecast_mw) AS forecast_mw FROM h_demand d LEFT JOIN (
  SELECT period, arg_max(value, pos) AS forecast_mw FROM h_demand WHERE type = 'DF' AND value IS NOT NULL
  GROUP BY period) f ON d.period = f.period WHERE d.type = 'D' GROUP BY d.period""")
def _(v):
    demand = feeds.normalize_demand(v.demand_feed, keep=["pos"])
    forecast = feeds.normalize_demand(v.demand_feed, "DF", "forecast_mw", keep=["pos"])
    paired = feeds.pair_forecast(demand, forecast.drop("ts"))
    return paired.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.max("forecast_mw").alias("forecast_mw"))


@query("j5_key_anti_join", "event_id ts settlement_point market_type", "price_usd_mwh", """
SELECT * FROM fx_spp_prices p WHERE event_id % 3 <> 0 AND NOT EXISTS (
  SELECT 1 FROM fx_spp_prices k WHERE k.event_id % 3 = 0 AND date_trunc('hour', k.ts) = date_trunc('hour', p.ts)
    AND k.settlement_point = p.settlement_point AND k.market_type = p.market_type)""")
def _(v):
    rows = v.prices.withColumn("hour", fn.hour_of("ts"))
    old = F.col("event_id") % 3 == 0
    return joins.without_known(rows.where(~old), rows.where(old), ["hour", "settlement_point", "market_type"])


helper("h_keyed_pred", "SELECT *, l_orderkey || '-' || l_linenumber AS series FROM fx_pred")


def _two_models(v):
    key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("series")
    a = v.pred.select(key, "ts", "horizon", "y", F.col("y_hat").alias("y_a"))
    b = v.pred.select(key, "ts", "horizon", (F.col("y_hat") * 1.01).alias("y_b"))
    return a, b


@query("j6_align_predictions", "series horizon ts", "y y_a y_b", """
SELECT a.series, a.horizon, a.ts, a.y, a.y_hat AS y_a, b.y_hat * 1.01 AS y_b
FROM h_keyed_pred a JOIN h_keyed_pred b ON a.series = b.series AND a.ts = b.ts AND a.horizon = b.horizon""")
def _(v):
    return joins.align_predictions(*_two_models(v))


# Aggregates -------------------------------------------------------------------------------

helper("h_rollup", """
SELECT date_trunc('hour', ts) AS bucket, settlement_point, market_type, avg(price_usd_mwh) AS avg_price_usd_mwh,
  max(price_usd_mwh) AS max_price_usd_mwh, min(price_usd_mwh) AS min_price_usd_mwh
FROM fx_spp_prices GROUP BY ALL""")
ROLLUP = ("bucket settlement_point market_type", "avg_price_usd_mwh max_price_usd_mwh min_price_usd_mwh")


@query("a1_price_rollup", *ROLLUP, "SELECT * FROM h_rollup")
def price_rollup(v):
    return aggregates.price_rollup(v.prices)


@query("a2_zone_average", "ts", _WX, "SELECT * FROM h_zone_avg")
def _(v):
    return aggregates.zone_average(v.weather)


@query("a3_dedupe_mean", "ts", "load_mw value", """
SELECT * FROM (SELECT date_trunc('hour', ts) AS ts, avg(value * 800) AS load_mw, avg(value) AS value
FROM events GROUP BY 1) WHERE load_mw > 10000""")
def _(v):
    rows = v.table("events").select(fn.hour_of("ts").alias("ts"), "value", (F.col("value") * 800).alias("load_mw"))
    return aggregates.dedupe_mean(rows)


@query("a4_load_heatmap", "hour date", "load_mw", """
SELECT CAST(hour(ts) AS INT) AS hour, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, avg(load_mw) AS load_mw
FROM fx_grid_load GROUP BY ALL""")
def _(v):
    return aggregates.load_heatmap(v.load)


_CORR = ["load_mw", "temperature_2m", "wind_speed_10m", "relative_humidity"]


def _load_weather(v):
    return joins.hour_join(v.load.select("ts", "load_mw"), v.weather)


helper("h_load_weather", """
SELECT g.ts, load_mw, temperature_2m, wind_speed_10m, direct_radiation, relative_humidity
FROM fx_grid_load g JOIN fx_weather w ON g.ts = w.ts WHERE zone = 'houston' OR zone IS NULL""")


def _corr_sql(columns, source, value="corr"):
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, " + ("1.0" if a == b else f"corr({a}, {b})") + f" AS r FROM {source}"
        for a in columns for b in columns)
    return f"SELECT DISTINCT i, j, r FROM ({cells})"


@query("a5_corr_matrix", "i j", "r", _corr_sql(_CORR, "h_load_weather"))
def _(v):
    return aggregates.corr_matrix(_load_weather(v), _CORR)


_XS = ["temperature_2m", "wind_speed_10m", "direct_radiation"]


@query("a6_ols_trend", "x n", "slope intercept r2", " UNION ALL ".join(
    f"SELECT '{x}' AS x, CAST(regr_count(load_mw, {x}) AS BIGINT) AS n, regr_slope(load_mw, {x}) AS slope, "
    f"regr_intercept(load_mw, {x}) AS intercept, regr_r2(load_mw, {x}) AS r2 FROM h_load_weather" for x in _XS))
def _(v):
    return aggregates.ols_trend(_load_weather(v), "load_mw", _XS)


@query("a7_table_stats", "table_name n_rows min_ts max_ts", "", """
SELECT 'grid_load' AS table_name, count(*) AS n_rows, min(ts) AS min_ts, max(ts) AS max_ts FROM fx_grid_load
UNION ALL SELECT 'weather', count(*), min(ts), max(ts) FROM fx_weather
UNION ALL SELECT 'spp_prices', count(*), min(ts), max(ts) FROM fx_spp_prices
UNION ALL SELECT 'model_metrics', count(*), min(ts), max(ts) FROM fx_metrics""")
def _(v):
    return aggregates.table_stats({"grid_load": v.load, "weather": v.weather, "spp_prices": v.prices,
                                   "model_metrics": v.metrics})


@query("a8_severity_counts", "severity n", "", "SELECT severity, count(*) AS n FROM h_alerts GROUP BY severity")
def _(v):
    return aggregates.severity_counts(alert_table(v))


@query("a9_distinct_zones", "zones several", "",
       "SELECT count(DISTINCT zone) AS zones, count(DISTINCT zone) > 1 AS several FROM fx_weather")
def _(v):
    return aggregates.distinct_zones(v.weather)


@query("a10_score_threshold", "n", "threshold",
       "SELECT count(*) AS n, quantile_cont(abs(y - y_hat), 0.98) AS threshold FROM fx_pred")
def _(v):
    scores = v.pred.select(F.abs(F.col("y") - F.col("y_hat")).alias("score"))
    threshold = ordered.exact_percentile(scores, "score", 0.98)
    return scores.agg(F.count("score").alias("n")).withColumn("threshold", F.lit(threshold))


@query("a11_readiness", "settlement_point market_type n_rows n_values training_frame tree_baseline price_training "
       "price_serving anomaly_serving latest_window", "", """
SELECT settlement_point, market_type, count(*) AS n_rows, count(price) AS n_values, count(*) >= 100 AS training_frame,
  count(*) >= 51 AS tree_baseline, count(price) >= 100 AS price_training, count(price) >= 24 AS price_serving,
  count(*) >= 48 AS anomaly_serving, count(*) >= 24 AS latest_window
FROM (SELECT *, CASE WHEN price_usd_mwh > 100 THEN price_usd_mwh END AS price FROM fx_spp_prices) GROUP BY 1, 2""")
def _(v):
    rows = v.prices.withColumn("price", F.when(F.col("price_usd_mwh") > 100, F.col("price_usd_mwh")))
    return aggregates.readiness(rows, ["settlement_point", "market_type"], "price")


_GATED = ["price_usd_mwh", "high", "load_mw", "never", "no_such_column"]


@query("a11_feature_gate", "settlement_point market_type n_features n_rows ready", "", """
SELECT settlement_point, market_type, 1 + (count(high) > 0)::INT + (count(load_mw) > 0)::INT AS n_features,
  count(*) FILTER ((high IS NOT NULL OR NOT any_high) AND (load_mw IS NOT NULL OR NOT any_load)) AS n_rows,
  1 + (count(high) > 0)::INT + (count(load_mw) > 0)::INT >= 3 AND count(*) FILTER (
    (high IS NOT NULL OR NOT any_high) AND (load_mw IS NOT NULL OR NOT any_load)) >= 72 AS ready
FROM (SELECT *, count(high) OVER o > 0 AS any_high, count(load_mw) OVER o > 0 AS any_load FROM (
        SELECT p.settlement_point, p.market_type, p.price_usd_mwh, g.load_mw,
               CASE WHEN p.price_usd_mwh > 100 AND p.settlement_point <> 'HB_WEST' THEN p.price_usd_mwh END AS high
        FROM fx_spp_prices p LEFT JOIN (SELECT * FROM fx_grid_load WHERE load_mw > 200000) g
          ON date_trunc('hour', p.ts) = g.ts)
      WINDOW o AS (PARTITION BY settlement_point, market_type)) GROUP BY 1, 2""")
def _(v):
    price = F.col("price_usd_mwh")
    busy = v.load.where("load_mw > 200000").select(F.col("ts").alias("_hour"), "load_mw")
    rows = (v.prices.withColumns({"_hour": fn.hour_of("ts"), "never": F.lit(float("nan")),
                                  "high": F.when((price > 100) & (F.col("settlement_point") != "HB_WEST"), price)})
            .join(busy, "_hour", "left"))
    return aggregates.feature_gate(rows, SERIES, _GATED)


# Ordered operators over every price row, per hub and market -------------------------------------

SERIES = ["settlement_point", "market_type"]
ORDER = ["ts", "event_id"]
_W = "PARTITION BY settlement_point, market_type ORDER BY ts, event_id"


def _price_windows(v, build, back=0, ahead=0):
    return ordered.positional(v.prices, SERIES, ORDER, build, back, ahead)


@query("w1_lags", "event_id", "price_lag_1h price_lag_24h price_lag_168h", f"""
SELECT event_id, lag(price_usd_mwh, 1) OVER w AS price_lag_1h, lag(price_usd_mwh, 24) OVER w AS price_lag_24h,
  lag(price_usd_mwh, 168) OVER w AS price_lag_168h FROM fx_spp_prices WINDOW w AS ({_W})""")
def _(v):
    return _price_windows(v, lambda w: ordered.lags(w, "price_usd_mwh", [1, 24, 168], "price_lag"), back=168)


@query("w2_rolling_mean", "event_id", "mean_6 mean_24", f"""
SELECT event_id, avg(price_usd_mwh) OVER ({_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS mean_6,
  avg(price_usd_mwh) OVER ({_W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS mean_24 FROM fx_spp_prices""")
def _(v):
    return _price_windows(v, lambda w: {"mean_6": ordered.rolling_mean(w, "price_usd_mwh", 6),
                                        "mean_24": ordered.rolling_mean(w, "price_usd_mwh", 24)}, back=23)


def _full_sql(name, call, frame):
    window = f"({_W} ROWS BETWEEN {frame})"
    return (f"SELECT event_id, CASE WHEN count(price_usd_mwh) OVER {window} = 24 THEN {call}(price_usd_mwh) "
            f"OVER {window} END AS {name} FROM fx_spp_prices")


@query("w3_rolling_mean_full", "event_id", "mean_24", _full_sql("mean_24", "avg", "23 PRECEDING AND CURRENT ROW"))
def _(v):
    return _price_windows(v, lambda w: {"mean_24": ordered.rolling_mean_full(w, "price_usd_mwh", 24)}, back=23)


@query("w4_past_rolling_mean", "event_id", "mean_24", _full_sql("mean_24", "avg", "24 PRECEDING AND 1 PRECEDING"))
def _(v):
    return _price_windows(v, lambda w: {"mean_24": ordered.past_rolling_mean(w, "price_usd_mwh", 24)}, back=24)


@query("w5_rolling_std", "event_id", "std_24", _full_sql("std_24", "stddev_samp", "23 PRECEDING AND CURRENT ROW"))
def _(v):
    return _price_windows(v, lambda w: {"std_24": ordered.rolling_std(w, "price_usd_mwh", 24)}, back=23)


def interpolate_sql(source, value, keys, series, order):
    """Interpolation by the neighbouring known rows' positions."""
    part = f"PARTITION BY {series} " if series else ""
    return f"""
SELECT *, CASE WHEN v IS NOT NULL THEN v WHEN pa IS NULL THEN NULL WHEN pb IS NULL THEN va
  ELSE va + (vb - va) * (nr - pa) / (pb - pa) END AS filled
FROM (SELECT *, max(CASE WHEN v IS NOT NULL THEN nr END) OVER back AS pa,
        last_value(v IGNORE NULLS) OVER back AS va,
        min(CASE WHEN v IS NOT NULL THEN nr END) OVER ahead AS pb,
        first_value(v IGNORE NULLS) OVER ahead AS vb
      FROM (SELECT {keys}, {value} AS v, row_number() OVER ({part}ORDER BY {order}) AS nr FROM {source})
      WINDOW back AS ({part}ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             ahead AS ({part}ORDER BY nr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


helper("h_price_gaps", interpolate_sql(
    "fx_spp_prices", "CASE WHEN event_id % 4 = 1 THEN price_usd_mwh END", "*",
    "settlement_point, market_type", "ts, event_id"))


@query("w6_interpolate_linear", "event_id", "price_usd_mwh",
       "SELECT event_id, filled AS price_usd_mwh FROM h_price_gaps")
def _(v):
    gaps = v.prices.withColumn("price_usd_mwh", F.when(F.col("event_id") % 4 == 1, F.col("price_usd_mwh")))
    return ordered.interpolate_linear(gaps, SERIES, ORDER, "price_usd_mwh")


helper("h_price_grid", """
SELECT s.settlement_point, s.market_type, s.ts, p.price_usd_mwh
FROM (SELECT settlement_point, market_type, unnest(generate_series(
        date_trunc('hour', min(ts))::TIMESTAMP, date_trunc('hour', max(ts))::TIMESTAMP, INTERVAL 1 HOUR)) AS ts
      FROM fx_spp_prices GROUP BY settlement_point, market_type) s
LEFT JOIN (SELECT date_trunc('hour', ts) AS ts, settlement_point, market_type,
             arg_min(price_usd_mwh, (ts, event_id)) AS price_usd_mwh FROM fx_spp_prices GROUP BY ALL) p
ON s.ts = p.ts AND s.settlement_point = p.settlement_point AND s.market_type = p.market_type""")


def _price_grid(v):
    return resample.resample_first(v.prices, ["price_usd_mwh"], SERIES, order=["event_id"])


@query("w7_ffill", "settlement_point market_type ts", "price_usd_mwh", """
SELECT settlement_point, market_type, ts, last_value(price_usd_mwh IGNORE NULLS) OVER (
  PARTITION BY settlement_point, market_type ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS price_usd_mwh
FROM h_price_grid""")
def _(v):
    return resample.ffill_hourly(_price_grid(v), ["price_usd_mwh"], SERIES)


@query("w9_latest_row", "settlement_point market_type ts event_id", "price_usd_mwh", """
SELECT * FROM fx_spp_prices QUALIFY row_number() OVER (
  PARTITION BY settlement_point, market_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(v):
    return ordered.latest_per_key(v.prices, SERIES, ORDER)


@query("w10_metric_history", "metric_id model_name ts", "metric_value",
       "SELECT metric_id, model_name, ts, metric_value FROM fx_metrics WHERE metric_name = 'mape'")
def _(v):
    return ordered.metric_history(v.metrics, "mape")


# Resampling -----------------------------------------------------------------------------------

@query("t1_resample_first", "settlement_point market_type ts", "price_usd_mwh", "SELECT * FROM h_price_grid")
def _(v):
    return _price_grid(v)


@query("t2_hour_spine", "settlement_point market_type ts", "",
       "SELECT settlement_point, market_type, ts FROM h_price_grid")
def _(v):
    return resample.hour_spine(v.prices, SERIES)


helper("h_training", f"""
SELECT s.ts, {', '.join(f'last_value({c} IGNORE NULLS) OVER w AS {c}' for c in
                        ['load_mw', 'forecast_mw', 'grid_stress', *_WX.split(), 'price_usd_mwh'])}
FROM (SELECT unnest(generate_series(date_trunc('hour', lo)::TIMESTAMP, date_trunc('hour', hi)::TIMESTAMP,
                                    INTERVAL 1 HOUR)) AS ts
      FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM (
        SELECT ts FROM fx_grid_load UNION ALL SELECT ts FROM h_zone_avg UNION ALL SELECT ts FROM h_houston_dam))) s
LEFT JOIN (SELECT *, load_mw - forecast_mw AS grid_stress FROM fx_grid_load) g ON s.ts = g.ts
LEFT JOIN h_zone_avg z ON s.ts = z.ts
LEFT JOIN (SELECT date_trunc('hour', ts) AS ts, arg_min(price_usd_mwh, ts) AS price_usd_mwh
           FROM h_houston_dam GROUP BY 1) p ON s.ts = p.ts
WINDOW w AS (ORDER BY s.ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
TRAINING = f"load_mw forecast_mw grid_stress {_WX} price_usd_mwh"


@query("t3_build_training_frame", "ts", TRAINING, "SELECT * FROM h_training")
def training(v):
    return q.training_frame(v.load, v.weather, v.prices, days=90, as_of=AS_OF)


# Ordering, limits, unions -----------------------------------------------------------------------

@query("o1_time_ordered", "event_id ts", "price_usd_mwh", "SELECT event_id, ts, price_usd_mwh FROM fx_spp_prices")
def _(v):
    return reports.time_ordered(v.prices, ties=["event_id"])


@query("o2_recent_top", "event_id ts", "price_usd_mwh",
       "SELECT event_id, ts, price_usd_mwh FROM fx_spp_prices ORDER BY ts DESC, event_id DESC LIMIT 200")
def _(v):
    return reports.recent_top(v.prices, ties=["event_id"])


@query("o3_caps", "report event_id ts", "", """
SELECT 'outages' AS report, event_id, ts FROM (SELECT * FROM fx_conditions ORDER BY ts DESC, event_id DESC LIMIT 100)
UNION ALL SELECT 'anomalies_stored', event_id, ts FROM (SELECT * FROM fx_conditions ORDER BY ts, event_id LIMIT 50)
UNION ALL SELECT 'week_of_hours', event_id, ts FROM (SELECT * FROM fx_conditions ORDER BY ts, event_id LIMIT 168)
UNION ALL SELECT 'banner', event_id, ts FROM (SELECT * FROM fx_conditions ORDER BY ts DESC, event_id DESC LIMIT 3)""")
def _(v):
    def part(name, rows):
        return rows.select(F.lit(name).alias("report"), "event_id", "ts")

    rows = v.conditions
    return reports.union_records([
        part("outages", reports.recent_top(rows, reports.REPORT_ROWS["outages"], ties=["event_id"])),
        part("anomalies_stored", reports.oldest_top(rows, reports.REPORT_ROWS["anomalies_stored"], ties=["event_id"])),
        part("week_of_hours", reports.oldest_top(rows, reports.REPORT_ROWS["week_of_hours"], ties=["event_id"])),
        part("banner", reports.recent_top(rows, reports.REPORT_ROWS["banner"], ties=["event_id"]))])


@query("o4_union_by_name", "model_name horizon ts", "y_hat", """
SELECT m.model_name, p.horizon, p.ts, p.y_hat FROM (VALUES ('A'), ('N'), ('R'), ('absent')) m(model_name)
LEFT JOIN (SELECT model_name, 1 AS horizon, max(ts) AS ts, max(y_hat) AS y_hat FROM fx_pred WHERE horizon = 1 GROUP BY 1
           UNION ALL SELECT model_name, NULL, max(ts), NULL FROM fx_pred WHERE horizon = 24 GROUP BY 1) p
ON m.model_name = p.model_name""")
def _(v):
    one = v.pred.where("horizon = 1").groupBy("model_name").agg(
        F.max("ts").alias("ts"), F.max("y_hat").alias("y_hat")).withColumn("horizon", F.lit(1))
    other = v.pred.where("horizon = 24").groupBy("model_name").agg(F.max("ts").alias("ts"))
    return reports.with_absent(reports.union_records([one, other]), ["A", "N", "R", "absent"])


# Evaluation -------------------------------------------------------------------------------------

_BY = ["model_name", "horizon"]


def _metric(name, sql, make):
    @query(name, "model_name horizon", "value",
           f"SELECT model_name, horizon, {sql} AS value FROM fx_pred GROUP BY model_name, horizon")
    def _(v):
        return v.pred.groupBy(*_BY).agg(make().alias("value"))


_metric("e1_mape", "avg(abs((y - y_hat) / (y + 1e-8))) * 100", ev.mape)
_metric("e2_mape_fraction", "avg(abs(y - y_hat) / greatest(abs(y), 2.220446049250313e-16))", ev.mape_fraction)
_metric("e3_mae", "avg(abs(y - y_hat))", ev.mae)


@query("e4_mbe", "model_name horizon bias", "value", """
SELECT *, CASE WHEN value > 0 THEN 'under-predicts' WHEN value < 0 THEN 'over-predicts' ELSE 'unbiased' END AS bias
FROM (SELECT model_name, horizon, avg(y - y_hat) AS value FROM fx_pred GROUP BY ALL)""")
def _(v):
    rows = v.pred.groupBy(*_BY).agg(ev.mbe().alias("value"))
    return rows.withColumn("bias", ev.bias_label(F.col("value")))


@query("e5_huber_mse", "model_name horizon", "huber mse", """
SELECT model_name, horizon, avg((y / 1000 - y_hat / 1000) ** 2) AS mse,
  avg(CASE WHEN abs(y / 1000 - y_hat / 1000) <= 2.0 THEN 0.5 * (y / 1000 - y_hat / 1000) ** 2
           ELSE 2.0 * (abs(y / 1000 - y_hat / 1000) - 1.0) END) AS huber FROM fx_pred GROUP BY ALL""")
def _(v):
    rows = v.pred.withColumns({"y": F.col("y") / 1000, "y_hat": F.col("y_hat") / 1000})
    return rows.groupBy(*_BY).agg(ev.huber(2.0).alias("huber"), ev.mse().alias("mse"))


@query("e6_metric_rows", "model_name horizon metric_name", "metric_value", """
SELECT model_name, horizon, 'mape' AS metric_name, avg(abs((y - y_hat) / (y + 1e-8))) * 100 AS metric_value
FROM fx_pred GROUP BY ALL
UNION ALL SELECT model_name, horizon, 'mae', avg(abs(y - y_hat)) FROM fx_pred GROUP BY ALL""")
def _(v):
    return ev.metric_rows(v.pred)


@query("e6_hub_metrics", "model_name horizon metric_name notes", "metric_value", """
SELECT model_name, horizon, 'mape' AS metric_name, avg(abs((y - y_hat) / (y + 1e-8))) * 100 AS metric_value,
  'settlement_point=HB_' || (l_orderkey % 5) AS notes FROM fx_pred GROUP BY ALL
UNION ALL SELECT model_name, horizon, 'mae', avg(abs(y - y_hat)), 'settlement_point=HB_' || (l_orderkey % 5)
FROM fx_pred GROUP BY ALL""")
def _(v):
    """Errors of models per hub, whose notes say which hub."""
    rows = v.pred.withColumn("settlement_point", F.concat(F.lit("HB_"), (F.col("l_orderkey") % 5).cast("string")))
    return ev.hub_notes(ev.metric_rows(rows, ["model_name", "horizon", "settlement_point"]))


@query("e7_residual_table", "l_orderkey l_linenumber ts", "actual predicted residual", """
SELECT l_orderkey, l_linenumber, ts, y AS actual, y_hat AS predicted, y - y_hat AS residual FROM fx_pred""")
def _(v):
    return ev.residual_table(v.pred, ["l_orderkey", "l_linenumber", "ts"])
