"""Registered queries: feature frames, windows, forecasts, anomalies and rules."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gridlens import schemas
from gridlens.functions import scalars as fn
from gridlens.operators import aggregates, blocks
from gridlens.operators import datasets as ds
from gridlens.operators import detect, forecast, joins, ordered, reports
from gridlens.operators import evaluate as ev

from gridlens.plans.catalog_series import ORDER, SERIES, _two_models, interpolate_sql

from gridlens.plans.registry import helper, query
from gridlens.session import materialise, scratch_path

READING_ORDER = ("ts", "event_id")
TAU = "2 * pi()"

# Feature frames over every reading, one long series ----------------------------------------

helper("h_readings_filled", interpolate_sql("fx_readings", "nullif(load_mw, 0)", "*", "", "ts, event_id"))
helper("h_engineered", f"""
SELECT * FROM (
  SELECT ts, event_id, load_mw, forecast_mw, temperature_2m, wind_speed_10m, direct_radiation, Wind, Solar,
    CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week, CAST(month(ts) AS INT) AS month,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    sin({TAU} * hour(ts) / 24) AS hour_sin, cos({TAU} * hour(ts) / 24) AS hour_cos,
    sin({TAU} * (isodow(ts) - 1) / 7) AS dow_sin, cos({TAU} * (isodow(ts) - 1) / 7) AS dow_cos,
    sin({TAU} * month(ts) / 12) AS month_sin, cos({TAU} * month(ts) / 12) AS month_cos,
    lag(load_mw, 1) OVER w AS load_lag_1h, lag(load_mw, 24) OVER w AS load_lag_24h, lag(load_mw, 168) OVER w AS load_lag_168h,
    avg(load_mw) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS load_rolling_6h,
    avg(load_mw) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS load_rolling_24h,
    load_mw - forecast_mw AS grid_stress, temperature_2m * temperature_2m AS temp_squared,
    coalesce(Wind, 0) + coalesce(Solar, 0) AS Renewables, load_mw - (coalesce(Wind, 0) + coalesce(Solar, 0)) AS Net_Load
  FROM (SELECT * EXCLUDE (load_mw), filled AS load_mw FROM h_readings_filled WHERE filled > 10000)
  WINDOW w AS (ORDER BY ts, event_id))
WHERE load_mw > 20000 AND load_lag_1h IS NOT NULL AND load_lag_24h IS NOT NULL""")
_M1 = ("load_mw forecast_mw hour_sin hour_cos dow_sin dow_cos month_sin month_cos load_lag_1h load_lag_24h "
       "load_lag_168h load_rolling_6h load_rolling_24h grid_stress temp_squared Renewables Net_Load")


def engineered(v):
    return ds.engineer_load(v.readings, order=READING_ORDER)


@query("m1_engineer_load", "ts event_id hour day_of_week month is_weekend", _M1, "SELECT * FROM h_engineered")
def engineer_load(v):
    return engineered(v)


helper("h_price_rows", """
SELECT p.settlement_point, p.market_type, p.ts, p.event_id, p.price_usd_mwh, g.load_mw
FROM fx_spp_prices p JOIN fx_grid_load g ON date_trunc('hour', p.ts) = g.ts""")


def _price_rows(v):
    hourly = v.load.select(F.col("ts").alias("_hour"), "load_mw")
    return (v.prices.withColumn("_hour", fn.hour_of("ts")).join(hourly, "_hour").drop("_hour")
            .select(*SERIES, "ts", "event_id", "price_usd_mwh", "load_mw"))


_PW = "PARTITION BY settlement_point, market_type ORDER BY ts, event_id"


@query("m2_engineer_price", "event_id hour day_of_week is_weekend",
       "price_usd_mwh load_mw hour_sin hour_cos price_lag_1h price_lag_24h price_lag_168h price_rolling_24h load_lag_1h", f"""
SELECT * FROM (
  SELECT event_id, price_usd_mwh, load_mw, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    sin({TAU} * hour(ts) / 24) AS hour_sin, cos({TAU} * hour(ts) / 24) AS hour_cos,
    lag(price_usd_mwh, 1) OVER w AS price_lag_1h, lag(price_usd_mwh, 24) OVER w AS price_lag_24h,
    lag(price_usd_mwh, 168) OVER w AS price_lag_168h,
    avg(price_usd_mwh) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS price_rolling_24h,
    lag(load_mw, 1) OVER w AS load_lag_1h
  FROM h_price_rows WINDOW w AS ({_PW}))
WHERE price_lag_168h IS NOT NULL""")
def _(v):
    return ds.engineer_price(_price_rows(v), SERIES, ORDER)


_SEASON = f"""sin({TAU} * month(ts) / 12) AS month_sin, cos({TAU} * month(ts) / 12) AS month_cos,
    sin({TAU} * weekofyear(ts) / 52) AS week_sin, cos({TAU} * weekofyear(ts) / 52) AS week_cos,
    sin({TAU} * hour(ts) / 24) AS hour_sin, sin({TAU} * (isodow(ts) - 1) / 7) AS day_sin,
    temperature_2m * sin({TAU} * month(ts) / 12) AS temp_x_month"""


def _past_mean(column):
    window = "(w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({column}) OVER {window} = 24 THEN avg({column}) OVER {window} END"


@query("m3_engineer_seasonal", "ts event_id",
       "load_mw month_sin month_cos week_sin week_cos hour_sin day_sin load_rolling_mean_24h temp_x_month", f"""
SELECT * FROM (SELECT ts, event_id, load_mw, {_SEASON}, {_past_mean('load_mw')} AS load_rolling_mean_24h
               FROM (SELECT * FROM h_engineered WHERE load_lag_168h IS NOT NULL) WINDOW w AS (ORDER BY ts, event_id))
WHERE load_rolling_mean_24h IS NOT NULL""")
def _(v):
    rows = engineered(v).drop("forecast_mw", "grid_stress", "Wind", "Solar")
    return ds.engineer_seasonal(rows.where(F.col("load_lag_168h").isNotNull()), order=READING_ORDER)


def _full_mean(column):
    window = "(w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {window} = 24 THEN avg({column}) OVER {window} END"


@query("m4_engineer_renewable", "ts",
       "load_mw month_sin week_cos hour_sin load_lag_24h load_rolling_mean_24h solar_rolling_24h wind_rolling_24h "
       "wind_power_proxy temp_x_month", f"""
SELECT * FROM (
  SELECT ts, avg(load_mw) AS load_mw, avg(month_sin) AS month_sin, avg(week_cos) AS week_cos, avg(hour_sin) AS hour_sin,
    avg(load_lag_24h) AS load_lag_24h, avg(load_rolling_mean_24h) AS load_rolling_mean_24h,
    avg(solar_rolling_24h) AS solar_rolling_24h, avg(wind_rolling_24h) AS wind_rolling_24h,
    avg(wind_power_proxy) AS wind_power_proxy, avg(temp_x_month) AS temp_x_month
  FROM (SELECT ts, load_mw, {_SEASON}, lag(load_mw, 24) OVER w AS load_lag_24h,
          {_past_mean('load_mw')} AS load_rolling_mean_24h, {_full_mean('direct_radiation')} AS solar_rolling_24h,
          {_full_mean('wind_speed_10m')} AS wind_rolling_24h,
          wind_speed_10m * wind_speed_10m * wind_speed_10m AS wind_power_proxy
        FROM fx_readings WINDOW w AS (ORDER BY ts, event_id))
  WHERE load_rolling_mean_24h IS NOT NULL GROUP BY ts)
WHERE load_mw > 10000""")
def _(v):
    return ds.engineer_renewable(v.readings.drop("forecast_mw", "Wind", "Solar"), order=READING_ORDER)


helper("h_split", f"""
SELECT *, row_number() OVER ({_PW}) - 1 AS rn, count(*) OVER (PARTITION BY settlement_point, market_type) AS n
FROM fx_spp_prices""")


@query("m5_chrono_split", "event_id is_train", "",
       "SELECT event_id, rn < floor(n * 0.85::DOUBLE) AS is_train FROM h_split")
def chrono_split(v):
    return ordered.chrono_split(v.prices, SERIES, ORDER)


def _scaled_rows(v):
    rows = v.weather.withColumns({"flat": F.lit(3.0), "relative_humidity": fn.or_zero("relative_humidity")})
    return rows, rows.where(F.col("ts") < F.lit("2024-01-25").cast("timestamp"))


_SCALED = ["temperature_2m", "wind_speed_10m", "relative_humidity", "flat"]


@query("m6_standard_scale", "ts zone", " ".join(_SCALED), """
SELECT ts, zone, (temperature_2m - tm) / td AS temperature_2m, (wind_speed_10m - wm) / wd AS wind_speed_10m,
  (coalesce(relative_humidity, 0) - hm) / hd AS relative_humidity, 0.0 AS flat
FROM fx_weather, (SELECT avg(temperature_2m) AS tm, stddev_pop(temperature_2m) AS td, avg(wind_speed_10m) AS wm,
  stddev_pop(wind_speed_10m) AS wd, avg(coalesce(relative_humidity, 0)) AS hm,
  stddev_pop(coalesce(relative_humidity, 0)) AS hd FROM fx_weather WHERE ts < TIMESTAMP '2024-01-25')""")
def _(v):
    rows, train = _scaled_rows(v)
    return ds.fit_scaler(train, _SCALED).transform(rows)


@query("m7_target_scale", "event_id", "scaled restored", """
SELECT event_id, (price_usd_mwh - m) / greatest(s, 1e-6) AS scaled, price_usd_mwh AS restored
FROM fx_spp_prices, (SELECT avg(price_usd_mwh) AS m, stddev_pop(price_usd_mwh) AS s FROM fx_spp_prices)""")
def _(v):
    scale = ds.fit_target(v.prices, "price_usd_mwh")
    scaled = v.prices.withColumn("scaled", scale.scaled("price_usd_mwh"))
    return scaled.withColumn("restored", scale.restored("scaled"))


helper("h_windows", f"""
SELECT settlement_point, market_type, rn AS window_id, n - 24 AS n_windows, lead(ts, 23) OVER w AS window_ts,
  lead(ts, 24) OVER w AS target_ts, lead(price_usd_mwh, 24) OVER w AS y, price_usd_mwh AS x_first,
  lead(price_usd_mwh, 23) OVER w AS x_last,
  sum(price_usd_mwh) OVER (w ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING) AS x_sum
FROM h_split WINDOW w AS ({_PW})""")


def _price_windows(v):
    rows = v.prices.withColumn("offset", F.col("price_usd_mwh") + 1)
    return ds.sliding_windows(rows, ["price_usd_mwh", "offset"], "price_usd_mwh", SERIES, ORDER)


@query("m8_sliding_windows", "settlement_point market_type window_id window_ts target_ts n_windows",
       "y x_first x_last x_sum", "SELECT * FROM h_windows WHERE window_id + 24 < n_windows + 24")
def _(v):
    first = F.transform("x", lambda r: r[0])
    return _price_windows(v).withColumns({
        "x_first": F.col("x")[0][1] - 1, "x_last": F.col("x")[23][0],
        "x_sum": F.aggregate(first, F.lit(0.0), lambda a, b: a + b)})


@query("m9_window_split", "settlement_point market_type window_id is_train", "", """
SELECT settlement_point, market_type, window_id, window_id < floor(n_windows * 0.85::DOUBLE) AS is_train
FROM h_windows WHERE window_id < n_windows""")
def _(v):
    return ds.window_split(_price_windows(v))


_GRAPH = ["load_mw", "temperature_2m", "wind_speed_10m", "direct_radiation"]


def _graph_sql(columns, source):
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, "
        + ("1.0" if a == b else f"least(1.0, abs(coalesce(corr({a}, {b}), 0.0)))") + f" AS w FROM {source}"
        for a in columns for b in columns)
    return f"SELECT DISTINCT i, j, w FROM ({cells})"


@query("m10_correlation_graph", "i j", "w", _graph_sql(_GRAPH, "fx_readings"))
def _(v):
    return ds.correlation_graph(v.readings, _GRAPH)


def _smooth_sql():
    names = {a: f"c{k}" for k, a in enumerate(_GRAPH)}
    pairs = [(a, b) for k, a in enumerate(_GRAPH) for b in _GRAPH[k + 1:]]
    weights = ", ".join(f"abs(corr({a}, {b})) AS {names[a]}_{names[b]}" for a, b in pairs)

    def weight(a, b):
        if a == b:
            return "1.0"
        return f"{names[a]}_{names[b]}" if (a, b) in pairs else f"{names[b]}_{names[a]}"

    cells = ", ".join(
        "(" + " + ".join(f"{weight(a, b)} * {b}" for b in _GRAPH) + ") / ("
        + " + ".join(weight(a, b) for b in _GRAPH) + f" + 1e-8) AS nb_{a}" for a in _GRAPH)
    return f"SELECT event_id, {cells} FROM fx_readings, (SELECT {weights} FROM fx_readings)"


@query("m11_graph_smooth", "event_id", " ".join(f"nb_{c}" for c in _GRAPH), _smooth_sql())
def _(v):
    graph = ds.collect_graph(ds.correlation_graph(v.readings, _GRAPH))
    return ds.graph_smooth(v.readings, graph)


@query("m12_latest_window", "settlement_point market_type window_ts n", "x_first x_last x_sum", f"""
SELECT settlement_point, market_type, max(ts) AS window_ts, count(*) AS n, arg_min(price_usd_mwh, ts) AS x_first,
  arg_max(price_usd_mwh, ts) AS x_last, sum(price_usd_mwh) AS x_sum
FROM (SELECT * FROM fx_spp_prices QUALIFY row_number() OVER (
  PARTITION BY settlement_point, market_type ORDER BY ts DESC) <= 24) GROUP BY settlement_point, market_type""")
def _(v):
    latest = ds.latest_window(v.prices, ["price_usd_mwh"], SERIES)
    values = F.transform("x", lambda r: r[0])
    return latest.withColumns({
        "n": F.size("x").cast("long"), "x_first": F.col("x")[0][0], "x_last": F.col("x")[23][0],
        "x_sum": F.aggregate(values, F.lit(0.0), lambda a, b: a + b)})


# Forecasts ----------------------------------------------------------------------------------

def _split_readings(v):
    rows = ordered.chrono_split(materialise(engineered(v), "engineered"), [], READING_ORDER)
    return materialise(rows, "split")


@query("f1_fit_boosted_load", "metric", "value")
def _(v):
    rows = _split_readings(v)
    model = forecast.fit_boosted_load(rows, schemas.TREE_FEATURES)
    scored = model.predict(rows.where(~F.col("is_train")))
    return scored.agg(ev.mape("load_mw").alias("mape"), ev.mae("load_mw").alias("mae")).unpivot(
        [], ["mape", "mae"], "metric", "value")


_WINDOW = schemas.LOAD_FEATURES


def _smoothed(v):
    """Scaled readings with their neighbour means, the scaler fitted on training rows only."""
    rows = _split_readings(v)
    scaler = ds.fit_scaler(rows.where("is_train"), _WINDOW)
    graph = ds.collect_graph(ds.correlation_graph(rows, _WINDOW))
    return forecast.smoothed_features(rows.withColumn("target", F.col("load_mw")), scaler, graph)


@query("f2_fit_graph_load", "horizon metric", "value")
def _(v):
    """Errors over the windows after the training windows, by horizon."""
    smooth, names = _smoothed(v)
    packed = blocks.pack(smooth, [*names, "target"], order=READING_ORDER, horizon=max(forecast.HORIZONS))
    parts = []
    for model in forecast.fit_window_loads(packed, names, "target", forecast.HORIZONS):
        scored = forecast.window_forecasts(packed, model, "target").where(~F.col("is_train"))
        parts.append(scored.agg(ev.mape("y").alias("mape"), ev.mae("y").alias("mae"))
                     .withColumn("horizon", F.lit(model.horizon)))
    return reports.union_records(parts).unpivot(["horizon"], ["mape", "mae"], "metric", "value")


@query("f2_fit_one_feature", "n", "intercept slope", """
SELECT count(*) AS n, regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope
FROM (SELECT price_usd_mwh AS x, lead(price_usd_mwh, 1) OVER o AS y, row_number() OVER o - 1 AS rn,
             count(*) OVER () - 1 AS windows
      FROM fx_spp_prices WHERE price_usd_mwh IS NOT NULL WINDOW o AS (ORDER BY ts, event_id))
WHERE rn < floor(windows * 0.85::DOUBLE)""")
def _(v):
    """The window regression where it has a closed form: one row, one feature, squared loss."""
    packed = blocks.pack(v.prices, ["price_usd_mwh"], order=ORDER, seq_len=1, horizon=1)
    fitted = forecast.fit_window_load(packed, ["price_usd_mwh"], "price_usd_mwh", 1, loss="squared", penalty=0.0)
    scored = forecast.window_forecasts(packed, fitted, "price_usd_mwh")
    return scored.where("is_train").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"intercept": F.lit(fitted.intercept), "slope": F.lit(float(fitted.coefficients[0]))})


def _targets_sql():
    return " UNION ALL ".join(
        f"SELECT *, {h} AS horizon, lead(price_usd_mwh, {h}) OVER ({_PW}) AS y FROM fx_spp_prices"
        for h in forecast.HORIZONS)


helper("h_price_targets", _targets_sql())


def _price_models(v):
    rows = forecast.with_targets(v.prices, "price_usd_mwh", SERIES, ORDER)
    # Written, so that the join with the facts knows how small the models are.
    return rows, materialise(forecast.fit_price(rows, ["price_usd_mwh"], SERIES), "models")


@query("f3_fit_price", "settlement_point market_type horizon n", "intercept slope", """
SELECT settlement_point, market_type, horizon, count(y) AS n, regr_intercept(y, price_usd_mwh) AS intercept,
  regr_slope(y, price_usd_mwh) AS slope FROM h_price_targets WHERE y IS NOT NULL GROUP BY 1, 2, 3 HAVING count(y) >= 72""")
def _(v):
    return _price_models(v)[1].withColumn("slope", F.col("coefficients")[0])


@query("f4_predict", "event_id horizon", "y_hat", """
SELECT p.event_id, m.horizon, m.a + m.b * p.price_usd_mwh AS y_hat FROM fx_spp_prices p
JOIN (SELECT settlement_point, market_type, horizon, regr_intercept(y, price_usd_mwh) AS a, regr_slope(y, price_usd_mwh) AS b
      FROM h_price_targets WHERE y IS NOT NULL GROUP BY 1, 2, 3 HAVING count(y) >= 72) m
ON p.settlement_point = m.settlement_point AND p.market_type = m.market_type""")
def _(v):
    rows, models = _price_models(v)
    return forecast.predict_price(rows, models, ["price_usd_mwh"], SERIES)


def _price_features(v):
    """All price features on every price row; the hour's weather is the mean of its zones."""
    weather = aggregates.zone_average(v.weather, humidity=False)
    rows = _price_rows(v).withColumn("_hour", fn.hour_of("ts"))
    rows = rows.join(weather.withColumnRenamed("ts", "_hour"), "_hour").drop("_hour")
    return materialise(ds.engineer_price(rows, SERIES, ORDER), "price_features")


def _price_blocks(v, series, seq_len=24):
    return blocks.pack(_price_features(v), schemas.PRICE_FEATURES, series, ORDER, seq_len, max(forecast.HORIZONS))


def _price_window_models(packed):
    """A model per series and horizon, fitted on the training windows of 24 rows."""
    models = blocks.fit_ridge(packed, schemas.PRICE_FEATURES, "price_usd_mwh", forecast.HORIZONS, ratio=0.85)
    return materialise(models, "models")


def _short(models):
    return models.withColumn("coefficients", F.transform("coefficients", lambda c: F.round(c, 8)))


@query("f3_fit_price_windows", "settlement_point market_type horizon n coefficients", "intercept")
def _(v):
    return _short(_price_window_models(_price_blocks(v, SERIES)))


helper("h_two_rows", f"""
SELECT settlement_point, market_type, h.horizon, y, x1, x2 FROM (
  SELECT settlement_point, market_type, price_usd_mwh AS x1, lead(price_usd_mwh, 1) OVER w AS x2,
         lead(price_usd_mwh, 2) OVER w AS y1, lead(price_usd_mwh, 25) OVER w AS y24 FROM fx_spp_prices WINDOW w AS ({_PW})),
  LATERAL (SELECT unnest([1, 24]) AS horizon, unnest([y1, y24]) AS y) h WHERE y IS NOT NULL""")
helper("h_two_row_models", """
SELECT settlement_point, market_type, horizon, n, b1, b2, my - b1 * m1 - b2 * m2 AS intercept FROM (
  SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM (
    SELECT settlement_point, market_type, horizon, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
      covar_pop(y, x1) AS c1, covar_pop(y, x2) AS c2, covar_pop(x1, x2) AS v12, var_pop(x1) AS v1, var_pop(x2) AS v2
    FROM h_two_rows GROUP BY 1, 2, 3 HAVING count(*) >= 72))""")


def _two_row_models(v):
    packed = blocks.pack(v.prices, ["price_usd_mwh"], SERIES, ORDER, 2, max(forecast.HORIZONS))
    models = blocks.fit_ridge(packed, ["price_usd_mwh"], "price_usd_mwh", forecast.HORIZONS, penalty=0.0)
    return packed, materialise(models, "models")


@query("f3_fit_two_rows", "settlement_point market_type horizon n", "intercept b1 b2", "SELECT * FROM h_two_row_models")
def _(v):
    """The window regression per series where it has a closed form: two rows, one feature, no penalty."""
    weights = F.col("coefficients")
    return _two_row_models(v)[1].withColumns({"b1": weights[0], "b2": weights[1]})


@query("f4_predict_two_rows", "event_id horizon", "y_hat", f"""
SELECT event_id, horizon, intercept + b1 * x1 + b2 * x2 AS y_hat FROM (
  SELECT settlement_point, market_type, event_id, price_usd_mwh AS x2, lag(price_usd_mwh, 1) OVER w AS x1
  FROM fx_spp_prices WINDOW w AS ({_PW})) JOIN h_two_row_models USING (settlement_point, market_type)
WHERE x1 IS NOT NULL""")
def _(v):
    packed, models = _two_row_models(v)
    return blocks.predict(packed, ["price_usd_mwh"], models)


@query("f4_predict_windows", "settlement_point market_type window_ts event_id horizon", "y_hat")
def _(v):
    packed = _price_blocks(v, SERIES)
    return blocks.predict(packed, schemas.PRICE_FEATURES, _price_window_models(packed))


@query("f5_ensemble", "series horizon ts", "y y_hat", """
SELECT a.series, a.horizon, a.ts, a.y, 0.5 * a.y_hat + 0.5 * (b.y_hat * 1.01) AS y_hat
FROM h_keyed_pred a JOIN h_keyed_pred b ON a.series = b.series AND a.ts = b.ts AND a.horizon = b.horizon""")
def _(v):
    return reports.ensemble(joins.align_predictions(*_two_models(v)), {"y_a": 0.5, "y_b": 0.5})


@query("f6_compare_models", "model_name ts l_orderkey", "y_hat", """
SELECT m.model_name, p.ts, p.l_orderkey, p.y_hat FROM (VALUES ('A'), ('N'), ('boosted')) m(model_name)
LEFT JOIN (SELECT * FROM fx_pred QUALIFY row_number() OVER (
  PARTITION BY model_name ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, y DESC) = 1) p ON m.model_name = p.model_name""")
def _(v):
    return reports.compare_models(v.pred, ["A", "N", "boosted"], ["ts", "l_orderkey", "l_linenumber", "y"])


def _registry_rows():
    return [
        forecast.registry_row("price_HB_NORTH_1h", "price", 1, "HB_NORTH", 1, weights=[1.0]),
        forecast.registry_row("price_HB_NORTH_1h", "price", 2, "HB_NORTH", 1, weights=[2.0], threshold=0.5),
        forecast.registry_row("price_1h", "price", 1, None, 1, weights=[1.0]),
        forecast.registry_row("price_24h", "price", 1, None, 24),
        forecast.registry_row("price", "price", 1, weights=[1.0])]


def _registry(v):
    path = scratch_path(v.spark, "registry")
    forecast.write_registry(v.spark, path, _registry_rows())
    return forecast.read_registry(v.spark, path)


@query("f7_resolve_model", "kind hub horizon model_id n", "", """
SELECT 'price' AS kind, settlement_point AS hub, horizon, count(*) AS n,
  CASE WHEN settlement_point = 'HB_NORTH' AND horizon = 1 THEN 'price_HB_NORTH_1h' WHEN horizon = 1 THEN 'price_1h'
       ELSE 'price' END AS model_id FROM h_price_targets GROUP BY settlement_point, horizon""")
def _(v):
    horizons = F.explode(F.array(*[F.lit(h) for h in forecast.HORIZONS])).alias("horizon")
    requests = (v.prices.select(F.lit("price").alias("kind"), F.col("settlement_point").alias("hub"), horizons)
                .groupBy("kind", "hub", "horizon").agg(F.count(F.lit(1)).alias("n")))
    return forecast.resolve_model(requests, _registry(v)).join(requests, ["kind", "hub", "horizon"])


@query("f8_model_registry", "model_id hub horizon version n", "intercept slope", """
SELECT 'price_' || settlement_point || '_' || horizon || 'h' AS model_id, settlement_point AS hub, horizon, 2 AS version,
  count(y) AS n, regr_intercept(y, price_usd_mwh) AS intercept, regr_slope(y, price_usd_mwh) AS slope
FROM (SELECT *, lead(price_usd_mwh, 1) OVER (PARTITION BY settlement_point ORDER BY ts, event_id) AS y, 1 AS horizon
      FROM fx_spp_prices) WHERE y IS NOT NULL GROUP BY settlement_point, horizon""")
def _(v):
    rows = forecast.with_targets(v.prices, "price_usd_mwh", ["settlement_point"], ORDER, [1])
    models = forecast.fit_price(rows, ["price_usd_mwh"], ["settlement_point"], [1])
    path = scratch_path(v.spark, "registry")
    models = materialise(models, "models")
    for version in (1, 2):
        forecast.append_registry(
            forecast.registry_of(models, "price", version, "settlement_point", ["price_usd_mwh"]), path)
    weights = F.col("weights")
    return forecast.read_registry(v.spark, path).withColumns({
        "n": weights[0].cast("long"), "intercept": weights[1], "slope": weights[2],
        "version": F.col("version").cast("int")})


helper("h_two_price_rows", """
SELECT * FROM (
  SELECT ts, price_usd_mwh AS x1, lead(price_usd_mwh, 1) OVER w AS x2, lead(price_usd_mwh, 2) OVER w AS y,
         row_number() OVER w - 1 AS rn, count(*) OVER () - 2 AS windows FROM fx_spp_prices WINDOW w AS (ORDER BY ts, event_id))
WHERE rn < floor(windows * 0.85::DOUBLE)""")


@query("f8_forecast_latest", "model_id window_ts horizon", "y_hat", """
SELECT 'load_1h' AS model_id, window_ts, 1 AS horizon, my + b1 * (p1 - m1) + b2 * (p2 - m2) AS y_hat FROM (
  SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM (
    SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(y, x1) AS c1, covar_pop(y, x2) AS c2,
      covar_pop(x1, x2) AS v12, var_pop(x1) AS v1, var_pop(x2) AS v2 FROM h_two_price_rows)), (
  SELECT max(ts) AS window_ts, arg_max(price_usd_mwh, (ts, event_id)) AS p2, arg_min(price_usd_mwh, (ts, event_id)) AS p1
  FROM (SELECT * FROM fx_spp_prices ORDER BY ts DESC, event_id DESC LIMIT 2))""")
def _(v):
    """Fit, store, resolve, load, and forecast from the newest rows: nothing but the registry row and they are read.

    Windows of two rows of one feature, whose regression has a closed form.
    """
    rows = v.prices.select("ts", "event_id", "price_usd_mwh")
    numbered = ordered.chrono_split(rows, [], ORDER)
    scaler = ds.fit_scaler(numbered.where("is_train"), ["price_usd_mwh"])
    graph = ds.collect_graph(ds.correlation_graph(rows, ["price_usd_mwh"]))
    smooth, names = forecast.smoothed_features(rows.withColumn("target", F.col("price_usd_mwh")), scaler, graph)
    packed = blocks.pack(smooth, [*names, "target"], order=ORDER, seq_len=2, horizon=1)
    fitted = forecast.fit_window_load(packed, names, "target", 1, loss="squared", penalty=0.0)
    path = scratch_path(v.spark, "registry")
    forecast.write_registry(v.spark, path, [
        forecast.save_model(fitted, path, "load_1h", "load", 1, scaler=scaler, graph=graph)])
    registry = forecast.read_registry(v.spark, path)
    asked = v.spark.createDataFrame([("load", "HB_NORTH", 1)], "kind string, hub string, horizon int")
    found = forecast.resolve_model(asked, registry).first()["model_id"]
    row = registry.where(F.col("model_id") == found).first()
    latest = forecast.forecast_latest(row, rows, ties=["event_id"], seq_len=2)
    return latest.withColumn("model_id", F.lit(found))


@query("f8_window_registry", "model_id hub horizon version features n coefficients", "intercept")
def _(v):
    models = _price_window_models(_price_blocks(v, ["settlement_point"]))
    path = scratch_path(v.spark, "registry")
    for version in (1, 2):
        forecast.append_registry(
            forecast.registry_of(models, "price", version, "settlement_point", schemas.PRICE_FEATURES), path)
    weights = F.col("weights")
    return _short(forecast.read_registry(v.spark, path).withColumns({
        "n": weights[0].cast("long"), "intercept": weights[1], "version": F.col("version").cast("int"),
        "coefficients": F.slice(weights, 3, F.size(weights) - 2)}))


# Anomalies and rules ------------------------------------------------------------------------

def reading_blocks(v):
    """Scaled readings in blocks, and as rows."""
    rows = materialise(engineered(v), "engineered").withColumn("draw", detect.hold_out_draw(["ts"]))
    # Scaled once and written, for the blocks and for whatever reads the rows after them.
    scaled = ds.fit_scaler(rows, _WINDOW, at_once=6).transform(rows).select(*READING_ORDER, *_WINDOW, "draw")
    rows = materialise(scaled, "scaled")
    return blocks.pack(rows, [*_WINDOW, "draw"], order=READING_ORDER, stored=True), rows


def _errors(v, model):
    cells = [F.struct(F.lit(k).alias("k"), F.lit(k == model.k).alias("chosen"), F.lit(e).alias("hold_out_error"))
             for k, e in model.hold_out_error.items()]
    return v.spark.range(1).select(F.inline(F.array(*cells)))


@query("d1_fit_reconstruction", "k chosen", "hold_out_error")
def _(v):
    return _errors(v, detect.fit_reconstruction_blocks(reading_blocks(v)[0], _WINDOW, "draw"))


@query("d2_reconstruction_score", "window_ts", "score")
def _(v):
    packed, _ = reading_blocks(v)
    return detect.reconstruction_score_blocks(
        packed, _WINDOW, detect.fit_reconstruction_blocks(packed, _WINDOW, "draw"))


# Windows of two rows of one feature: principal axes in closed form. The draw follows from the row's id.
helper("h_two_cells", """
SELECT *, (event_id * 48271) % 1000000 < greatest(0.12::DOUBLE, 8.0 / count(*) OVER ()) * 1000000 AS held FROM (
  SELECT ts, event_id, lag(price_usd_mwh, 1) OVER w AS p, price_usd_mwh AS q
  FROM fx_spp_prices WINDOW w AS (ORDER BY ts, event_id)) WHERE p IS NOT NULL""")
helper("h_two_cell_axis", """
SELECT mp, mq, b / sqrt(b * b + (l - a) * (l - a)) AS u, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS v FROM (
  SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l FROM (
    SELECT avg(p) AS mp, avg(q) AS mq, var_samp(p) AS a, covar_samp(p, q) AS b, var_samp(q) AS c
    FROM h_two_cells WHERE NOT held))""")
helper("h_two_cell_scores", """
SELECT ts, event_id, held, greatest(0, ((p - mp) * (p - mp) + (q - mq) * (q - mq)
  - ((p - mp) * u + (q - mq) * v) * ((p - mp) * u + (q - mq) * v)) / 2) AS score FROM h_two_cells, h_two_cell_axis""")


def two_cell_blocks(v):
    draw = F.pmod(F.col("event_id") * 48271, F.lit(1_000_000)).cast("double")
    return blocks.pack(v.prices.withColumn("draw", draw), ["price_usd_mwh", "draw"], order=ORDER, seq_len=2)


@query("d1_fit_two_cells", "k chosen", "hold_out_error", """
SELECT 1 AS k, avg(score) <= 0 AS chosen, avg(score) AS hold_out_error FROM h_two_cell_scores WHERE held
UNION ALL SELECT 2, avg(score) > 0, 0.0 FROM h_two_cell_scores WHERE held""")
def _(v):
    return _errors(v, detect.fit_reconstruction_blocks(two_cell_blocks(v), ["price_usd_mwh"], "draw", ks=(1, 2)))


@query("d2_score_two_cells", "window_ts event_id", "score",
       "SELECT ts AS window_ts, event_id, score FROM h_two_cell_scores")
def _(v):
    packed = two_cell_blocks(v)
    model = detect.fit_reconstruction_blocks(packed, ["price_usd_mwh"], "draw", ks=(1,))
    return detect.reconstruction_score_blocks(packed, ["price_usd_mwh"], model)


helper("h_scores", "SELECT l_orderkey, l_linenumber, ts, abs(y - y_hat) AS score FROM fx_pred")
helper("h_flagged", """
SELECT *, score > threshold AS is_anomaly,
  CASE WHEN score > threshold * 1.5 THEN 'high' WHEN score > threshold THEN 'medium' END AS severity
FROM h_scores, (SELECT quantile_cont(score, 0.98) AS threshold FROM h_scores)""")


def _scores(v):
    return v.pred.select("l_orderkey", "l_linenumber", F.col("ts").alias("window_ts"),
                         F.abs(F.col("y") - F.col("y_hat")).alias("score"))


@query("d3_flag", "l_orderkey l_linenumber is_anomaly", "score threshold",
       "SELECT l_orderkey, l_linenumber, is_anomaly, score, threshold FROM h_flagged")
def _(v):
    return detect.flag(_scores(v))


@query("e6_detection_metrics", "model_name metric_name", "metric_value", """
SELECT 'gnn_ae' AS model_name, 'threshold' AS metric_name, max(threshold) AS metric_value FROM h_flagged
UNION ALL SELECT 'gnn_ae', 'test_anomalies', count(*) FILTER (is_anomaly) FROM h_flagged""")
def _(v):
    return ev.detection_metrics(detect.flag(_scores(v)), "gnn_ae")


@query("d4_anomaly_severity", "l_orderkey l_linenumber severity", "score", """
SELECT l_orderkey, l_linenumber, score, CASE WHEN score > 3000 THEN 'high' WHEN score > 2000 THEN 'medium' END AS severity
FROM h_scores""")
def _(v):
    return detect.anomaly_severity(detect.flag(_scores(v), threshold=2000.0))


@query("d5_anomaly_events", "detected_at anomaly_type level description", "severity", r"""
SELECT ts AS detected_at, 'reconstruction' AS anomaly_type, round(score, 4) AS severity, severity AS level,
  'Score ' || regexp_replace(printf('%.4f', round(score, 4)), '(\.\d+?)0+$', '\1') || ' (' || severity || ')' AS description
FROM h_flagged WHERE is_anomaly""")
def _(v):
    events = detect.anomaly_events(detect.flag(_scores(v)))
    return events.withColumn("level", F.regexp_extract("description", r"\((\w+)\)$", 1))


@query("d6_isolation_forest", "label n", "low high")
def _(v):
    labelled = detect.isolation_forest(
        v.readings, ["load_mw", "temperature_2m"], ["event_id"])
    return labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))


#: Three small trees, as a fitted forest holds them: feature (-1 in a leaf), split, children, path length.
_TREES = [
    {"feature": [0, 1, -1, -1, -1], "split": [100000.0, 20.0, 0.0, 0.0, 0.0], "left": [1, 3, -1, -1, -1],
     "right": [2, 4, -1, -1, -1], "depth": [0.0, 0.0, 1.0, 3.5, 2.0]},
    {"feature": [1, -1, 0, -1, -1], "split": [60.0, 0.0, 250000.0, 0.0, 0.0], "left": [1, -1, 3, -1, -1],
     "right": [2, -1, 4, -1, -1], "depth": [0.0, 6.25, 0.0, 4.0, 2.0]},
    {"feature": [0, -1, 1, -1, -1], "split": [30000.0, 0.0, 110.0, 0.0, 0.0], "left": [1, -1, 3, -1, -1],
     "right": [2, -1, 4, -1, -1], "depth": [0.0, 1.0, 0.0, 5.75, 2.0]}]
_TREE_ROWS, _TREE_FEATURES = 256, ["load_mw", "temperature_2m"]


def _path_sql(tree, node=0):
    """The path length of a row as nested CASEs."""
    if tree["feature"][node] < 0:
        return repr(tree["depth"][node])
    test = f"{_TREE_FEATURES[tree['feature'][node]]} <= {tree['split'][node]!r}"
    return f"CASE WHEN {test} THEN {_path_sql(tree, tree['left'][node])} ELSE {_path_sql(tree, tree['right'][node])} END"


helper("h_isolation", f"""
SELECT event_id, pow(2.0, -(({' + '.join(_path_sql(t) for t in _TREES)}) / 3)
  / (2 * (ln({_TREE_ROWS} - 1) + 0.5772156649015329) - 2 * ({_TREE_ROWS} - 1.0) / {_TREE_ROWS})) AS score
FROM fx_readings WHERE load_mw IS NOT NULL AND temperature_2m IS NOT NULL""")


def _given_forest():
    trees = [{k: np.asarray(c) for k, c in t.items()} for t in _TREES]
    return detect.IsolationForest(_TREE_FEATURES, trees, _TREE_ROWS)


@query("d6_isolation_score", "event_id label", "score", """
SELECT event_id, score, CASE WHEN score > t THEN -1 ELSE 1 END AS label
FROM h_isolation, (SELECT quantile_cont(score, 0.95) AS t FROM h_isolation)""")
def _(v):
    """Path lengths, scores and labels of every row by trees that are known."""
    return detect.isolation_labels(detect.isolation_score(v.readings, _given_forest()), 0.05)


@query("d7_anomaly_overlay", "ts method", "load_mw", """
SELECT ts, load_mw, 'low' AS method FROM fx_grid_load WHERE ts IN (
  SELECT date_trunc('hour', ts) FROM fx_conditions WHERE demand > 80000)
UNION ALL SELECT ts, load_mw, 'stress' FROM fx_grid_load WHERE load_mw - forecast_mw > 2000""")
def _(v):
    crowded = v.conditions.where("demand > 80000").select(fn.hour_of("ts").alias("ts"))
    return detect.anomaly_overlay(v.load, {"low": crowded, "stress": v.load.where("grid_stress > 2000")})


@query("d8_capacity_rule", "event_id ts alert_type severity title", "", """
SELECT a.event_id, a.ts, a.alert_type, severity, title FROM h_alerts a
JOIN h_alert_text t ON a.event_id = t.event_id AND a.alert_type = t.alert_type WHERE a.alert_type = 'capacity_stress'""")
def _(v):
    return detect.capacity_rule(v.conditions)


@query("d9_frequency_rule", "event_id ts alert_type severity description", "", """
SELECT a.event_id, a.ts, a.alert_type, severity, description FROM h_alerts a
JOIN h_alert_text t ON a.event_id = t.event_id AND a.alert_type = t.alert_type WHERE a.alert_type = 'frequency_deviation'""")
def _(v):
    return detect.frequency_rule(v.conditions)


helper("h_outages", """
SELECT ts, event_id, 'system_snapshot' AS outage_type, capacity - demand AS capacity_mw, ts AS start_time,
  CASE WHEN demand / capacity > 0.90 THEN 'high_stress' ELSE 'normal' END AS status,
  printf('Grid (demand=%.0f, capacity=%.0f, wind=%.0f, solar=%.0f)', floor(demand + 0.500001),
         floor(capacity + 0.500001), floor(wind + 0.500001), floor(solar + 0.500001)) AS facility_name,
  printf('reserve_ratio=%.3f, freq=%.3f', floor(demand / capacity * 1000 + 0.500001) / 1000,
         floor(freq * 1000 + 0.500001) / 1000) AS nature
FROM (SELECT * REPLACE (nullif(capacity, 0) AS capacity) FROM fx_conditions) WHERE capacity IS NOT NULL""")


@query("d10_condition_snapshot", "event_id ts outage_type facility_name nature status start_time", "capacity_mw",
       "SELECT * FROM h_outages")
def _(v):
    return detect.condition_snapshot(v.conditions)


@query("d11_anomaly_alert", "ts alert_type severity title description", "", """
SELECT max(ts) AS ts, 'anomaly_detection' AS alert_type, 'warning' AS severity,
  count(*) || ' high-severity anomalies detected' AS title,
  printf('Reconstruction error exceeded 1.5x threshold for %d windows. Max score: %.4f', count(*),
         floor(max(score) * 10000 + 0.5001) / 10000) AS description
FROM h_scores WHERE score > 3000 HAVING count(*) > 0""")
def _(v):
    return detect.anomaly_alert(detect.flag(_scores(v), threshold=2000.0))
