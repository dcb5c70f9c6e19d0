"""Table schemas and domain values."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TS, _D, _S, _I, _B = (
    T.TimestampType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.BooleanType())

GRID_LOAD = _struct(ts=_TS, load_mw=_D, forecast_mw=_D, grid_stress=_D)
SPP_PRICES = _struct(ts=_TS, settlement_point=_S, price_usd_mwh=_D, market_type=_S)
WEATHER = _struct(ts=_TS, zone=_S, temperature_2m=_D, wind_speed_10m=_D,
                  direct_radiation=_D, relative_humidity=_D)
OUTAGES = _struct(ts=_TS, outage_id=_S, outage_type=_S, facility_name=_S, from_station=_S,
                  to_station=_S, voltage_kv=_D, capacity_mw=_D, start_time=_TS, end_time=_TS,
                  nature=_S, status=_S)
MODEL_METRICS = _struct(ts=_TS, model_name=_S, metric_name=_S, metric_value=_D, horizon=_I, notes=_S)
ANOMALY_EVENTS = _struct(ts=_TS, detected_at=_TS, anomaly_type=_S, severity=_D, description=_S)
ALERTS = _struct(ts=_TS, alert_id=_S, alert_type=_S, severity=_S, title=_S, description=_S,
                 acknowledged=_B, source=_S)
PRICES_HOURLY = _struct(bucket=_TS, settlement_point=_S, market_type=_S, avg_price_usd_mwh=_D,
                        max_price_usd_mwh=_D, min_price_usd_mwh=_D)
PRICE_PARTIALS = _struct(bucket=_TS, settlement_point=_S, market_type=_S, total=_D, n=T.LongType(), most=_D, least=_D)
SCORE_SKETCHES = _struct(day=_TS, sketch=T.BinaryType(), n=T.LongType())
CONDITIONS = _struct(ts=_TS, demand=_D, capacity=_D, wind=_D, solar=_D, freq=_D)
DEMAND_FEED = _struct(period=_S, type=_S, value=_S)
WEATHER_FEED = _struct(
    zone=_S,
    hourly=_struct(time=T.ArrayType(_S), temperature_2m=T.ArrayType(_D),
                   wind_speed_10m=T.ArrayType(_D), direct_radiation=T.ArrayType(_D),
                   relative_humidity_2m=T.ArrayType(_D)))

# Unique keys: the store's upsert and insert-once contracts are stated on these.
KEYS = {
    "grid_load": ["ts"],
    "spp_prices": ["ts", "settlement_point", "market_type"],
    "weather": ["ts", "zone"],
    "alerts": ["alert_id", "ts"],
    "spp_prices_hourly": ["bucket", "settlement_point", "market_type"],
}

# Days kept per table, and days before a table is rewritten compactly.
RETENTION_DAYS = {"model_metrics": 400, "anomaly_events": 365, "alerts": 180}
COMPACT_AFTER_DAYS = {"grid_load": 7, "spp_prices": 7, "weather": 7, "outages": 7,
                      "model_metrics": 3, "anomaly_events": 7, "alerts": 7}
SEGMENT_BY = {"grid_load": [], "spp_prices": ["settlement_point", "market_type"],
              "weather": ["zone"], "outages": ["outage_type"], "model_metrics": ["model_name"],
              "anomaly_events": [], "alerts": ["alert_type"]}

# Hubs, weather zones with coordinates, fuel codes, severities.
HUBS = ["HB_HOUSTON", "HB_NORTH", "HB_SOUTH", "HB_WEST", "HB_BUSAVG"]
ZONES = {
    "houston": (29.76, -95.36),
    "dallas": (32.78, -96.80),
    "san_antonio": (29.42, -98.49),
    "west_texas": (31.99, -102.08),
    "corpus": (27.80, -97.40),
}
FUELS = {"WND": "Wind", "SUN": "Solar", "NG": "Natural_Gas", "COL": "Coal", "NUC": "Nuclear"}
SEVERITY_RANK = {"critical": 3, "warning": 2, "info": 1}

# Defaults used when a weather source has no data.
WEATHER_DEFAULTS = {"temperature_2m": 20.0, "wind_speed_10m": 10.0, "direct_radiation": 200.0}

# Feature lists per model.
LOAD_FEATURES = [
    "load_mw", "temperature_2m", "wind_speed_10m", "direct_radiation",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend",
    "load_lag_1h", "load_lag_24h", "load_lag_168h", "load_rolling_6h", "load_rolling_24h",
    "temp_squared"]
PRICE_FEATURES = [
    "price_usd_mwh", "load_mw", "temperature_2m", "wind_speed_10m", "direct_radiation",
    "hour", "day_of_week", "is_weekend", "hour_sin", "hour_cos",
    "price_lag_1h", "price_lag_24h", "price_lag_168h", "price_rolling_24h"]
TREE_FEATURES = [
    "temperature_2m", "temp_squared", "wind_speed_10m", "direct_radiation",
    "hour", "day_of_week", "is_weekend", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "load_lag_1h", "load_lag_24h", "load_lag_168h", "load_rolling_6h", "grid_stress"]
SEASONAL_FEATURES = [
    "load_mw", "temperature_2m", "hour_sin", "hour_cos", "day_sin", "day_cos",
    "month_sin", "month_cos", "week_sin", "week_cos", "is_weekend",
    "load_lag_1h", "load_lag_24h", "load_rolling_mean_24h", "temp_x_month"]
RENEWABLE_FEATURES = [
    "load_mw", "temperature_2m", "wind_speed_10m", "direct_radiation",
    "wind_power_proxy", "solar_rolling_24h", "wind_rolling_24h",
    "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
    "week_sin", "week_cos", "is_weekend",
    "load_lag_1h", "load_lag_24h", "load_rolling_mean_24h", "temp_x_month"]
FEATURE_SETS = {"load": LOAD_FEATURES, "price": PRICE_FEATURES, "tree": TREE_FEATURES,
                "seasonal": SEASONAL_FEATURES, "renewable": RENEWABLE_FEATURES}
