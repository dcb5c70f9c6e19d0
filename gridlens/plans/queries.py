"""Operational reads over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions.scalars import days_before, matching, moment, or_zero, recent, since
from gridlens.operators.aggregates import price_rollup, zone_average
from gridlens.operators.joins import hour_join
from gridlens.operators.reports import REPORT_ROWS, recent_top, time_ordered
from gridlens.operators.resample import build_training_frame
from gridlens.schemas import HUBS
from gridlens.sources.store import LogTable

ROLLUP_START_DAYS = 3
ROLLUP_END_HOURS = 1
ALERT_COLUMNS = ["ts", "alert_id", "alert_type", "severity", "title", "description",
                 "acknowledged", "source"]


def read_load(load: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    return time_ordered(recent(load, days, as_of).select("ts", "load_mw", "forecast_mw", "grid_stress"))


def read_prices(prices: DataFrame, days: int = 30, hub: str = HUBS[0], market: str = "DAM",
                as_of=None) -> DataFrame:
    rows = matching(recent(prices, days, as_of), settlement_point=hub, market_type=market)
    return time_ordered(rows.select("ts", "price_usd_mwh"))


def read_weather(weather: DataFrame, days: int = 30, zone: str | None = None, as_of=None) -> DataFrame:
    """One zone as stored, or the mean over zones."""
    rows = recent(weather, days, as_of)
    if zone:
        rows = matching(rows, zone=zone).select(
            "ts", "temperature_2m", "wind_speed_10m", "direct_radiation",
            or_zero("relative_humidity").alias("relative_humidity"))
    else:
        rows = zone_average(rows)
    return time_ordered(rows)


def training_frame(load: DataFrame, weather: DataFrame, prices: DataFrame, days: int = 90,
                   hub: str = HUBS[0], market: str = "DAM", as_of=None) -> DataFrame:
    """Recent load, zone-averaged weather and one hub's prices on the hourly grid."""
    return build_training_frame(
        recent(load, days, as_of).select("ts", "load_mw", "forecast_mw", "grid_stress"),
        zone_average(recent(weather, days, as_of)),
        matching(recent(prices, days, as_of), settlement_point=hub, market_type=market)
        .select("ts", "price_usd_mwh"))


def alerts(table: DataFrame, days: int = 7, unacknowledged_only: bool = False, as_of=None,
           ties: tuple[str, ...] = ("alert_id",)) -> DataFrame:
    rows = recent(table, days, as_of)
    if unacknowledged_only:
        rows = rows.where(~F.col("acknowledged"))
    present = [c for c in ALERT_COLUMNS if c in table.columns]
    return recent_top(rows.select(*present), ties=[c for c in ties if c in present])


def active_alerts(table: DataFrame, as_of=None) -> DataFrame:
    return alerts(table, 1, True, as_of)


def anomaly_history(events: DataFrame, days: int = 7, as_of=None, ties: tuple[str, ...] = ()) -> DataFrame:
    if not 1 <= days <= 90:
        raise ValueError("days must be between 1 and 90")
    rows = recent(events, days, as_of, ts="detected_at").select(
        "detected_at", "anomaly_type", or_zero("severity").alias("severity"), "description")
    return recent_top(rows, ts="detected_at", ties=ties or ("severity", "description"))


def outage_history(outages: DataFrame, days: int = 7, as_of=None,
                   ties: tuple[str, ...] = ("facility_name", "nature")) -> DataFrame:
    rows = recent(outages, days, as_of).select(
        "ts", "outage_type", "facility_name", "capacity_mw", "nature", "status", "start_time")
    return recent_top(rows, REPORT_ROWS["outages"], ties=ties)


def grid_status(load: DataFrame, alert_rows: DataFrame, outages: DataFrame, as_of=None) -> DataFrame:
    """One row: latest load of the day, active alerts, high-stress snapshots in 24 hours.

    Three single-row aggregates are stacked and folded; nothing is cross joined.
    """
    newest = F.max_by(F.struct("ts", "load_mw", "forecast_mw", "grid_stress"), "ts").alias("_load")
    a = recent(load, 1, as_of).agg(newest).select(
        F.col("_load.ts").alias("load_ts"), F.col("_load.load_mw").alias("current_mw"),
        F.col("_load.forecast_mw").alias("forecast_mw"), F.col("_load.grid_stress").alias("stress"))
    active = recent(alert_rows, 1, as_of).where(~F.col("acknowledged"))
    last = F.max_by(F.struct("alert_type", "severity", "title"), F.struct("ts", "alert_id")).alias("_a")
    b = active.agg(F.count(F.lit(1)).alias("_n"), last).select(
        F.col("_n").alias("active_alerts"),
        F.col("_a.alert_type").alias("alert_type"), F.col("_a.severity").alias("alert_severity"),
        F.col("_a.title").alias("alert_title"))
    c = recent(outages, 1, as_of).agg(
        F.count_if(F.coalesce(F.col("status") == "high_stress", F.lit(False))).alias("stress_events_24h"))
    stacked = a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def load_vs_forecast(load: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    return time_ordered(recent(load, days, as_of).select("ts", "load_mw", "forecast_mw"))


def dam_vs_rtm(prices: DataFrame, hub: str = HUBS[0], days: int = 7, as_of=None) -> DataFrame:
    """Both markets of one hub side by side, per time at which either has a price."""
    rows = matching(recent(prices, days, as_of), settlement_point=hub)
    price = F.col("price_usd_mwh")
    return rows.groupBy("ts").agg(
        F.max(F.when(F.col("market_type") == "DAM", price)).alias("dam"),
        F.max(F.when(F.col("market_type") == "RTM", price)).alias("rtm"))


def zone_comparison(weather: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    return time_ordered(recent(weather, days, as_of).select("ts", "zone", "temperature_2m"), ties=["zone"])


def weather_load_overlay(load: DataFrame, weather: DataFrame, days: int = 7, zone: str = "houston",
                         as_of=None) -> DataFrame:
    # Weather from the start of the hour that the oldest load falls into.
    start = F.date_trunc("hour", days_before(as_of, days))
    pairs = hour_join(recent(load, days, as_of).select("ts", "load_mw"),
                      since(weather.where(F.col("ts") >= start), start).select("ts", "zone", "temperature_2m"), zone)
    return pairs.select("ts", "load_mw", "temperature_2m")


def rollup_range(as_of=None):
    """First bucket start and last bucket end that a refresh rebuilds."""
    return (days_before(as_of, ROLLUP_START_DAYS),
            moment(as_of) - F.make_dt_interval(hours=F.lit(ROLLUP_END_HOURS)))


def refresh_rollup(prices: DataFrame, as_of=None) -> DataFrame:
    """Buckets lying wholly inside the refresh range, rebuilt from the raw rows."""
    first, last = rollup_range(as_of)
    in_range = prices.where((F.col("ts") >= first) & (F.col("ts") < last))
    in_range = since(in_range, first)
    hour = F.make_dt_interval(hours=F.lit(1))
    return price_rollup(in_range).where(
        (F.col("bucket") >= first) & (F.col("bucket") + hour <= last))


def refresh_into(table: LogTable, prices: DataFrame, as_of=None) -> None:
    """The scheduled refresh: rebuilt buckets are upserted on the bucket key."""
    table.append(refresh_rollup(prices, as_of), writer="refresh", unique=True, small_days=True)


def visible_rollup(rollup: DataFrame, as_of=None) -> DataFrame:
    """Buckets old enough to be shown."""
    return rollup.where(F.col("bucket") + F.make_dt_interval(hours=F.lit(1)) <= rollup_range(as_of)[1])
