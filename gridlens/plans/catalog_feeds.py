"""Registered queries: feeds, sinks, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens import schemas
from gridlens.functions import scalars as fn
from gridlens.operators import detect, ordered, resample
from gridlens.plans.fixtures import AS_OF
from gridlens.plans.registry import helper, query
from gridlens.session import scratch_path
from gridlens.sources import feeds, store

# Feeds --------------------------------------------------------------------------------

helper("h_demand", """
SELECT pos, period, CAST(replace(period, 'T', ' ') || ':00:00' AS TIMESTAMP) AS ts, type,
       TRY_CAST(value AS DOUBLE) AS value
FROM fx_demand_feed WHERE value IS NOT NULL AND period <> ''""")


@query("s1_normalize_demand", "pos period ts", "load_mw",
       "SELECT pos, period, ts, value AS load_mw FROM h_demand WHERE type = 'D'")
def _(v):
    return feeds.normalize_demand(v.demand_feed, keep=["pos"])


@query("s2_pair_forecast", "pos period ts", "load_mw forecast_mw grid_stress", """
SELECT d.pos, d.period, d.ts, d.value AS load_mw, f.forecast_mw, d.value - f.forecast_mw AS grid_stress
FROM h_demand d LEFT JOIN (
  SELECT period, arg_max(value, pos) AS forecast_mw FROM h_demand
  WHERE type = 'DF' AND value IS NOT NULL GROUP BY period) f ON d.period = f.period
WHERE d.type = 'D'""")
def _(v):
    demand = feeds.normalize_demand(v.demand_feed, keep=["pos"])
    forecast = feeds.normalize_demand(v.demand_feed, "DF", "forecast_mw", keep=["pos"])
    return feeds.pair_forecast(demand, forecast.drop("ts"))


@query("s3_latest_n", "pos period", "load_mw", """
SELECT pos, period, value AS load_mw FROM h_demand WHERE type = 'D' ORDER BY period DESC, pos DESC LIMIT 48""")
def _(v):
    return feeds.latest_n(feeds.normalize_demand(v.demand_feed, keep=["pos"]), ties=["pos"])


def _weather_feed(v):
    """One struct of parallel arrays per zone and day; some arrays too short, some too long."""
    rows = v.weather.withColumn("day", F.to_date("ts"))
    names = ["temperature_2m", "wind_speed_10m", "direct_radiation", "relative_humidity"]
    packed = rows.groupBy("zone", "day").agg(
        F.sort_array(F.collect_list(F.struct("ts", *names))).alias("r"))

    def column(name):
        return F.transform("r", lambda x: x[name])

    short = F.dayofmonth("day") % 5 == 0
    wind = column("wind_speed_10m")
    return packed.select("zone", F.struct(
        F.transform("r", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        column("temperature_2m").alias("temperature_2m"),
        F.when(short, F.slice(wind, 1, F.greatest(F.size("r") - 2, F.lit(0)))).otherwise(wind).alias("wind_speed_10m"),
        F.concat(column("direct_radiation"), F.array(F.lit(-1.0))).alias("direct_radiation"),
        column("relative_humidity").alias("relative_humidity_2m")).alias("hourly"))


@query("s4_explode_hourly", "ts zone", "temperature_2m wind_speed_10m direct_radiation relative_humidity", """
SELECT ts, zone, temperature_2m, direct_radiation, relative_humidity,
  CASE WHEN day(ts) % 5 = 0 AND rn > n - 2 THEN NULL ELSE wind_speed_10m END AS wind_speed_10m
FROM (SELECT *, row_number() OVER (PARTITION BY zone, CAST(ts AS DATE) ORDER BY ts) AS rn,
             count(*) OVER (PARTITION BY zone, CAST(ts AS DATE)) AS n FROM fx_weather)""")
def _(v):
    return feeds.explode_hourly(_weather_feed(v))


@query("s5_multi_zone_union", "ts zone", "temperature_2m",
       "SELECT ts, zone, temperature_2m FROM fx_weather WHERE zone <> 'corpus'")
def _(v):
    return feeds.multi_zone_union({
        zone: None if zone == "corpus" else fn.matching(v.weather, zone=zone).drop("zone")
        for zone in schemas.ZONES})


@query("s6_source_fallback", "ts", "temperature_2m wind_speed_10m direct_radiation", """
SELECT s.ts, coalesce(a.temperature_2m, f.temperature_2m, 20.0) AS temperature_2m,
  coalesce(a.wind_speed_10m, f.wind_speed_10m, 10.0) AS wind_speed_10m,
  coalesce(a.direct_radiation, f.direct_radiation, 200.0) AS direct_radiation
FROM h_spine s LEFT JOIN (SELECT * FROM fx_weather WHERE zone = 'houston') a ON s.ts = a.ts
LEFT JOIN (SELECT * FROM fx_weather WHERE zone = 'dallas') f ON s.ts = f.ts""")
def _(v):
    spine = resample.hour_spine(v.load.select("ts"))
    return feeds.source_fallback(spine, fn.matching(v.weather, zone="houston"),
                                 fn.matching(v.weather, zone="dallas"))


helper("h_spine", """
SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM fx_grid_load)""")


@query("s7_chunk_ranges", "o_custkey chunk_start chunk_end", "", """
SELECT o_custkey, CAST(CAST(s AS DATE) AS VARCHAR) AS chunk_start,
  CAST(CAST(least(s + INTERVAL 30 DAY, last) AS DATE) AS VARCHAR) AS chunk_end
FROM (SELECT o_custkey, last, unnest(generate_series(first, last - INTERVAL 1 DAY, INTERVAL 31 DAY)) AS s
      FROM (SELECT o_custkey, date_trunc('day', min(o_orderdate))::TIMESTAMP AS first,
                   date_trunc('day', max(o_orderdate))::TIMESTAMP AS last
            FROM orders GROUP BY o_custkey) WHERE first < last)""")
def _(v):
    spans = v.table("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return feeds.chunk_ranges(spans, keys=["o_custkey"])


@query("s8_dam_wide_to_long", "event_id ts settlement_point market_type", "price_usd_mwh", """
SELECT event_id, settlement_point, 'DAM' AS market_type, price AS price_usd_mwh,
  coalesce(CAST(operating_day AS TIMESTAMP), TIMESTAMP '2024-02-01') + to_hours(CAST(hour_ending AS INT)) AS ts
FROM (SELECT event_id, operating_day, hour_ending, 'HB_HOUSTON' AS settlement_point, TRY_CAST(hb_houston AS DOUBLE) AS price FROM fx_dam_page
      UNION ALL SELECT event_id, operating_day, hour_ending, 'HB_NORTH', TRY_CAST(hb_north AS DOUBLE) FROM fx_dam_page
      UNION ALL SELECT event_id, operating_day, hour_ending, 'HB_BUSAVG', TRY_CAST(hb_busavg AS DOUBLE) FROM fx_dam_page)
WHERE hour_ending <> 'XX' AND price IS NOT NULL AND NOT isnan(price)""")
def _(v):
    return feeds.dam_wide_to_long(v.dam_page, "2024-02-01 00:00:00", keep=["event_id"])


@query("s9_rtm_wide_to_long", "event_id ts settlement_point market_type", "price_usd_mwh", """
SELECT event_id, TRY_CAST(interval_ending AS TIMESTAMP) AS ts, settlement_point, 'RTM' AS market_type,
       price AS price_usd_mwh
FROM (SELECT event_id, interval_ending, 'HB_SOUTH' AS settlement_point, TRY_CAST(hb_south AS DOUBLE) AS price FROM fx_rtm_page
      UNION ALL SELECT event_id, interval_ending, 'HB_WEST', TRY_CAST(hb_west AS DOUBLE) FROM fx_rtm_page)
WHERE TRY_CAST(interval_ending AS TIMESTAMP) IS NOT NULL AND price IS NOT NULL""")
def _(v):
    return feeds.rtm_wide_to_long(v.rtm_page, keep=["event_id"])


def _price_pages(rows, names):
    """An HTML page with one table per row, headed by the row's column names."""
    head = "".join(f"<th>{n}</th>" for n in names)
    cells = [F.concat(F.lit("<td> "), F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")), F.lit("</td>")) for n in names]
    body = F.concat(F.lit(f"<html><table class='x'><tr>{head}</tr><tr>"), *cells, F.lit("</tr></table></html>"))
    return rows.select(F.col("event_id").alias("page_id"), body.alias("html"))


@query("s8_dam_from_pages", "page_id ts settlement_point market_type", "price_usd_mwh", """
SELECT event_id AS page_id, settlement_point, 'DAM' AS market_type, price AS price_usd_mwh,
  coalesce(CAST(operating_day AS TIMESTAMP), TIMESTAMP '2024-02-01') + to_hours(CAST(hour_ending AS INT)) AS ts
FROM (SELECT event_id, operating_day, hour_ending, 'HB_HOUSTON' AS settlement_point, TRY_CAST(hb_houston AS DOUBLE) AS price FROM fx_dam_page
      UNION ALL SELECT event_id, operating_day, hour_ending, 'HB_NORTH', TRY_CAST(hb_north AS DOUBLE) FROM fx_dam_page
      UNION ALL SELECT event_id, operating_day, hour_ending, 'HB_BUSAVG', TRY_CAST(hb_busavg AS DOUBLE) FROM fx_dam_page)
WHERE hour_ending <> 'XX' AND price IS NOT NULL AND NOT isnan(price)""")
def _(v):
    names = [c for c in v.dam_page.columns if c != "event_id"]
    return feeds.dam_from_pages(_price_pages(v.dam_page, names), "2024-02-01 00:00:00")


@query("s9_rtm_from_pages", "page_id ts settlement_point market_type", "price_usd_mwh", """
SELECT event_id AS page_id, TRY_CAST(interval_ending AS TIMESTAMP) AS ts, settlement_point, 'RTM' AS market_type,
       price AS price_usd_mwh
FROM (SELECT event_id, interval_ending, 'HB_SOUTH' AS settlement_point, TRY_CAST(hb_south AS DOUBLE) AS price FROM fx_rtm_page
      UNION ALL SELECT event_id, interval_ending, 'HB_WEST', TRY_CAST(hb_west AS DOUBLE) FROM fx_rtm_page)
WHERE TRY_CAST(interval_ending AS TIMESTAMP) IS NOT NULL AND price IS NOT NULL""")
def _(v):
    names = [c for c in v.rtm_page.columns if c != "event_id"]
    return feeds.rtm_from_pages(_price_pages(v.rtm_page, names))


@query("s10_resolve_column", "l_returnflag n", "total", """
SELECT l_returnflag, count(*) AS n, sum(l_extendedprice) AS total FROM lineitem GROUP BY l_returnflag""")
def _(v):
    items = v.table("lineitem")
    flag = feeds.resolve_column(items.columns, ["returnflag", "l_returnflag"])
    price = feeds.resolve_column(items.columns, ["Price"], ["price"])
    return items.groupBy(F.col(flag).alias("l_returnflag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"))


@query("s11_extract_cells", "page_id block row cell text", "", r"""
SELECT page_id, CAST(block AS INT) AS block, CAST(row AS INT) AS row, 0 AS cell, trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', ' ', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
  '\s+', ' ', 'g')) AS text
FROM (SELECT page_id, block, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS row
      FROM (SELECT page_id, block, regexp_extract_all(list, '(?is)<li[^>]*>(.*?)</li>', 1) AS items
            FROM (SELECT page_id, unnest(lists) AS list, generate_subscripts(lists, 1) - 1 AS block
                  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<[uo]l[^>]*>(.*?)</[uo]l>', 1) AS lists
                        FROM pages))))""")
def _(v):
    return feeds.extract_list_items(v.table("pages"))


def _condition_pages(v, conditions=None):
    """An HTML table of labelled values per snapshot."""
    def line(label, cell):
        return F.concat(F.lit(f"<tr><td>{label}</td><td>"), cell, F.lit("</td></tr>"))

    body = F.concat(
        F.lit("<html><table><tr><th>Item</th><th>Value</th></tr>"),
        line("Total System Capacity (MW)", F.concat(F.format_number("capacity", 0), F.lit(" MW"))),
        line("Actual System Demand", F.lit("0 MW")),
        line("Current Frequency", F.concat(F.col("freq").cast("string"), F.lit(" Hz"))),
        line("Total Wind Output", F.concat(F.format_number("wind", 1), F.lit(" MW"))),
        F.lit("</table><p>x</p><table>"),
        line("Actual System Demand", F.concat(F.format_number("demand", 0), F.lit(" MW"))),
        line("Total PVGR Output", F.concat(F.format_number("solar", 2), F.lit(" MW"))),
        line("Operating State &amp; Note", F.lit("<b>Normal</b>")),
        F.lit("<tr><td>lonely</td><td></td></tr></table></html>"))
    return (v.conditions if conditions is None else conditions).select(
        F.col("event_id").alias("page_id"), "ts", body.alias("html"))


helper("h_kv", """
SELECT event_id AS page_id, unnest([
  {'name': 'total_system_capacity_mw', 'value': capacity}, {'name': 'actual_system_demand', 'value': round(demand)},
  {'name': 'current_frequency', 'value': freq}, {'name': 'total_wind_output', 'value': wind},
  {'name': 'total_pvgr_output', 'value': solar}, {'name': 'operating_state_&_note', 'value': NULL}]) AS kv
FROM fx_conditions""")


@query("s12_kv_from_cells", "page_id name", "value",
       "SELECT page_id, kv.name AS name, kv.value AS value FROM h_kv")
def _(v):
    return feeds.kv_from_cells(feeds.extract_cells(_condition_pages(v)))


@query("s13_pick_metric", "page_id", "demand capacity wind solar freq", """
SELECT event_id AS page_id, round(demand) AS demand, capacity, wind, solar, freq FROM fx_conditions""")
def _(v):
    return feeds.page_figures(_condition_pages(v))


@query("s13_pick_from_cells", "page_id", "demand capacity wind solar freq", """
SELECT event_id AS page_id, round(demand) AS demand, capacity, wind, solar, freq FROM fx_conditions""")
def _(v):
    """From cells that lie in rows of their own, whoever took them from the page."""
    return feeds.pick_metric(feeds.kv_from_cells(feeds.extract_cells(_condition_pages(v))))


@query("s13_pick_snapshot", "page_id", "demand capacity wind solar freq", """
SELECT event_id AS page_id, round(demand) AS demand, capacity, wind,
  CASE WHEN event_id % 3 = 0 THEN solar ELSE solar * 2 END AS solar, freq FROM fx_conditions""")
def _(v):
    """By the wider fragments of snapshots: a page that names its solar figure otherwise still has one."""
    renamed = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(
        F.replace("html", F.lit("Total PVGR Output"), F.lit("PVGR Today")))
    doubled = v.conditions.withColumn("solar", F.when(F.col("event_id") % 3 == 0, F.col("solar")).otherwise(F.col("solar") * 2))
    pages = _condition_pages(v, doubled).withColumn("html", renamed)
    return feeds.page_figures(pages, feeds.CONDITION_KEYS | feeds.SNAPSHOT_KEYS)


@query("s14_fuel_pivot", "ts", "Wind Solar Natural_Gas Coal Nuclear", """
SELECT ts, arg_min(value, event_id) FILTER (type = 'WND') AS Wind, arg_min(value, event_id) FILTER (type = 'SUN') AS Solar,
  arg_min(value, event_id) FILTER (type = 'NG') AS Natural_Gas, arg_min(value, event_id) FILTER (type = 'COL') AS Coal,
  arg_min(value, event_id) FILTER (type = 'NUC') AS Nuclear
FROM fx_fuel GROUP BY ts""")
def _(v):
    return feeds.fuel_pivot(v.fuel)


@query("s15_to_utc_naive", "event_id utc_ts plain_ts", "",
       "SELECT event_id, ts + INTERVAL 6 HOUR AS utc_ts, ts AS plain_ts FROM events")
def _(v):
    text = F.col("ts").cast("string")
    return v.table("events").select(
        "event_id", feeds.to_utc_naive(F.concat(text, F.lit("-06:00"))).alias("utc_ts"),
        feeds.to_utc_naive(text).alias("plain_ts"))


@query("s17_append", "model_name metric_name n first_ts", "total", """
SELECT model_name, metric_name, count(*) AS n, min(ts) AS first_ts, sum(metric_value) AS total
FROM fx_metrics GROUP BY model_name, metric_name""")
def _(v):
    log = store.LogTable(v.spark, scratch_path(v.spark, "metrics"), schemas.MODEL_METRICS, grain="month")
    rows = store.metric_record(v.metrics)
    late = F.col("ts") >= F.lit("1996-01-01")
    for batch, part in ((0, rows.where(~late)), (1, rows.where(late)), (0, rows.where(~late))):
        log.append(part, batch)
    return log.rows().groupBy("model_name", "metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.sum("metric_value").alias("total"))


def _hourly_log(v):
    return v.prices.withColumn("ts", fn.hour_of("ts"))


@query("s18_upsert_last", "ts settlement_point market_type", "price_usd_mwh", """
SELECT date_trunc('hour', ts) AS ts, settlement_point, market_type, arg_max(price_usd_mwh, event_id) AS price_usd_mwh
FROM fx_spp_prices GROUP BY ALL""")
def _(v):
    return store.upsert_last(_hourly_log(v), schemas.KEYS["spp_prices"], ["event_id"])


@query("s19_insert_ignore", "ts settlement_point market_type", "price_usd_mwh", """
SELECT date_trunc('hour', ts) AS ts, settlement_point, market_type, arg_min(price_usd_mwh, event_id) AS price_usd_mwh
FROM fx_spp_prices GROUP BY ALL""")
def _(v):
    log = store.LogTable(v.spark, scratch_path(v.spark, "prices"), schemas.SPP_PRICES, schemas.KEYS["spp_prices"])
    log.append(_hourly_log(v), 0, "event_id")
    return log.first()


helper("h_alerts", """
SELECT ts, event_id, 'capacity_stress' AS alert_type,
  CASE WHEN demand / capacity > 0.95 THEN 'critical' ELSE 'warning' END AS severity, 'system_conditions' AS source
FROM fx_conditions WHERE demand <> 0 AND capacity <> 0 AND demand / nullif(capacity, 0) > 0.90
UNION ALL
SELECT ts, event_id, 'frequency_deviation',
  CASE WHEN abs(freq - 60.0) < 0.1 THEN 'warning' ELSE 'critical' END, 'system_conditions'
FROM fx_conditions WHERE demand <> 0 AND capacity <> 0 AND (freq < 59.95 OR freq > 60.05)""")

helper("h_alert_ids", """
SELECT *, sha256(alert_type || '|' || CAST(event_id AS VARCHAR)) AS alert_id,
  event_id % 3 = 0 AS acknowledged FROM h_alerts""")


helper("h_alert_text", r"""
SELECT event_id, 'capacity_stress' AS alert_type,
  printf('Grid Capacity Alert: %.1f%% reserve', floor((1 - demand / capacity) * 1000 + 0.500001) / 10) AS title,
  'Demand ' || format('{:,}', CAST(floor(demand + 0.500001) AS BIGINT)) || ' MW vs Capacity '
    || format('{:,}', CAST(floor(capacity + 0.500001) AS BIGINT))
    || printf(' MW (%.1f%% utilization). Wind: ', floor(demand / capacity * 1000 + 0.500001) / 10)
    || format('{:,}', CAST(floor(wind + 0.500001) AS BIGINT)) || ' MW, Solar: '
    || format('{:,}', CAST(floor(solar + 0.500001) AS BIGINT))
    || printf(' MW, Freq: %.3f Hz', floor(freq * 1000 + 0.500001) / 1000) AS description
FROM fx_conditions WHERE capacity <> 0 AND demand / nullif(capacity, 0) > 0.90
UNION ALL
SELECT event_id, 'frequency_deviation', printf('Frequency Deviation: %.3f Hz', floor(freq * 1000 + 0.500001) / 1000),
  printf('Grid frequency at %.3f Hz (nominal 60.000 Hz). Deviation: %.1f mHz',
         floor(freq * 1000 + 0.500001) / 1000, round((freq - 60.0) * 1000, 1))
FROM fx_conditions WHERE capacity <> 0 AND (freq < 59.95 OR freq > 60.05)""")


def alert_table(v):
    """Rule alerts with ids, a third of them acknowledged."""
    rows = fn.assign_alert_id(detect.condition_alerts(v.conditions), ["alert_type", "event_id"])
    return rows.withColumn("acknowledged", F.col("event_id") % 3 == 0)


@query("s20_export_alert_payload", "alert_id payload", "", """
SELECT alert_id, CAST(to_json({'alert_id': alert_id, 'alert_type': a.alert_type, 'severity': severity, 'title': title,
  'description': description, 'source': source, 'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%SZ')}) AS VARCHAR) AS payload
FROM h_alert_ids a JOIN h_alert_text t ON a.event_id = t.event_id AND a.alert_type = t.alert_type""")
def _(v):
    return store.alert_payload(alert_table(v))


# Projections and filters ------------------------------------------------------------------

@query("p1_recent", "event_id ts settlement_point", "price_usd_mwh", f"""
SELECT event_id, ts, settlement_point, price_usd_mwh FROM fx_spp_prices
WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def _(v):
    return fn.recent(v.prices, 7, AS_OF)


@query("p2_date_range", "event_id ts", "price_usd_mwh", """
SELECT event_id, ts, price_usd_mwh FROM fx_spp_prices
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'""")
def _(v):
    return fn.date_range(v.prices, "2024-01-05 00:00:00", "2024-01-09 12:00:00")


@query("p3_by_hub", "event_id ts", "price_usd_mwh", """
SELECT event_id, ts, price_usd_mwh FROM fx_spp_prices
WHERE settlement_point = 'HB_HOUSTON' AND market_type = 'DAM'""")
def _(v):
    return fn.matching(v.prices, settlement_point="HB_HOUSTON", market_type="DAM")


@query("p4_plausible", "ts", "load_mw", "SELECT ts, load_mw FROM fx_grid_load WHERE load_mw > 10000 AND load_mw > 20000")
def _(v):
    return fn.above(fn.above(v.load, "load_mw", 10_000), "load_mw", 20_000)


@query("p5_drop_missing", "ts zone", "temperature_2m relative_humidity", """
SELECT ts, zone, temperature_2m, relative_humidity FROM fx_weather
WHERE relative_humidity IS NOT NULL AND temperature_2m IS NOT NULL""")
def _(v):
    return fn.drop_missing(v.weather, ["temperature_2m", "relative_humidity", "absent_column"])


@query("p6_calendar", "event_id hour day_of_week month is_weekend week_of_year date", "", """
SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week, CAST(month(ts) AS INT) AS month,
  CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(weekofyear(ts) AS INT) AS week_of_year,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM fx_spp_prices""")
def _(v):
    return fn.calendar(v.prices, iso_week=True, date=True)


@query("p7_cyclic", "event_id", "hour_sin hour_cos dow_sin dow_cos month_sin month_cos week_sin week_cos", """
SELECT event_id, sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
  sin(2 * pi() * (isodow(ts) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(ts) - 1) / 7) AS dow_cos,
  sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos,
  sin(2 * pi() * weekofyear(ts) / 52) AS week_sin, cos(2 * pi() * weekofyear(ts) / 52) AS week_cos
FROM fx_spp_prices""")
def _(v):
    return fn.with_cyclic(fn.calendar(v.prices, iso_week=True), hour=("hour", 24), dow=("day_of_week", 7),
                          month=("month", 12), week=("week_of_year", 52))


@query("p8_derived", "ts zone", "temp_squared wind_power_proxy grid_stress Renewables Net_Load temp_x_month", """
SELECT w.ts, w.zone, temperature_2m * temperature_2m AS temp_squared,
  wind_speed_10m * wind_speed_10m * wind_speed_10m AS wind_power_proxy, load_mw - forecast_mw AS grid_stress,
  coalesce(Wind, 0) + coalesce(Solar, 0) AS Renewables, load_mw - (coalesce(Wind, 0) + coalesce(Solar, 0)) AS Net_Load,
  temperature_2m * sin(2 * pi() * month(w.ts) / 12) AS temp_x_month
FROM fx_weather w JOIN fx_grid_load g ON w.ts = g.ts JOIN (
  SELECT ts, arg_min(value, event_id) FILTER (type = 'WND') AS Wind,
         arg_min(value, event_id) FILTER (type = 'SUN') AS Solar FROM fx_fuel GROUP BY ts) f ON w.ts = f.ts""")
def _(v):
    rows = v.weather.join(v.load.drop("grid_stress"), "ts").join(feeds.fuel_pivot(v.fuel), "ts")
    return fn.derived(fn.with_cyclic(fn.calendar(rows), month=("month", 12)))


@query("p9_zero_as_missing", "ts", "load_mw", "SELECT ts, nullif(load_mw, 0) AS load_mw FROM fx_grid_load")
def _(v):
    return v.load.withColumn("load_mw", fn.zero_as_missing("load_mw"))


@query("p10_coalesce_zero", "ts zone", "relative_humidity",
       "SELECT ts, zone, coalesce(relative_humidity, 0) AS relative_humidity FROM fx_weather")
def _(v):
    return v.weather.withColumn("relative_humidity", fn.or_zero("relative_humidity"))


@query("p11_sanitize", "l_orderkey l_linenumber", "value", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 4 IN (0, 1) OR l_linenumber % 4 = 2 THEN 0 ELSE y END AS value FROM fx_pred""")
def _(v):
    kind = F.col("l_linenumber") % 4
    spoiled = (F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("-inf")))
               .when(kind == 2, F.lit(None)).otherwise(F.col("y")))
    return v.pred.withColumn("value", fn.sanitize(spoiled))


@query("p12_stress_sign", "ts stress_label stress_positive stress_strong", "grid_stress", """
SELECT ts, grid_stress, CASE WHEN grid_stress > 0 THEN 'Over-forecast' WHEN grid_stress < 0 THEN 'Under-forecast' END AS stress_label,
  coalesce(grid_stress, 0) > 0 AS stress_positive, coalesce(abs(grid_stress) > 2000, false) AS stress_strong
FROM (SELECT ts, load_mw - forecast_mw AS grid_stress FROM fx_grid_load)""")
def _(v):
    return fn.stress_sign(v.load)


@query("p13_severity_rank", "alert_id severity rank", "", """
SELECT alert_id, severity, CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 WHEN 'info' THEN 1 ELSE 0 END AS rank
FROM h_alert_ids""")
def _(v):
    return alert_table(v).withColumn("rank", fn.severity_rank())


@query("p14_select_available", "ts", "load_mw grid_stress",
       "SELECT ts, load_mw, load_mw - forecast_mw AS grid_stress FROM fx_grid_load")
def _(v):
    wanted = [c for names in schemas.FEATURE_SETS.values() for c in names]
    return fn.select_available(v.load, wanted, keys=["ts"])


@query("p15_round_report", "l_orderkey l_linenumber", "mw price score", """
SELECT l_orderkey, l_linenumber, round(y, 1) AS mw, round(y / 7, 2) AS price, round(y_hat / y, 4) AS score FROM fx_pred""")
def _(v):
    return v.pred.select("l_orderkey", "l_linenumber", fn.round_report("y", "mw").alias("mw"),
                         fn.round_report(F.col("y") / 7, "price").alias("price"),
                         fn.round_report(F.col("y_hat") / F.col("y"), "score").alias("score"))


@query("p16_assign_alert_id", "alert_id event_id alert_type", "",
       "SELECT alert_id, event_id, alert_type FROM h_alert_ids")
def _(v):
    return alert_table(v)


@query("p17_format_alert_text", "event_id alert_type title description", "", "SELECT * FROM h_alert_text")
def _(v):
    return detect.condition_alerts(v.conditions)


@query("w8_latest_per_key", "model_name metric_name metric_id ts", "metric_value", """
SELECT * FROM fx_metrics QUALIFY row_number() OVER (PARTITION BY model_name, metric_name ORDER BY ts DESC, metric_id DESC) = 1""")
def _(v):
    return ordered.latest_per_key(v.metrics, ["model_name", "metric_name"], ["ts", "metric_id"])
