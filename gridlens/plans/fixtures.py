"""Typed reads of the test tables and portable views over them.

Each view is one SQL text that Spark and DuckDB both accept.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"

# Read schemas. Timestamps are taken as instants in UTC, which keeps time filters in the scan.
TABLES = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "pages": "page_id long, url string, html string",
}

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"

VIEWS = {
    "fx_grid_load": """
SELECT date_trunc('hour', ts) AS ts,
  CASE WHEN max(event_id) % 50 = 0 THEN 0.0 ELSE avg(value) * 800 END AS load_mw,
  avg(CASE WHEN event_type = 'view' THEN value END) * 800 AS forecast_mw
FROM {events} GROUP BY date_trunc('hour', ts)""",
    "fx_spp_prices": """
SELECT ts,
  CASE event_type WHEN 'click' THEN 'HB_HOUSTON' WHEN 'view' THEN 'HB_NORTH' WHEN 'purchase' THEN 'HB_SOUTH'
                  WHEN 'signup' THEN 'HB_WEST' ELSE 'HB_BUSAVG' END AS settlement_point,
  value - 20 AS price_usd_mwh,
  CASE WHEN user_id % 2 = 0 THEN 'DAM' ELSE 'RTM' END AS market_type,
  event_id
FROM {events}""",
    "fx_weather": f"""
SELECT date_trunc('hour', ts) AS ts,
  CASE user_id % 5 WHEN 0 THEN 'houston' WHEN 1 THEN 'dallas' WHEN 2 THEN 'san_antonio'
                   WHEN 3 THEN 'west_texas' ELSE 'corpus' END AS zone,
  avg(value) / 4 AS temperature_2m, min(value) AS wind_speed_10m, max(value) AS direct_radiation,
  max(CASE WHEN {_K} >= 50 THEN {_K} END) AS relative_humidity
FROM {{events}} GROUP BY 1, 2""",
    "fx_conditions": f"""
SELECT ts, event_id, 40000 + value * 100 AS demand,
  CASE WHEN event_id % 97 = 0 THEN 0.0E0 ELSE 75000.0E0 END AS capacity,
  value * 10 AS wind, value * 5 AS solar, 60 + ({_K} - 50) / 400 AS freq
FROM {{events}}""",
    "fx_readings": f"""
SELECT ts, event_id, CASE WHEN event_id % 50 = 0 THEN 0.0E0 ELSE value * 800 END AS load_mw,
  CASE WHEN event_id % 7 <> 0 THEN value * 790 END AS forecast_mw,
  {_K} / 4 AS temperature_2m, value / 10 AS wind_speed_10m, CAST(user_id AS DOUBLE) AS direct_radiation,
  CASE WHEN event_type = 'click' THEN value END AS Wind, CASE WHEN event_type = 'view' THEN value END AS Solar
FROM {{events}}""",
    "fx_fuel": """
SELECT date_trunc('hour', ts) AS ts,
  CASE event_type WHEN 'click' THEN 'WND' WHEN 'view' THEN 'SUN' WHEN 'purchase' THEN 'NG'
                  WHEN 'signup' THEN 'COL' ELSE 'NUC' END AS type,
  event_id, value
FROM {events}""",
    "fx_pred": """
SELECT l_orderkey, l_linenumber, l_returnflag AS model_name,
  CAST(l_linenumber % 2 AS INT) * 23 + 1 AS horizon, l_shipdate AS ts,
  l_extendedprice AS y, l_extendedprice * (1 + (l_discount - 0.05)) AS y_hat
FROM {lineitem}""",
    "fx_metrics": """
SELECT o_orderkey AS metric_id, o_orderdate AS ts, concat('model_', o_orderstatus) AS model_name,
  CASE WHEN o_custkey % 2 = 0 THEN 'mape' ELSE 'mae' END AS metric_name, o_totalprice / 1000 AS metric_value
FROM {orders}""",
    "fx_demand_feed": """
SELECT event_id AS pos,
  CASE WHEN event_id % 61 = 0 THEN '' ELSE replace(substring(CAST(ts AS STRING), 1, 13), ' ', 'T') END AS period,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'D' ELSE 'DF' END AS type,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'n/a'
       ELSE CAST(value AS STRING) END AS value
FROM {events}""",
    "fx_dam_page": """
SELECT event_id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE substring(CAST(ts AS STRING), 1, 10) END AS operating_day,
  CASE WHEN event_id % 19 = 0 THEN 'XX' ELSE CAST(extract(hour FROM ts) + 1 AS STRING) END AS hour_ending,
  CAST(value AS STRING) AS hb_houston,
  CASE WHEN event_id % 7 = 0 THEN '-' ELSE CAST(value * 2 AS STRING) END AS hb_north,
  CASE WHEN event_id % 11 = 0 THEN 'NaN' ELSE CAST(value - 30 AS STRING) END AS hb_busavg
FROM {events}""",
    "fx_rtm_page": """
SELECT event_id,
  CASE WHEN event_id % 13 = 0 THEN 'not a time' WHEN event_id % 29 = 0 THEN NULL
       ELSE CAST(ts AS STRING) END AS interval_ending,
  CAST(value AS STRING) AS hb_south,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(value + 5 AS STRING) END AS hb_west
FROM {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(path)


class Fixtures:
    """The views as DataFrames, over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    @cached_property
    def load(self) -> DataFrame:
        return self.view("fx_grid_load").withColumn("grid_stress", F.col("load_mw") - F.col("forecast_mw"))

    @cached_property
    def prices(self) -> DataFrame:
        return self.view("fx_spp_prices")

    @cached_property
    def weather(self) -> DataFrame:
        return self.view("fx_weather")

    @cached_property
    def conditions(self) -> DataFrame:
        return self.view("fx_conditions")

    @cached_property
    def fuel(self) -> DataFrame:
        return self.view("fx_fuel")

    @cached_property
    def readings(self) -> DataFrame:
        """One long series: every event as a meter reading."""
        return self.view("fx_readings")

    @cached_property
    def pred(self) -> DataFrame:
        return self.view("fx_pred")

    @cached_property
    def metrics(self) -> DataFrame:
        return self.view("fx_metrics")

    @cached_property
    def demand_feed(self) -> DataFrame:
        return self.view("fx_demand_feed")

    @cached_property
    def dam_page(self) -> DataFrame:
        return self.view("fx_dam_page").withColumnsRenamed({
            "operating_day": "Operating Day", "hour_ending": "Hour Ending", "hb_houston": "HB_HOUSTON",
            "hb_north": "HB_NORTH", "hb_busavg": "HB_BUSAVG"})

    @cached_property
    def rtm_page(self) -> DataFrame:
        return self.view("fx_rtm_page").withColumnsRenamed({
            "interval_ending": "Interval Ending", "hb_south": "HB_SOUTH", "hb_west": "HB_WEST"})


def duck(text: str) -> str:
    """The view text for DuckDB, whose tables go by their plain names."""
    return re.sub(r"\{(\w+)\}", r"\1", text)
