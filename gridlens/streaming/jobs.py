"""Structured Streaming jobs. Each returns a started query; the caller awaits it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlens.functions.scalars import drop_missing
from gridlens.operators.aggregates import price_rollup
from gridlens.operators.blocks import SEQ_LEN, pack
from gridlens.operators.detect import (
    Reconstruction, anomaly_events, condition_alerts, condition_snapshot, flag,
    reconstruction_score_blocks)
from gridlens.operators.joins import without_known
from gridlens.operators.ordered import first_per_key, join_on, latest_per_key
from gridlens.schemas import PRICES_HOURLY
from gridlens.session import materialise, path_exists, scratch
from gridlens.sources.store import LogTable, RollupLog, alert_payload, event_record

# Seconds between polls of each feed.
POLL_SECONDS = {"load": 300, "weather": 3600, "price": 900, "conditions": 300}
LATENESS = "3 days"


def cadence(feed: str | None) -> dict:
    """Trigger options: a feed's polling interval, or drain what is there and stop."""
    if feed is None:
        return {"availableNow": True}
    return {"processingTime": f"{POLL_SECONDS[feed]} seconds"}


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _writer(checkpoint: str) -> str:
    """A stream is known by its checkpoint: with a new one its numbers start anew, and so does its name."""
    return f"stream:{checkpoint.rstrip('/')}"


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           feed: str | None, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**cadence(feed)).start())


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch read more than once; lost pieces are computed again from the source."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def rollup_stream(prices: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Hourly price rollup with bounded state. The whole window is the key: grouping by
    its start alone would lose the watermark."""
    price = F.col("price_usd_mwh")
    return (prices.withWatermark("ts", lateness)
            .groupBy(F.window("ts", "1 hour"), "settlement_point", "market_type")
            .agg(F.avg(price).alias("avg_price_usd_mwh"), F.max(price).alias("max_price_usd_mwh"),
                 F.min(price).alias("min_price_usd_mwh"))
            .select(F.col("window.start").alias("bucket"), "settlement_point", "market_type",
                    "avg_price_usd_mwh", "max_price_usd_mwh", "min_price_usd_mwh"))


def rollup_table(spark: SparkSession, path: str) -> LogTable:
    return LogTable(spark, path, PRICES_HOURLY, ["bucket", "settlement_point", "market_type"], ts="bucket")


def stream_rollup(prices: DataFrame, table: LogTable, checkpoint: str, feed: str | None = None,
                  lateness: str = LATENESS) -> StreamingQuery:
    """Changed buckets of each micro-batch are upserted; ``table.latest()`` is the rollup."""
    return _start(rollup_stream(prices, lateness), lambda df, n: table.append(
        df, n, writer=_writer(checkpoint), unique=True, small_days=True), checkpoint, feed, mode="update")


def stream_refresh(prices: DataFrame, raw: LogTable, table: LogTable, checkpoint: str,
                   feed: str | None = None) -> StreamingQuery:
    """Raw rows into their table, and every bucket that they touch rebuilt from it, however late they are."""
    def write(df: DataFrame, n: int) -> None:
        with _kept(df) as batch:
            raw.append(batch, n, writer=_writer(checkpoint))
            rebuild_buckets(batch, raw, table, n, _writer(checkpoint))
    return _start(prices, write, checkpoint, feed)


def stream_partial_rollup(prices: DataFrame, table: RollupLog, checkpoint: str, feed: str | None = None) -> StreamingQuery:
    """Each batch adds its partial aggregates, however late its rows; ``table.rollup()`` is the rollup."""
    return _start(prices, lambda df, n: table.add(df, n, _writer(checkpoint)), checkpoint, feed)


def rebuild_buckets(changed: DataFrame, raw: LogTable, table: LogTable, batch: int | None = None,
                    writer: str = "refresh") -> None:
    """Upsert the buckets of the changed rows, computed from all raw rows of their days."""
    hour = F.date_trunc("hour", "ts")
    touched = changed.select(hour.alias("bucket"), "settlement_point", "market_type").distinct()
    first, last = touched.agg(F.min(F.to_date("bucket")), F.max(F.to_date("bucket"))).first()
    if first is not None:
        rows = raw.log(str(first), str(last)).withColumn("bucket", hour)
        rows = rows.join(touched, touched.columns, "left_semi").drop("bucket")
        table.append(price_rollup(rows), batch, writer=writer, unique=True, small_days=True)


def stream_append(rows: DataFrame, table: LogTable, checkpoint: str, feed: str | None = None) -> StreamingQuery:
    """Every row of each batch into the log."""
    return _start(rows, lambda df, n: table.append(df, n, writer=_writer(checkpoint)), checkpoint, feed)


def stream_upsert(rows: DataFrame, table: LogTable, checkpoint: str, position: str,
                  feed: str | None = None) -> StreamingQuery:
    """Last row per key of each batch into the log."""
    def write(df: DataFrame, n: int) -> None:
        table.append(latest_per_key(df, table.keys, [position]), n, position, _writer(checkpoint))
    return _start(rows, write, checkpoint, feed)


def stream_insert_ignore(rows: DataFrame, table: LogTable, checkpoint: str, position: str,
                         feed: str | None = None) -> StreamingQuery:
    """First row per key of each batch, unless an earlier batch holds the key.

    Only the partitions that the batch falls into are read. A replay of an accepted batch
    adds nothing; one of a batch that was not accepted finds none of its own rows.
    """
    def write(df: DataFrame, n: int) -> None:
        with _kept(df) as batch:
            span = [F.to_date(F.date_trunc(table.grain, edge(table.ts))) for edge in (F.min, F.max)]
            first, last = batch.agg(*span).first()
            known = table.log(str(first), str(last)) if first else table.log().limit(0)
            fresh = without_known(first_per_key(batch, table.keys, [position]), known, table.keys)
            table.append(fresh, n, position, _writer(checkpoint))
    return _start(rows, write, checkpoint, feed)


def stream_alerts(conditions: DataFrame, alerts: LogTable, outages: LogTable, checkpoint: str,
                  assign_id: Callable[[DataFrame], DataFrame], threshold: float = 0.90,
                  feed: str | None = None) -> StreamingQuery:
    """Rules and snapshot of every condition row, by the row's own time."""
    def write(df: DataFrame, n: int) -> None:
        with _kept(df) as batch:
            alerts.append(assign_id(condition_alerts(batch, threshold)), n, writer=_writer(checkpoint), unique=True)
            outages.append(condition_snapshot(batch, threshold), n, writer=_writer(checkpoint), unique=True)
    return _start(conditions, write, checkpoint, feed)


def stream_payloads(alerts: DataFrame, folder: str, checkpoint: str, feed: str | None = None) -> StreamingQuery:
    """Alert texts as JSON lines, one folder per batch."""
    def write(df: DataFrame, n: int) -> None:
        alert_payload(df).select("payload").write.mode("overwrite").text(f"{folder}/batch={n}")
    return _start(alerts, write, checkpoint, feed)


class Context:
    """The rows that windows to come still reach, one small written table per micro-batch.

    Batch ``n`` reads the newest table before it and writes its own, so that a replay finds what the first run found;
    tables before those two are deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        return at, at.getFileSystem(sc._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        at, fs = self._fs()
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.removeprefix("batch=")) for n in names
                      if n.startswith("batch=") and path_exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def before(self, n: int, schema) -> DataFrame:
        known = [b for b in self.batches() if b < n]
        return (self.spark.read.schema(schema).parquet(f"{self.path}/batch={known[-1]}") if known
                else self.spark.createDataFrame([], schema))

    def write(self, rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={n}")
        at, fs = self._fs()
        for old in [b for b in self.batches() if b < n][:-1]:
            fs.delete(at.suffix(f"/batch={old}"), True)


def _newest(rows: DataFrame, series: Sequence[str], name: str = "_newest") -> DataFrame:
    """Each row with the newest time of its series. A single series needs no join: its newest time is one value."""
    if not series:
        return rows.withColumn(name, F.lit(rows.agg(F.max("ts")).first()[0]).cast(rows.schema["ts"].dataType))
    return join_on(rows, rows.groupBy(*series).agg(F.max("ts").alias(name)), series)


def still_reached(rows: DataFrame, series: Sequence[str], order: Sequence[str], seq_len: int, lateness: str,
                  forget: str | None = None) -> DataFrame:
    """The rows that windows ending at a row not later than ``lateness`` before the newest of its series can hold:
    those since then, and the ``seq_len - 1`` before them. Series without a row for the time ``forget`` have none."""
    span, plain = F.expr(f"INTERVAL {lateness}"), rows.columns
    dated = _newest(rows, series)
    if forget:
        newest = rows.agg(F.max("ts")).first()[0]
        dated = dated.where(F.col("_newest") >= F.lit(newest).cast(rows.schema["ts"].dataType) - F.expr(f"INTERVAL {forget}"))
    recent = dated.where(F.col("ts") >= F.col("_newest") - span).select(*plain)
    older = dated.where(F.col("ts") < F.col("_newest") - span).select(*plain)
    backwards = [F.col(c).desc() for c in order]
    if series:  # ranked within tasks first, so that a hot series sends few rows on
        older = (older.withColumn("_k", F.row_number().over(Window.partitionBy(*series).orderBy(*backwards)))
                 .where(F.col("_k") < seq_len).drop("_k"))
    else:
        older = older.orderBy(*backwards).limit(seq_len - 1)
    return recent.unionByName(older)


def stream_anomaly(rows: DataFrame, context: str, events: LogTable, checkpoint: str,
                   model: Reconstruction, features: Sequence[str], threshold: float,
                   series: Sequence[str] = (), ties: Sequence[str] = (), seq_len: int = SEQ_LEN,
                   lateness: str = LATENESS, forget: str | None = None, feed: str | None = None) -> StreamingQuery:
    """Score the windows that end in the batch, each once.

    A row is known by series, time and ``ties``, so rows of equal time stay apart. What windows reach back to is kept
    in ``context``, a folder that holds per series its rows of the last ``lateness`` and the ``seq_len - 1`` before
    them: the work of a batch does not grow with what came before. Rows later than that are not scored. The state is
    a table and not a store keyed by series, so that one series is scored by many tasks.
    """
    order = ["ts", *ties]
    keys = [*series, *order]
    held = Context(rows.sparkSession, context)

    def write(df: DataFrame, n: int) -> None:
        with _kept(drop_missing(df.select(*keys, *features))) as batch, scratch():
            if batch.isEmpty():
                return
            known = held.before(n, batch.schema)
            edge = known.groupBy(*series).agg(F.max("ts").alias("_edge")) if series else None
            if series:
                mine = join_on(batch, edge, series, "left")
            else:
                last = known.agg(F.max("ts")).first()[0]
                mine = batch.withColumn("_edge", F.lit(last).cast(batch.schema["ts"].dataType))
            mine = mine.where(F.col("_edge").isNull() | (F.col("ts") >= F.col("_edge") - F.expr(f"INTERVAL {lateness}")))
            mine = mine.select(*keys, *features, F.lit(1.0).alias("_new"))
            known = without_known(known, mine, keys)
            both = materialise(known.withColumn("_new", F.lit(0.0)).unionByName(mine), "context")
            packed = pack(both, [*features, "_new"], series, order, seq_len, stored=True)
            scored = reconstruction_score_blocks(packed, features, model, only="_new")
            events.append(event_record(anomaly_events(flag(scored, threshold))), n, writer=_writer(checkpoint))
            # Last, so that a replay after a failure still finds the context without this batch.
            held.write(still_reached(both.drop("_new"), series, order, seq_len, lateness, forget), n)
    return _start(rows, write, checkpoint, feed)
