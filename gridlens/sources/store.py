"""Keyed tables as append logs of plain parquet.

Layout of a table folder::

    data/load=<id>/dt=<day>/...   the rows of one accepted batch or of one rewrite
    commits/<seq>-<id>.json       one small file per accepted batch, rewrite or expiry
    commits/<seq>-<id>.snapshot   all of them up to some point, merged

A batch counts from the moment its commit file has its name, and is known by its
writer and that writer's batch number. Readers take the pieces (load, day) that the
commits name, so nothing is listed but the commits. A rewrite names the pieces it
replaces; `vacuum` deletes what no commit names any more after a time of grace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.scalars import days_before, since
from gridlens.operators.ordered import first_per_key, join_on, latest_per_key
from gridlens.schemas import PRICE_PARTIALS, SCORE_SKETCHES

_ORDER = ["_batch", "_pos", "load"]
#: Commit files after which they are merged into a snapshot.
SNAPSHOT_EVERY = 32


@dataclass
class _State:
    next: int = 1
    live: dict[tuple[str, str], bool] = field(default_factory=dict)  # (load, day) -> whether rewritten
    single: set[tuple[str, str]] = field(default_factory=set)  # those that hold a row per key at most
    seen: dict[str, int] = field(default_factory=dict)  # writer -> its last batch
    files: list[str] = field(default_factory=list)
    fresh: int = 0  # commit files that no snapshot holds

    def apply(self, entry: dict) -> None:
        self.next = max(self.next, entry["seq"] + 1)
        gone = [tuple(x) for x in entry.get("replaces", [])]
        if entry["kind"] == "batch":
            if entry["batch"] <= self.seen.get(entry["writer"], -1):
                return  # a replay that raced with the first run
            self.seen[entry["writer"]] = entry["batch"]
        elif any(piece not in self.live for piece in gone):
            return  # another rewrite took these pieces first
        for piece in gone:
            del self.live[piece]
            self.single.discard(piece)
        pieces = [(entry["load"], day) for day in entry.get("days", [])]
        self.live |= {piece: entry["kind"] == "rewrite" for piece in pieces}
        if entry.get("single"):
            self.single |= set(pieces)


class LogTable:
    """One table; ``keys`` is its unique key, empty for plain append tables.

    ``grain`` is the span of a ``dt`` partition: days for the large tables, months
    for small ones kept over years.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 keys: Sequence[str] = (), ts: str = "ts", grain: str = "day"):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.ts, self.grain = list(keys), ts, grain
        self._stored = T.StructType([
            *schema.fields, T.StructField("_pos", T.LongType()), T.StructField("_batch", T.LongType()),
            T.StructField("load", T.StringType()), T.StructField("dt", T.DateType())])

    # Commits -----------------------------------------------------------------------

    def _at(self, name: str):
        """A path below the table, and its file system."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())

    def _children(self, name: str) -> list[tuple[str, int]]:
        """Names and modification times below a folder; none if it does not exist."""
        path, fs = self._at(name)
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path)] if fs.exists(path) else []

    def _read(self, name: str) -> dict:
        path, fs = self._at(f"commits/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, entry: dict, suffix: str) -> None:
        """The file gets its name only when it is whole."""
        name = f"{entry['seq']:012d}-{uuid.uuid4().hex}.{suffix}"
        hidden, fs = self._at(f"commits/_{name}")
        stream = fs.create(hidden, False)
        stream.write(json.dumps(entry).encode())
        stream.close()
        if not fs.rename(hidden, self._at(f"commits/{name}")[0]):
            raise OSError(f"cannot commit {name}")

    def _state(self) -> _State:
        names = sorted(n for n, _ in self._children("commits") if not n.startswith(("_", ".")))
        state, merged = _State(files=names), set()
        snapshots = [n for n in names if n.endswith(".snapshot")]
        if snapshots:
            held = self._read(snapshots[-1])
            state.next, state.seen, merged = held["seq"] + 1, held["seen"], set(held["merged"])
            state.live = {(load, day): rewritten for load, day, rewritten, *_ in held["live"]}
            state.single = {(load, day) for load, day, *rest in held["live"] if rest[1:] == [True]}
        for name in names:
            if name.endswith(".json") and name not in merged:
                state.apply(self._read(name))
                state.fresh += 1
        return state

    def _commit(self, entry: dict) -> None:
        self._put(entry, "json")
        state = self._state()
        if state.fresh >= SNAPSHOT_EVERY:
            self._put({"seq": state.next, "seen": state.seen, "live": [[*k, v, k in state.single] for k, v in state.live.items()],
                       "merged": [n for n in state.files if n.endswith(".json")]}, "snapshot")

    def _days_of(self, load: str) -> list[str]:
        return [n.removeprefix("dt=") for n, _ in self._children(f"data/load={load}") if n.startswith("dt=")]

    # Writing ---------------------------------------------------------------------

    def append(self, rows: DataFrame, batch: int | None = None, position: str | None = None,
               writer: str = "main", unique: bool = False, small_days: bool = False) -> None:
        """Store a batch under its writer and number. Numbers of a writer ascend; one that is
        not above its last is a replay and adds nothing. Without a number every call counts.

        ``position`` names the column that orders rows within the batch. A keyed table asks
        for it unless ``unique`` says that the batch has one row per key. ``small_days`` says
        a day fits one task. It is needed for the output of stateful streams, whose plans
        Spark does not adapt at run time, and holds for rollups.
        """
        if self.keys and position is None and not unique:
            raise ValueError("rows of a keyed table need a position")
        state, load = self._state(), uuid.uuid4().hex
        if batch is None:
            writer, batch = load, 0
        elif batch <= state.seen.get(writer, -1):
            return
        have = set(rows.columns)
        cells = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                 for f in self.schema.fields]
        pos = F.col(position).cast("long") if position else F.lit(0).cast("long")
        span = F.to_date(F.date_trunc(self.grain, self.ts))
        out = rows.select(*cells, pos.alias("_pos"), F.lit(state.next).cast("long").alias("_batch")).withColumn("dt", span)
        # A day's rows go together, and a day too large for one task is split at run time.
        laid = out.repartition("dt") if small_days else out.hint("rebalance", "dt")
        laid.write.partitionBy("dt").parquet(f"{self.path}/data/load={load}")
        self._commit({"seq": state.next, "kind": "batch", "writer": writer, "batch": int(batch), "load": load,
                      "days": self._days_of(load), "single": unique})

    # Reading -----------------------------------------------------------------------

    def _pieces(self, pieces: Sequence[tuple[str, str]]) -> DataFrame:
        if not pieces:
            return self.spark.createDataFrame([], self._stored)
        paths = [f"{self.path}/data/load={load}/dt={day}" for load, day in sorted(pieces)]
        return (self.spark.read.schema(self._stored).option("basePath", f"{self.path}/data").parquet(*paths)
                .select(*self._stored.fieldNames()))

    def log(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """All accepted rows with their batch and position; of the partitions ``first`` to
        ``last`` only, when given, as ISO dates."""
        def wanted(day: str) -> bool:
            return (first is None or day >= first) and (last is None or day <= last)

        return self._pieces([(load, day) for load, day in self._state().live if wanted(day)])

    def _plain(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[f.name for f in self.schema.fields], "dt")

    def rows(self) -> DataFrame:
        return self._plain(self.log())

    def latest(self) -> DataFrame:
        """Upsert reading: the last row written per key."""
        return self._plain(self._merged("latest"))

    def first(self) -> DataFrame:
        """Insert-once reading: the first row written per key."""
        return self._plain(self._merged("first"))

    def _fold(self, rows: DataFrame, mode: str) -> DataFrame:
        """One row per key. ``dt`` follows from the key's time; grouping by it too lets a
        predicate on it through to the partitions."""
        return (upsert_last if mode == "latest" else insert_ignore)(rows, [*self.keys, "dt"], _ORDER)

    def _merged(self, mode: str) -> DataFrame:
        """Days that are one piece with a row per key, as rewritten days are, are read as they are.

        Where later pieces came to a rewritten day, their keys are looked up in it: only its
        rows of those keys are folded with theirs. Only days never rewritten are grouped whole.
        """
        state = self._state()
        days: dict[str, list[tuple[str, str]]] = {}
        for piece in state.live:
            days.setdefault(piece[1], []).append(piece)
        settled, base, added, whole = [], [], [], []
        for pieces in days.values():
            written = [p for p in pieces if state.live[p] and p in state.single]
            if len(pieces) == 1 and pieces[0] in state.single:
                settled += pieces
            elif len(written) == 1:
                base += written
                added += [p for p in pieces if p != written[0]]
            else:
                whole += pieces
        parts = [self._pieces(settled)] if settled else []
        again = self._pieces([*added, *whole]) if added or whole else None
        if base:
            key = [*self.keys, "dt"]
            held, touched = self._pieces(base), self._pieces(added).select(*key).distinct()
            parts.append(join_on(held, touched, key, "left_anti"))
            again = again.unionByName(join_on(held, touched, key, "left_semi"))
        if again is not None:
            parts.append(self._fold(again, mode).select(*self._stored.fieldNames()))
        out = parts[0] if parts else self._pieces([])
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # Maintenance -------------------------------------------------------------------

    def _day_before(self, as_of, days: int) -> str:
        """Partitions up to this one, itself included, lie wholly before ``days`` ago."""
        limit = days_before(as_of, days)
        cut = F.date_sub(F.to_date(F.date_trunc(self.grain, limit)), 1)
        return self.spark.range(1).select(cut.cast("string")).first()[0]

    def compact(self, mode: str = "latest", segment_by: Sequence[str] = (),
                older_than_days: int | None = None, as_of=None, keep_days: int | None = None) -> None:
        """Rewrite days that changed and are old enough: one row per key, clustered, newest first.

        Only days that are not already a single rewritten piece are read. Days wholly beyond
        ``keep_days`` are dropped first. What is replaced stays readable until `vacuum`.
        """
        if keep_days is not None:
            self.expire(keep_days, as_of)
        state = self._state()
        last = None if older_than_days is None else self._day_before(as_of, older_than_days)
        days: dict[str, list[tuple[str, str]]] = {}
        for piece in state.live:
            if last is None or piece[1] <= last:
                days.setdefault(piece[1], []).append(piece)
        changed = [p for pieces in days.values() if len(pieces) > 1 or not state.live[pieces[0]] for p in pieces]
        if not changed:
            return
        rows = self._pieces(changed)
        single = bool(self.keys) and mode in ("latest", "first")
        if single:
            rows = self._fold(rows, mode)
        load = uuid.uuid4().hex
        cluster(rows.drop("load"), segment_by, self.ts).write.partitionBy("dt").parquet(f"{self.path}/data/load={load}")
        self._commit({"seq": state.next, "kind": "rewrite", "load": load, "days": self._days_of(load), "replaces": changed,
                      "single": single})

    def expire(self, keep_days: int, as_of=None) -> None:
        """Drop the days that lie wholly beyond the retention; `vacuum` deletes their files."""
        state, last = self._state(), self._day_before(as_of, keep_days)
        old = [piece for piece in state.live if piece[1] <= last]
        if old:
            self._commit({"seq": state.next, "kind": "expire", "load": "", "replaces": old})

    def vacuum(self, grace_seconds: float = 7 * 86_400) -> int:
        """Delete pieces that no commit names, and merged commit files, once they are older than
        the grace, which must outlast any read or write under way. Returns the folders deleted."""
        now = self.spark.sparkContext._jvm.System.currentTimeMillis()
        state, deleted = self._state(), 0
        old = lambda at: now - at >= grace_seconds * 1000
        for name, _ in self._children("data"):
            load = name.removeprefix("load=")
            days = self._children(f"data/{name}")
            for day, at in days:
                if day.startswith("dt=") and (load, day.removeprefix("dt=")) not in state.live and old(at):
                    path, fs = self._at(f"data/{name}/{day}")
                    deleted += bool(fs.delete(path, True))
        snapshots = [n for n in state.files if n.endswith(".snapshot")]
        merged = set(self._read(snapshots[-1])["merged"]) if snapshots else set()
        for name, at in self._children("commits"):
            if old(at) and (name in merged or name in snapshots[:-1]):
                path, fs = self._at(f"commits/{name}")
                fs.delete(path, False)
        return deleted


class RollupLog(LogTable):
    """A rollup as a log of partial aggregates: each batch adds its own sums, counts and extremes per bucket, which
    are merged when read and when days are rewritten. Rows of any lateness cost what they count themselves; raw rows
    are never read again."""

    def __init__(self, spark: SparkSession, path: str, grain: str = "day"):
        super().__init__(spark, path, PRICE_PARTIALS, ["bucket", "settlement_point", "market_type"], ts="bucket", grain=grain)

    def add(self, prices: DataFrame, batch: int | None = None, writer: str = "main") -> None:
        """The batch's rows, aggregated."""
        price = F.col("price_usd_mwh")
        sums = prices.groupBy(F.date_trunc("hour", "ts").alias("bucket"), "settlement_point", "market_type").agg(
            F.sum(price).alias("total"), F.count(price).alias("n"), F.max(price).alias("most"), F.min(price).alias("least"))
        self.append(sums, batch, writer=writer, unique=True, small_days=True)

    def _fold(self, rows: DataFrame, mode: str) -> DataFrame:
        return rows.groupBy(*self.keys, "dt").agg(
            F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("most").alias("most"), F.min("least").alias("least"),
            F.max("_pos").alias("_pos"), F.max("_batch").alias("_batch"), F.max("load").alias("load"))

    def rollup(self) -> DataFrame:
        return self.latest().select(*self.keys, (F.col("total") / F.col("n")).alias("avg_price_usd_mwh"),
                                    F.col("most").alias("max_price_usd_mwh"), F.col("least").alias("min_price_usd_mwh"), "dt")


#: Size of a quantile sketch; its rank error falls with it.
SKETCH_K = 4096


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of a sketch's quantile is from the wanted one, as a share of all values, in 99 of 100 cases."""
    return 2.296 / k ** 0.9021


class SketchLog(LogTable):
    """Mergeable quantile sketches of scores by day. A threshold over any days is read from their sketches and no old
    score is read again; batches, rewritten days and late scores only merge. `exact_percentile` is the exact way."""

    def __init__(self, spark: SparkSession, path: str, k: int = SKETCH_K, grain: str = "day"):
        super().__init__(spark, path, SCORE_SKETCHES, ["day"], ts="day", grain=grain)
        self.k = k

    def add(self, scores: DataFrame, batch: int | None = None, writer: str = "main", ts: str = "window_ts",
            score: str = "score") -> None:
        """The batch's scores, missing ones left out."""
        value = F.col(score).cast("double")
        rows = scores.select(F.date_trunc("day", ts).alias("day"), value.alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
        days = rows.groupBy("day").agg(F.kll_sketch_agg_double("v", self.k).alias("sketch"), F.count(F.lit(1)).alias("n"))
        self.append(days, batch, writer=writer, unique=True, small_days=True)

    def _fold(self, rows: DataFrame, mode: str) -> DataFrame:
        return rows.groupBy(*self.keys, "dt").agg(
            F.kll_merge_agg_double("sketch", self.k).alias("sketch"), F.sum("n").alias("n"),
            F.max("_pos").alias("_pos"), F.max("_batch").alias("_batch"), F.max("load").alias("load"))

    def threshold(self, p: float, first: str | None = None, last: str | None = None) -> tuple[float | None, int, float]:
        """The percentile of the scores of the days ``first`` to ``last`` (ISO dates; all without), how many there are,
        and the error of its rank."""
        rows = self.log(first, last)
        row = rows.agg(F.kll_merge_agg_double("sketch", self.k).alias("s"), F.sum("n").alias("n")).select(
            F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(float(p)))).alias("q"), "n").first()
        return row["q"], row["n"] or 0, rank_error(self.k)


def upsert_last(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_seq",)) -> DataFrame:
    """Last write per key wins, for every measure at once."""
    return latest_per_key(log, list(keys), list(order))


def insert_ignore(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_seq",)) -> DataFrame:
    """First write per key wins."""
    return first_per_key(log, list(keys), list(order))


def retain(rows: DataFrame, days: int, as_of=None, ts: str = "ts", grain: str = "day") -> DataFrame:
    """Drop rows older than the retention; whole partitions are pruned."""
    limit = days_before(as_of, days)
    return since(rows.where(F.col(ts) >= limit), limit, grain)


def cluster(rows: DataFrame, segment_by: Sequence[str], ts: str = "ts") -> DataFrame:
    """Rows of a segment together, newest first, for narrow min-max statistics.

    Ranges on (day, segment, time) rather than a hash of the segment, so that one
    large segment is still written by many tasks.
    """
    by_time = F.col(ts).desc()
    day = ["dt"] if "dt" in rows.columns else []
    keys = [*[F.col(c) for c in day], *[F.col(c) for c in segment_by]]
    return rows.repartitionByRange(*keys, by_time).sortWithinPartitions(*keys, by_time)


def metric_record(metrics: DataFrame, as_of=None) -> DataFrame:
    """Metric rows stamped for the store."""
    stamped = metrics if "ts" in metrics.columns else metrics.withColumn(
        "ts", F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"))
    for name, kind in (("horizon", "int"), ("notes", "string")):
        if name not in stamped.columns:
            stamped = stamped.withColumn(name, F.lit(None).cast(kind))
    return stamped.select("ts", "model_name", "metric_name", "metric_value", "horizon", "notes")


def event_record(events: DataFrame) -> DataFrame:
    """Anomaly events for the store: stamped with their detection time, gaps defaulted."""
    have = set(events.columns)

    def or_default(name, value):
        return F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)

    return events.select(
        F.col("detected_at").alias("ts"), "detected_at",
        or_default("anomaly_type", "reconstruction").alias("anomaly_type"),
        or_default("severity", 0.0).cast("double").alias("severity"),
        or_default("description", "").alias("description"))


def acknowledge(alerts: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New versions of the alerts to acknowledge, and per id whether one matched."""
    changed = alerts.join(ids.select("alert_id").distinct(), "alert_id", "left_semi").withColumn(
        "acknowledged", F.lit(True))
    hits = changed.select("alert_id").distinct().withColumn("matched", F.lit(True))
    report = ids.select("alert_id").distinct().join(hits, "alert_id", "left").withColumn(
        "matched", F.coalesce("matched", F.lit(False)))
    return changed, report


def alert_payload(alerts: DataFrame) -> DataFrame:
    """One JSON text per alert."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")
    body = F.struct("alert_id", "alert_type", "severity", "title", "description", "source", stamp)
    return alerts.select("alert_id", F.to_json(body).alias("payload"))
