"""Line dedup by levelled sorted runs of line hashes.

Documents come in batches of ascending ids. A run holds the line keys a batch was the first to show, sorted by
hash, with the document that owns each. A new batch is joined with the runs: keys they hold belong to older
documents, the rest become the batch's own run. When a level has ``fanout`` runs they are merged into one run
of the next level. Since ids ascend from batch to batch, the owner of a key is the smallest id that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.llm.store import remove, written
from gridlens.llm.textops import prepare

MIN_CHARS, BATCHES, FANOUT = 10, 4, 2
KEY = ["h1", "h2"]


def line_key(line: bytes) -> bytes:
    """A line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased (bytes methods mean just these)."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode("utf-8", "replace")) >= least)


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _texts(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.large_binary()).to_pylist()


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, second = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                keys = {line_key(x) for x in text.split(b"\n")}
                for key in keys:
                    if _long_enough(key, least):
                        digest = _digest(key)
                        ids.append(doc)
                        first.append(int.from_bytes(digest[:8], "big", signed=True))
                        second.append(int.from_bytes(digest[8:], "big", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                names=["doc", "h1", "h2"])
    return run


def _cuts(ids: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into batches of about equal size; any cuts give the same result."""
    shares = [i / batches for i in range(1, batches)]
    return sorted({int(x) for x in ids.approxQuantile("doc", shares, 0.01)}) if shares else []


class Runs:
    """The levels: each a list of tables of (h1, h2, owner), sorted by hash within their partitions."""

    def __init__(self, fanout: int):
        self.fanout, self.levels = fanout, [[]]

    def table(self) -> DataFrame | None:
        out = None
        for run in (r for level in self.levels for r, _ in level):
            out = run if out is None else out.unionByName(run)
        return out

    def add(self, run: DataFrame, paths: list[str]) -> None:
        self.levels[0].append((run, paths))
        for k in range(len(self.levels)):
            if len(self.levels[k]) < self.fanout:
                break
            made: list[str] = []
            merged = self.levels[k][0][0]
            for more, _ in self.levels[k][1:]:
                merged = merged.unionByName(more)
            spark = merged.sparkSession
            merged = written(merged.repartition(*KEY).sortWithinPartitions(*KEY), f"run{k + 1}", made)
            for _, old in self.levels[k]:
                remove(spark, old)
            self.levels[k] = []
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append((merged, made))


def dropped_keys(keys: DataFrame, cuts: Sequence[int], fanout: int = FANOUT,
                 made: list[str] | None = None) -> DataFrame:
    """The (doc, h1, h2) of ``keys`` (with their ``batch``) whose lines an older document owns."""
    made = [] if made is None else made
    runs, drops = Runs(fanout), None
    for b in range(len(cuts) + 1):
        batch = keys.filter(F.col("batch") == b).drop("batch")
        shown = batch.groupBy(*KEY).agg(F.min("doc").alias("own"), F.max("doc").alias("last"))
        older = runs.table()
        if older is None:
            merged = shown.withColumn("owner", F.col("own")).withColumn("fresh", F.lit(True))
        else:
            merged = (shown.join(older, KEY, "left").withColumn("fresh", F.col("owner").isNull())
                      .withColumn("owner", F.coalesce("owner", "own")))
        merged = merged.drop("own").sortWithinPartitions(*KEY)
        path: list[str] = []
        merged = written(merged, f"batch{b}", path)
        beyond = merged.filter(F.col("last") > F.col("owner")).select(*KEY, "owner")
        lost = batch.join(beyond, KEY).filter(F.col("doc") > F.col("owner")).select("doc", *KEY)
        lost = written(lost, f"lost{b}", made)
        drops = lost if drops is None else drops.unionByName(lost)
        if b < len(cuts):
            runs.add(merged.filter("fresh").select(*KEY, "owner"), path)
        else:
            remove(keys.sparkSession, path)
    for level in runs.levels:
        for _, old in level:
            remove(keys.sparkSession, old)
    return drops


def _strip(names: list[str], n_carry: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, lost in zip(_texts(batch.column(1)), batch.column(2).to_pylist()):
                parts = text.split(b"\n")
                lines.append(len(parts))
                if lost:
                    gone = set(lost)
                    parts = [x for x in parts if _digest(line_key(x)) not in gone]
                dropped.append(lines[-1] - len(parts))
                kept.append(b"\n".join(parts))
            columns = [batch.column(0), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
                       pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                       *[batch.column(3 + i) for i in range(n_carry)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
                min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Drop lines that a document with a smaller id holds too: ``id_col``, ``text_col`` without them,
    ``n_lines`` before, ``n_dropped``, and the columns named in ``carry``.

    Lines are compared by key (see `line_key`); keys under ``min_chars`` code points are never dropped, nor are
    repeats within the document that owns a line. A null or empty text is one empty line. Rows with a null id
    stay as they are and own nothing. Rows that share an id are one document: none of them drops a line of the
    other. Columns not in ``carry`` are left out, and a carried name that equals one of the operator's own gives
    way. An empty table gives an empty table.
    """
    spark = prepare(df.sparkSession)
    own = [id_col, text_col, "n_lines", "n_dropped"]
    carry = [c for c in carry if c not in own]
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"),
                     *[F.col(f"`{c}`").alias(f"carry{i}") for i, c in enumerate(carry)])
    made: list[str] = []
    ids = docs.select("doc").filter("doc IS NOT NULL")
    cuts = _cuts(ids, batches)
    keys = docs.select("doc", "text").filter("doc IS NOT NULL").mapInArrow(
        _keys(min_chars), "doc long, h1 long, h2 long")
    number = sum([(F.col("doc") > c).cast("int") for c in cuts], F.lit(0))
    keys = written(keys.distinct().withColumn("batch", number), "keys", made, partition_by="batch")
    drops = dropped_keys(keys, cuts, fanout, made)
    word = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    lost = drops.groupBy("doc").agg(F.collect_list(F.concat(word("h1"), word("h2"))).alias("lost"))
    joined = docs.join(lost, "doc", "left").select("doc", "text", "lost", *[f"carry{i}" for i in range(len(carry))])
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField(text_col, T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                           *[T.StructField(c, df.schema[c].dataType) for c in carry]])
    return joined.mapInArrow(_strip([f.name for f in schema], len(carry)), schema)
