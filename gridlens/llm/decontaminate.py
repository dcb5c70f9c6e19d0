"""Benchmark decontamination: a BM25 index of the test items, queried with every passage of the training texts.

A passage is a stretch of twice the longest item's words; stretches overlap by half, so each copy of an item lies
whole in one. Scores are BM25 shares of what the item scores against itself. Retrieval is block-max WAND over all
passages of a task at once: terms so common that together they cannot lift any item of a block to the threshold are
left out at first; the block's greatest impacts of the other terms bound its scores, and only blocks whose bound
reaches the threshold are scored in full. Each retrieved item is then verified on the words themselves: its question
(first half) and its answer (second half) must both be there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.llm.textops import U64, flatten, mix, pieces, prepare, words
from gridlens.llm.textops import _BASE
from gridlens.session import materialise

K1, B = 1.2, 0.75
#: Share of an item's own score from which a passage is a candidate; of the shingles of either half that verify it.
THRESHOLD, OVERLAP = 0.4, 0.75
SHINGLE, BLOCK = 5, 16
#: Items and words of an index; more make more indexes, each passed over all texts, so that what tasks hold stays
#: bounded. An item of more words is an index of its own. Statistics are those of the whole benchmark in each.
SHARD, SHARD_WORDS = 20_000, 8_000_000


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of ``size`` words."""
    acc = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for j in range(size):
        acc = acc * U64(_BASE) + hashes[j : j + len(acc)]
    return mix(acc)


@dataclass(frozen=True)
class Index:
    items: np.ndarray  # ids
    halves: list  # per item: ((shingle words, distinct shingles) of the question, the same of the answer)
    window: int  # words of a passage
    terms: np.ndarray  # sorted word hashes
    low: np.ndarray  # 2**16 flags: whether any term has these low bits
    posting_start: np.ndarray  # by term, into the next two
    posting_item: np.ndarray
    posting_impact: np.ndarray
    essential_start: np.ndarray  # by term, into the next two; empty for terms left out at first
    essential_block: np.ndarray
    essential_most: np.ndarray
    slack: np.ndarray  # by block, what the terms left out can add at most


@dataclass(frozen=True)
class Statistics:
    """Of the whole benchmark, so that an item's scores and passages do not depend on its index."""

    items: int
    mean: float  # words of an item
    longest: int  # words of the longest item


def build_index(ids: Sequence[int], texts: Sequence[str], whole: Statistics | None = None,
                frequency: dict[int, int] | None = None) -> Index:
    """Items without words are in the index but never found. ``whole`` and ``frequency``, items by word hash, are
    counted from the given items if left out."""
    buf, offs = flatten(pa.array(texts, pa.large_string()))
    hashes, _, owner = words(buf, offs)
    n = len(ids)
    length = np.bincount(owner, minlength=n)
    terms, at = np.unique(hashes, return_inverse=True)
    pair, tf = np.unique(at * n + owner, return_counts=True)
    term, item = pair // n, pair % n
    df = np.bincount(term, minlength=len(terms))
    if whole is None:
        whole = Statistics(n, length.mean() if n else 0, int(length.max()) if n else 0)
    if frequency is not None:
        df = np.array([frequency[t] for t in terms.tolist()], np.int64)
    idf = np.log1p((whole.items - df + 0.5) / (df + 0.5))
    mean = max(whole.mean, 1e-9)
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / mean))
    impact = impact / np.bincount(item, impact, n)[item]
    start = np.searchsorted(term, np.arange(len(terms) + 1))
    # Common terms are left out as long as what is left out of any item stays under the threshold.
    out, essential = np.zeros(n), np.ones(len(terms), bool)
    for t in np.argsort(-df, kind="stable"):
        s = slice(start[t], start[t + 1])
        if (out[item[s]] + impact[s] < 0.9 * THRESHOLD).all():
            out[item[s]] += impact[s]
            essential[t] = False
    blocks = -(-n // BLOCK)
    kept = essential[term]
    key = term[kept] * blocks + item[kept] // BLOCK
    block_key, place = np.unique(key, return_inverse=True)
    most = np.zeros(len(block_key))
    np.maximum.at(most, place, impact[kept])
    slack = np.zeros(blocks)
    np.maximum.at(slack, np.arange(n) // BLOCK, out)
    low = np.zeros(1 << 16, bool)
    low[(terms & U64(0xFFFF)).astype(np.int64)] = True
    edge = np.searchsorted(owner, np.arange(n + 1))
    halves = []
    for i in range(n):
        own = hashes[edge[i] : edge[i + 1]]
        cut = (len(own) + 1) // 2
        halves.append(tuple((min(SHINGLE, len(h)), np.unique(grams(h, min(SHINGLE, len(h)))))
                            for h in (own[:cut], own[cut:]) if len(h)))
    return Index(np.array(ids, np.int64), halves, 2 * max(whole.longest, SHINGLE), terms, low, start,
                 item, impact, np.searchsorted(block_key // max(blocks, 1), np.arange(len(terms) + 1)),
                 block_key % max(blocks, 1), most, slack)


def _expand(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with ranges starts[r]..starts[r+1]: which row each element belongs to, and its place."""
    size = starts[rows + 1] - starts[rows]
    which = np.repeat(np.arange(len(rows)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + starts[rows][which]


def find(index: Index, buf: np.ndarray, offs: np.ndarray) -> list[list[int]]:
    """For each text the items (by place in the index) of which it holds a verified copy."""
    n = len(offs) - 1
    found: list[set] = [set() for _ in range(n)]
    hashes, _, owner = words(buf, offs)
    if not len(hashes) or not len(index.terms):
        return [[] for _ in range(n)]
    first = np.searchsorted(owner, np.arange(n + 1))
    half = index.window // 2
    passages = np.maximum(1, -(-np.diff(first) // half) - 1)
    passage_of = np.concatenate([[0], np.cumsum(passages)])
    known = np.flatnonzero(index.low[(hashes & U64(0xFFFF)).astype(np.int64)])
    term = np.minimum(np.searchsorted(index.terms, hashes[known]), len(index.terms) - 1)
    hit = index.terms[term] == hashes[known]
    known, term = known[hit], term[hit]
    text = owner[known]
    stretch = (known - first[text]) // half
    pairs = []
    for back in (0, 1):
        k = stretch - back
        ok = (k >= 0) & (k < passages[text])
        pairs.append((passage_of[text[ok]] + k[ok]) * len(index.terms) + term[ok])
    pair = np.unique(np.concatenate(pairs))
    passage, term = pair // len(index.terms), pair % len(index.terms)
    blocks = len(index.slack)
    which, at = _expand(index.essential_start, term)
    key, place = np.unique(passage[which] * blocks + index.essential_block[at], return_inverse=True)
    bound = np.bincount(place, index.essential_most[at], len(key)) + index.slack[key % blocks]
    alive = key[bound >= THRESHOLD]
    if not len(alive):
        return [[] for _ in range(n)]
    live = np.isin(passage, np.unique(alive // blocks))
    passage, term = passage[live], term[live]
    which, at = _expand(index.posting_start, term)
    inside = np.isin(passage[which] * blocks + index.posting_item[at] // BLOCK, alive)
    which, at = which[inside], at[inside]
    key, place = np.unique(passage[which] * len(index.items) + index.posting_item[at], return_inverse=True)
    score = np.bincount(place, index.posting_impact[at], len(key))
    for cell in key[score >= THRESHOLD].tolist():
        p, item = divmod(cell, len(index.items))
        t = int(np.searchsorted(passage_of, p, "right")) - 1
        if item not in found[t]:
            start = first[t] + (p - passage_of[t]) * half
            own = hashes[start : min(start + index.window, first[t + 1])]
            if all(np.isin(half_of[1], grams(own, half_of[0])).sum() >= OVERLAP * len(half_of[1])
                   for half_of in index.halves[item]):
                found[t].add(item)
    return [sorted(f) for f in found]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each item, and its distinct word hashes."""
    for batch in batches:
        for a, b in pieces(flatten(batch.column(1))[1]):
            ids, texts = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
            hashes, _, owner = words(*flatten(texts))
            length = np.bincount(owner, minlength=b - a)
            edge = np.searchsorted(owner, np.arange(b - a + 1))
            own = [np.unique(hashes[edge[i] : edge[i + 1]]).view(np.int64) for i in range(b - a)]
            start = np.cumsum([0, *map(len, own)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, texts, pa.array(length, pa.int64()), pa.ListArray.from_arrays(start, np.concatenate([*own, np.zeros(0, np.int64)]))],
                names=["id", "text", "n", "hashes"])


def shards(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
           size: int | None = None, most_words: int | None = None) -> Iterator[Index]:
    """Indexes of at most ``size`` items and ``most_words`` words each, read part by part. Null texts count as empty;
    items with a null id are left out; of items with one id each is looked for.

    Item count, mean and longest length and the items of each word are counted by Spark over the whole benchmark. The
    driver holds one index at a time and the counts of its words only.
    """
    size, most_words = size or SHARD, most_words or SHARD_WORDS
    rows = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
                            .alias("text")).filter("id IS NOT NULL")
    counted = rows.mapInArrow(_counted, "id long, text string, n long, hashes array<long>")
    items, mean, longest = counted.agg(F.count(F.lit(1)), F.avg("n"), F.max("n")).first()
    whole = Statistics(items, mean or 0.0, longest or 0)
    frequency = None

    def built(part: list) -> Index:
        nonlocal frequency
        if len(part) == items:  # one index, whose own counts are those of the whole
            return build_index([r["id"] for r in part], [r["text"] for r in part])
        if frequency is None:
            frequency = materialise(counted.select(F.explode("hashes").alias("h")).groupBy("h").agg(
                F.count(F.lit(1)).alias("df")), "frequency")
        own = {h for r in part for h in r["hashes"]}
        wanted = benchmark.sparkSession.createDataFrame(pa.table({"h": pa.array(own, pa.int64())}))
        counts = {r["h"] & (1 << 64) - 1: r["df"] for r in frequency.join(wanted, "h").collect()}
        return build_index([r["id"] for r in part], [r["text"] for r in part], whole, counts)

    part, held = [], 0
    for row in counted.toLocalIterator():
        if part and (len(part) == size or held + row["n"] > most_words):
            yield built(part)
            part, held = [], 0
        part.append(row)
        held += row["n"]
    if part:
        yield built(part)


def _mark(shared, names: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            buf, offs = flatten(batch.column(text_at))
            before = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in pieces(offs):
                got = find(index, buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                items = [sorted({*(old or []), *(int(index.items[i]) for i in g)}) for old, g in zip(before[a:b], got)]
                carried = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(items, pa.list_(pa.int64()))], names=names)
    return run


def mark_leaks(df: DataFrame, benchmark: DataFrame, columns: Sequence[str], text_col: str = "text") -> DataFrame:
    """``columns`` of ``df`` and ``leaked_items``: ascending ids of the benchmark items that the text holds.

    An item is held if a passage retrieves it and at least 0.75 of the distinct five-word shingles of its question and
    of its answer stand in that passage (a half of fewer words is one shingle). Words are parted by
    ``[\\x20\\x09-\\x0D]`` after A-Z are lower-cased. Null and empty texts hold nothing. Rows are judged one by one,
    whatever their ids. A column named ``leaked_items`` in the input gives way. Empty tables are fine on either side.
    """
    spark = prepare(df.sparkSession)
    columns = [c for c in columns if c != "leaked_items"]
    held = [*columns, *([] if text_col in columns else [text_col])]
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in held],
                           T.StructField("leaked_items", T.ArrayType(T.LongType()))])
    out = df.select(*[F.col(f"`{c}`") for c in held], F.array().cast("array<bigint>").alias("leaked_items"))
    for index in shards(benchmark):
        # Of a class of the standard library: workers need no copy of this package to read it.
        shared = spark.sparkContext.broadcast(SimpleNamespace(**vars(index)))
        out = out.mapInArrow(_mark(shared, schema.fieldNames(), held.index(text_col)), schema)
    return out.select(*[F.col(f"`{c}`") for c in columns], "leaked_items")
