"""Vectorised helpers on the bytes of many texts at once; they run inside Spark tasks.

Texts come as Arrow columns. A null text is treated as empty throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that Spark hands to a Python worker at once: long texts must not add up.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
#: Bytes of text that the array code below takes at once; its arrays need some 100 times as much.
PIECE = 1 << 20

U64 = np.uint64
_RNG = np.random.default_rng(0x51EED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that are neither ASCII letters nor part of a longer character.
NOT_LETTERS = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prepare(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker receives at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, which its owner sizes with the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every other."""
    h = (h ^ (h >> U64(31))) * U64(0x7FB5D329728EA185)
    h = (h ^ (h >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


def flatten(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offsets where each begins (one more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    if texts.type not in (pa.large_string(), pa.large_binary()):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("" if texts.type == pa.large_string() else b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offs - offs[0]


def pieces(offs: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text is alone in its range."""
    first, n = 0, len(offs) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def window_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``buf[i:i+k]``, by doubling; ``len(buf) - k + 1`` of them."""
    if len(buf) < k:
        return np.zeros(0, np.uint64)
    cur, length, out, have = _BYTE[buf], 1, None, 0
    while True:
        if k & length:
            if out is None:
                out, have = cur, length
            else:
                n = len(buf) - have - length + 1
                out, have = out[:n] * U64(pow(_BASE, length, 1 << 64)) + cur[have : have + n], have + length
        if length * 2 > k:
            return mix(out)
        cur = cur[:-length] * U64(pow(_BASE, length, 1 << 64)) + cur[length:]
        length *= 2


def slide(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over each ``values[i:i+width]``, by doubling."""
    if len(values) < width:
        return values[:0]
    cur, length = values, 1
    while length * 2 <= width:
        cur = op(cur[:-length], cur[length:])
        length *= 2
    if length < width:
        rest = width - length
        cur = op(cur[:-rest], cur[rest:])
    return cur


#: Powers of the base and of its inverse, grown to the longest text seen by this process.
_TABLES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES[0]) <= n:
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _TABLES[i] = np.cumprod(steps)
    return _TABLES[0], _TABLES[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``buf[starts[i]:ends[i]]``; equal contents hash alike wherever they stand."""
    up, down = _power_tables(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(buf: np.ndarray, offs: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the lower-cased (A-Z) texts: hash, first byte and text of each. ``between`` marks the bytes that
    part words, by default ``[\\x20\\x09-\\x0D]``."""
    low = _LOWER[buf]
    inside = ~between[low]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(buf))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return span_hashes(low, s, e), s, np.searchsorted(offs, s, "right") - 1


def shingles(hashes: np.ndarray, owner: np.ndarray, n_texts: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``size`` words within a text; shorter texts give all their words as one."""
    count = np.bincount(owner, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    n = len(hashes)
    acc = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        acc = acc * U64(_BASE) + hashes[j : j + len(acc)]
    ok = owner[: len(acc)] == owner[size - 1 : size - 1 + len(acc)] if len(acc) else np.zeros(0, bool)
    out, who = [mix(acc[ok])], [owner[: len(acc)][ok]]
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(size):
            has = count[few] > j
            at = np.where(has, first[few] + j, 0)
            short = np.where(has, short * U64(_BASE) + hashes[at], short)
        out.append(mix(short + count[few].astype(np.uint64) * U64(0xD6E8FEB86659FD93)))
        who.append(few)
    sh, ow = np.concatenate(out), np.concatenate(who)
    if len(few):
        order = np.argsort(ow, kind="stable")
        sh, ow = sh[order], ow[order]
    return sh, ow
