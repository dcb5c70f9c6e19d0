"""Embedding near-dedup by collision-counting projections.

Every vector is projected on many random lines. Two vectors collide on a line when the one's value lies in the window
centred on the other's. A pair at the cosine bound collides on each line with a known chance, so the number of
collisions it reaches is binomial: pairs under the count that all but one in a hundred million such pairs reach
are refuted, the rest is verified by cosine in double precision.

Vectors are sorted along the direction in which they spread most and cut into blocks. Block pairs whose stretches lie
further apart than linked vectors can, or whose ranges overlap on too few lines for the count, are never compared.
A task reads two parts of the written blocks, so that no vector is moved once for each block it meets; what leaves it is
a row per linked vector: its number of links and the smallest vector it is connected with there. Equal vectors are one
node with a weight.

Collisions are counted for all pairs of two blocks, or, where that is less work, for those that share a key: the signs of
their projections on a few further lines. There are so many keys, each of lines of its own, that a pair at the bound shares
one with a known chance too, and keys, signs and counts together miss no more than one in a hundred million such pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.components import connected
from gridlens.llm.store import remove, shuffles_dropped, written
from gridlens.llm.textops import prepare

COSINE = 0.9
#: Lines, half a window in standard deviations of a pair at the bound, and the chance to miss such a pair.
LINES, WINDOW, MISS = 48, 2.0, 1e-8
#: Signs of a key, and the further signs of which a pair must share most: of the first, then of all.
BITS, SIGNS = 16, (128, 256)
#: Vectors of a block at least, those of a tile in it, and those of a tile that are compared at once.
BLOCK, TILE, ROWS = 2048, 2048, 256
#: Pairs whose cosines are computed at once, those that are picked by a key at once, and the most that are held.
PAIRS, TAKEN, HELD = 1 << 12, 1 << 15, 1 << 23
#: Bytes of a block, of blocks of a part that a task meets with another, and of blocks with signs that a task keeps.
BYTES, PART, KEPT = 7 << 20, 21 << 20, 128 << 20
#: Pairs whose collisions on all lines are counted while one pair is taken from a key, and while one key's table is made.
PICKED, SORTED = 3, 1 << 14
#: How far apart linked vectors can lie, and a step of the coarse projections.
FAR, STEP = math.sqrt(2 - 2 * COSINE), 10 / 255
#: The chance that a pair at the bound lies on one side of a plane through the origin.
SIDE = 1 - math.acos(COSINE) / math.pi


def _below(count: int, lines: int, hit: float) -> float:
    """The chance of fewer than ``count`` hits on ``lines``."""
    return sum(math.comb(lines, k) * hit**k * (1 - hit) ** (lines - k) for k in range(count))


def _reached(lines: int, hit: float, miss: float) -> int:
    """The most hits on ``lines`` that are reached but for a chance of ``miss``."""
    return next((count for count in range(lines) if _below(count + 1, lines, hit) > miss), lines)


def calibrated_count(lines: int = LINES, window: float = WINDOW, miss: float = MISS) -> int:
    """The most collisions that a pair at the bound reaches but for a chance of ``miss``."""
    return _reached(lines, math.erf(window / math.sqrt(2)), miss)


#: Signs that a pair must share: a pair at the bound shares fewer with a chance of at most a tenth of MISS each.
SHARED = [_reached(signs, SIDE, MISS / 10) for signs in SIGNS]


def keys(bits: int = BITS, miss: float = MISS) -> int:
    """How many keys of ``bits`` signs a pair at the bound needs to share one, so that keys, signs and collisions together
    miss it with a chance of at most ``miss``."""
    hit = math.erf(WINDOW / math.sqrt(2))
    left = miss - _below(calibrated_count(miss=miss), LINES, hit) - sum(
        _below(need, signs, SIDE) for need, signs in zip(SHARED, SIGNS))
    return math.ceil(math.log(left) / math.log1p(-(SIDE**bits)))


KEYS = keys()
#: Bytes of the signs of a vector: its keys, and those to share.
MARKS = (KEYS * BITS + SIGNS[-1]) // 8


def lines(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, LINES))


def _planes(dim: int) -> np.ndarray:
    return np.random.default_rng([dim, KEYS]).standard_normal((dim, MARKS * 8), np.float32)


def _scales(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest component of each row, and the row's length in units of it."""
    wide = raw.astype(np.float64)
    most = np.abs(wide).max(1, keepdims=True)
    wide /= most
    return most, np.sqrt((wide * wide).sum(1, keepdims=True))


def _units(raw: np.ndarray, most: np.ndarray | None = None, length: np.ndarray | None = None) -> np.ndarray:
    """Rows of length one, in double precision."""
    if most is None:
        most, length = _scales(raw)
    wide = raw / most
    wide /= length
    return wide


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row's components, None if it can link with nothing."""
    kind = np.float64 if column.type.value_type == pa.float64() else np.float32
    flat = column.values
    values = flat.fill_null(math.nan).to_numpy(zero_copy_only=False).astype(kind, copy=False) + kind(0)
    offs, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for i in range(len(column)):
        v = values[offs[i] : offs[i + 1]]
        out.append(v if valid[i] and len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _vectors(batch.column(1))
        raw = [None if v is None else v.tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([None if v is None else len(v) for v in vectors], pa.int32()),
             pa.array([None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
             pa.array(raw, pa.binary())], names=["id", "dim", "same", "raw"])


def _rows(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _moments(kind: str, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                u = _units(_rows(batch.column(0), kind, dim))
                n, first, second = n + len(u), first + u.sum(0), second + u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([np.append(first, second.ravel()).tolist()], pa.list_(pa.float64()))],
            names=["n", "sums"])
    return run


def widest(vectors: DataFrame, kind: str, dim: int) -> np.ndarray:
    """The direction of greatest spread, from the sums over all vectors; dim squared numbers a task."""
    sums = vectors.select("raw").mapInArrow(_moments(kind, dim), "n long, sums array<double>")
    n, total = 0, np.zeros(dim + dim * dim)
    for row in sums.select("n", F.posexplode("sums").alias("i", "v")).groupBy("i").agg(
            F.sum("v").alias("v"), F.sum("n").alias("n")).collect():
        total[row["i"]], n = row["v"], row["n"]
    mean = total[:dim] / max(n, 1)
    return np.linalg.eigh(total[dim:].reshape(dim, dim) / max(n, 1) - np.outer(mean, mean))[1][:, -1]


def _along(axis: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _units(_rows(batch.column(2), kind, len(axis))) @ axis if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(v)], names=["id", "weight", "raw", "along"])
    return run


BLOCKS = "block long, low double, high double, least array<float>, most array<float>, ids binary, weights binary, raw binary"


def _blocks(kind: str, dim: int, most: int):
    """Sorted vectors to blocks of about ``most``, numbered by partition and place in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, part, held, number = lines(dim), TaskContext.get().partitionId(), [], 0

        def emit(table: pa.Table, number: int) -> pa.RecordBatch:
            p = (_units(_rows(table.column("raw"), kind, dim)) @ at).astype(np.float32)
            along = table.column("along").to_numpy()
            cells = [[(part << 32) + number], [along.min()], [along.max()], [p.min(0).tolist()], [p.max(0).tolist()],
                     [table.column("id").to_numpy().astype("<i8").tobytes()],
                     [table.column("weight").to_numpy().astype("<i8").tobytes()],
                     [b"".join(table.column("raw").to_pylist())]]
            kinds = [pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float32()), pa.list_(pa.float32()), pa.binary(),
                     pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)],
                                              names=[x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * most:
                table = pa.Table.from_batches(held)
                while table.num_rows >= 2 * most:
                    yield emit(table.slice(0, most), number)
                    table, number = table.slice(most), number + 1
                held = table.combine_chunks().to_batches()
        if rest := sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held)
            size = rest if 4 * rest <= 5 * most else -(-rest // 2)
            for k in range(0, rest, size):
                yield emit(table.slice(k, size), number)
                number += 1
    return run


def collisions(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """How many lines each row of ``a`` (lines x rows, whole steps from 0 to 255) shares a window with those of ``b``."""
    count = np.zeros((a.shape[1], b.shape[1]), np.uint8)
    apart = np.empty_like(count)
    close = np.empty(count.shape, bool)
    shifted = a + np.uint8(reach)  # wraps, as does the difference
    for j in range(len(a)):
        np.subtract(shifted[j][:, None], b[j][None, :], out=apart)
        np.less_equal(apart, np.uint8(2 * reach), out=close)
        count += close.view(np.uint8)
    return count


def _steps(units: np.ndarray) -> np.ndarray:
    """Projections (lines x rows) in whole steps from 0 to 255."""
    return np.clip(np.round((units @ lines(units.shape[1]) + 5) / STEP), 0, 255).astype(np.uint8).T.copy()


REACH = math.ceil(WINDOW * FAR / STEP) + 1


class _Block:
    """The vectors of a block; all else is made when it is needed."""

    def __init__(self, raw: bytes, planes: np.ndarray, kind: str):
        self.raw, self.planes = np.frombuffer(raw, kind).reshape(-1, len(planes)), planes
        self.scales = self.keys = self.signs = None
        self.orders: dict[int, np.ndarray] = {}
        self.cut: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return len(self.raw)

    def mark(self) -> None:
        """Keys (keys x rows) and further signs (words x rows): on which side of each plane a vector lies."""
        if self.keys is None:
            marks = np.concatenate([np.packbits(_units(self.raw[k : k + ROWS]).astype(np.float32) @ self.planes > 0, axis=1)
                                    for k in range(0, len(self), ROWS)])
            self.keys = marks[:, : KEYS * BITS // 8].copy().view(np.uint16).T.copy()
            self.signs = marks[:, KEYS * BITS // 8 :].copy().view(np.uint64).T.copy()

    def units(self, rows: np.ndarray) -> np.ndarray:
        if self.scales is None:
            tiles = [_scales(self.raw[k : k + TILE]) for k in range(0, len(self), TILE)]
            self.scales = [np.concatenate(x) for x in zip(*tiles)]
        return _units(self.raw[rows], *(x[rows] for x in self.scales))

    def order(self, key: int) -> np.ndarray:
        """Rows in order of a key."""
        if key not in self.orders:
            self.orders[key] = np.argsort(self.keys[key], kind="stable").astype(np.int32)
        return self.orders[key]

    def tiles(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Steps of rows, a tile at a time, and the least and the most of each line."""
        if not self.cut:
            steps = [_steps(_units(self.raw[k : k + TILE])) for k in range(0, len(self), TILE)]
            self.cut = [(x, x.min(1).astype(int), x.max(1).astype(int)) for x in steps]
        return self.cut


def _differ(a: _Block, b: _Block, x: np.ndarray, y: np.ndarray, words: int) -> np.ndarray:
    """How many of the first signs differ, pair by pair."""
    count = np.zeros(len(x), np.uint16)
    for word in range(words):
        count += np.bitwise_count(a.signs[word][x] ^ b.signs[word][y])
    return count


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    pairs = np.concatenate(found)
    pairs.sort()
    return pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]


def _by_keys(a: _Block, b: _Block) -> np.ndarray | None:
    """Pairs of rows (a * len(b) + b) that share a key and most signs, in order; None if counting all pairs is less work."""
    n, pairs = 1 << BITS, len(a) * len(b)
    if KEYS * SORTED >= pairs:
        return None
    a.mark()
    b.mark()
    counts = [np.bincount(a.keys[k], minlength=n)[b.keys[k]].sum() for k in range(0, KEYS, KEYS // 8)]
    if KEYS * (SORTED + PICKED * np.mean(counts)) >= pairs:
        return None
    found, held = [np.zeros(0, np.int64)], 0
    for key in range(KEYS):
        order, count = a.order(key), np.bincount(a.keys[key], minlength=n)
        start = (np.cumsum(count) - count)[b.keys[key]]
        count = count[b.keys[key]]
        end = np.cumsum(count)
        first = 0
        while first < len(b):
            # Rows of b with about TAKEN candidates together.
            last = max(first + 1, int(np.searchsorted(end, end[first] - count[first] + TAKEN, "right")))
            some = count[first:last]
            y = np.repeat(np.arange(first, last), some)
            x = np.repeat(start[first:last] - end[first:last] + some, some) + np.arange(
                end[first] - count[first], end[last - 1])
            x = order[x].astype(np.int64)
            for signs, need in zip(SIGNS, SHARED):
                near = _differ(a, b, x, y, signs // 64) <= signs - need
                if a is b:  # each pair once
                    near &= x < y
                x, y = x[near], y[near]
            found.append(x * len(b) + y)
            held += len(x)
            first = last
            if held > HELD:  # most came by many keys
                found = [_distinct(found)]
                held = len(found[0])
                if held > HELD // 2:
                    return None
    return _distinct(found)


def _linked(a: _Block, b: _Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that collide often enough and have a cosine of at least the bound, some at a time."""
    need, by_keys = calibrated_count(), _by_keys(a, b)

    def near(r: np.ndarray, c: np.ndarray, counted: bool):
        # Summed pair by pair: a cosine must not depend on what else the block holds.
        for k in range(0, len(r), PAIRS):
            x, y = r[k : k + PAIRS], c[k : k + PAIRS]
            ua, ub = a.units(x), b.units(y)
            if not counted:
                apart = _steps(ua).astype(np.int16) - _steps(ub)
                often = (np.abs(apart) <= REACH).sum(0) >= need
                x, y, ua, ub = x[often], y[often], ua[often], ub[often]
            link = (ua * ub).sum(1) >= COSINE
            yield x[link], y[link]
            if a is b and not counted:
                yield y[link], x[link]

    if by_keys is not None:
        yield from near(*np.divmod(by_keys, len(b)), False)
        return
    for i, (pa_, least_a, most_a) in enumerate(a.tiles()):
        for j, (pb, least_b, most_b) in enumerate(b.tiles()):
            if ((least_a - REACH <= most_b) & (least_b - REACH <= most_a)).sum() < need:
                continue
            for k in range(0, pa_.shape[1], ROWS):
                r, c = np.nonzero(collisions(pa_[:, k : k + ROWS], pb, REACH) >= need)
                yield from near(r + (i * TILE + k), c + j * TILE, True)


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = parent[x]
    while not np.array_equal(at, up := parent[at]):
        at = up
    parent[x] = at
    return at


def _join(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Put each x and its y in one group; a group is known by the smallest place in it."""
    while len(x):
        x, y = _root(parent, x), _root(parent, y)
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def _compare(kind: str, dim: int):
    """Block pairs (a, b, and ids, weights, raw of both) to a row per vector linked in this task: its links here and the
    smallest vector it is connected with here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, at, ready, left = _planes(dim), {}, {}, None
        firsts, nodes, times, parent = [], [], [], np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                a, b = cell["a"].as_py(), cell["b"].as_py()
                if left not in (None, a):
                    ready[left].orders.clear()
                left = a
                for side, block in (("a", a), ("b", b)):
                    if block not in at:
                        at[block] = len(nodes)
                        nodes.append(np.frombuffer(cell[f"ids_{side}"].as_py(), "<i8"))
                        times.append(np.zeros(len(nodes[-1]), np.int64))
                        firsts.append(len(parent))
                        parent = np.concatenate([parent, np.arange(len(parent), len(parent) + len(nodes[-1]))])
                    if block not in ready:
                        if (sum(map(len, ready.values())) + len(nodes[at[block]])) * _size(kind, dim, MARKS) > KEPT:
                            ready = {x: ready[x] for x in (a,) if x in ready}
                        ready[block] = _Block(cell[f"raw_{side}"].as_py(), planes, kind)
                wa, wb = (np.frombuffer(cell[f"weights_{x}"].as_buffer(), "<i8") for x in "ab")
                for r, c in _linked(ready[a], ready[b]):
                    if a == b:  # a block with itself
                        r, c = r[r != c], c[r != c]
                    else:
                        np.add.at(times[at[b]], c, wa[r])
                    np.add.at(times[at[a]], r, wb[c])
                    _join(parent, firsts[at[a]] + r, firsts[at[b]] + c)
        if nodes:
            node, times, least = np.concatenate(nodes), np.concatenate(times), np.concatenate(nodes)
            group = _root(parent, np.arange(len(parent)))
            np.minimum.at(least, group, node)
            hit = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(times[hit]), pa.array(least[group[hit]])],
                                             names=["node", "times", "root"])
    return run


def _near() -> str:
    """Whether blocks a <= b may hold a link."""
    reach, need = WINDOW * FAR + STEP, calibrated_count()
    shared = " + ".join(f"int(least_a[{j}] - {reach} <= most_b[{j}] AND least_b[{j}] - {reach} <= most_a[{j}])"
                        for j in range(LINES))
    return f"a <= b AND low_a - {FAR} <= high_b AND low_b - {FAR} <= high_a AND {shared} >= {need}"


def _parts(spark: SparkSession, n: int, size: int, most: int) -> int:
    """Into how many parts of at most ``most`` bytes to cut ``n`` vectors: enough for all cores when each part meets each."""
    return max(1, min(-(-n // BLOCK), math.isqrt(16 * spark.sparkContext.defaultParallelism)), -(-n * size // most))


def _size(kind: str, dim: int, more: int = 16) -> int:
    """Bytes of a vector, and what goes with it."""
    return dim * np.dtype(kind).itemsize + more


def _laid(classes: DataFrame, kind: str, dim: int, made: list[str]) -> DataFrame:
    """The classes (id, weight, raw) of one dimension in blocks, along the direction of their greatest spread."""
    axis = widest(classes, kind, dim)
    along = classes.mapInArrow(_along(axis, kind), "id long, weight long, raw binary, along double")
    n = classes.count()
    parts = _parts(classes.sparkSession, n, _size(kind, dim), BYTES)
    # Sampled ranges may differ when a task runs again, so the blocks are written before anything refers to them.
    return written(along.repartitionByRange(parts, "along").sortWithinPartitions("along", "id")
                   .mapInArrow(_blocks(kind, dim, max(1, -(-n // parts))), BLOCKS), "blocks", made)


def _links(blocks: DataFrame, kind: str, dim: int) -> DataFrame:
    """(node, times, root) of the linked classes of one dimension, a row per vector and pair of parts."""
    n = blocks.agg(F.sum(F.length("ids")).alias("n")).first()["n"] // 8
    blocks = blocks.coalesce(_parts(blocks.sparkSession, n, _size(kind, dim), PART))
    a, b = (blocks.select(F.col("block").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in blocks.columns[1:]]) for x in "ab")
    # Each task reads two parts of the written blocks: dealing blocks out by pair would move each once per partner.
    pairs = a.join(b.hint("shuffle_replicate_nl"), F.expr(_near())).select(
        "a", "b", *[f"{c}_{x}" for x in "ab" for c in ("ids", "weights", "raw")])
    return pairs.mapInArrow(_compare(kind, dim), "node long, times long, root long")


def _found(rows: DataFrame, kind: str, made: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (id, dim, same), their classes (dim, same, rep, weight), and (node, times, root) of linked classes."""
    spark = rows.sparkSession
    read, whole, cut = [], [], []
    told = written(rows.mapInArrow(_digests, "id long, dim int, same binary, raw binary"), "vectors", read)
    classes = written(told.filter("id IS NOT NULL AND same IS NOT NULL").groupBy("dim", "same").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("raw").alias("raw")), "classes", whole)
    told = written(told.select("id", "dim", "same"), "told", made)
    remove(spark, read)
    dims = [row["dim"] for row in classes.select("dim").distinct().orderBy("dim").collect()]
    laid = [_laid(classes.filter(F.col("dim") == dim).select(F.col("rep").alias("id"), "weight", "raw"), kind, dim, cut)
            for dim in dims]
    classes = written(classes.select("dim", "same", "rep", "weight"), "classes", made)
    remove(spark, whole)
    pairs = [_links(blocks, kind, dim) for blocks, dim in zip(laid, dims)]
    if pairs:
        found = written(reduce(DataFrame.unionByName, pairs), "links", made)
    else:
        found = classes.selectExpr("rep AS node", "weight AS times", "rep AS root").limit(0)
    remove(spark, cut)
    return told, classes, found


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: ``id_col``, ``n_links`` (other rows with a cosine of at least 0.9), ``component_id``
    (the smallest id reachable by links, its own included) and ``kept`` (whether that is its own).

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing, as do rows with
    a null id, which have a null component and are kept. Vectors of different lengths never link; each length is
    compared by itself. Equal vectors link. Rows that share an id are vectors of their own and one node of the
    components. Other columns are not carried. An empty table gives an empty table.
    """
    spark = prepare(df.sparkSession)
    made: list[str] = []
    kind = "<f8" if df.schema[vector_col].dataType.elementType.simpleString() == "double" else "<f4"
    vector = F.col(f"`{vector_col}`").cast("array<double>" if kind == "<f8" else "array<float>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v"))
    # Vectors lie on disk in as few copies as can be: each table or shuffle of them goes when the next is written.
    with shuffles_dropped(spark):
        told, classes, found = _found(rows, kind, made)
        usable = told.filter("id IS NOT NULL AND same IS NOT NULL")
        times = found.groupBy("node").agg(F.sum("times").alias("times"))
        edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
            usable.join(classes.select("dim", "same", "rep"), ["dim", "same"]).select(
                F.col("id").alias("a"), F.col("rep").alias("b")))
        roots = connected(written(edges, "edges", made), made).withColumnRenamed("node", "id")
    per_row = (told.select("id", "dim", "same")
               .join(classes.select("dim", "same", F.col("rep").alias("node"), "weight"), ["dim", "same"], "left")
               .join(times, "node", "left").join(roots, "id", "left"))
    root = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    links = F.when(F.col("id").isNotNull() & F.col("weight").isNotNull(),
                   F.coalesce("times", F.lit(0)) + F.col("weight") - 1).otherwise(F.lit(0))
    return per_row.select(F.col("id").alias(id_col), links.cast("long").alias("n_links"), root.alias("component_id"),
                          F.coalesce(root == F.col("id"), F.lit(True)).alias("kept"))
