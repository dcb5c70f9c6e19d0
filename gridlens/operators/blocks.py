"""Window models on blocks of rows.

A window of ``seq_len`` rows repeats every row ``seq_len`` times. Models that are linear in the
window need no such copies: the product of two window columns depends on the rows they lie apart,
but for a few rows at the ends of a series, and a linear forecast is a sum over the last rows.

Rows are packed once, each series into blocks of ``size`` rows as one matrix of doubles with the
few rows before it that its windows reach. A block is a row of a written table; every pass over
the windows is a map over that table, without a shuffle, and holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.scalars import drop_missing
from gridlens.operators.ordered import number_rows, with_halo
from gridlens.session import materialise

SEQ_LEN = 24
BLOCK_SIZE = 8192
#: Sums of so many series are held by a task before they are handed on.
HELD_SERIES = 16
#: Kinds of sums: products of rows a lag apart, of rows with a later target, and the first and last rows themselves.
LAG, CROSS, HEAD, TAIL = 0, 1, 2, 3


@dataclass(frozen=True)
class Blocks:
    """A written table of blocks: the series, ``_first`` (position of the matrix' first row), ``_home`` (rows of the
    block before which the others belong to earlier blocks), ``_total`` (rows of the series), ``_z`` (the matrix, row
    by row) and the order columns of the block's own rows as arrays. The matrix has the columns ``columns``."""

    table: DataFrame
    columns: list[str]
    series: list[str]
    order: list[str]
    seq_len: int
    reach: int

    def at(self, names: Sequence[str]) -> list[int]:
        return [self.columns.index(n) for n in names]


def pack(df: DataFrame, columns: Sequence[str], series: Sequence[str] = (), order: Sequence[str] = ("ts",),
         seq_len: int = SEQ_LEN, horizon: int = 0, size: int = BLOCK_SIZE, stored: bool = False) -> Blocks:
    """Blocks of the rows without a missing cell; windows are to reach ``horizon`` rows ahead at most. ``stored`` says
    that ``df`` is a written table already."""
    columns, series, order = list(dict.fromkeys(columns)), list(series), list(order)
    reach = seq_len - 1 + horizon
    # Written, since numbering reads them several times and their columns may be long expressions, which a filter
    # on each would double.
    rows = df.select(*dict.fromkeys([*series, *order]), *[
        F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    rows = drop_missing(rows if stored else materialise(rows, "rows"))
    spread = with_halo(number_rows(rows, series, order, "_rn", total="_total"), "_rn", reach, 0, size)
    kinds = [rows.schema[c] for c in series]
    schema = T.StructType([
        *kinds, T.StructField("_first", T.LongType()), T.StructField("_home", T.LongType()),
        T.StructField("_total", T.LongType()), T.StructField("_z", T.BinaryType()),
        *[T.StructField(f"_o{i}", T.ArrayType(rows.schema[c].dataType)) for i, c in enumerate(order)]])
    wide = len(columns)

    def as_block(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rn")
        rn = table.column("_rn").to_numpy()
        home = int(np.searchsorted(rn, table.column("_slice")[0].as_py() * size))
        z = np.column_stack([table.column(f"_x{i}").to_numpy() for i in range(wide)]) if wide else np.zeros((len(rn), 0))
        cells = [table.column(c).slice(0, 1).combine_chunks() for c in series]
        own = [table.column(c).slice(home).combine_chunks() for c in order]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), _whole_array(c)) for c in own]
        return pa.Table.from_arrays(
            [*[_whole_array(c) for c in cells], pa.array([int(rn[0])]), pa.array([home], pa.int64()),
             pa.array([table.column("_total")[0].as_py()], pa.int64()), pa.array([z.tobytes()], pa.binary()), *lists],
            names=schema.fieldNames())

    # Dealt out to as many tasks as the session has for shuffles: every later pass has one for each file.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartition(tasks, *series, "_slice")
    blocks = dealt.groupBy(*series, "_slice").applyInArrow(lambda table: as_block(table), schema)
    return Blocks(materialise(blocks, "blocks"), columns, series, order, seq_len, reach)


def _whole_array(values):
    if isinstance(values, pa.ChunkedArray):
        return pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return values


@dataclass(frozen=True)
class Block:
    """A block inside a task: its matrix, the position of its first row, and where its own rows begin."""

    key: tuple
    z: np.ndarray
    first: int
    home: int
    total: int

    def windows(self, seq_len: int, horizon: int) -> int:
        """Windows of the whole series whose target ``horizon`` rows ahead is there."""
        return max(0, self.total - (seq_len - 1) - horizon)


def read(batch: pa.RecordBatch, n_series: int, wide: int) -> Iterator[tuple[int, Block]]:
    for i in range(batch.num_rows):
        key = tuple(batch.column(k)[i].as_py() for k in range(n_series))
        first, home, total = (batch.column(n_series + k)[i].as_py() for k in range(3))
        z = np.frombuffer(batch.column(n_series + 3)[i].as_buffer(), np.float64).reshape(-1, wide)
        yield i, Block(key, z, first, home, total)


def over_windows(block: Block, at: Sequence[int], weights: np.ndarray, seq_len: int, ahead: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each own row that a window ends ``ahead`` rows before: its place in the matrix, and the sum of the window
    times ``weights`` (row of the window, column of ``at``, result)."""
    lead = seq_len - 1 + ahead
    place = np.arange(max(block.home, lead), len(block.z))
    out = np.zeros((len(place), weights.shape[2]))
    if len(place):
        z = block.z[:, at]
        for t in range(seq_len):
            rows = place[0] - lead + t
            out += z[rows : rows + len(place)] @ weights[t]
    return place, out


# Sums of products --------------------------------------------------------------------

def _add(sums: dict, key: tuple, kind: int, i: int, values: np.ndarray) -> None:
    own = sums.setdefault(key, {})
    for k, row in enumerate(values if values.ndim == 2 else values[None]):
        place = (kind, i * len(values) + k if values.ndim == 2 else i)
        own[place] = own.get(place, 0.0) + row


def _lag_task(blocks: Blocks, at: list[int], target: int | None, horizons: Sequence[int], ratio: float, moved: np.ndarray):
    n_series, wide, length = len(blocks.series), len(blocks.columns), blocks.seq_len
    names = [*blocks.series, "horizon", "_kind", "_i", "_v"]

    def of_block(b: Block, sums: dict) -> None:
        rn = b.first + np.arange(len(b.z))
        one = np.column_stack([np.ones(len(rn)), b.z[:, at] - moved[: len(at)]])
        for h in horizons:
            # As Spark rounds the split: a double product, cut off.
            n = int(np.floor(b.windows(length, h) * ratio))
            if n <= 0:
                continue
            key, last = (*b.key, h), n + length - 1
            stop = int(np.clip(last - b.first, 0, len(rn)))
            for k in range(length):
                since = max(b.home, k)
                if since < stop:
                    _add(sums, key, LAG, k, one[since - k : stop - k].T @ one[since:stop])
            for kind, low, high in ((HEAD, 0, length - 1), (TAIL, n, last)):
                for j in range(max(b.home, low - b.first), min(len(rn), high - b.first)):
                    _add(sums, key, kind, b.first + j - low, one[j])
            if target is not None:
                since, upto = max(b.home, length - 1 + h), min(len(rn), last + h - b.first)
                if since < upto:
                    y = b.z[since:upto, target] - moved[-1]
                    for t in range(length):
                        lag = length - 1 + h - t
                        _add(sums, key, CROSS, t, y @ one[since - lag : upto - lag])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, dict] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for key, own in sums.items():
                cells = [pa.array([k] * len(own), f) for k, f in zip(key, types)]
                yield pa.RecordBatch.from_arrays(
                    [*cells, pa.array([k for k, _ in own], pa.int32()), pa.array([i for _, i in own], pa.int32()),
                     pa.array([v.tolist() for v in own.values()], pa.list_(pa.float64()))], names=names)
            sums.clear()

        for batch in batches:
            types = [*[batch.column(k).type for k in range(n_series)], pa.int32()]
            for _, block in read(batch, n_series, wide):
                if len(sums) >= HELD_SERIES * len(horizons) and (*block.key, horizons[0]) not in sums:
                    yield from rows()
                of_block(block, sums)
        if sums:
            yield from rows()
    return task


def means(blocks: Blocks, names: Sequence[str]) -> np.ndarray:
    """Mean of each column over the rows of all blocks; 0 without rows."""
    at, n_series, wide = blocks.at(names), len(blocks.series), len(blocks.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(len(at))
        for batch in batches:
            for _, b in read(batch, n_series, wide):
                own = b.z[b.home :, at]
                n, total = n + len(own), total + own.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([[float(n), *total.tolist()]], pa.list_(pa.float64()))], names=["v"])

    found = _summed(blocks.table.mapInArrow(task, "v array<double>"))
    if not len(found):
        return np.zeros(len(at))
    return found[1:] / max(found[0], 1.0)


@dataclass(frozen=True)
class Sums:
    """Sums over the windows of one series: how many, of the columns (row of the window, feature) and of their
    products, of the target and of its products with them. All are of values less ``moved``, the target's last."""

    n: int
    column: np.ndarray
    product: np.ndarray
    target: float
    cross: np.ndarray
    moved: np.ndarray


def assemble(parts: Mapping[tuple[int, int], np.ndarray], length: int, moved: np.ndarray) -> Sums:
    """The sums over the windows from those over rows: rows a lag apart meet in every window that holds both, so the
    first and last rows of the series, which fewer windows hold, are taken off where they do not."""
    wide = len(next(iter(parts.values())))
    none = np.zeros((length, wide))
    lag = [np.array([parts[LAG, k * wide + a] for a in range(wide)]) if (LAG, k * wide) in parts else np.zeros((wide, wide))
           for k in range(length)]
    head, tail = (np.array([parts.get((kind, i), none[0]) for i in range(length - 1)]).reshape(-1, wide)
                  for kind in (HEAD, TAIL))
    whole = np.zeros((length, wide, length, wide))
    for k in range(length):
        rest = lag[k].copy()
        for j in range(length - 1 - k):  # the tail of the first window row
            rest -= np.outer(tail[j], tail[j + k])
        for s in range(length - k):
            whole[s, :, s + k, :] = rest
            whole[s + k, :, s, :] = rest.T
            if s < length - 1 - k:  # one step on: the head's row leaves, the tail's comes in
                rest = rest - np.outer(head[s], head[s + k]) + np.outer(tail[s], tail[s + k])
    n = whole[0, 0, 0, 0]
    d = wide - 1
    cross = np.array([parts.get((CROSS, t), none[0]) for t in range(length)])
    return Sums(round(n), whole[np.arange(length), 0, np.arange(length), 1:].ravel(),
                whole[:, 1:, :, 1:].reshape(length * d, length * d), float(cross[0, 0]), cross[:, 1:].ravel(), moved)


def window_sums(blocks: Blocks, features: Sequence[str], target: str | None, horizons: Sequence[int],
                ratio: float = 1.0) -> tuple[DataFrame, np.ndarray]:
    """Rows (series, horizon, _kind, _i, _v) for `assemble`, over the first ``ratio`` of each series' windows, and
    what the values are moved by. Without a target the horizon only tells how far ahead windows must reach."""
    features = list(features)
    moved = means(blocks, [*features, target] if target else features)
    at, y = blocks.at(features), blocks.columns.index(target) if target else None
    kinds = [blocks.table.schema[c] for c in blocks.series]
    schema = T.StructType([*kinds, T.StructField("horizon", T.IntegerType()), T.StructField("_kind", T.IntegerType()),
                           T.StructField("_i", T.IntegerType()), T.StructField("_v", T.ArrayType(T.DoubleType()))])
    rows = blocks.table.mapInArrow(_lag_task(blocks, at, y, list(horizons), ratio, moved), schema)
    summed = rows.groupBy(*blocks.series, "horizon", "_kind", "_i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("_v"))).alias("_v"))
    return summed, moved


def solve_ridge(sums: Sums, penalty: float, d: int) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of the target on the window, the penalty on columns in units of their deviation."""
    n, s = sums.n, sums.column
    g = sums.product - np.outer(s, s) / n
    c = sums.cross - s * sums.target / n
    spread = np.sqrt(np.maximum(np.diag(g) / n, 0.0))
    moved = np.tile(sums.moved[:d], len(s) // d)
    varies = spread > 1e-9 * np.maximum(1.0, np.abs(moved))
    unit = np.where(varies, spread, 1.0)
    system = g / np.outer(unit, unit) / n * np.outer(varies, varies) + penalty * np.eye(len(unit))
    beta = np.linalg.lstsq(system, c / unit / n * varies, rcond=1e-12)[0] / unit
    mean = moved + s / n
    return float(sums.moved[-1] + sums.target / n - mean @ beta), beta


def fit_ridge(blocks: Blocks, features: Sequence[str], target: str, horizons: Sequence[int], ratio: float = 1.0,
              penalty: float = 1e-4, min_rows: int = 72) -> DataFrame:
    """Ridge regression per series and horizon of the row ``horizon`` after a window on the window: rows (series,
    horizon, n, intercept, coefficients), the coefficients window row by window row. Series with fewer than
    ``min_rows`` windows have no model. A series may be of any size; its sums are some hundred short rows."""
    sums, moved = window_sums(blocks, features, target, horizons, ratio)
    series, length, d = blocks.series, blocks.seq_len, len(features)
    groups = ", ".join(f"{blocks.table.schema[c].name} {blocks.table.schema[c].dataType.simpleString()}" for c in series)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {(k, i): np.asarray(v) for k, i, v in zip(pdf["_kind"], pdf["_i"], pdf["_v"])}
        found = assemble(parts, length, moved)
        out = {**{c: [pdf[c].iloc[0]] for c in series}, "horizon": [pdf["horizon"].iloc[0]], "n": [found.n]}
        if found.n < min_rows:
            return pd.DataFrame(out | {"intercept": [0.0], "coefficients": [[]]}).iloc[:0]
        intercept, beta = solve_ridge(found, penalty, d)
        return pd.DataFrame(out | {"intercept": [intercept], "coefficients": [beta.tolist()]})

    return sums.groupBy(*series, "horizon").applyInPandas(
        lambda pdf: solve(pdf), f"{groups}{', ' if series else ''}horizon int, n bigint, intercept double, coefficients array<double>")


def predict(blocks: Blocks, features: Sequence[str], models: DataFrame, name: str = "y_hat") -> DataFrame:
    """Every window with every horizon that its series, which has a name, has a model for: the series, ``window_ts`` and the other order
    columns of the window's last row, ``horizon`` and the forecast.

    Blocks meet the models of their series, so that models travel once a block and not once a row.
    """
    series, order, length = blocks.series, blocks.order, blocks.seq_len
    if not series:
        raise ValueError("models are found by the names of their series")
    own = models.select(*[F.col(c).alias(f"_m_{c}") for c in series], F.struct("horizon", "intercept", "coefficients").alias("_model"))
    own = own.groupBy(*[f"_m_{c}" for c in series]).agg(F.sort_array(F.collect_list("_model")).alias("_models"))
    same = F.lit(True)
    for c in series:
        same = same & (F.col(c) == F.col(f"_m_{c}"))
    joined = blocks.table.join(own, same).drop(*[f"_m_{c}" for c in series])
    at, n_series, wide = blocks.at(features), len(series), len(blocks.columns)
    kinds = {c: blocks.table.schema[c].dataType for c in series}
    of_order = [blocks.table.schema[f"_o{i}"].dataType.elementType for i in range(len(order))]
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in series], T.StructField("window_ts", of_order[0]),
                           *[T.StructField(c, k) for c, k in zip(order[1:], of_order[1:])],
                           T.StructField("horizon", T.IntegerType()), T.StructField(name, T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, b in read(batch, n_series, wide):
                found = batch.column(batch.num_columns - 1)[i].as_py()
                weights = np.stack([np.array(m["coefficients"]).reshape(length, len(at)) for m in found], 2)
                place, y_hat = over_windows(b, at, weights, length)
                lists = [batch.column(n_series + 4 + k)[i].values for k in range(len(order))]
                labels = [v.take(pa.array(place - b.home)) for v in lists]
                for k, m in enumerate(found):
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array([v] * len(place), batch.column(c).type) for c, v in enumerate(b.key)], *labels,
                         pa.array([m["horizon"]] * len(place), pa.int32()), pa.array(y_hat[:, k] + m["intercept"])],
                        names=schema.fieldNames())
    return joined.mapInArrow(task, schema)


def score(blocks: Blocks, of_block: Callable[[Block], tuple[np.ndarray, np.ndarray]], name: str) -> DataFrame:
    """One number per window from ``of_block`` (places of the windows' last rows, numbers): the series, ``window_ts``
    and the other order columns of the last row, and the number."""
    series, order = blocks.series, blocks.order
    n_series, wide = len(series), len(blocks.columns)
    of_order = [blocks.table.schema[f"_o{i}"].dataType.elementType for i in range(len(order))]
    schema = T.StructType([*[blocks.table.schema[c] for c in series], T.StructField("window_ts", of_order[0]),
                           *[T.StructField(c, k) for c, k in zip(order[1:], of_order[1:])], T.StructField(name, T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, b in read(batch, n_series, wide):
                place, values = of_block(b)
                lists = [batch.column(n_series + 4 + k)[i].values for k in range(len(order))]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v] * len(place), batch.column(c).type) for c, v in enumerate(b.key)],
                     *[v.take(pa.array(place - b.home)) for v in lists], pa.array(values, pa.float64())],
                    names=schema.fieldNames())
    return blocks.table.mapInArrow(task, schema)


def _summed(rows: DataFrame) -> np.ndarray:
    """The sum of the vectors ``v`` of a few short rows a task; empty without rows."""
    row = rows.groupBy(F.lit(0).alias("all")).agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).first()
    return np.array(row["v"] if row else [])


def products(rows: DataFrame, moved: Sequence[float]) -> np.ndarray:
    """The matrix of products of all columns, less ``moved``, summed over complete rows."""
    wide, off = len(moved), np.array(moved, float)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((wide, wide))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(wide)]) - off
            held += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])

    found = _summed(rows.mapInArrow(task, "v array<double>"))
    return found.reshape(wide, wide) if len(found) else np.zeros((wide, wide))


def total(blocks: Blocks, of_block: Callable[[Block], np.ndarray]) -> np.ndarray:
    """The sum of ``of_block``'s short vectors over all blocks; empty without blocks."""
    n_series, wide = len(blocks.series), len(blocks.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for _, b in read(batch, n_series, wide):
                own = of_block(b)
                held = own if held is None else held + own
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tolist()], pa.list_(pa.float64()))], names=["v"])

    return _summed(blocks.table.mapInArrow(task, "v array<double>"))


def total_matrix(blocks: Blocks, of_block: Callable[[Block], np.ndarray], rows: int) -> np.ndarray:
    """The sum of ``of_block``'s matrices of so many rows over all blocks. They are summed row by row, so that no task
    receives whole matrices of all others."""
    n_series, wide = len(blocks.series), len(blocks.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for _, b in read(batch, n_series, wide):
                own = of_block(b)
                held = own if held is None else held + own
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(held)), pa.int32()), pa.array(held.tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    found = blocks.table.mapInArrow(task, "i int, v array<double>").groupBy("i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).collect()
    out: list = [None] * rows
    for r in found:
        out[r["i"]] = r["v"]
    return np.array(out, float) if found else np.zeros((rows, 0))


def pooled(blocks: Blocks, features: Sequence[str], target: str | None, horizons: Sequence[int],
           ratio: float = 1.0) -> dict[int, Sums]:
    """By horizon the sums over the windows of all series together. Those of each series are put together first, where
    its first and last rows count."""
    sums, moved = window_sums(blocks, features, target, horizons, ratio)
    length, wide = blocks.seq_len, 1 + len(features)

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {(k, i): np.asarray(v) for k, i, v in zip(pdf["_kind"], pdf["_i"], pdf["_v"])}
        found = assemble(parts, length, moved)
        rows = [np.concatenate([[found.n, found.target], found.column]), np.concatenate([[0, 0], found.cross]),
                *np.column_stack([np.zeros((len(found.column), 2)), found.product])]
        return pd.DataFrame({"horizon": pdf["horizon"].iloc[0], "i": range(len(rows)), "v": [r.tolist() for r in rows]})

    found = (sums.groupBy(*blocks.series, "horizon").applyInPandas(lambda pdf: put(pdf), "horizon int, i int, v array<double>")
             .groupBy("horizon", "i").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
             .orderBy("horizon", "i").collect())
    none = np.zeros(length * (wide - 1))
    out = {h: Sums(0, none, np.zeros((len(none), len(none))), 0.0, none, moved) for h in horizons}
    for h in {r["horizon"] for r in found}:
        rows = np.array([r["v"] for r in found if r["horizon"] == h])
        out[h] = Sums(round(rows[0, 0]), rows[0, 2:], rows[2:, 2:], float(rows[0, 1]), rows[1, 2:], moved)
    return out
