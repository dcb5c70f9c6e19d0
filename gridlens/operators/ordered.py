"""Positional operators over long series.

A window ordered by time runs each series in one task. These operators instead
number the rows of a series, cut it into slices of ``size`` rows, copy the few
boundary rows a frame can reach into the neighbouring slice, and run the window
per (series, slice). No group holds more than ``size`` rows plus the copies, so
one series may hold any share of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridlens.session import materialise

SLICE_ROWS = 32_768

# Rows that a block of `number_rows` holds where the densest series is evenly spread; a block
# of more than twice as many is split. Blocks or slices whose counts are summed before any
# run over them.
BLOCK_ROWS = 16_384
GROUP_KEYS = 1024


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which missing keys match each other; keys kept once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def running_before(counts: DataFrame, series: Sequence[str], keys: str | Sequence[str], n: str, out: str,
                   total: str | None = None) -> DataFrame:
    """Sum of ``n`` over the rows of the same series with smaller ``keys``, the first a whole number.

    In two levels: keys are summed in groups of ``GROUP_KEYS`` and only the groups are
    run through in one go, so that a single series, or none, is no bottleneck.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    grouped = counts.withColumn("_up", F.floor(F.col(keys[0]) / GROUP_KEYS))
    groups = grouped.groupBy(*series, "_up").agg(F.sum(n).alias("_n_up"))
    earlier = (Window.unboundedPreceding, -1)
    over_groups = Window.partitionBy(*series).orderBy("_up").rowsBetween(*earlier)
    columns = {"_before_up": F.coalesce(F.sum("_n_up").over(over_groups), F.lit(0))}
    if total:
        columns[total] = F.sum("_n_up").over(Window.partitionBy(*series))
    groups = groups.withColumns(columns).drop("_n_up")
    inside = Window.partitionBy(*series, "_up").orderBy(*keys).rowsBetween(*earlier)
    return (join_on(grouped, groups, [*series, "_up"])
            .withColumn(out, F.col("_before_up") + F.coalesce(F.sum(n).over(inside), F.lit(0)))
            .drop("_up", "_before_up"))


def carried(edges: DataFrame, series: Sequence[str], key: str, before: tuple[str, str], after: tuple[str, str]) -> DataFrame:
    """For (value, name) ``before``, the nearest value that is not null among the rows of the same series with a
    smaller ``key``, as ``name``; for ``after`` that among those with a greater one. In two levels, as `running_before`."""
    ways = [(*before, F.max_by, lambda c: F.col(c)), (*after, F.min_by, lambda c: F.col(c).desc())]
    # Looking ahead is looking back in reverse order: Spark extends a frame that grows
    # from the start, but rebuilds one that runs to the end for every row.
    frame = (Window.unboundedPreceding, -1)
    grouped = edges.withColumn("_up", F.floor(F.col(key) / GROUP_KEYS))
    groups = grouped.groupBy(*series, "_up").agg(*[
        nearest(value, F.when(F.col(value).isNotNull(), F.col(key))).alias(f"_v_{out}") for value, out, nearest, _ in ways])
    groups = groups.select(*series, "_up", *[
        F.last(f"_v_{out}", ignorenulls=True).over(Window.partitionBy(*series).orderBy(way("_up")).rowsBetween(*frame))
        .alias(f"_up_{out}") for _, out, _, way in ways])
    inside = {out: F.last(value, ignorenulls=True).over(
        Window.partitionBy(*series, "_up").orderBy(way(key)).rowsBetween(*frame)) for value, out, _, way in ways}
    return (join_on(grouped, groups, [*series, "_up"])
            .withColumns({out: F.coalesce(near, f"_up_{out}") for out, near in inside.items()})
            .drop("_up", *[f"_up_{out}" for out in inside]))


def _whole(df: DataFrame, column: str) -> Column:
    """A time, number or text as a double that does not fall where it grows; null where it is null."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        value = F.unix_micros(value.cast("timestamp"))
    if kind == "string":  # its first six bytes
        value = F.conv(F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 12), 12, "0"), 16, 10)
    return value.cast("double")


def _split_full(rows: DataFrame, series: Sequence[str], order: Sequence[str], keys: list[str]
                ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows with the keys of their block, and the written counts of the blocks.

    Blocks of more than twice ``BLOCK_ROWS`` rows are cut between their least and greatest value of the first order
    column that is not the same throughout, again and again until none is left or its rows do not differ. Every block
    to be cut is one row of a written table, which Spark broadcasts where its size allows.
    """
    while True:
        spread = [x for i, c in enumerate(order) for x in (
            F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}"), F.count(c).alias(f"_k{i}"),
            F.min(_whole(rows, c)).alias(f"_a{i}"), F.max(_whole(rows, c)).alias(f"_b{i}"))]
        counts = materialise(rows.groupBy(*series, *keys).agg(F.count(F.lit(1)).alias("_n"), *spread), "blocks")
        # The first order column that varies, a null being a value of its own.
        varies = [F.coalesce(F.col(f"_lo{i}") < F.col(f"_hi{i}"), F.lit(False))
                  | ((F.col(f"_k{i}") > 0) & (F.col(f"_k{i}") < F.col("_n"))) for i in range(len(order))]
        first = F.coalesce(*[F.when(v, F.lit(i)) for i, v in enumerate(varies)])
        pick = lambda name: F.coalesce(*[F.when(F.col("_by") == i, F.col(f"{name}{i}")) for i in range(len(order))])
        parts = F.ceil(F.col("_n") / F.lit(BLOCK_ROWS)) * 2
        full = counts.where(F.col("_n") > 2 * BLOCK_ROWS).withColumn("_by", first).where("_by IS NOT NULL").select(
            *series, *keys, "_by", pick("_a").alias("_from"), pick("_b").alias("_to"), parts.alias("_parts"),
            (pick("_k") < F.col("_n")).alias("_nulls"))
        # Values that differ but not as doubles cannot be told apart by width.
        full = full.where("_from < _to OR _nulls")
        if full.isEmpty():
            return rows, counts.select(*series, *keys, "_n"), keys
        value = F.coalesce(*[F.when(F.col("_by") == i, _whole(rows, c)) for i, c in enumerate(order)])
        share = (value - F.col("_from")) / F.when(F.col("_to") > F.col("_from"), F.col("_to") - F.col("_from")).otherwise(1.0)
        part = F.least(F.floor(share * F.col("_parts")), F.col("_parts") - 1)
        key = f"_c{len(keys)}"
        cut = F.when(F.col("_by").isNull(), 0).when(value.isNull(), -1).otherwise(part).cast("long")
        rows = join_on(rows, full, [*series, *keys], "left").withColumn(key, cut).drop(
            "_by", "_from", "_to", "_parts", "_nulls")
        keys = [*keys, key]


def number_rows(df: DataFrame, series: Sequence[str], order: Sequence[str],
                rn: str = "rn", total: str | None = None) -> DataFrame:
    """Zero-based position of each row in its series; ``order`` must be unique in it.

    Rows are cut into blocks of equal width along the first order column, a time or a
    number. The width follows from the densest series, so that a hot series is spread
    over many tasks; where rows crowd, at a burst or at one timestamp, blocks are cut
    further, so that none holds more than twice ``BLOCK_ROWS`` rows that differ. The
    bounds are written: a task that runs again gives the same positions. The rows before
    each block travel as one marker row at its head, so that the rows are shuffled once.
    """
    at = _whole(df, order[0])
    spread = (df.groupBy(*series).agg(F.count(at).alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
              .agg(F.min("lo"), F.max("hi"), F.min((F.col("hi") - F.col("lo")) / F.col("n"))).first())
    start, end, gap = (x or 0.0 for x in spread)
    # However dense a series, blocks are numbered within a long.
    width = max(gap * BLOCK_ROWS, (end - start) / 1e12) or 1.0
    block = F.coalesce(F.floor((at - F.lit(start)) / F.lit(width)), F.lit(-1))
    blocked, counts, keys = _split_full(df.withColumn("_c0", block), series, order, ["_c0"])
    heads = running_before(counts, series, keys, "_n", "_before", total).drop("_n")
    inside = Window.partitionBy(*series, *keys).orderBy("_row", *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = blocked.withColumn("_row", F.lit(1)).unionByName(heads.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    columns = {"_rank": F.row_number().over(inside), "_base": F.max("_before").over(so_far)}
    if total:
        columns[total] = F.max(total).over(so_far)
    return (marked.withColumns(columns).where("_row = 1")
            .withColumn(rn, F.col("_base") + F.col("_rank") - 2)
            .drop(*keys, "_row", "_rank", "_base", "_before"))


def with_slice(df: DataFrame, rn: str = "rn", size: int = SLICE_ROWS) -> DataFrame:
    return df.withColumn("_slice", F.floor(F.col(rn) / size))


def with_halo(df: DataFrame, rn: str, back: int, ahead: int, size: int) -> DataFrame:
    """Each row in its home slice plus copies in the slices whose frames reach it."""
    if max(back, ahead) > size:
        raise ValueError("a slice must be at least as long as the frame")
    home = F.floor(F.col(rn) / size)
    offset = F.pmod(F.col(rn), F.lit(size))
    none = F.array().cast("array<bigint>")
    slices = F.array(home)
    if back:
        slices = F.concat(slices, F.when(offset >= size - back, F.array(home + 1)).otherwise(none))
    if ahead:
        slices = F.concat(slices, F.when((offset < ahead) & (home > 0), F.array(home - 1)).otherwise(none))
    return df.withColumn("_home", home).withColumn("_slice", F.explode(slices))


def over_slices(df: DataFrame, series: Sequence[str], rn: str,
                build: Callable[[WindowSpec], dict[str, Column]],
                back: int = 0, ahead: int = 0, size: int = SLICE_ROWS) -> DataFrame:
    """Add the window columns ``build`` makes; frames reach ``back``/``ahead`` rows at most."""
    spread = with_halo(df, rn, back, ahead, size)
    window = Window.partitionBy(*series, "_slice").orderBy(rn)
    return (spread.withColumns(build(window))
            .where(F.col("_slice") == F.col("_home"))
            .drop("_slice", "_home"))


def positional(df: DataFrame, series: Sequence[str], order: Sequence[str],
               build: Callable[[WindowSpec], dict[str, Column]],
               back: int = 0, ahead: int = 0, size: int = SLICE_ROWS,
               keep: bool = False) -> DataFrame:
    """``over_slices`` for rows that carry no position yet."""
    numbered = number_rows(df, series, order, rn="_rn")
    out = over_slices(numbered, series, "_rn", build, back, ahead, size)
    return out if keep else out.drop("_rn")


def renumber(df: DataFrame, series: Sequence[str], rn: str = "rn", size: int = SLICE_ROWS) -> DataFrame:
    """Close the gaps a filter left in ``rn``.

    The old positions still cut the series into bounded slices. The number of rows
    before each slice travels as one marker row at its head, so that ranking inside
    the slice needs a single shuffle and no join.
    """
    sliced = with_slice(df, rn, size)
    counts = sliced.groupBy(*series, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    heads = running_before(counts, series, "_slice", "_n", "_before").select(
        *series, "_slice", F.lit(-1).cast("bigint").alias(rn), "_before")
    inside = Window.partitionBy(*series, "_slice").orderBy(rn)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = sliced.unionByName(heads, allowMissingColumns=True).withColumns({
        "_rank": F.row_number().over(inside),
        "_base": F.max("_before").over(so_far)})
    return (ranked.where(F.col(rn) >= 0)
            .withColumn(rn, F.col("_base") + F.col("_rank") - 2)
            .drop("_slice", "_before", "_rank", "_base"))


# Window columns -------------------------------------------------------------

def lags(window: WindowSpec, column: str, steps: Sequence[int], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{k}h": F.lag(column, k).over(window) for k in steps}


def rolling_mean(window: WindowSpec, column: str, rows: int) -> Column:
    """Mean of the last ``rows`` rows, from the first non-missing value on."""
    return F.avg(column).over(window.rowsBetween(1 - rows, 0))


def rolling_mean_full(window: WindowSpec, column: str, rows: int) -> Column:
    """Missing until ``rows`` values are in the frame."""
    return _full(F.avg(column), column, window.rowsBetween(1 - rows, 0), rows)


def past_rolling_mean(window: WindowSpec, column: str, rows: int) -> Column:
    """Mean of the ``rows`` rows before this one, itself left out."""
    return _full(F.avg(column), column, window.rowsBetween(-rows, -1), rows)


def rolling_std(window: WindowSpec, column: str, rows: int) -> Column:
    """Sample standard deviation of a full frame."""
    return _full(F.stddev_samp(column), column, window.rowsBetween(1 - rows, 0), rows)


def _full(value: Column, column: str, frame: WindowSpec, rows: int) -> Column:
    return F.when(F.count(column).over(frame) == rows, value.over(frame))


def forward_fill(window: WindowSpec, column: str, limit: int) -> Column:
    return F.last(column, ignorenulls=True).over(window.rowsBetween(-limit, 0))


# Whole operators --------------------------------------------------------------

def interpolate_numbered(df: DataFrame, series: Sequence[str], column: str,
                         rn: str = "rn", size: int = SLICE_ROWS) -> DataFrame:
    """Fill gaps on a straight line between the nearest known rows, by position.

    Leading gaps stay empty; trailing gaps hold the last value. The nearest known row
    may lie many slices away: each slice therefore gets copies of the last known row
    before it and the first after it, found on one summary row per slice.
    """
    sliced = with_slice(df, rn, size)
    known = F.when(F.col(column).isNotNull(), F.struct(F.col(rn).alias("at"), F.col(column).alias("v")))
    edges = sliced.groupBy(*series, "_slice").agg(
        F.min(known).alias("_lo"), F.max(known).alias("_hi"))
    anchors = carried(edges, series, "_slice", ("_hi", "_from"), ("_lo", "_to"))
    anchors = anchors.select(*series, "_slice", F.explode(F.array("_from", "_to")).alias("_anchor"))
    anchors = anchors.where(F.col("_anchor").isNotNull()).select(
        *series, "_slice", F.col("_anchor.at").alias(rn), F.col("_anchor.v").alias(column),
        F.lit(True).alias("_copy"))
    inside = Window.partitionBy(*series, "_slice")
    so_far = (Window.unboundedPreceding, 0)
    marked = sliced.unionByName(anchors, allowMissingColumns=True).withColumns({
        "_a": F.last(known, ignorenulls=True).over(inside.orderBy(rn).rowsBetween(*so_far)),
        "_b": F.last(known, ignorenulls=True).over(
            inside.orderBy(F.col(rn).desc()).rowsBetween(*so_far)),
    }).where(F.col("_copy").isNull())
    gap = F.col("_b.at") - F.col("_a.at")
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col(rn) - F.col("_a.at")) / gap
    filled = (F.when(F.col(column).isNotNull(), F.col(column))
              .when(F.col("_a").isNull(), F.lit(None))
              .when(F.col("_b").isNull(), F.col("_a.v"))
              .otherwise(line))
    return marked.withColumn(column, filled).drop("_slice", "_copy", "_a", "_b")


def interpolate_linear(df: DataFrame, series: Sequence[str], order: Sequence[str],
                       column: str, size: int = SLICE_ROWS) -> DataFrame:
    # Written, since the edges of slices and the rows are both read from it.
    numbered = materialise(number_rows(df, series, order, rn="_rn"), "numbered")
    return interpolate_numbered(numbered, series, column, "_rn", size).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key. An aggregate, so each task sends one row per key on."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    out = df.groupBy(*keys).agg(newest).select(*keys, "_row.*")
    return out.select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    oldest = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    out = df.groupBy(*keys).agg(oldest).select(*keys, "_row.*")
    return out.select(*df.columns)


def metric_history(metrics: DataFrame, metric: str) -> DataFrame:
    """One metric over time, models one after another."""
    return (metrics.where(F.col("metric_name") == metric)
            .orderBy("model_name", "ts"))


def chrono_split(df: DataFrame, series: Sequence[str], order: Sequence[str],
                 ratio: float = 0.85) -> DataFrame:
    """Mark the first ``floor(n * ratio)`` rows of each series as training rows."""
    numbered = number_rows(df, series, order, rn="rn", total="n")
    return numbered.withColumn("is_train", F.col("rn") < F.floor(F.col("n") * F.lit(ratio)))


# Cells that a pass of ``exact_percentile`` cuts the remaining values into.
CELLS = 4096
_LARGEST = 1.7976931348623157e308


def exact_percentile(df: DataFrame, column: str, p: float, accuracy: int = 10_000) -> float | None:
    """Linearly interpolated percentile, ``0 <= p <= 1``.

    A sketch brackets the wanted rank. Passes over the bracket then count its values
    in equal cells and go on with the cell that holds the rank, until one value is
    left. Nothing is ordered or written; a pass returns one small row per cell.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    slack = 4.0 / accuracy
    bounds = F.percentile_approx("v", [max(0.0, p - slack), min(1.0, p + slack)], accuracy)
    n, around, smallest, largest = values.agg(
        F.count("v"), bounds, F.min("v"), F.max("v")).first()
    if not n:
        return None
    lo, hi = around
    rank = p * (n - 1)
    first, last = int(rank), int(rank) + (rank > int(rank))
    below, upto = values.agg(F.count_if(F.col("v") < lo), F.count_if(F.col("v") <= hi)).first()
    if below > first or upto <= last:
        lo, hi, below = smallest, largest, 0
    a = _ranked(values, lo, hi, first - below)
    if last == first:
        return a
    upto, above_a = values.agg(F.count_if(F.col("v") <= a), F.min(F.when(F.col("v") > a, F.col("v")))).first()
    return a if upto > last else a + (above_a - a) * (rank - first)


def _ranked(values: DataFrame, lo: float, hi: float, rank: int) -> float:
    """The value of zero-based ``rank`` among those from ``lo`` to ``hi``."""
    while lo < hi:
        inside = values.where(F.col("v").between(lo, hi))
        # Halves, since the distance of two huge values of unlike sign is no double.
        least, most = max(lo, -_LARGEST) / 2, min(hi, _LARGEST) / 2
        share = (F.col("v") / 2 - least) / F.lit(most - least) if most > least else F.lit(0.0)
        cell = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1 - 1 / CELLS)) * CELLS)
        cells = (inside.groupBy(cell.alias("cell"))
                 .agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("low"), F.max("v").alias("high"))
                 .orderBy("cell").collect())
        if len(cells) == 1:  # neighbouring doubles, of which there are few
            cells = (inside.groupBy("v").agg(F.count(F.lit(1)).alias("k")).orderBy("v")
                     .select("k", F.col("v").alias("low"), F.col("v").alias("high")).collect())
        for row in cells:
            if rank < row["k"]:
                lo, hi = row["low"], row["high"]
                break
            rank -= row["k"]
    return lo
