"""Positional operators: slices must not change any result."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlens.operators import ordered


def _events(views):
    return views.prices.select("settlement_point", "ts", "event_id", "price_usd_mwh")


@pytest.mark.parametrize("size", [168, 200, 100_000])
@pytest.mark.parametrize("series", [[], ["settlement_point"]])
def test_slices_equal_plain_window(views, size, series):
    rows = _events(views)
    built = ordered.positional(
        rows, series, ["ts", "event_id"],
        lambda w: {"lag": F.lag("price_usd_mwh", 168).over(w), "mean": ordered.rolling_mean(w, "price_usd_mwh", 24),
                   "lead": F.lead("price_usd_mwh", 47).over(w)}, back=168, ahead=47, size=size)
    plain = Window.partitionBy(*series).orderBy("ts", "event_id")
    expected = rows.withColumns({
        "lag": F.lag("price_usd_mwh", 168).over(plain),
        "mean": F.avg("price_usd_mwh").over(plain.rowsBetween(-23, 0)),
        "lead": F.lead("price_usd_mwh", 47).over(plain)})
    assert built.count() == expected.count()
    assert built.exceptAll(expected).isEmpty()


def test_one_hot_series_is_spread_over_many_groups(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 100)).alias("s"), "id")
    numbered = ordered.number_rows(rows, ["s"], ["id"], total="n")
    check = numbered.groupBy("s").agg(F.count("*").alias("c"), F.min("rn"), F.max("rn").alias("hi"),
                                      F.count_distinct("rn").alias("d"), F.max("n").alias("n"))
    assert check.where("c <> d or hi <> c - 1 or n <> c or `min(rn)` <> 0").isEmpty()
    biggest = ordered.with_slice(numbered, "rn", 100).groupBy("s", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest <= 100
    order = Window.partitionBy("s").orderBy("id")
    assert numbered.withColumn("e", F.row_number().over(order) - 1).where("e <> rn").isEmpty()


def test_missing_series_key_keeps_its_rows(rows):
    df = rows("s string, t int", (None, 1), (None, 2), ("a", 1))
    out = {(r.s, r.t): r.rn for r in ordered.number_rows(df, ["s"], ["t"]).collect()}
    assert out == {(None, 1): 0, (None, 2): 1, ("a", 1): 0}


def test_frame_longer_than_slice_is_refused(views):
    with pytest.raises(ValueError):
        ordered.positional(_events(views), [], ["ts", "event_id"],
                           lambda w: {"x": F.lag("price_usd_mwh", 24).over(w)}, back=24, size=10)


@pytest.mark.parametrize("size", [2, 3, 50])
def test_interpolation_equals_pandas(rows, size):
    values = [None, None, 1.0, None, None, 4.0, 5.0, None, None, None, 9.0, None, None]
    df = rows("i int, v double", *enumerate(values))
    got = [r.v for r in ordered.interpolate_linear(df, [], ["i"], "v", size=size).orderBy("i").collect()]
    expected = pd.Series(values, dtype=float).interpolate("linear")
    assert np.allclose([np.nan if g is None else g for g in got], expected, equal_nan=True)


def test_interpolation_without_any_value(rows):
    df = rows("i int, v double", (0, None), (1, None))
    assert [r.v for r in ordered.interpolate_linear(df, [], ["i"], "v").collect()] == [None, None]


def test_renumber_closes_gaps(spark):
    df = spark.range(100).withColumnRenamed("id", "rn").where("rn % 3 <> 0")
    got = [r.rn for r in ordered.renumber(df.withColumn("k", F.col("rn")), [], "rn", size=7).orderBy("k").collect()]
    assert got == list(range(len(got)))


@pytest.mark.parametrize("cells", [3, 4096])
@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("p", [0.0, 0.25, 0.98, 1.0])
def test_percentile_is_exact(views, p, accuracy, cells, monkeypatch):
    monkeypatch.setattr(ordered, "CELLS", cells)
    values = views.prices.select("price_usd_mwh")
    expected = np.percentile([r[0] for r in values.collect()], p * 100)
    got = ordered.exact_percentile(values, "price_usd_mwh", p, accuracy)
    assert got == pytest.approx(expected, abs=1e-9)


def test_percentile_of_extreme_values(rows):
    values = [float("-inf"), -1.7e308, -5e-324, 0.0, 5e-324, 1e-323, 1.7e308, float("inf"), float("inf")]
    for p, want in ((0.0, values[0]), (0.25, -5e-324), (0.5, 5e-324), (0.75, 1.7e308), (1.0, values[-1])):
        assert ordered.exact_percentile(rows("v double", *[(v,) for v in values]), "v", p) == want


def test_percentile_of_heavy_ties_and_nothing(rows, spark):
    tied = spark.range(1000).select(F.when(F.col("id") < 990, 1.0).otherwise(F.col("id").cast("double")).alias("v"))
    assert ordered.exact_percentile(tied, "v", 0.98) == 1.0
    assert ordered.exact_percentile(rows("v double", (None,), (float("nan"),)), "v", 0.5) is None


def test_latest_per_key_breaks_ties_by_order(rows):
    df = rows("k string, t int, id int, v double", ("a", 1, 1, 1.0), ("a", 1, 2, None), ("b", 0, 1, 3.0))
    got = {r.k: (r.id, r.v) for r in ordered.latest_per_key(df, ["k"], ["t", "id"]).collect()}
    assert got == {"a": (2, None), "b": (1, 3.0)}


def test_split_takes_the_floor(rows):
    df = rows("t int", *[(i,) for i in range(7)])
    out = ordered.chrono_split(df, [], ["t"], 0.85)
    assert out.where("is_train").count() == int(7 * 0.85)


def test_no_single_task_window_over_raw_rows(views):
    """The windows over data rows are partitioned by slice."""
    built = ordered.positional(_events(views), [], ["ts", "event_id"],
                               lambda w: {"l": F.lag("price_usd_mwh", 1).over(w)}, back=1)
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    lag_lines = [line for line in plan.splitlines() if "Window" in line and "lag(" in line]
    assert lag_lines and all("_slice" in line for line in lag_lines)


def test_positions_need_no_written_copy_of_the_rows(views, spark):
    """What is written is one row a block."""
    from gridlens import session
    before = set(session._written)
    out = ordered.number_rows(views.prices, ["settlement_point", "market_type"], ["ts", "event_id"])
    made = [path for path in session._written if path not in before]
    assert out.count() and len(made) == 1
    assert spark.read.parquet(made[0]).agg(F.sum("_n")).first()[0] == out.count()
    assert spark.read.parquet(made[0]).count() <= views.prices.select("settlement_point", "market_type").distinct().count() * 2


def test_positions_of_bursts_nulls_and_one_time(rows, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 4)
    monkeypatch.setattr(ordered, "GROUP_KEYS", 3)
    values = [("burst", 5, k) for k in range(50)] + [("even", 10 * k, 0) for k in range(60)] + [("even", None, 1)]
    values += [(None, 10**12, 0), (None, -3, 0), ("one", 7, 0)]
    df = rows("s string, t long, k int", *values)
    got = ordered.number_rows(df, ["s"], ["t", "k"], total="n").collect()
    assert len(got) == len(values)
    for s in ("burst", "even", "one", None):
        own = sorted((r.rn, r.t is not None, r.t or 0, r.k) for r in got if r.s == s)
        assert [r[0] for r in own] == list(range(len(own))) and [r[1:] for r in own] == sorted(r[1:] for r in own)
        assert {r.n for r in got if r.s == s} == {len(own)}
    assert ordered.number_rows(df.limit(0), [], ["t"]).count() == 0


def _blocks_of(monkeypatch, df, series, order):
    """Positions, and the rows of each block that a window orders at once."""
    seen = {}
    whole = ordered._split_full

    def spy(*args):
        rows, counts, keys = whole(*args)
        seen["most"] = counts.agg(F.max("_n")).first()[0]
        return rows, counts, keys
    monkeypatch.setattr(ordered, "_split_full", spy)
    return ordered.number_rows(df, series, order, total="n"), seen


@pytest.mark.parametrize("series", [[], ["s"]])
def test_bursts_and_equal_times_are_split(spark, monkeypatch, series):
    """A third of the rows in one hour of a year, another third at one timestamp."""
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 100)
    at = (F.when(F.col("id") % 3 == 0, F.col("id") * 3600).when(F.col("id") % 3 == 1, 7_000_000 + F.col("id") % 3600)
          .otherwise(9_000_000))
    rows = spark.range(9000).select(F.timestamp_seconds(at).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("k"),
                                    (F.col("id") % 2).cast("string").alias("s"), "id")
    numbered, seen = _blocks_of(monkeypatch, rows, series, ["ts", "k"])
    plain = Window.partitionBy(*series).orderBy("ts", "k")
    assert numbered.withColumn("e", F.row_number().over(plain) - 1).where("e <> rn").isEmpty()
    assert numbered.count() == 9000 and seen["most"] <= 200


def test_blocks_split_by_nulls_text_and_not_by_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 50)
    rows = spark.range(1200).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.lit(5.0)).alias("t"),
        F.when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.concat(F.lit("é"), F.hex("id"))).alias("w"), "id")
    numbered, seen = _blocks_of(monkeypatch, rows, [], ["t", "w", "id"])
    plain = Window.orderBy("t", "w", "id")
    assert numbered.withColumn("e", F.row_number().over(plain) - 1).where("e <> rn").isEmpty() and seen["most"] <= 100
    same = spark.range(300).select(F.lit(1.0).alias("t"))
    assert sorted(r.rn for r in ordered.number_rows(same, [], ["t"]).collect()) == list(range(300))


def test_known_values_are_carried_over_groups_of_slices(spark, monkeypatch):
    monkeypatch.setattr(ordered, "GROUP_KEYS", 4)
    rng = np.random.default_rng(1)
    values = [float(v) if v % 5 == 0 else None for v in rng.integers(0, 40, 200)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)] + [("b", 3, None), ("b", 9, 1.0)],
                               "s string, i int, v double")
    got = {(r.s, r.i): (r.b, r.f) for r in ordered.carried(df, ["s"], "i", ("v", "b"), ("v", "f")).collect()}
    first = lambda values: next((v for v in values if v is not None), None)
    for i in range(200):
        assert got["a", i] == (first(values[:i][::-1]), first(values[i + 1 :]))
    assert got["b", 3] == (None, 1.0) and got["b", 9] == (None, None)
