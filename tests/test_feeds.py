"""Feed edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlens.sources import feeds

TS = dt.datetime


def test_demand_drops_empty_and_keeps_or_rejects_junk(rows):
    raw = rows("period string, type string, value string", ("2024-01-01T05", "D", "10"), ("", "D", "1"),
               (None, "D", "2"), ("2024-01-01T06", "D", None), ("2024-01-01T07", "D", "x"), ("2024-01-01T05", "DF", "9"))
    got = {r.ts: r.load_mw for r in feeds.normalize_demand(raw).collect()}
    assert got == {TS(2024, 1, 1, 5): 10.0, TS(2024, 1, 1, 7): None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feeds.normalize_demand(raw, coerce=False).collect()


@pytest.mark.parametrize("zero_is_missing, stress", [(False, 10.0), (True, None)])
def test_forecast_of_zero(rows, zero_is_missing, stress):
    demand = rows("period string, load_mw double", ("p", 10.0), ("q", 5.0))
    forecast = rows("period string, forecast_mw double, pos int", ("p", 7.0, 0), ("p", 0.0, 1), ("p", None, 2))
    got = {r.period: (r.forecast_mw, r.grid_stress)
           for r in feeds.pair_forecast(demand, forecast, zero_is_missing=zero_is_missing).collect()}
    assert got == {"p": (0.0, stress), "q": (None, None)}


def test_latest_n(rows):
    df = rows("period string", ("a",), ("c",), ("b",))
    assert [r.period for r in feeds.latest_n(df, 2).collect()] == ["c", "b"]


def test_arrays_short_and_long(spark):
    feed = spark.sql("""SELECT 'z' AS zone, named_struct('time', array('2024-01-01T00:00', '2024-01-01T01:00'),
        'temperature_2m', array(1.0D), 'wind_speed_10m', array(1.0D, 2.0D, 3.0D),
        'direct_radiation', array(1.0D, 2.0D), 'relative_humidity_2m', CAST(array() AS array<double>)) AS hourly""")
    got = feeds.explode_hourly(feed).orderBy("ts").collect()
    assert [(r.temperature_2m, r.wind_speed_10m, r.relative_humidity) for r in got] == [(1.0, 1.0, None), (None, 2.0, None)]


def test_zone_union_without_any_zone():
    with pytest.raises(ValueError):
        feeds.multi_zone_union({"a": None})


def test_fallback_by_row_and_by_feed(rows):
    spine = rows("ts int", (1,), (2,), (3,))
    schema = "ts int, temperature_2m double"
    archive, forecast = rows(schema, (1, 5.0), (2, None)), rows(schema, (2, 6.0))
    args = dict(columns=["temperature_2m"])
    by_row = {r.ts: r.temperature_2m for r in feeds.source_fallback(spine, archive, forecast, **args).collect()}
    assert by_row == {1: 5.0, 2: 6.0, 3: 20.0}
    by_feed = feeds.source_fallback(spine, archive, forecast, mode="feed", **args).collect()
    assert {r.ts: r.temperature_2m for r in by_feed} == {1: 5.0, 2: None}
    empty = archive.where("ts > 9")
    assert feeds.source_fallback(spine, empty, forecast, mode="feed", **args).count() == 1
    assert feeds.source_fallback(spine, empty, None, mode="feed", **args).count() == 3


def test_chunks_are_inclusive_and_clipped(rows):
    df = rows("first date, last date", (dt.date(2024, 1, 1), dt.date(2024, 3, 5)), (dt.date(2024, 1, 1), dt.date(2024, 1, 1)))
    got = [(r.chunk_start, r.chunk_end) for r in feeds.chunk_ranges(df).orderBy("chunk_start").collect()]
    assert got == [(dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2024, 2, 1), dt.date(2024, 3, 2)),
                   (dt.date(2024, 3, 3), dt.date(2024, 3, 5))]


def test_day_ahead_hour_24_and_skips(rows):
    page = rows("`Oper Day` string, `Hour Ending` string, HB_NORTH string, HB_X string",
                ("01/02/2024", "1", "5", "1"), ("2024-01-01", "24", "7.5", "1"), ("2024-01-01", "x", "7", "1"),
                ("2024-01-01", "2", "-", "1"), (None, "3", "-4", "1"), ("2024-01-01", "4", "NaN", "1"), ("no date", "5", "1", "1"))
    got = {(r.ts, r.price_usd_mwh) for r in feeds.dam_wide_to_long(page, "2024-05-01").collect()}
    assert got == {(TS(2024, 1, 2, 1), 5.0), (TS(2024, 1, 2), 7.5), (TS(2024, 5, 1, 3), -4.0)}


def test_real_time_needs_a_readable_time(rows):
    page = rows("`SCED stamp` string, HB_WEST string", ("2024-01-01 00:15:00", "5"), ("1/2/2024 0:30", "8"), ("junk", "6"), (None, "7"))
    assert [(r.ts, r.price_usd_mwh) for r in feeds.rtm_wide_to_long(page).collect()] == [
        (TS(2024, 1, 1, 0, 15), 5.0), (TS(2024, 1, 2, 0, 30), 8.0)]
    with pytest.raises(ValueError):
        feeds.rtm_wide_to_long(rows("`Oper Day` string, HB_WEST string", ("2024-01-01", "5")))
    with pytest.raises(ValueError):
        feeds.rtm_wide_to_long(rows("Time string, other string", ("x", "y")))


def test_resolve_column():
    assert feeds.resolve_column(["a", " Time "], ["Interval", "Time"]) == " Time "
    assert feeds.resolve_column(["a", "My STAMP"], ["Time"], ["stamp"]) == "My STAMP"
    assert feeds.resolve_column(["a"], ["b"], ["c"]) is None


PAGE = """<TABLE><tr><th>k</th><th>v</th></tr>
<tr><td>System
 Demand (MW)</td><td></td><td>50,123.5 MW</td></tr><tr><td>Frequency</td><td>60.01 Hz</td></tr>
<tr><td>lonely</td></tr></TABLE><table><tr><td>Frequency</td><td>59.9 Hz</td></tr>
<tr><td>State &amp; more</td><td><b>ok</b>&nbsp;!</td></tr><tr><td>Demand text</td><td>none</td></tr></table>"""


def test_cells_labels_and_picks(rows):
    pages = rows("page_id int, html string", (1, PAGE), (2, "<p>nothing</p>"))
    kv = {r.name: (r.text, r.value) for r in feeds.kv_from_cells(feeds.extract_cells(pages)).collect()}
    assert kv == {"system_demand_mw": ("50,123.5 MW", 50123.5), "frequency": ("59.9 Hz", 59.9),
                  "state_&_more": ("ok !", None), "demand_text": ("none", None)}
    direct = feeds.kv_from_rows(feeds.extract_rows(pages))
    assert {r.name: (r.text, r.value) for r in direct.collect()} == kv
    picked = feeds.pick_metric(direct).first()
    assert (picked.demand, picked.freq, picked.capacity) == (50123.5, 59.9, None)
    assert feeds.kv_maps(direct).first().conditions["frequency"] == "59.9 Hz"


def test_pick_prefers_fragment_then_first_label(rows):
    kv = rows("page_id int, name string, pos long, value double", (1, "b_demand", 1, 1.0), (1, "a_demand", 2, 2.0),
              (1, "system_demand", 3, 3.0), (2, "b_demand", 1, None), (2, "a_demand", 2, 2.0))
    got = {r.page_id: r.demand for r in feeds.pick_metric(kv).collect()}
    assert got == {1: 3.0, 2: 2.0}


def test_fuel_pivot_keeps_first_and_unknown(rows):
    df = rows("ts int, type string, event_id int, value double", (1, "WND", 2, 5.0), (1, "WND", 1, None),
              (1, "WND", 3, 9.0), (1, "OTH", 1, 4.0))
    got = feeds.fuel_pivot(df, extra=["OTH"]).first()
    assert (got.Wind, got.OTH, got.Coal) == (5.0, 4.0, None)


def test_utc_naive(rows):
    df = rows("t string", ("2024-01-01T00:00:00-06:00",), ("2024-01-01 00:00:00",))
    assert [r[0] for r in df.select(feeds.to_utc_naive("t")).collect()] == [TS(2024, 1, 1, 6), TS(2024, 1, 1)]
    assert df.select(feeds.to_utc_naive(F.col("t"), "America/Chicago")).collect()[1][0] == TS(2024, 1, 1, 6)


def test_synthetic_series_is_hourly_and_clipped(spark):
    df = feeds.synthetic_series(spark, 800)
    low, high, n, first, last = df.selectExpr("min(load_mw)", "max(load_mw)", "count(*)", "min(ts)", "max(ts)").first()
    assert n == 800 and 25000 <= low <= high <= 65000
    assert last - first == dt.timedelta(hours=799)
    assert df.collect() == feeds.synthetic_series(spark, 800).collect()


def test_hours_of_any_kind(rows):
    for kind, values in (("double", (1.0, 24.0, 1.5)), ("int", (1, 24, None)), ("string", ("01:00", " 24 ", "x")),
                         ("string", ("1.0", "24.0", "1.5"))):
        page = rows(f"`Oper Day` string, `Hour Ending` {kind}, HB_WEST string", *[("2024-01-01", h, "5") for h in values])
        got = sorted(r.ts for r in feeds.dam_wide_to_long(page).collect())
        assert got == [dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2)], kind


def test_feed_fallback_takes_the_first_with_rows(rows):
    spine = rows("ts int", (1,), (2,))
    some = rows("ts int, temperature_2m double", (2, 5.0))
    pick = lambda a, b: sorted(
        (r.ts, r.temperature_2m) for r in feeds.source_fallback(
            spine, a, b, ["temperature_2m"], {"temperature_2m": 1.0}, mode="feed").collect())
    assert pick(some.where("ts > 9"), some) == [(2, 5.0)] == pick(some, None)
    assert pick(some.where("ts > 9"), None) == [(1, 1.0), (2, 1.0)]


def test_snapshot_goes_by_wider_labels(rows):
    page = "<table>" + "".join(f"<tr><td>{n}</td><td>{v}</td></tr>" for n, v in (
        ("Actual System Demand", "50,000 MW"), ("Total System Capacity", "60,000 MW"), ("Wind Now", "7 MW"),
        ("Solar Share", "3 %"), ("Freq", "60.01 Hz"))) + "</table>"
    kv = feeds.kv_from_rows(feeds.extract_rows(rows("page_id int, html string", (1, page))))
    assert feeds.pick_metric(kv).first().wind is None
    got = feeds.pick_snapshot(kv).first()
    assert (got.demand, got.capacity, got.wind, got.solar, got.freq) == (50000.0, 60000.0, 7.0, 3.0, 60.01)


def test_pages_of_several_layouts_become_prices(rows):
    one = ("<TABLE><tr><td>title</td></tr><tr><th>Oper Day</th><th>Hour Ending</th><th> HB_NORTH </th></tr>"
           "<tr><td>2024-01-01</td><td>1</td><td>5</td></tr><tr><td>2024-01-01</td><td>24</td></tr></TABLE>"
           "<table><tr><td>no header</td></tr></table>")
    two = "<table><tr><th>HB_NORTH</th><th>Hour Ending</th></tr><tr><td>7</td><td>2.0</td></tr></table>"
    got = feeds.dam_from_pages(rows("page_id int, html string", (1, one), (2, two), (3, None), (4, "")), "2024-05-01")
    assert sorted((r.page_id, r.ts, r.price_usd_mwh) for r in got.collect()) == [
        (1, TS(2024, 1, 1, 1), 5.0), (2, TS(2024, 5, 1, 2), 7.0)]


def test_cells_are_parsed_once_and_rows_not_put_together(rows):
    pages = rows("page_id int, html string", (1, PAGE))
    picked = feeds.pick_metric(feeds.kv_from_cells(feeds.extract_cells(pages)))
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<t[dh]") == 1 and "collect_list" not in plan
    assert picked.select("demand", "freq").first() == (50123.5, 59.9)


def test_patterns_of_elements_end_where_lazy_ones_do(spark):
    odd = ["<tr><td>a</td><TD x='1'>b</tD></tr><tr><td>open<tr><td>c</td></TR>", "<tr>a < b </t <b>c</b></tr>", "<tr></tr>",
           "<tr>\n<td>x\n</td>", "<track><tr>1</tr></track>", "<tr" * 3, "</tr><tr>a</tr", "<tr><td>" + "<b>x</b>" * 50_000 + "</td></tr>", None]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, x string")
    for name in ("tr", "t[dh]", "[uo]l", "li", "table"):
        old = F.regexp_extract_all("x", F.lit(f"(?is)<{name}[^>]*>(.*?)</{name}>"), 1)
        new = F.regexp_extract_all("x", F.lit(feeds._element(name)), 1)
        assert df.where(~old.eqNullSafe(new)).count() == 0


def test_rows_of_cells_from_elsewhere(rows):
    schema = "page_id int, block int, row int, is_header boolean, cell int, text string"
    cells = [(1, 0, 0, False, 2, "7 MW"), (1, 0, 0, False, 0, ""), (1, 0, 0, False, 1, "Demand"), (1, 0, 0, False, 3, None),
             (1, 0, 0, True, 0, "Head"), (1, 0, 1, False, 0, "lonely"), (1, 0, 2, None, 0, "a"), (1, 0, 2, None, 1, "b"),
             (1, None, 0, False, 0, "Freq"), (1, None, 0, False, 1, "60 Hz"), (None, 0, 0, False, 5, "8"), (None, 0, 0, False, 4, "Wind"),
             (1, 1, 0, False, 1, "9"), (1, 1, 0, False, 0, "Demand"), (2, 0, 0, False, 1, "z"), (2, 0, 0, False, 1, "y")]
    df = rows(schema, *cells)
    got = {tuple(r) for r in feeds.kv_from_cells(df).collect()}
    assert got == {tuple(r) for r in feeds.kv_from_rows(feeds.rows_of_cells(df)).collect()}
    assert got == {(1, "demand", 0, "9", 9.0), (1, "freq", None, None, None), (None, "wind", 0, "8", 8.0), (2, "y", 0, "z", None)}


def test_texts_of_cells_are_made_once_and_outside_of_lambdas(rows):
    page = ("<table><tr><td> A\t\n(B)  C </td><td>x &amp;<i>\r y</i> 1</td></tr><tr><td>a_b_c</td><td></td><td>7,0 MW</td></tr>"
            "<tr><td> </td><td><b> </b></td></tr></table>")
    pages = rows("page_id int, html string", (1, page), (2, None))
    cells = feeds.extract_cells(pages)
    got = {(r.block, r.row, r.cell): r.text for r in cells.collect()}
    assert got == {(0, 0, 0): "A (B) C", (0, 0, 1): "x & y 1", (0, 1, 0): "a_b_c", (0, 1, 1): "", (0, 1, 2): "7,0 MW",
                   (0, 2, 0): "", (0, 2, 1): ""}
    kv = feeds.kv_from_cells(cells)
    assert [tuple(r) for r in kv.collect()] == [(1, "a_b_c", 0, "7,0 MW", 70.0)]
    plan = feeds.pick_metric(kv)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]*>") == 2 and "transform(" not in plan and "translate(" not in plan  # one text has two branches


def test_white_space_is_closed_up_as_before(spark):
    odd = ["", " ", "  ", "a b", "a  b", "a\tb", " \t a\n\n b\x0b\x0c\r\n ", "\t", "a \t", "   ", None]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    assert df.where(~F.regexp_replace("x", r"\s+", " ").eqNullSafe(feeds._spaced(F.col("x")))).count() == 0


def test_names_of_labels_are_those_of_translate(spark):
    df = spark.createDataFrame([(x,) for x in ["", "Total (MW) now", "((", "_a b_", "É (x)", None]], "x string")
    assert df.where(~F.translate(F.lower("x"), " ()", "_").eqNullSafe(feeds._label(F.col("x")))).count() == 0
