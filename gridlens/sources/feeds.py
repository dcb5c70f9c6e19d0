"""Raw feeds to keyed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.scalars import moment, nan_as_null
from gridlens.operators.ordered import join_on
from gridlens.schemas import FUELS, HUBS, WEATHER_DEFAULTS

# How many newest rows each poll asks for.
LATEST_LIVE = 48

# Header names of price pages, in order of preference.
DATE_HEADERS = ["Operating Day", "Oper Day", "OperDay"]
HOUR_HEADERS = ["Hour Ending", "HourEnding", "Hour"]
TIME_HEADERS = ["Interval Ending", "Time", "Delivery Time", "Timestamp", "Interval", "SCEDTimestamp"]
TIME_PARTS = ["time", "interval", "stamp"]

# Label fragments of a conditions page, in order of preference.
CONDITION_KEYS = {
    "demand": ["actual_system_demand", "system_demand", "demand"],
    "capacity": ["total_system_capacity", "system_capacity", "capacity"],
    "wind": ["wind_output", "total_wind"],
    "solar": ["pvgr_output", "total_pvgr", "solar"],
    "freq": ["frequency", "current_frequency"],
}
# The wider fragments used for the snapshot record.
SNAPSHOT_KEYS = {
    "wind": ["wind_output", "wind"],
    "solar": ["pvgr_output", "solar", "pvgr"],
    "freq": ["frequency", "freq"],
}
VALUE_UNITS = [",", " MW", " Hz", " %"]


def number(column: str | Column) -> Column:
    """A finite or missing number; junk and NaN become missing."""
    column = F.col(column) if isinstance(column, str) else column
    return nan_as_null(column.try_cast("double"))


# Demand and forecast ----------------------------------------------------------------

def normalize_demand(raw: DataFrame, kind: str = "D", value_name: str = "load_mw",
                     coerce: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of one type with a period and a value. ``coerce`` turns a bad number into a gap."""
    value = F.col("value").cast("string")
    parsed = nan_as_null(value.try_cast("double")) if coerce else value.cast("double")
    return (raw.where((F.col("type") == kind) & F.col("value").isNotNull()
                      & (F.coalesce(F.col("period"), F.lit("")) != ""))
            .select("period", F.try_to_timestamp("period").alias("ts"),
                    parsed.alias(value_name), *keep))


def pair_forecast(demand: DataFrame, forecast: DataFrame, position: str = "pos",
                  zero_is_missing: bool = False) -> DataFrame:
    """Attach the forecast of the same period; of several, the last in feed order."""
    single = forecast.where(F.col("forecast_mw").isNotNull()).groupBy("period").agg(F.max_by("forecast_mw", position).alias("forecast_mw"))
    given = F.col("forecast_mw").isNotNull()
    if zero_is_missing:
        given = given & (F.col("forecast_mw") != 0)
    return (demand.join(single, "period", "left")
            .withColumn("grid_stress", F.when(given, F.col("load_mw") - F.col("forecast_mw"))))


def latest_n(feed: DataFrame, n: int = LATEST_LIVE, by: str = "period", ties: Sequence[str] = ()) -> DataFrame:
    return feed.orderBy(F.col(by).desc(), *[F.col(c).desc() for c in ties]).limit(n)


# Weather ------------------------------------------------------------------------------

WEATHER_ARRAYS = {"temperature_2m": "temperature_2m", "wind_speed_10m": "wind_speed_10m",
                  "direct_radiation": "direct_radiation", "relative_humidity": "relative_humidity_2m"}


def explode_hourly(feed: DataFrame, keys: Sequence[str] = ("zone",)) -> DataFrame:
    """Parallel arrays to rows. Short arrays give gaps; values beyond ``time`` are dropped."""
    arrays = [F.col(f"hourly.{source}").alias(name) for name, source in WEATHER_ARRAYS.items()]
    flat = feed.select(*keys, F.col("hourly.time").alias("time"), *arrays)
    zipped = flat.select(*keys, F.size("time").alias("_n"),
                         F.posexplode(F.arrays_zip("time", *WEATHER_ARRAYS)).alias("_pos", "_row"))
    return zipped.where(F.col("_pos") < F.col("_n")).select(
        F.try_to_timestamp("_row.time").alias("ts"), *keys,
        *[F.col(f"_row.{name}").alias(name) for name in WEATHER_ARRAYS])


def multi_zone_union(zones: Mapping[str, DataFrame | None]) -> DataFrame:
    """One frame of all zones; a zone whose fetch failed adds no rows."""
    tagged = [df.withColumn("zone", F.lit(name)) for name, df in zones.items() if df is not None]
    if not tagged:
        raise ValueError("no zone delivered data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_fallback(spine: DataFrame, archive: DataFrame | None, forecast: DataFrame | None,
                    columns: Sequence[str] = tuple(WEATHER_DEFAULTS),
                    defaults: Mapping[str, float] = WEATHER_DEFAULTS,
                    mode: str = "row", keys: Sequence[str] = ("ts",)) -> DataFrame:
    """Weather on every spine hour: archive, else forecast, else the defaults.

    ``mode="row"`` decides per hour and column; ``mode="feed"`` is all or nothing: the
    rows of the first source that has any, as they are, and the spine with defaults
    if none has.
    """
    sources = [s for s in (archive, forecast) if s is not None]
    if mode == "feed":
        plain = spine.select(*keys, *[F.lit(defaults[c]).alias(c) for c in columns])
        ranked = [s.select(*keys, *columns).withColumn("_rank", F.lit(k)) for k, s in enumerate([*sources, plain])]
        stacked = reduce(lambda a, b: a.unionByName(b), ranked)
        return stacked.where(F.col("_rank") == stacked.agg(F.min("_rank")).scalar()).drop("_rank")
    out = spine
    for k, source in enumerate(sources):
        named = source.select(*keys, *[F.col(c).alias(f"_{k}_{c}") for c in columns])
        out = join_on(out, named, keys, "left")
    picked = [F.coalesce(*[F.col(f"_{k}_{c}") for k in range(len(sources))], F.lit(defaults[c])).alias(c)
              for c in columns]
    return out.select(*keys, *picked)


def chunk_ranges(spans: DataFrame, first: str = "first", last: str = "last", days: int = 30,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Cut date ranges into inclusive chunks; the next chunk starts a day after the last."""
    step = F.make_interval(days=F.lit(days + 1))
    starts = F.sequence(F.to_date(first), F.date_sub(F.to_date(last), 1), step)
    return (spans.where(F.to_date(first) < F.to_date(last))
            .select(*keys, F.to_date(last).alias("_last"), F.explode(starts).alias("chunk_start"))
            .select(*keys, "chunk_start",
                    F.least(F.date_add("chunk_start", days), F.col("_last")).alias("chunk_end")))


# Prices -----------------------------------------------------------------------------------

def resolve_column(columns: Sequence[str], candidates: Sequence[str],
                   parts: Sequence[str] = ()) -> str | None:
    """First candidate present, else the first column containing a part."""
    names = {c.strip(): c for c in columns}
    for candidate in candidates:
        if candidate in names:
            return names[candidate]
    for c in columns:
        if any(part in c.lower() for part in parts):
            return c
    return None


def _hub_columns(df: DataFrame, hubs: Sequence[str]) -> list[str]:
    found = [c for c in df.columns if c.strip() in hubs]
    if not found:
        raise ValueError("no hub column on the page")
    return found


def _prices(rows: DataFrame, hubs: Sequence[str], market: str, keep: Sequence[str]) -> DataFrame:
    texts = rows.select("ts", *keep, *[F.col(f"`{h}`").cast("string").alias(h.strip()) for h in hubs])
    long = texts.unpivot(["ts", *keep], [h.strip() for h in hubs], "settlement_point", "_price")
    return (long.withColumn("price_usd_mwh", number("_price"))
            .where(F.col("price_usd_mwh").isNotNull())
            .select("ts", "settlement_point", "price_usd_mwh", F.lit(market).alias("market_type"), *keep))


# Time formats of price pages besides the standard one.
PAGE_TIMES = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy"]


def page_time(text: Column) -> Column:
    """A page's date or time; missing when it cannot be read."""
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in PAGE_TIMES])


def dam_wide_to_long(rows: DataFrame, fallback_date=None, hubs: Sequence[str] = HUBS,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Day-ahead page: date plus hour ending; hour 24 is the next midnight.

    The fallback date stands in for a missing date only; an unreadable one drops the row.
    """
    hour_name = resolve_column(rows.columns, HOUR_HEADERS, ["hour"])
    if hour_name is None:
        raise ValueError("no hour column on the page")
    date_name = resolve_column(rows.columns, DATE_HEADERS, ["day", "date"])
    fallback = F.to_date(moment(fallback_date))
    date = fallback
    if date_name:
        given = F.col(f"`{date_name}`").cast("string")
        date = F.when(given.isNull(), fallback).otherwise(page_time(given).cast("date"))
    # Pages give whole hours as 1, 01, 1.0 or with minutes; a broken hour is no hour.
    given = F.col(f"`{hour_name}`").cast("string")
    number_ = F.regexp_replace(F.trim(given), ":00$", "").try_cast("double")
    hour = F.when(number_ == F.floor(number_), number_).try_cast("int")
    ts = date.cast("timestamp") + F.make_dt_interval(hours=hour)
    stamped = rows.withColumn("ts", ts).where(F.col("ts").isNotNull())
    return _prices(stamped, _hub_columns(rows, hubs), "DAM", keep)


def rtm_wide_to_long(rows: DataFrame, hubs: Sequence[str] = HUBS, keep: Sequence[str] = ()) -> DataFrame:
    """Real-time page: explicit time column; unreadable times are dropped."""
    time_name = resolve_column(rows.columns, TIME_HEADERS, TIME_PARTS)
    if time_name is None:
        raise ValueError("no time column on the page")
    stamped = rows.withColumn("ts", page_time(F.col(f"`{time_name}`").cast("string")))
    return _prices(stamped.where(F.col("ts").isNotNull()), _hub_columns(rows, hubs), "RTM", keep)


def dam_from_pages(pages: DataFrame, fallback_date=None, hubs: Sequence[str] = HUBS, key: str = "page_id",
                   html: str = "html") -> DataFrame:
    """Day-ahead prices from the HTML of their pages."""
    return dam_wide_to_long(named_rows(pages, key, html), fallback_date, hubs, [key])


def rtm_from_pages(pages: DataFrame, hubs: Sequence[str] = HUBS, key: str = "page_id", html: str = "html") -> DataFrame:
    """Real-time prices from the HTML of their pages."""
    return rtm_wide_to_long(named_rows(pages, key, html), hubs, [key])


# Pages ------------------------------------------------------------------------------------

_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _element(name: str) -> str:
    """The pattern of an element's content, up to its first end tag.

    It goes from one ``<`` to the next and gives nothing back, where a lazy ``.*?`` tries the end tag at every character.
    """
    return f"(?is)<{name}[^>]*>([^<]*+(?:<(?!/{name}>)[^<]*+)*+)</{name}>"


TABLE, ROW, CELL, HEADER = _element("table"), _element("tr"), _element("t[dh]"), "(?is)<th[ >]"


def _spaced(text: Column) -> Column:
    """Runs of white space as one space. Single spaces, the most of them, are no match and stay."""
    return F.regexp_replace(text, r" \s+|[\t\n\x0B\f\r]\s*", " ")


def _plain(markup: Column) -> Column:
    """Text of a cell. Most cells hold neither tags nor entities and skip that work."""
    untagged = F.when(markup.contains("<"), _spaced(F.regexp_replace(markup, "<[^>]*>", " "))).otherwise(markup)
    decoded = untagged
    for entity, char in _ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.trim(F.when(markup.contains("&"), _spaced(decoded)).otherwise(untagged))


def _row_texts(pages: DataFrame, key: str, html: str, block: str, row: str) -> DataFrame:
    blocks = pages.select(key, F.posexplode(
        F.regexp_extract_all(_spaced(F.col(html)), F.lit(block), 1)).alias("block", "_block"))
    return blocks.select(key, "block", F.posexplode(
        F.regexp_extract_all("_block", F.lit(row), 1)).alias("row", "_row"))


def _cells_of(row: str, cell: str) -> Column:
    return F.transform(F.regexp_extract_all(row, F.lit(cell), 1), _plain)


def extract_rows(pages: DataFrame, key: str = "page_id", html: str = "html", block: str = TABLE, row: str = ROW,
                 cell: str = CELL, header: str = HEADER) -> DataFrame:
    """Table rows of each page: ``(key, block, row, is_header, cells)``. Needs no shuffle."""
    return _row_texts(pages, key, html, block, row).select(
        key, "block", "row", F.col("_row").rlike(header).alias("is_header"), _cells_of("_row", cell).alias("cells"))


def named_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows of the tables that have a header, one column per header cell; empty cells are missing.

    A table's header is its first row with header cells. Everything happens within the
    page's row; the driver sees only the distinct names, which are few in a feed.
    """
    blocks = pages.select(key, F.explode(F.regexp_extract_all(
        _spaced(F.col(html)), F.lit(TABLE), 1)).alias("_block"))
    lines = F.transform(F.regexp_extract_all("_block", F.lit(ROW), 1), lambda r: F.struct(
        r.rlike(HEADER).alias("is_header"),
        F.transform(F.regexp_extract_all(r, F.lit(CELL), 1), _plain).alias("cells")))
    header = F.get(F.filter("_lines", lambda r: r["is_header"]), F.lit(0))["cells"]
    rows = (blocks.select(key, lines.alias("_lines")).select(key, header.alias("_names"), F.explode("_lines").alias("_line"))
            .where(F.col("_names").isNotNull() & ~F.col("_line.is_header")).select(key, "_names", "_line.cells"))
    names = sorted(r[0] for r in rows.select(F.explode("_names")).distinct().collect() if r[0])
    at = lambda name: F.get("cells", F.array_position("_names", F.lit(name)).cast("int") - 1)
    return rows.select(key, *[F.nullif(at(n), F.lit("")).alias(n) for n in names if n != key])


def extract_cells(pages: DataFrame, key: str = "page_id", html: str = "html", block: str = TABLE, row: str = ROW,
                  cell: str = CELL, header: str = HEADER) -> DataFrame:
    """Cells of each page as rows ``(key, block, row, is_header, cell, text)``."""
    # The cells are exploded where they are parsed: of a column of them Spark would derive a filter that parses them again.
    # Their texts are made from rows, in compiled code, where lambdas over arrays are interpreted; held in a one-element
    # array and exploded, so that a filter on the text makes it once.
    found = _row_texts(pages, key, html, block, row).select(
        key, "block", "row", F.col("_row").rlike(header).alias("is_header"),
        F.posexplode(F.regexp_extract_all("_row", F.lit(cell), 1)).alias("cell", "_cell"))
    return found.select(key, "block", "row", "is_header", "cell", F.explode(F.array(_plain(F.col("_cell")))).alias("text"))


# The patterns that read a list item as a row of one cell.
LIST_PATTERNS = {"block": _element("[uo]l"), "row": _element("li"), "cell": "(?is)^(.*)$"}


def extract_list_items(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return extract_cells(pages, key, html, **LIST_PATTERNS)


def rows_of_cells(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """Cells back to rows, for cell tables from elsewhere."""
    packed = F.sort_array(F.collect_list(F.struct("cell", "text")))
    # Dealt out by page: whatever is grouped by page and more after this needs no further shuffle.
    return cells.repartition(key).groupBy(key, "block", "row", "is_header").agg(
        F.transform(packed, lambda c: c["text"]).alias("cells"))


def kv_from_cells(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """`kv_from_rows` of the rows that the cells make up, which are not put together: of a row only its first and its
    last filled cell and their number are kept."""
    filled = cells.where(~F.col("is_header") & (F.col("text") != ""))
    # Dealt out by page, once for the grouping by row, the one by label and the one by page in `pick_metric`.
    # A cell and its text travel as the struct that they are compared as, and are not put together for each comparison.
    held = filled.select(key, "block", "row", F.struct("cell", "text").alias("_cell"))
    ends = held.repartition(key).groupBy(key, "block", "row").agg(
        F.count(F.lit(1)).alias("n"), F.min("_cell")["text"].alias("label"), F.max("_cell")["text"].alias("text"))
    return _by_label(ends.select(key, _place(), "n", "label", "text"), key)


def kv_from_rows(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """First cell as label, last as value, per row of at least two filled cells.

    Rows ``(key, name, pos, text, value)``: ``pos`` is where the label first came,
    the value is the last one given.
    """
    # Held in a one-element array and exploded, so that the cells are parsed once.
    filled = F.array(F.filter("cells", lambda c: c != ""))
    pairs = F.transform(filled, lambda f: F.struct(
        F.size(f).alias("n"), F.get(f, F.lit(0)).alias("label"), F.get(f, F.size(f) - 1).alias("text")))
    # Dealt out by page, once for the grouping by label here and the one by page in `pick_metric`.
    return _by_label(rows.where(~F.col("is_header")).select(key, _place(), F.inline(pairs)), key, deal=True)


def _place() -> Column:
    return F.shiftleft(F.col("block").cast("bigint"), 32).bitwiseOR(F.col("row").cast("bigint")).alias("_at")


def _label(text: Column) -> Column:
    """A label's name. Replaced text by text, which takes a fraction of what `translate` does character by character."""
    name = F.lower(text)
    for mark, instead in ((" ", "_"), ("(", ""), (")", "")):
        name = F.replace(name, F.lit(mark), F.lit(instead))
    return name


def _by_label(ends: DataFrame, key: str, deal: bool = False) -> DataFrame:
    usable = ends.where(F.col("n") >= 2)
    value = F.col("text")
    for unit in VALUE_UNITS:
        value = F.replace(value, F.lit(unit), F.lit(""))
    named = (usable.repartition(key) if deal else usable).select(
        key, "_at", _label(F.col("label")).alias("name"), "text", value.try_cast("double").alias("value"))

    def last(column: str) -> Column:
        # Over structs, which Spark sorts for: rows come almost in order, and hardly two are of one label.
        return F.max(F.when(F.col("_at").isNotNull(), F.struct("_at", column)))[column].alias(column)

    return named.groupBy(key, "name").agg(F.min("_at").alias("pos"), last("text"), last("value"))


def kv_maps(kv: DataFrame, key: str = "page_id") -> DataFrame:
    """One map of labels to values per page; a page's labels are few."""
    return kv.groupBy(key).agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("name", "text")))).alias("conditions"))


def pick_metric(kv: DataFrame, wanted: Mapping[str, Sequence[str]] = CONDITION_KEYS,
                key: str = "page_id") -> DataFrame:
    """Per page and figure: best fragment first, then the label that came first."""
    picks = []
    for figure, fragments in wanted.items():
        found = [F.min_by("value", F.when(
            F.col("name").contains(fragment) & F.col("value").isNotNull(), F.col("pos"))) for fragment in fragments]
        picks.append(F.coalesce(*found).alias(figure))
    return kv.groupBy(key).agg(*picks)


def pick_snapshot(kv: DataFrame, key: str = "page_id") -> DataFrame:
    """The figures of a snapshot record: wind, solar and frequency go by wider fragments."""
    return pick_metric(kv, CONDITION_KEYS | SNAPSHOT_KEYS, key)


def page_figures(pages: DataFrame, wanted: Mapping[str, Sequence[str]] = CONDITION_KEYS, key: str = "page_id",
                 html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """The same straight from pages: a page's labels all lie in its row, so nothing is shuffled.

    Per figure the first fragment that a label holds whose last value is a number; of its
    labels the one that came first. Pages without a labelled value are left out.
    """
    found = F.regexp_extract_all(_spaced(F.col(html)), F.lit(TABLE), 1)
    lines = F.flatten(F.transform(found, lambda b: F.regexp_extract_all(b, F.lit(ROW), 1)))
    plain = F.filter(lines, lambda r: ~r.rlike(HEADER))
    cells = F.transform(plain, lambda r: F.filter(
        F.transform(F.regexp_extract_all(r, F.lit(CELL), 1), _plain), lambda c: c != ""))

    def pair(c: Column) -> Column:
        value = F.get(c, F.size(c) - 1)
        for unit in VALUE_UNITS:
            value = F.replace(value, F.lit(unit), F.lit(""))
        return F.struct(_label(F.get(c, F.lit(0))).alias("name"),
                        value.try_cast("double").alias("value"))

    pairs = F.transform(F.filter(cells, lambda c: F.size(c) >= 2), pair)
    # Held in a one-element array and exploded, so that the page is parsed once.
    rows = pages.select(key, *keep, F.explode(F.array(pairs)).alias("_kv")).where(F.size("_kv") > 0)
    picks = []
    for figure, fragments in wanted.items():
        def value_of(fragment: str) -> Column:
            labels = F.transform(F.filter("_kv", lambda p: p["name"].contains(fragment)), lambda p: F.element_at(
                F.filter("_kv", lambda q: q["name"] == p["name"]), -1)["value"])
            return F.get(F.filter(labels, lambda x: x.isNotNull()), F.lit(0))
        picks.append(F.coalesce(*[value_of(f) for f in fragments]).alias(figure))
    return rows.select(key, *keep, *picks)


# Fuel mix -----------------------------------------------------------------------------------

def fuel_pivot(rows: DataFrame, tie: str = "event_id", codes: Mapping[str, str] = FUELS,
               extra: Sequence[str] = ()) -> DataFrame:
    """One column per fuel, the first value of each hour; ``extra`` codes keep their name."""
    names = dict(codes) | {c: c for c in extra}
    picks = [F.min_by("value", F.when((F.col("type") == code) & F.col("value").isNotNull(), F.col(tie))).alias(name)
             for code, name in names.items()]
    return rows.groupBy("ts").agg(*picks)


# Time and synthetic data --------------------------------------------------------------------

def to_utc_naive(column: str | Column, zone: str | None = None) -> Column:
    """UTC wall clock; a zone-less text is taken as it stands unless ``zone`` is given."""
    column = F.col(column) if isinstance(column, str) else column
    ts = column.cast("timestamp")
    return (F.to_utc_timestamp(ts, zone) if zone else ts).cast("timestamp_ntz")


def synthetic_series(spark: SparkSession, n: int = 800, start: str = "2024-01-01 00:00:00",
                     seed: int = 42) -> DataFrame:
    """Hourly load and temperature with noise, made on the executors."""
    hours = spark.range(n)
    load = F.lit(45_000.0) + F.randn(seed) * 2_000 + F.sin(F.col("id") / 24) * 3_000
    return hours.select(
        (F.lit(start).cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
        F.least(F.lit(65_000.0), F.greatest(F.lit(25_000.0), load)).alias("load_mw"),
        (F.lit(25.0) + F.randn(seed + 1) * 5).alias("temperature_2m"))

