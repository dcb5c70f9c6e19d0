"""Secret scans: fixed rules, and the Shannon entropy of a window sliding over candidate strings.

A candidate is a maximal run of the characters of one class (hexadecimal, base 36, base 64). A window of ``width``
characters slides over it; the counts of its characters change by one leaving and one entering at each step, and with
them the sum of ``c log2 c``, which gives the entropy. Windows of enough bits that mix kinds of characters, laid over
each other, are the spans. Candidates on the allow-list (slugs, paths, dates, UUIDs, alphabets) give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.llm.textops import flatten, pieces, prepare

#: The rules, in their order, each with the group whose length counts and its least length.
#: They are matched on bytes with A-Z lowered where ``any_case``, so that letters are ASCII letters only.
RULES = [
    ("assign", rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)", True, 2, 6),
    ("access", rb"AKIA[A-Z0-9]+", False, 0, 20),
    ("hex", rb"[0-9a-f]{24,}", False, 0, 24),
]


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    characters: str  # inside of a regular expression's brackets
    width: int
    bits: float  # least entropy of a window
    digits: int  # least digits, letters, capitals and small letters in it
    letters: int
    capitals: int = 0
    small: int = 0


#: From narrow to wide. A random window has about 3.3, 3.9 and 4.1 bits, one of prose under 3.5 and no digits.
CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 20, 2.95, 2, 2),
    CharacterClass("entropy_base36", "0-9a-z", 20, 3.55, 2, 2),
    CharacterClass("entropy_base64", "0-9A-Za-z+/=_-", 20, 3.75, 1, 2, 1, 1),
)
#: Whole candidates that are no secrets: words and numbers joined by single marks; UUIDs.
ALLOWED_PATTERNS = (
    r"[+/=_-]?([A-Za-z]+|[0-9]+)([+/=_-]([A-Za-z]+|[0-9]+))*[+/=_-]?",
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
)
#: Spans that stand inside one of these are no secrets.
ALLOWED_TEXTS = (
    "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=", "0123456789abcdef0123456789abcdef",
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_", "0123456789ABCDEF0123456789ABCDEF",
)
#: Parts of a bit in the sums below; whole numbers do not depend on the order of addition.
_PARTS = 1 << 32


def _members(characters: str) -> np.ndarray:
    inside = re.compile(f"[{characters}]".encode())
    return np.array([bool(inside.match(bytes([b]))) for b in range(256)])


def runs_of(mask: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of set places of at least ``least`` within one text each."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    edges = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < len(mask))]
    begins[edges] = mask[edges]
    ends[edges - 1] = mask[edges - 1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = e - s >= least
    return s[long], e[long]


def window_sums(codes: np.ndarray, run: np.ndarray, width: int) -> np.ndarray:
    """For the window of ``width`` places that ends at each place, the sum of ``c log2 c`` over the counts of its
    characters, in whole ``_PARTS``; windows do not reach into another run (shorter ones stand at a run's start).

    A place's character enters with the count that the window holds of it already and leaves with the count that the
    window holds then; both counts are distances among the sorted places of that character.
    """
    n = len(codes)
    count = np.arange(width + 2, dtype=float)
    cost = np.rint(count * np.log2(np.maximum(count, 1)) * _PARTS).astype(np.int64)
    first = np.searchsorted(run, run)  # first place of each place's run
    key = run.astype(np.int64) * 256 + codes
    order = np.argsort(key, kind="stable")
    group = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0])) * (n + 2 * width)
    at = group + order  # ascending: places of one character of one run stand together
    index = np.arange(n)
    held = index - np.searchsorted(at, at - width + 1)
    left = np.searchsorted(at, at + width) - index
    enter, leave = np.empty(n, np.int64), np.empty(n, np.int64)
    enter[order] = cost[held + 1] - cost[held]
    leave[order] = cost[left - 1] - cost[left]
    entered, gone = (np.concatenate([[0], np.cumsum(c)]) for c in (enter, leave))
    out = np.maximum(index + 1 - width, first)
    return entered[index + 1] - entered[first] + gone[out] - gone[first]


def entropy_spans(buf: np.ndarray, offs: np.ndarray, kind: CharacterClass, allowed: re.Pattern, texts: Sequence[str]
                  ) -> list[tuple[int, int, float]]:
    """(start, end, most bits of a window) of the places of ``buf`` that lie in a window of enough bits."""
    starts, ends = runs_of(_members(kind.characters)[buf], offs, kind.width)
    if not len(starts):
        return []
    size = ends - starts
    base = np.cumsum(size) - size
    place = np.repeat(starts - base, size) + np.arange(size.sum())
    run = np.repeat(np.arange(len(starts)), size)
    codes = buf[place].astype(np.int64)
    sums = window_sums(codes, run, kind.width)
    most = int(np.floor((np.log2(kind.width) - kind.bits) * kind.width * _PARTS))
    good = (sums <= most) & (np.arange(len(codes)) - base[run] >= kind.width - 1)
    if not good.any():
        return []
    digit, capital, small = ((codes >= a) & (codes <= b) for a, b in ((48, 57), (65, 90), (97, 122)))
    for has, least in ((digit, kind.digits), (capital | small, kind.letters), (capital, kind.capitals),
                       (small, kind.small)):
        seen = np.concatenate([[0], np.cumsum(has)])
        last = np.arange(len(codes)) + 1
        good &= seen[last] - seen[np.maximum(last - kind.width, 0)] >= least
    hit = np.flatnonzero(good)
    if not len(hit):
        return []
    new = np.concatenate([[True], (np.diff(hit) > kind.width) | (np.diff(run[hit]) > 0)])
    heads = np.flatnonzero(new)
    least_sum = np.minimum.reduceat(sums[hit], heads)
    tails = np.concatenate([heads[1:], [len(hit)]]) - 1
    kept = []
    for first, last, least in zip(hit[heads].tolist(), hit[tails].tolist(), least_sum.tolist()):
        a, b, r = int(place[first]) - kind.width + 1, int(place[last]) + 1, run[first]
        candidate, span = buf[starts[r] : ends[r]].tobytes().decode(), buf[a:b].tobytes().decode()
        if not allowed.fullmatch(candidate) and not any(span in t for t in texts):
            kept.append((a, b, float(np.log2(kind.width) - least / kind.width / _PARTS)))
    return kept


def _scan(classes: Sequence[CharacterClass], patterns: Sequence[str], texts: Sequence[str], rules: list, n_carry: int,
          schema: pa.Schema):
    compiled = [(kind, re.compile(p), low, group, least) for kind, p, low, group, least in rules]
    allowed = re.compile("|".join(f"(?:{p})" for p in patterns) or r"(?!)")
    order = {k: i for i, k in enumerate([*(r[0] for r in rules), *(c.kind for c in classes)])}

    def of_piece(buf: np.ndarray, offs: np.ndarray) -> list[list[dict]]:
        raw = buf.tobytes()
        low = raw.lower()  # of bytes: A-Z only, in place
        n = len(offs) - 1
        found: list[list[tuple]] = [[] for _ in range(n)]
        for i in range(n):
            a, b = int(offs[i]), int(offs[i + 1])
            for kind, pattern, any_case, group, least in compiled:
                # A slice, since a match must neither begin before nor reach beyond its text.
                for m in pattern.finditer((low if any_case else raw)[a:b]):
                    if m.end(group) - m.start(group) >= least:
                        found[i].append((a + m.start(), a + m.end(), kind, None))
        for c in classes:
            for a, b, bits in entropy_spans(buf, offs, c, allowed, texts):
                i = int(np.searchsorted(offs, a, "right")) - 1
                if not any(s <= a and b <= e for s, e, _, _ in found[i]):
                    found[i].append((a, b, c.kind, bits))
        if not any(found):
            return [[] for _ in range(n)]
        point = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        return [[{"kind": kind, "start": int(point[s] - point[offs[i]]), "end": int(point[e] - point[offs[i]]),
                  "bits": bits}
                 for s, e, kind, bits in sorted(spans, key=lambda x: (x[0], order[x[2]], x[1]))]
                for i, spans in enumerate(found)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = flatten(batch.column(0))
            for a, b in pieces(offs):
                spans = of_piece(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                carried = [batch.column(1 + i).slice(a, b - a) for i in range(n_carry)]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(spans, schema.field("secrets").type)],
                                                 names=schema.names)
    return task


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("bits", T.DoubleType())]))


def scan_secrets(df: DataFrame, columns: Sequence[str], text_col: str = "text",
                 classes: Sequence[CharacterClass] = CLASSES, allowed_patterns: Sequence[str] = ALLOWED_PATTERNS,
                 allowed_texts: Sequence[str] = ALLOWED_TEXTS) -> DataFrame:
    """``columns`` of ``df`` and ``secrets``: spans (kind, start, end, bits) by start, then kind, then end.

    Places count code points, ends are exclusive. ``RULES`` are matched leftmost and without overlap, kind by kind, a
    match whose group is too short is dropped; their spans always stay and have no bits. A span by entropy is left out
    where it lies within one by a rule or by a narrower class, or where the allow-list suppresses it. Rows are judged
    one by one, whatever their other columns hold; a null or empty text has no spans; a column named ``secrets`` in
    the input gives way. A text is scanned whole, however long. An empty table gives an empty table.
    """
    prepare(df.sparkSession)
    columns = [c for c in columns if c != "secrets"]
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in columns], T.StructField("secrets", SPANS)])
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())])
    arrow = pa.schema([*[pa.field(c, pa.null()) for c in columns], pa.field("secrets", pa.list_(span))])
    rows = df.select(F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"carry{i}") for i, c in enumerate(columns)])
    return rows.mapInArrow(
        _scan(tuple(classes), tuple(allowed_patterns), tuple(allowed_texts), RULES, len(columns), arrow), schema)


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df``, which has ``secrets``, with every place of ``text_col`` that a span covers replaced by ``mark``, once for
    spans that overlap or touch."""
    text, spans = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.array_sort(
        F.transform("secrets", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("upto"))
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))

    def step(done, s):
        apart = (s["start"] > done["upto"]) | (done["out"] == "")
        added = F.concat(done["out"], part(done["upto"], s["start"]), F.lit(mark))
        return F.struct(F.when(apart, added).otherwise(done["out"]).alias("out"),
                        F.greatest(done["upto"], s["end"]).alias("upto"))

    clean = F.aggregate(spans, empty, step, lambda d: F.concat(d["out"], F.substring(
        text, (d["upto"] + 1).cast("int"), F.length(text))))
    return df.withColumn(text_col, F.when(F.size("secrets") > 0, clean).otherwise(F.col(f"`{text_col}`")))
