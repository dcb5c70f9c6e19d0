"""Suffix dedup by a radix sort that stops at the threshold: equal groups are exactly the repeated windows.

A window is the first ``WIDTH`` bytes of a suffix. Its digits are read in an order that the content fixes: first
its smallest gram of ``GRAM`` bytes by hash (the anchor), then where in the window that gram stands, with the bytes
around it. Windows are equal just when all these digits are, and neighbouring windows share their anchor, so one
entry stands for up to ``WIDTH - GRAM + 1`` suffixes and the sort moves about one entry in fourteen bytes.

Pass 1 deals entries out by anchor. Groups of one entry are finished, as in any most-significant-digit sort.
Pass 2 deals the others out again with the bytes around them and orders each of the windows by its remaining
digits. Within a group the smallest document keeps its bytes. Each task sorts its own entries first and passes on
only those that the smallest document of the task holds, so a passage in a third of all documents is one entry a
task and not one a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.store import written
from gridlens.llm.textops import (
    _BASE, _BASE_INV, _BYTE, U64, flatten, mix, pieces, prepare, slide, window_hashes)

WIDTH, GRAM = 50, 24
REACH = WIDTH - GRAM
SPAN = REACH + WIDTH
#: Bytes of text that a task sorts by itself before it passes entries on.
HOARD = 8 << 20
#: Entries whose windows are ordered at once.
RUN = 1 << 15
#: Bytes of all texts for each hash group of entries, which one worker sorts, and groups at least.
GROUP_BYTES, LEAST_GROUPS = 8 << 20, 16
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_UP = np.array([pow(_BASE, i, 1 << 64) for i in range(SPAN + 1)], np.uint64)
_DOWN = np.array([pow(_BASE_INV, i, 1 << 64) for i in range(SPAN + 1)], np.uint64)
NOTE = "doc long, mark int, a long, b int"


def anchors(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of all anchors of the windows within the texts."""
    at, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, last in pieces(offs):
        part = buf[offs[first] : offs[last]]
        n = len(part)
        if n < WIDTH:
            continue
        gram = np.full(n, _NONE)
        gram[: n - GRAM + 1] = window_hashes(part, GRAM)
        bounds = offs[first : last + 1] - offs[first]
        crossing = bounds[1:, None] - np.arange(1, GRAM)[None, :]
        gram[crossing[crossing >= 0]] = _NONE
        least = np.zeros(n, np.uint64)
        least[: n - REACH] = slide(gram, REACH + 1, np.minimum)
        outside = bounds[1:, None] - np.arange(1, WIDTH)[None, :]
        least[outside[outside >= 0]] = 0
        most = slide(np.concatenate([np.zeros(REACH, np.uint64), least]), REACH + 1, np.maximum)
        here = np.flatnonzero((most == gram) & (gram != _NONE))
        at.append(here + offs[first])
        grams.append(gram[here])
    return np.concatenate(at), np.concatenate(grams)


def contexts(buf: np.ndarray, offs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes that the windows of each anchor reach (zero outside its text), and how far left and right."""
    text = np.searchsorted(offs, at, "right") - 1
    left = np.minimum(REACH, at - offs[text]).astype(np.uint8)
    right = np.minimum(WIDTH, offs[text + 1] - at).astype(np.uint8)
    column = np.arange(SPAN)
    out = np.empty((len(at), SPAN), np.uint8)
    for i in range(0, len(at), 1 << 16):
        s = slice(i, i + (1 << 16))
        out[s] = buf[np.clip(at[s, None] + (column - REACH)[None, :], 0, max(0, len(buf) - 1))]
        out[s] *= (column[None, :] >= REACH - left[s, None]) & (column[None, :] < REACH + right[s, None].astype(int))
    return out, left, right


def _least(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each entry the smallest document among those with its key."""
    order = np.lexsort((doc, key))
    sorted_key = key[order]
    start = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    out = np.empty(len(doc), np.int64)
    out[order] = doc[order][np.flatnonzero(start)][np.cumsum(start) - 1]
    return out


def _whole_groups(entries: np.ndarray, gram: np.ndarray) -> Iterator[np.ndarray]:
    """Entries in runs of about ``RUN``, none of which parts a group of equal grams."""
    edges = np.concatenate([np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])), [len(gram)]])
    first = 0
    while first < len(entries):
        last = int(edges[np.searchsorted(edges, min(first + RUN, len(entries)))])
        yield entries[first:last]
        first = last


def resolve(doc: np.ndarray, gram: np.ndarray, ctx: np.ndarray, left: np.ndarray,
            right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry the removed stretch around its anchor (from, to; to 0 if none), and whether any window
    is left that no smaller document among these entries holds."""
    n = len(doc)
    low, high, open_ = np.full(n, REACH + 1, np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
    if not n:
        return low, high, open_
    first_i = np.maximum(0, WIDTH - right.astype(np.int64))
    last_i = left.astype(np.int64)
    whole = np.empty(n, np.uint64)
    for i in range(0, n, 1 << 14):
        s = slice(i, i + (1 << 14))
        whole[s] = (_BYTE[ctx[s]] * _UP[:SPAN]).sum(1, dtype=np.uint64)
    whole = mix(whole + left.astype(np.uint64) * U64(1 << 40) + right.astype(np.uint64) * U64(1 << 50)) ^ gram
    gone = doc > _least(doc, whole)
    low[gone], high[gone] = first_i[gone], last_i[gone]
    rest = np.flatnonzero(~gone)
    order = rest[np.argsort(gram[rest], kind="stable")]
    g = gram[order]
    start = np.concatenate([[True], g[1:] != g[:-1]])
    size = np.diff(np.concatenate([np.flatnonzero(start), [len(g)]]))
    alone = np.repeat(size == 1, size)
    open_[order[alone]] = True
    many = order[~alone]
    for part in _whole_groups(many, gram[many]):
        sums = np.zeros((len(part), SPAN + 1), np.uint64)
        np.cumsum(_BYTE[ctx[part]] * _UP[:SPAN], axis=1, out=sums[:, 1:])
        for i in range(REACH + 1):
            has = np.flatnonzero((first_i[part] <= i) & (i <= last_i[part]))
            if not len(has):
                continue
            entry, begin = part[has], REACH - i
            key = mix((sums[has, begin + WIDTH] - sums[has, begin]) * _DOWN[begin]) + gram[entry]
            lost = doc[entry] > _least(doc[entry], key)
            out = entry[lost]
            low[out] = np.minimum(low[out], i)
            high[out] = np.maximum(high[out], i)
            open_[entry[~lost]] = True
    return low, high, open_


def _hoards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= HOARD:
                yield held
                held, size = [], 0
    if held:
        yield held


def _texts(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    table = pa.Table.from_batches(held)
    buf, offs = flatten(table.column(1))
    doc = table.column(0).to_numpy().astype(np.int64)
    mark = table.column(2).to_numpy().astype(np.int32)
    return buf, offs, doc, mark, table


def _pack(ctx: np.ndarray) -> bytes:
    """Neighbouring contexts overlap and are text: entropy coding halves what the shuffle writes."""
    return pa.Codec("zstd", 1).compress(ctx.tobytes(), asbytes=True)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    flat = pa.Codec("zstd").decompress(raw, decompressed_size=n * SPAN, asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(n, SPAN)


def _six(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray((grams >> U64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _of_six(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.int64)


def _notes(doc: np.ndarray, mark: np.ndarray, text: np.ndarray, begin: np.ndarray, at: np.ndarray, low: np.ndarray,
           high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Removed stretches as (doc, mark, from, length), those of one text merged where they touch."""
    hit = np.flatnonzero(high >= 0)
    t = text[hit]
    a = at[hit] - begin[t] - high[hit]
    b = at[hit] - begin[t] - low[hit] + WIDTH
    order = np.lexsort((a, t))
    t, a, b = t[order], a[order], b[order]
    if not len(t):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.int32), none, none.astype(np.int32)
    lift = t.astype(np.int64) << 40
    reach = np.maximum.accumulate(b + lift)
    start = np.concatenate([[True], (a[1:] + lift[1:]) > reach[:-1]])
    first = np.flatnonzero(start)
    last = np.concatenate([first[1:], [len(t)]]) - 1
    end = reach[last] - lift[last]
    return doc[t[first]], mark[t[first]], a[first], (end - a[first]).astype(np.int32)


_BLOB = pa.schema([("bucket", pa.int32()), ("doc", pa.binary()), ("mark", pa.binary()), ("a", pa.binary()),
                   ("b", pa.binary()), ("gram", pa.binary()), ("ctx", pa.binary()), ("reach", pa.binary())])
BLOB = "bucket int, doc binary, mark binary, a binary, b binary, gram binary, ctx binary, reach binary"


def _blob(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_BLOB)], schema=_BLOB)


def _note_blob(notes: tuple, spread: int) -> tuple:
    """Stretches travel with the entries of some group and come out of it unchanged."""
    doc, mark, a, b = notes
    return (int(doc[0]) % spread, doc.tobytes(), mark.tobytes(), a.astype(np.int64).tobytes(), b.tobytes(), None, None,
            None)


def _by_bucket(gram: np.ndarray, spread: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = ((gram & U64(0xFFFF)) % U64(spread)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(spread + 1))
    for k in range(spread):
        if edges[k] < edges[k + 1]:
            yield k, order[edges[k] : edges[k + 1]]


def _repeated(gram: np.ndarray) -> np.ndarray:
    order = np.argsort(gram, kind="stable")
    g = gram[order]
    same = np.concatenate([[False], g[1:] == g[:-1]])
    same[:-1] |= same[1:]
    out = np.zeros(len(gram), bool)
    out[order] = same
    return out


def _pass_one(spread: int):
    """Texts to entries (doc and gram) dealt out by gram, and the stretches resolved within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _hoards(batches):
            buf, offs, doc, mark, _ = _texts(held)
            at, gram = anchors(buf, offs)
            if not len(at):
                continue
            text = np.searchsorted(offs, at, "right") - 1
            twice = np.flatnonzero(_repeated(gram))
            low, high, open_ = resolve(doc[text[twice]], gram[twice], *contexts(buf, offs, at[twice]))
            rows = []
            notes = _notes(doc, mark, text[twice], offs, at[twice], low, high)
            if len(notes[0]):
                rows.append(_note_blob(notes, spread))
            send = np.ones(len(at), bool)
            send[twice[~open_]] = False
            for k, own in _by_bucket(gram[send], spread):
                ids = doc[text[send][own]]
                rows.append((k, np.diff(ids, prepend=0).tobytes(), None, None, None, _six(gram[send][own]), None, None))
            yield _blob(rows)
    return run


def _pass_one_groups(table: pa.Table) -> pa.Table:
    """Entries whose gram another document holds too (b = -1), and the stretches handed through."""
    docs, grams, out = [], [], []
    for row in table.to_pylist():
        if row["gram"] is None:
            out.append([np.frombuffer(row[c], t) for c, t in (("doc", "<i8"), ("mark", "<i4"), ("a", "<i8"), ("b", "<i4"))])
        else:
            docs.append(np.cumsum(np.frombuffer(row["doc"], "<i8")))
            grams.append(_of_six(row["gram"]))
    if docs:
        doc, gram = np.concatenate(docs), np.concatenate(grams)
        order = np.lexsort((doc, gram))
        doc, gram = doc[order], gram[order]
        start = np.concatenate([[True], gram[1:] != gram[:-1]])
        first = np.flatnonzero(start)
        last = np.concatenate([first[1:], [len(gram)]]) - 1
        wanted = np.repeat(doc[first] != doc[last], last - first + 1)
        doc, gram = doc[wanted], gram[wanted]
        out.append([doc, np.zeros(len(doc), np.int32), gram, np.full(len(doc), -1, np.int32)])
    return _note_table(out)


def _note_table(parts: list[list[np.ndarray]]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
    cells = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(4)]
    return pa.Table.from_arrays([pa.array(c).cast(k) for c, k in zip(cells, kinds)], names=["doc", "mark", "a", "b"])


def _pass_two(spread: int):
    """Texts with the grams asked of them to entries with their contexts, dealt out by gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _hoards(batches):
            buf, offs, doc, mark, table = _texts(held)
            at, gram = anchors(buf, offs)
            asked = table.column(3).combine_chunks()
            asked = asked if isinstance(asked, pa.Array) else pa.concat_arrays(asked.chunks)
            of = np.repeat(np.arange(len(doc)), np.diff(asked.offsets.to_numpy()))
            want = asked.flatten().to_numpy().astype(np.uint64)
            text = np.searchsorted(offs, at, "right") - 1
            tag = lambda g, t: mix(g + t.astype(np.uint64) * U64(_BASE))
            mine = np.isin(tag(gram >> U64(16), text), tag(want, of))
            at, gram, text = at[mine], gram[mine], text[mine]
            if not len(at):
                continue
            ctx, left, right = contexts(buf, offs, at)
            low, high, open_ = resolve(doc[text], gram, ctx, left, right)
            rows = []
            notes = _notes(doc, mark, text, offs, at, low, high)
            if len(notes[0]):
                rows.append(_note_blob(notes, spread))
            keep = np.flatnonzero(open_)
            for k, own in _by_bucket(gram[keep], spread):
                e = keep[own]
                t = text[e]
                rows.append((k, np.diff(doc[t], prepend=0).tobytes(), mark[t].tobytes(),
                             (at[e] - offs[t]).astype(np.int64).tobytes(), None, gram[e].tobytes(), _pack(ctx[e]),
                             np.concatenate([left[e], right[e]]).tobytes()))
            yield _blob(rows)
    return run


def _pass_two_groups(table: pa.Table) -> pa.Table:
    """The stretches that the windows of equal anchors decide, and those handed through."""
    out, docs, marks, ats, grams, ctxs, lefts, rights = [], [], [], [], [], [], [], []
    for row in table.to_pylist():
        mark, a = np.frombuffer(row["mark"], "<i4"), np.frombuffer(row["a"], "<i8")
        if row["gram"] is None:
            out.append([np.frombuffer(row["doc"], "<i8"), mark, a, np.frombuffer(row["b"], "<i4")])
            continue
        docs.append(np.cumsum(np.frombuffer(row["doc"], "<i8")))
        marks.append(mark)
        ats.append(a)
        grams.append(np.frombuffer(row["gram"], "<u8"))
        ctxs.append(_unpack(row["ctx"], len(a)))
        reach = np.frombuffer(row["reach"], np.uint8).reshape(2, -1)
        lefts.append(reach[0])
        rights.append(reach[1])
    if docs:
        doc, mark, at, gram = (np.concatenate(x) for x in (docs, marks, ats, grams))
        low, high, _ = resolve(doc, gram, np.concatenate(ctxs), np.concatenate(lefts), np.concatenate(rights))
        hit = np.flatnonzero(high >= 0)
        out.append([doc[hit], mark[hit], at[hit] - high[hit], (high[hit] - low[hit] + WIDTH).astype(np.int32)])
    return _note_table(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their removed stretches."""
    for batch in batches:
        buf, offs = flatten(batch.column(1))
        mark = batch.column(2).to_numpy(zero_copy_only=False)
        lists = batch.column(3)
        cells = lists.flatten()
        owner, first, length = (cells.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        edges = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        kept, removed, spans = [], [], []
        for i in range(batch.num_rows):
            body = buf[offs[i] : offs[i + 1]]
            s = slice(int(edges[i]), int(edges[i + 1]))
            own = owner[s] == mark[i]
            a, n = first[s][own], length[s][own]
            if not len(a):
                kept.append(body.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            edge = np.zeros(len(body) + 1, np.int64)
            np.add.at(edge, a, 1)
            np.add.at(edge, a + n, -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept.append(body[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(kept, pa.binary())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that a window of 50 bytes covers which starts in a document with a smaller id too.

    Returns ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``: the remaining
    bytes, binary since a cut may part a character. Windows never cross texts and are judged on the input. A null
    text is empty. Texts shorter than a window stay. Rows with a null id stay whole and remove nothing elsewhere;
    rows that share an id remove nothing from each other. Other columns are not carried. An empty table gives an
    empty table.
    """
    spark = prepare(df.sparkSession)
    text = F.col(f"`{text_col}`")
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    marked = docs.withColumn("mark", F.hash("text"))
    # Groups by what there is to sort and not by the session's partitions: a group holds its share of the texts.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = max(LEAST_GROUPS, -(-size // GROUP_BYTES))
    made: list[str] = []
    entries = marked.filter("doc IS NOT NULL").mapInArrow(_pass_one(spread), BLOB)
    notes = written(entries.groupBy("bucket").applyInArrow(_pass_one_groups, NOTE), "notes", made)
    # Both passes over the dealt texts read one exchange.
    dealt = docs.filter("doc IS NOT NULL").repartition("doc").withColumn("mark", F.hash("text"))
    asked = notes.filter("b < 0").groupBy("doc").agg(F.collect_set("a").alias("asked"))
    second = dealt.join(asked, "doc").select("doc", "text", "mark", "asked").mapInArrow(_pass_two(spread), BLOB)
    found = second.groupBy("bucket").applyInArrow(_pass_two_groups, NOTE).unionByName(notes.filter("b >= 0"))
    stretches = found.groupBy("doc").agg(F.collect_list(F.struct("mark", "a", "b")).alias("stretches"))
    told = dealt.join(stretches, "doc", "left").select("doc", "text", "mark", "stretches")
    nameless = marked.filter("doc IS NULL").withColumn("stretches", F.lit(None).cast(told.schema["stretches"].dataType))
    out = told.unionByName(nameless).mapInArrow(
        _cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("doc", id_col)
