"""Cross-tokenizer alignment: groups of tokens that end at the same byte, and the links inside them.

Each tokenization of a text is a list of ids whose cumulative ends index it by byte: a dictionary from end to index.
The ends that both dictionaries hold, sorted, slice the two lists into groups; inside a group, a pair of tokens
is linked where their bytes overlap. Links are counted by pair of ids over the whole corpus, and every text is told how
many of its links are the commonest of their second id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.bpe import PATTERN, read_vocabulary
from gridlens.llm.store import remove, written
from gridlens.llm.textops import prepare

#: Pairs of ids whose counts every task holds: the commonest. Those of all other pairs are joined.
COMMON = 1 << 18
#: Distinct pairs that a task counts before it hands them on.
HELD_PAIRS = 1 << 20
#: Bytes of text that are tokenized at once; a longer text is alone.
AT_ONCE = 4 << 20


class Tokenizers:
    """The two tokenizers of a worker and the bytes of their tokens."""

    def __init__(self, files: dict):
        import sentencepiece
        import tiktoken

        ranks = files["ranks"]
        size = max(ranks.values()) + 1
        self.byte_level = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files["pieces"])
        self.a_bytes = [b""] * size
        for raw, i in ranks.items():
            self.a_bytes[i] = raw
        self.b_bytes = [self._raw(i) for i in range(self.pieces.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # Each id with what may follow it in the text of the groups.
        ids = range(max(size, len(self.b_bytes)))
        self.names = np.array([f"{i}{mark}".encode() for mark in (",", "|", ";") for i in ids], object)

    def _raw(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: Sequence[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of " " + text and of text; both empty unless the bytes of each are those of " " + text."""
        some = [i for i, t in enumerate(texts) if t]
        second = self.pieces.encode([texts[i] for i in some], num_threads=1) if some else []
        out: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        for i, b in zip(some, second):
            whole = " " + texts[i]
            a = self.byte_level.encode_ordinary(whole)
            raw = whole.encode()
            if b"".join([self.a_bytes[x] for x in a]) == raw and b"".join([self.b_bytes[x] for x in b]) == raw:
                out[i] = a, b
        return out


def tokenizers(files: Broadcast) -> Tokenizers:
    """The worker's tokenizers; they stay with the broadcast value from one task to the next."""
    held = files.value
    if "tokenizers" not in held:
        held["tokenizers"] = Tokenizers(held)
    return held["tokenizers"]


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From the byte sizes of two tokenizations of the same bytes: for each group the index after its last token in
    each list; and the index in each list of every link, in order."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_index = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_index = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    common = sorted(a_index.keys() & b_index.keys())
    a_upto, b_upto = (np.fromiter(map(x.__getitem__, common), np.int64, len(common)) for x in (a_index, b_index))
    a_n, b_n = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    # No end is shared inside a slice, so each of its tokens but the first begins a new link. Where a side has one
    # token, that is linked with all of the other side.
    count = a_n + b_n - 1
    first = np.cumsum(count) - count
    step = np.arange(count.sum()) - np.repeat(first, count)
    left = np.repeat(a_upto - a_n, count) + np.minimum(step, np.repeat(a_n - 1, count))
    right = np.repeat(b_upto - b_n, count) + np.minimum(step, np.repeat(b_n - 1, count))
    for g in np.flatnonzero((a_n > 1) & (b_n > 1)).tolist():  # the side whose token ends first steps on
        i, j, k = int(a_upto[g] - a_n[g]), int(b_upto[g] - b_n[g]), int(first[g])
        for k in range(k, k + int(count[g])):
            left[k], right[k] = i, j
            if a_ends[i] < b_ends[j]:
                i += 1
            else:
                j += 1
    return a_upto, b_upto, left, right


def group_text(names: np.ndarray, a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group. ``names`` holds every id before a comma, a bar, a semicolon."""
    ids = len(names) // 3
    a_n, b_n = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    at = np.empty(len(a) + len(b), np.int64)
    own_a, own_b = a.copy(), b.copy()
    own_a[a_upto - 1] += ids
    own_b[b_upto - 1] += 2 * ids
    at[np.arange(len(a)) + np.repeat(b_upto - b_n, a_n)] = own_a
    at[np.arange(len(b)) + np.repeat(a_upto, b_n)] = own_b
    return b"".join(names[at].tolist())[:-1]


def _align(files: Broadcast, digest: bool, names: list[str], wide: bool):
    number = pa.int64() if wide else pa.int32()

    def of_text(run: Tokenizers, a: list[int], b: list[int]) -> tuple:
        if not a:
            return 0, 0, 0, 0, "", [], []
        x, y = np.array(a), np.array(b)
        a_upto, b_upto, left, right = align(run.a_sizes[x], run.b_sizes[y])
        text = group_text(run.names, x, y, a_upto, b_upto)
        pairs, times = np.unique(x[left] * len(run.b_bytes) + y[right], return_counts=True)
        return (len(a), len(b), len(a_upto), len(left), sha256(text).hexdigest() if digest else text.decode(), pairs, times)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = tokenizers(files)
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(number), pa.list_(pa.int32())]
        for batch in batches:
            texts, first = batch.column(1), 0
            while first < batch.num_rows:
                part, held = [], 0
                while first + len(part) < batch.num_rows and (not part or held < AT_ONCE):
                    part.append(texts[first + len(part)].as_py() or "")
                    held += len(part[-1])
                rows = [of_text(run, a, b) for a, b in run.encode(part)]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *columns], names=names)
                first += len(part)
    return task


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair in a stretch of the task's rows; a stretch ends when its pairs are many."""
    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, at, np.concatenate([t for _, t in held]))
        return pairs, n

    held, size = [], 0
    for batch in batches:
        held.append(tuple(batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)))
        size += len(held[-1][0])
        if size > 2 * HELD_PAIRS:
            held = [counted(held)]
            size = len(held[0][0])
            if size > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=["pair", "n"])
                held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in counted(held)], names=["pair", "n"])


def _known(common: Broadcast, names: list[str]):
    """Rows with what their common pairs add, and the other pairs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            pairs, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            size = np.diff(pairs.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            flat, n = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (pairs, times))
            at = np.searchsorted(known["pair"], flat)
            is_known = at < len(known["pair"])
            is_known[is_known] = known["pair"][at[is_known]] == flat[is_known]
            at, own = at[is_known], row[is_known]
            total, best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, own, n[is_known] * known["n"][at])
            np.add.at(best, own, n[is_known] * known["best"][at])
            rest = np.bincount(row[~is_known], minlength=batch.num_rows)
            edges = pa.array(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32))
            rare = pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(
                [pa.array(flat[~is_known]), pa.array(n[~is_known])], ["pair", "times"]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(best), pa.array(total), rare], names=names)
    return task


def align_documents(df: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id",
                    text_col: str = "text", groups_as: str = "text", common: int = COMMON) -> DataFrame:
    """One row per input row: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best``, ``count_sum``.

    Tokenizer A is the byte-level BPE of the file at ``byte_level_path`` applied to a space and the text, B the pieces
    of ``pieces_path`` applied to the text; strings of special tokens are plain text. ``groups`` is
    ``a1,a2|b1;a3|b2,b3`` in ids, or its SHA-256 in hex with ``groups_as="sha256"``, and empty without tokens. A text
    that is null, empty, or whose joined token bytes differ from a space and the text has no tokens. ``count_sum`` adds
    over the links how many links of all rows hold the same pair of ids, ``n_best`` counts the links whose pair is the
    most linked of its B id, ties included. Every row counts, also those whose id is null or repeated. Other columns
    are not carried. An empty table gives an empty table.

    Texts are tokenized once; the pairs of each row are written. The counts of the ``common`` most linked pairs go to
    every task; rows meet the counts of all other pairs in a join on the pair, which no pair dominates: each of them has
    less than one in ``common`` of the links. ``common`` changes no result.
    """
    spark = prepare(df.sparkSession)
    with open(pieces_path, "rb") as file:
        raw = file.read()
    files = spark.sparkContext.broadcast({"ranks": read_vocabulary(byte_level_path)["ranks"], "pieces": raw})
    n_b = Tokenizers(dict(files.value)).pieces.get_piece_size()
    n_a = max(files.value["ranks"].values()) + 1
    wide, kind = n_a * n_b >= 1 << 31, df.schema[id_col].dataType.simpleString()
    own = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    plain = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string"
    aligned = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _align(files, groups_as == "sha256", [*own, "pairs", "times"], wide),
        f"{plain}, pairs array<{'bigint' if wide else 'int'}>, times array<int>")
    pairs_at: list[str] = []
    # Numbered as it is written: a row keeps its number from here on.
    aligned = written(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned", pairs_at)
    counts = aligned.select("pairs", "times").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts_at: list[str] = []
    counts = written(counts, "pair-counts", counts_at)
    # A row for each B id: as many as B has pieces.
    best = F.broadcast(counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most")))
    counts = counts.join(best, F.col("pair") % n_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    top = counts.orderBy(F.desc("n"), "pair").limit(common).toArrow()
    order = np.argsort(top.column("pair").to_numpy(), kind="stable")
    known = spark.sparkContext.broadcast({c: top.column(c).to_numpy()[order] for c in ("pair", "n", "best")})
    names = ["row", *own, "n_best", "count_sum", "rare"]
    partial_at: list[str] = []
    partial = written(aligned.select("row", *own, "pairs", "times").mapInArrow(
        _known(known, names),
        f"row long, {plain}, n_best long, count_sum long, rare array<struct<pair: bigint, times: bigint>>"), "aligned-common",
        partial_at)
    remove(spark, pairs_at)
    rest = partial.select("row", F.inline("rare")).join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.col("times") * F.col("best")).alias("more_best"))
    out = partial.drop("rare").join(rest, "row", "left")
    zero = F.lit(0)
    return out.select(F.col("id").alias(id_col), *own[1:],
                      (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("more", zero)).alias("count_sum"))
