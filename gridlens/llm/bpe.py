"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash of the bytes cuts texts into chunks, so that equal passages of different documents give equal
chunks. A chunk is encoded once; the tokens around each cut are then repaired: the stretch from the last
synchronising place before the cut to the second one after it is encoded anew, and has to agree exactly with the
tokens the right chunk has between its first and second such place. If it does not, or a chunk has no two such
places, the stretch grows. A synchronising place is a space after a printable ASCII character: no token of a
byte-level BPE with the word pattern below reaches across it, whatever stands on either side.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.textops import PIECE, U64, flatten, pieces, prepare, window_hashes

#: Bytes that the rolling hash sees; one in ``CHUNK`` places is a cut.
ROLL, CHUNK = 16, 1024
#: Bytes of chunks that a worker keeps with their tokens.
KEEP_BYTES = 24 << 20
#: Fixed value: the word pattern of byte-level BPE files of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable bytes for themselves, the rest for
    code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Ranks of byte strings and special tokens from a tokenizers file of byte-level BPE.

    Raises if the file holds anything this operator does not do, rather than giving other ids.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before, model = spec["pre_tokenizer"], spec["model"]
    plain = (model["type"] == "BPE" and not spec["normalizer"] and not model.get("dropout")
             and before["type"] == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    joined = (x if isinstance(x, list) else x.split(" ") for x in model["merges"])
    order = [model["vocab"]["".join(x)] for x in joined]
    if any(a >= b for a, b in zip(order, order[1:])) or any(" " in s for s in special):
        raise ValueError(f"{path}: ids do not follow the merges")
    return {"ranks": ranks, "special": special}


class Engine:
    """Encoder and byte table of a vocabulary, and the chunks this worker has encoded."""

    def __init__(self, vocabulary: dict):
        self.bpe = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=vocabulary["ranks"],
                                     special_tokens=vocabulary["special"])
        size = max([*vocabulary["ranks"].values(), *vocabulary["special"].values()], default=0) + 1
        tokens = [b""] * size
        for raw, i in vocabulary["ranks"].items():
            tokens[i] = raw
        for text, i in vocabulary["special"].items():
            tokens[i] = text.encode()
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.chunks: OrderedDict[bytes, np.ndarray] = OrderedDict()
        self.held = 0

    def encode(self, raw: bytes) -> np.ndarray:
        return np.array(self.bpe.encode(raw.decode(), allowed_special="all"), np.uint32)

    def chunk(self, raw: bytes) -> np.ndarray:
        ids = self.chunks.get(raw)
        if ids is None:
            ids = self.chunks[raw] = self.encode(raw)
            self.held += 3 * len(raw)
            while self.held > KEEP_BYTES:
                self.held -= 3 * len(self.chunks.popitem(last=False)[0])
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids in UTF-8; bytes that are no UTF-8 become replacement characters."""
        if not len(ids):
            return b""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.bytes[at].tobytes().decode("utf-8", "replace").encode()


def engine(vocabulary: Broadcast) -> Engine:
    """The worker's engine; it stays with the broadcast value from one task to the next."""
    held = vocabulary.value
    if "engine" not in held:
        held["engine"] = Engine(held)
    return held["engine"]


def cut_places(buf: np.ndarray, offs: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where the rolling hash cuts, at the first byte of a character and within texts only."""
    at = np.flatnonzero(window_hashes(buf, ROLL) % U64(chunk) == 0) + ROLL
    at = at[at < len(buf)]
    at = at[(buf[at] & 0xC0) != 0x80]
    text = np.searchsorted(offs, at, "right") - 1
    return at[at - offs[text] >= ROLL]


def sync_places(buf: np.ndarray) -> np.ndarray:
    """Spaces after a printable ASCII character."""
    return np.flatnonzero((buf[1:] == 0x20) & (buf[:-1] > 0x20) & (buf[:-1] < 0x7F)) + 1


def encode_text(run: Engine, body: bytes, cuts: list[int], syncs: np.ndarray) -> np.ndarray:
    """Ids of one text with its cuts and synchronising places."""
    edges = [0, *cuts, len(body)]
    if len(edges) == 2:
        return run.chunk(body)
    out, since = [], 0
    for start, end in zip(edges, edges[1:]):
        first, last = np.searchsorted(syncs, [start + 1, end])
        if last - first < 2:
            continue
        ids = run.chunk(body[start:end])
        ends = np.concatenate([[0], np.cumsum(run.lengths[ids])])
        one, two, end_sync = (int(syncs[i]) for i in (first, first + 1, last - 1))
        t1, t2, t3 = (int(np.searchsorted(ends, p - start)) for p in (one, two, end_sync))
        if start:
            repaired = run.encode(body[since:two])
            if len(repaired) < t2 - t1 or not np.array_equal(repaired[len(repaired) - (t2 - t1):], ids[t1:t2]):
                continue
            out.append(repaired)
            out.append(ids[t2:t3])
        else:
            out.append(ids[:t3])
        since = end_sync
    out.append(run.encode(body[since:]))
    return np.concatenate(out)


def _encode(vocabulary: Broadcast, names: list[str], wide: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = engine(vocabulary)
        for batch in batches:
            buf, offs = flatten(batch.column(1))
            for a, b in pieces(offs, 4 * PIECE):
                part, bounds = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                cuts, syncs = cut_places(part, bounds), sync_places(part)
                cut_at, sync_at = np.searchsorted(cuts, bounds, "right"), np.searchsorted(syncs, bounds)
                ids, counts, texts = [], [], []
                for i in range(b - a):
                    lo, hi = int(bounds[i]), int(bounds[i + 1])
                    own = cuts[cut_at[i] : cut_at[i + 1]]
                    own = own[own < hi] - lo
                    got = encode_text(run, part[lo:hi].tobytes(), own.tolist(), syncs[sync_at[i] : sync_at[i + 1]] - lo)
                    ids.append(got)
                    counts.append(len(got))
                    texts.append(run.decode(got))
                if wide:
                    edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
                else:
                    tokens = pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), tokens,
                     pa.array(texts, pa.binary()).cast(pa.string())], names=names)
    return task


def encode_documents(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                     ids_as: str = "array") -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``ids``, ``decoded`` (the text that the ids give back).

    The ids are those of the tokenizers library for the file at ``vocabulary_path`` without added special tokens;
    the strings of special tokens inside a text become their ids, as there. ``ids`` is an array of ints, or with
    ``ids_as="binary"`` their little-endian unsigned 32-bit values. A null or empty text has no ids. Ids of rows may
    be null or repeated. Other columns are not carried. An empty table gives an empty table.
    """
    spark: SparkSession = prepare(df.sparkSession)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    wide = ids_as == "array"
    kind = df.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids", "decoded"]
    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _encode(vocabulary, names, wide),
        f"id {kind}, n_tokens long, ids {'array<int>' if wide else 'binary'}, decoded string")
    return out.withColumnRenamed("id", id_col)
