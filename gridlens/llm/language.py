"""Language identification with error-correcting output codes.

Each learned language has a codeword. A linear classifier over hashed byte trigrams predicts each bit. Decoding adds
up, for every codeword, the logistic loss of the bit margins and takes the codeword of least loss; when the next one
is close the prediction is marked ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.textops import flatten, pieces, prepare

#: Hashed trigrams, and training texts of each language at most (whole texts, picked by a hash of their id).
FEATURES, SAMPLE = 4096, 600
#: Loss by which the runner-up must be worse, per bit.
AMBIGUOUS = 0.1
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # features x bits
    bias: np.ndarray


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 per class: all two-way splits for up to five classes, else the best of fixed random codes."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        splits = np.arange(1, 2 ** (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return (2 * bits - 1).astype(np.int8)
    rng, width, best, apart = np.random.default_rng(7), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        distance = (width - code.astype(int) @ code.T) // 2 + width * np.eye(n, dtype=int)
        if distance.min() > apart and (abs(code.sum(0)) < n).all():
            best, apart = code, distance.min()
    return best


def _lowered(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts in lower case, and whether each has a letter."""
    plain = [(x or "").lower() for x in texts.to_pylist()]
    return pa.array(plain, pa.large_string()), np.array([any(map(str.isalpha, x)) for x in plain], bool)


def trigram_counts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How often each hashed byte trigram occurs in each text: texts x FEATURES."""
    n = len(offs) - 1
    if len(buf) < 3:
        return np.zeros((n, FEATURES), np.float32)
    wide = buf.astype(np.uint32)
    gram = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    bucket = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(offs))[: len(bucket)]
    inside = np.arange(2, len(buf)) < offs[owner + 1]
    return np.bincount(owner[inside] * FEATURES + bucket[inside], minlength=n * FEATURES).reshape(n, FEATURES)


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of trigram frequencies: vectors of length one."""
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = batch.column(1).to_pylist()
        texts, letters = _lowered(batch.column(0))
        buf, offs = flatten(texts)
        for a, b in pieces(offs):
            counts = trigram_counts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            rows = [(lang[a + i], np.flatnonzero(c).astype("<u2"), c[c > 0].astype("<u4"))
                    for i, c in enumerate(counts) if letters[a + i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].tobytes() for r in rows], pa.binary()),
                 pa.array([r[2].tobytes() for r in rows], pa.binary())], names=["lang", "at", "count"])


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, ridge: float = 1e-4
               ) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions, one per column of ``y`` (-1 or 1), by accelerated gradient steps."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    look, look_b, share = w, b, (weight / weight.sum()).astype(np.float32)[:, None]
    rate = 2.0
    for t in range(steps):
        pull = -y * share / (1 + np.exp(np.clip(y * (x @ look + look_b), -30, 30)))
        new, new_b = look - rate * (x.T @ pull + ridge * look), look_b - rate * pull.sum(0)
        move = t / (t + 3)
        look, look_b = new + move * (new - w), new_b + move * (new_b - b)
        w, b = new, new_b
    return w, b


def train(df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows per language among those where ``training`` is true.

    Rows without language, id or a letter teach nothing. No rows at all give a model of no language.
    """
    prepare(df.sparkSession)
    lang, doc = F.col(f"`{lang_col}`"), F.col(f"`{id_col}`")
    rows = df.filter(training & lang.isNotNull() & doc.isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang.alias("lang")).count().collect()}
    if not counts:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((FEATURES, 1), np.float32), np.zeros(1, np.float32))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * sample / n))])
    draw = F.pmod(F.xxhash64(doc, F.lit(11)), F.lit(1 << 20)) / F.lit(1 << 20)
    drawn = rows.filter(draw < F.element_at(share, lang)).select(F.col(f"`{text_col}`").alias("text"), lang.alias("lang"))
    taken = drawn.mapInArrow(_sparse, "lang string, at binary, count binary").collect()
    languages = sorted({r["lang"] for r in taken})
    if not languages:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((FEATURES, 1), np.float32), np.zeros(1, np.float32))
    x = np.zeros((len(taken), FEATURES), np.float32)
    for i, r in enumerate(taken):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["count"], "<u4")
    x = features(x)
    label = np.searchsorted(languages, [r["lang"] for r in taken])
    code = codewords(len(languages))
    weight = 1 / np.bincount(label)[label]
    weights, bias = fit_linear(x, code[label].astype(np.float32), weight)
    return Model(languages, code, weights, bias)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each row of bit margins, its share of the likelihood, and whether it is ambiguous."""
    agree = margins[:, None, :] * model.code[None, :, :]
    loss = np.logaddexp(0, -agree).sum(2)
    order = np.sort(loss, axis=1)
    close = (order[:, 1] - order[:, 0] < AMBIGUOUS * model.code.shape[1] if loss.shape[1] > 1
             else np.zeros(len(loss), bool))
    like = np.exp(order[:, :1] - loss)
    best = loss.argmin(1)
    return best, like[np.arange(len(loss)), best] / like.sum(1), close


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, letters = _lowered(batch.column(1))
            buf, offs = flatten(texts)
            for a, b in pieces(offs):
                told, score, close = [UNKNOWN] * (b - a), np.zeros(b - a), np.zeros(b - a, bool)
                if model.languages:
                    x = features(trigram_counts(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]))
                    best, likely, near = decode(model, x @ model.weights + model.bias)
                    for i in np.flatnonzero(letters[a:b]):
                        told[i], score[i], close[i] = model.languages[best[i]], likely[i], near[i]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(told, pa.string()), pa.array(score, pa.float64()),
                     pa.array(close, pa.bool_())], names=["id", "lang_pred", "score", "ambiguous"])
    return run


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``lang_pred``, ``score`` from 0 to 1, ``ambiguous``.

    Only the text counts. A null text, one without a letter, or a model without languages gives `und` with score 0.
    Null and repeated ids are judged row by row. Other columns are not carried. An empty table gives an empty table.
    """
    prepare(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInArrow(_predict(model), f"id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
