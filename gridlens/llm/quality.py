"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence comes from two classifiers, one of style (hashed byte trigrams) and one of terms (words that
labelled toxic documents use and others don't). Documents of a site resemble each other, so the evidence is combined
with the posterior of the document's host and, below it, of its path. Both levels are shrunk: a path of few documents
towards its host, a host of few towards the global mean, each as strongly as the spread between sites that is left
after the spread within them demands. A document is left out of its own site's posterior.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.llm.language import FEATURES, features, fit_linear, trigram_counts
from gridlens.llm.store import written
from gridlens.llm.textops import NOT_LETTERS, U64, flatten, pieces, prepare, words

#: Labelled documents of each kind (good, junk, toxic, both) that are fitted on at most, picked by a hash of their id.
SAMPLE = 1200
TERMS = 1 << 18
#: Figures of a text's shape that the style classifier sees beside its trigrams, and the trigrams from which a text
#: is more itself than the average text.
SHAPE, ENOUGH = 8, 150
#: Occurrences of prior weight for a term's rates, and the log ratio from which a term counts.
TERM_PRIOR, TERM_FLOOR = 3.0, 1.5
#: Words by which a text's length is raised where its terms are set against it.
LENGTH = 40
#: Strength of a prior when sites do not differ at all.
MOST_STRENGTH = 1e9
KEEP_FROM = 0.5
_TINY = 1e-6
_SYMBOL = np.array([33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in ".,'-" for b in range(256)])


@dataclass(frozen=True)
class Model:
    style: np.ndarray  # FEATURES + SHAPE weights and a bias
    terms: np.ndarray  # excess log ratio of each hashed term
    toxic: np.ndarray  # weights of the strongest and of all terms, and a bias


def _term_buckets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text, the text of each, and how often each stands in it."""
    hashes, _, owner = words(buf, offs, NOT_LETTERS)
    both, times = np.unique((owner.astype(np.uint64) << U64(32)) | (hashes % U64(TERMS)), return_counts=True)
    return (both & U64(0xFFFFFFFF)).astype(np.int64), (both >> U64(32)).astype(np.int64), times


def _shape(buf: np.ndarray, offs: np.ndarray, owner: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Shares of capitals, digits, symbols and space among the bytes, letters a word, distinct among all words, the
    share of the commonest word, and that of its excess over the average word."""
    n = len(offs) - 1
    size = np.maximum(np.diff(offs), 1)
    sums = [np.concatenate([[0], np.cumsum(c)])[offs] for c in (
        (buf >= 65) & (buf <= 90), (buf >= 48) & (buf <= 57), _SYMBOL[buf], (buf == 32) | ((buf >= 9) & (buf <= 13)),
        ~NOT_LETTERS[buf])]
    capital, digit, symbol, space, letter = (np.diff(c) for c in sums)
    total = np.maximum(np.bincount(owner, times, n), 1)
    distinct = np.bincount(owner, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    cells = [capital / size, digit / size, symbol / size, space / size, letter / total / 10, distinct / total,
             most / total, most * distinct / total / 20]
    return np.stack(cells, 1).astype(np.float32)


def _style(counts: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Features of style; those of a short text are drawn towards nothing, and so its evidence to the average."""
    seen = counts.sum(1, keepdims=True)
    return np.concatenate([features(counts), shape], 1) * np.sqrt(seen / (seen + ENOUGH)).astype(np.float32)


def _term_features(weights: np.ndarray, bucket: np.ndarray, owner: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    """The strongest term, and what all terms add up to with all their repeats against the text's length: long texts
    hold a stray term or two that mean nothing."""
    excess = weights[bucket]
    most = np.zeros(n, np.float32)
    np.maximum.at(most, owner, excess)
    whole, words_in = np.bincount(owner, excess * times, n), np.bincount(owner, times, n)
    return np.stack([most / 5, np.minimum(10 * whole / (LENGTH + words_in) ** 0.75, 10)], 1).astype(np.float32)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offs = flatten(batch.column(0))
        for a, b in pieces(offs):
            part, bounds = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
            counts = trigram_counts(part, bounds)
            bucket, owner, times = _term_buckets(part, bounds)
            shape = _shape(part, bounds, owner, times)
            edge = np.searchsorted(owner, np.arange(b - a + 1))
            cells = [(np.flatnonzero(c).astype("<u2").tobytes(), c[c > 0].astype("<u4").tobytes(),
                      bucket[edge[i] : edge[i + 1]].astype("<u4").tobytes(),
                      times[edge[i] : edge[i + 1]].astype("<u4").tobytes(), shape[i].astype("<f4").tobytes())
                     for i, c in enumerate(counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a),
                 *[pa.array([c[i] for c in cells], pa.binary()) for i in range(5)]],
                names=["kind", "weight", "at", "count", "terms", "times", "shape"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> Model:
    """Fit on at most about ``sample`` labelled documents of each kind, weighted to the shares of all labels.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; a row with a null in the first two teaches nothing, a null
    ``toxic`` counts as 0, of repeated ids one row counts. With no labels of one kind its classifier is neutral.
    """
    prepare(docs.sparkSession)
    # 0 good, 1 junk, 2 toxic, 3 both: junk that is toxic teaches either classifier.
    kind = F.when(F.col("quality") == 0, 1).otherwise(0) + F.when(F.coalesce("toxic", F.lit(0)) == 1, 2).otherwise(0)
    told = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.max(kind).alias("kind")))
    counts = {r["kind"]: r["count"] for r in told.groupBy("kind").count().collect()}
    model = Model(np.zeros(FEATURES + SHAPE + 1, np.float32), np.zeros(TERMS, np.float32), np.zeros(3, np.float32))
    if not counts:
        return model
    share = {k: min(1.0, sample / n) for k, n in counts.items()}
    chance = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("kind"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / F.lit(1 << 20)
    # At most about four times ``sample`` ids: their size is bounded whatever the tables'.
    drawn = F.broadcast(told.filter(draw < chance).select(F.col("doc_id").alias("id"), "kind", (1 / chance).alias("w")))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(drawn, "id")
            .select("text", "kind", "w").mapInArrow(
                _examples, "kind int, weight double, at binary, count binary, terms binary, times binary, shape binary").collect())
    if not rows:
        return model
    label = np.array([r["kind"] for r in rows])
    weight = np.array([r["weight"] for r in rows])
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["count"], "<u4")
    x = _style(x, np.array([np.frombuffer(r["shape"], "<f4") for r in rows]))
    junk = np.where(label % 2 == 1, 1, -1).astype(np.float32)[:, None]
    if abs(junk.mean()) < 1:
        w, b = fit_linear(x, junk, weight, steps=500, ridge=3e-6)
        model.style[:] = np.append(w[:, 0], b)
    toxic = label >= 2
    if toxic.any() and not toxic.all():
        used = np.zeros((2, TERMS))
        terms = [np.frombuffer(r["terms"], "<u4").astype(np.int64) for r in rows]
        times = [np.frombuffer(r["times"], "<u4").astype(np.int64) for r in rows]
        n = np.zeros(2)
        for t, k, flag in zip(terms, times, toxic):
            used[int(flag), t] += k
            n[int(flag)] += k.sum()
        rate = (used + TERM_PRIOR * (n / max(n.sum(), 1.0))[:, None]) / (n + TERM_PRIOR)[:, None]
        model.terms[:] = np.maximum(np.log(np.maximum(rate[1], 1e-300) / np.maximum(rate[0], 1e-300)) - TERM_FLOOR, 0)
        owner = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
        f = _term_features(model.terms, np.concatenate(terms), owner, np.concatenate(times), len(rows))
        # Toxic texts weigh as much as all others together: missing one costs more than losing a clean one.
        even = weight / np.where(toxic, weight[toxic].sum(), weight[~toxic].sum())
        w, b = fit_linear(f, np.where(toxic, 1, -1).astype(np.float32)[:, None], even, steps=800, ridge=1e-5)
        model.toxic[:] = np.append(w[:, 0], b)
    return model


def _evidence(model, names: list[str], n_carry: int):
    def sigmoid(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            buf, offs = flatten(batch.column(0))
            for a, b in pieces(offs):
                part, bounds = buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                bucket, owner, times = _term_buckets(part, bounds)
                junk = np.full(b - a, 0.5)
                if m.style.any():
                    shape = _shape(part, bounds, owner, times)
                    junk = sigmoid(_style(trigram_counts(part, bounds), shape) @ m.style[:-1] + m.style[-1])
                toxic = np.zeros(b - a)
                if m.toxic.any():
                    toxic = sigmoid(_term_features(m.terms, bucket, owner, times, b - a) @ m.toxic[:-1] + m.toxic[-1])
                good = np.where(np.bincount(owner, minlength=b - a) > 0, (1 - junk) * (1 - toxic), 0.0)
                carried = [batch.column(1 + i).slice(a, b - a) for i in range(n_carry)]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(good.astype(np.float64))], names=names)
    return run


def evidence(df: DataFrame, model: Model, host: Column, path: Column, columns: Sequence[str],
             text_col: str = "text") -> DataFrame:
    """``columns`` of ``df`` with ``site_host``, ``site_path`` and ``evidence``: the probability, by the text alone,
    that it is neither junk nor toxic (0 without any word). Null hosts and paths are those of the empty name."""
    spark = prepare(df.sparkSession)
    # Of a class of the standard library: workers need no copy of this package to read it.
    shared = spark.sparkContext.broadcast(SimpleNamespace(**vars(model)))
    columns = [c for c in columns if c not in ("site_host", "site_path", "evidence")]
    empty = F.lit("")
    rows = df.select(F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"carry{i}") for i, c in enumerate(columns)],
                     F.coalesce(host, empty).alias("site_host"), F.coalesce(path, empty).alias("site_path"))
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in columns],
                           T.StructField("site_host", T.StringType()), T.StructField("site_path", T.StringType()),
                           T.StructField("evidence", T.DoubleType())])
    return rows.mapInArrow(_evidence(shared, schema.fieldNames(), len(columns) + 2), schema)


def _strength(between: float, within: float, groups: int, n: float, squares: float) -> float:
    """Documents of prior weight: the variance within groups over that between them, by the method of moments."""
    spare = n - squares / n if n else 0.0
    spread = (between - max(groups - 1, 0) * within) / spare if spare > 0 else 0.0
    return min(MOST_STRENGTH, max(within, _TINY) / spread) if spread > 0 else MOST_STRENGTH


@dataclass(frozen=True)
class Sites:
    table: DataFrame  # site_host, site_path, n_host, s_host, n_path, s_path
    mean: float
    host_strength: float
    path_strength: float


def site_levels(scored: DataFrame) -> Sites:
    """Counts and sums of the evidence of every host and path, and how strongly each level is shrunk."""
    paths = scored.groupBy("site_host", "site_path").agg(
        F.count(F.lit(1)).alias("n_path"), F.sum("evidence").alias("s_path"), F.sum(F.col("evidence") ** 2).alias("q"))
    paths = written(paths, "paths")
    hosts = paths.groupBy("site_host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"),
                                           F.sum("q").alias("q_host"))
    # Written, so that the join with the documents knows its size: it is broadcast if small, and otherwise both
    # sides are dealt out for that join alone, which adaptive execution can split at a hot site.
    table = written(paths.join(hosts, "site_host"), "sites")
    h = hosts.agg(F.count(F.lit(1)), F.sum("n_host"), F.sum("s_host"), F.sum("q_host"),
                  F.sum(F.col("s_host") ** 2 / F.col("n_host")), F.sum(F.col("n_host") ** 2)).first()
    if not h[0]:
        return Sites(table, 0.5, MOST_STRENGTH, MOST_STRENGTH)
    p = table.agg(F.count(F.lit(1)), F.sum(F.col("s_path") ** 2 / F.col("n_path")),
                  F.sum(F.col("n_path") ** 2 / F.col("n_host"))).first()
    n, mean = float(h[1]), h[2] / h[1]
    within_host = max(0.0, h[3] - h[4]) / max(1.0, n - h[0])
    host = _strength(h[4] - h[2] ** 2 / n, within_host, h[0], n, float(h[5]))
    within_path = max(0.0, h[3] - p[1]) / max(1.0, n - p[0])
    spare = n - float(p[2])
    spread = (p[1] - h[4] - (p[0] - h[0]) * within_path) / spare if spare > 0 else 0.0
    path = min(MOST_STRENGTH, max(within_path, _TINY) / spread) if spread > 0 else MOST_STRENGTH
    return Sites(table.drop("q", "q_host"), mean, host, path)


def combine(scored: DataFrame, sites: Sites, keep_from: float = KEEP_FROM) -> DataFrame:
    """``scored`` with ``host_posterior``, ``path_posterior``, ``score`` and ``kept`` (score of at least
    ``keep_from``). The site table has a row per path; Spark broadcasts it if its size allows, else splits the join."""
    def logit(c: Column) -> Column:
        c = F.least(F.greatest(c, F.lit(_TINY)), F.lit(1 - _TINY))
        return F.log(c / (1 - c))

    own, a, b = F.col("evidence"), F.lit(sites.host_strength), F.lit(sites.path_strength)
    host = (a * F.lit(sites.mean) + F.col("s_host") - own) / (a + F.col("n_host") - 1)
    path = (b * F.col("host_posterior") + F.col("s_path") - own) / (b + F.col("n_path") - 1)
    total = logit(own) + logit(F.col("path_posterior")) - logit(F.lit(sites.mean))
    return (scored.join(sites.table, ["site_host", "site_path"], "left")
            .withColumn("host_posterior", F.when(a + F.col("n_host") > 1, host).otherwise(F.lit(sites.mean)))
            .withColumn("path_posterior", F.when(b + F.col("n_path") > 1, path).otherwise(F.col("host_posterior")))
            .withColumn("score", 1 / (1 + F.exp(-total))).withColumn("kept", F.col("score") >= keep_from)
            .drop("n_host", "s_host", "n_path", "s_path"))
