"""Filter interaction audit: which filter removes a document under every order of the filters.

A document's failures are a row of a mask matrix: 0 where it fails a filter, out of reach where it passes. An order
is a row of a position matrix: the step at which each filter comes, the inverse of its permutation. Their min-plus
product holds the step that removes the document under the order. Documents matter only as counts of each mask, so
Spark counts masks by part, and the rest is scatter counts of 2**k weights a part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Filters of an audit over all orders at most; a part has ``k * k!`` rows. More need orders of their own.
MOST_FILTERS = 7


def position_matrix(orders: Sequence[Sequence[int]], k: int) -> np.ndarray:
    """Step (from 1) of each filter in each order."""
    at = np.zeros((len(orders), k), np.int64)
    np.put_along_axis(at, np.array(orders, np.int64).reshape(-1, k), np.arange(1, k + 1), 1)
    return at


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product of failure masks (rows of flags) and positions: the step that removes each mask under each
    order, one more than the number of filters if none does."""
    k = positions.shape[1]
    cost = np.where(masks, 0, k + 1)
    steps = np.full((len(masks), len(positions)), k + 1, np.int64)
    for f in range(k):  # one filter at a time: no array of masks x orders x filters
        np.minimum(steps, cost[:, f, None] + positions[None, :, f], out=steps)
    return steps


def interactions(weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by (order, step) from the ``weights`` (tally, mask) of one part; the first tally counts documents.

    ``removed`` has an entry for each tally. ``shapley`` sums a filter's removals over all orders.
    """
    tallies, n_masks = weights.shape
    n_orders, k = orders.shape
    masks = (np.arange(n_masks)[:, None] >> np.arange(k)) & 1 == 1
    steps = removal_steps(masks, position_matrix(orders, k))
    cell = np.arange(n_orders) * (k + 2) + steps  # (mask, order)
    removed = np.zeros((tallies, n_orders * (k + 2)), np.int64)
    for t in range(tallies):  # whole numbers, so that large counts stay exact
        np.add.at(removed[t], cell, weights[t][:, None])
    removed = removed.reshape(tallies, n_orders, k + 2)[:, :, 1 : k + 1]
    docs = removed[0]
    failing = (weights[0][:, None] * masks).sum(0)[orders]  # all that fail the filter of the step
    alone = weights[0][1 << np.arange(k)][orders]
    shapley = np.zeros(k, np.int64)
    np.add.at(shapley, orders, docs)
    return {"kept": weights[0].sum() - np.cumsum(docs, 1), "removed": removed, "redundant": failing - docs,
            "unique_fails": alone, "shapley": shapley[orders]}


def _audit(names: Sequence[str], tallies: Sequence[str], orders: np.ndarray, fields: Sequence[str]):
    labels = ["".join(names[f] for f in o) if all(len(n) == 1 for n in names) else ",".join(names[f] for f in o)
              for o in orders]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_orders, k = orders.shape
        order = pa.array(np.repeat(labels, k).tolist(), pa.string())
        step = pa.array(np.tile(np.arange(1, k + 1), n_orders), pa.int32())
        name = pa.array([names[f] for f in orders.ravel()], pa.string())
        for batch in batches:
            for i in range(batch.num_rows):  # rows are parts
                weights = np.array([batch.column(1 + t)[i].as_py() for t in range(1 + len(tallies))], np.int64)
                got = interactions(weights, orders)
                lost = [got["removed"][t].ravel() for t in range(1 + len(tallies))]
                columns = [got["kept"].ravel(), lost[0], got["redundant"].ravel(), got["unique_fails"].ravel(),
                           *lost[1:], got["shapley"].ravel()]
                part = pa.array([batch.column(0)[i].as_py()] * len(order), pa.string())
                yield pa.RecordBatch.from_arrays([part, order, step, name, *[pa.array(c, pa.int64()) for c in columns]],
                                                 names=list(fields))
    return task


def audit_filters(failures: DataFrame, filters: Sequence[str], part: Column, tallies: dict[str, Column] | None = None,
                  weight: Column | None = None, orders: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """One row per part, order of ``filters`` and step, zeros included: ``part``, ``filter_order`` (the names one after
    another, with commas if any is longer than a letter), ``step``, ``filter``, ``kept``, ``removed``, ``redundant``
    (fail the filter, removed earlier), ``unique_fails`` (fail no other), ``<tally>_lost`` and ``shapley`` (the filter's
    removals over all given orders).

    ``failures`` has a boolean column per filter, null counts as passing. ``weight`` is how many documents a row stands
    for (null: none), 1 by default; ``tallies`` are conditions whose documents are counted apart. A null part is that
    of the empty name. ``orders`` are all permutations unless given. A table without rows has no parts.
    """
    k, tallies = len(filters), tallies or {}
    if orders is None and k > MOST_FILTERS:
        raise ValueError(f"{k} filters have too many orders; give the orders to audit")
    at = {f: i for i, f in enumerate(filters)}
    rows = np.array(list(permutations(range(k))) if orders is None else [[at[f] for f in o] for o in orders], np.int64)
    if sorted(rows[0].tolist()) != list(range(k)) or (np.sort(rows, 1) != np.arange(k)).any():
        raise ValueError("every order must hold each filter once")
    mask = sum((F.coalesce(F.col(f"`{f}`"), F.lit(False)).cast("int") * (1 << i) for i, f in enumerate(filters)), F.lit(0))
    n = F.lit(1) if weight is None else weight
    masks = failures.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                            n.cast("long").alias("n"),
                            *[F.coalesce(c, F.lit(False)).alias(f"tally{i}") for i, c in enumerate(tallies.values())])
    masks = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(f"tally{i}"), F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(tallies))])
    # At most 2**k rows a part: their weights by mask, in arrays.
    counts = ["n", *[f"n{i}" for i in range(len(tallies))]]
    places = F.sequence(F.lit(0), F.lit((1 << k) - 1))

    def vector(count: str) -> Column:
        return F.transform(places, lambda m: F.coalesce(F.element_at(count, m), F.lit(0))).alias(count)

    by_part = masks.groupBy("part").agg(*[
        F.map_from_entries(F.collect_list(F.struct("mask", F.coalesce(c, F.lit(0)).alias("c")))).alias(c) for c in counts])
    vectors = by_part.select("part", *[vector(c) for c in counts])
    fields = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
              *[f"{t}_lost" for t in tallies], "shapley"]
    schema = ", ".join(f"`{f}` {'string' if i in (0, 1, 3) else 'int' if i == 2 else 'long'}" for i, f in enumerate(fields))
    return vectors.mapInArrow(_audit(list(filters), list(tallies), rows, fields), schema)


def document_failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "lang") -> DataFrame:
    """Counts ``n`` of documents by ``part``, flags ``A`` to ``E`` of failing, and flags ``good`` and ``toxic``.

    A: under 100 words; B: under 80 distinct words of 100; C: more than 10 capitals of 100 code points; D: holds one of
    ``#$%&*|``; E: a row with a smaller id has the same text. Words are parted by ``[\\x20\\x09-\\x0D]``, case counts. A
    null text is empty, a null part the empty name. A row without an id has no smaller one and is none; rows of one id
    are not smaller than each other, each counts. ``labels`` has ``doc_id``, ``quality``, ``toxic``: a document is
    good or toxic if any of its labels says so, neither without one.

    Texts leave their task as a digest and four flags. Copies are not sent to one place: their ids are counted first,
    then the least is found per digest, part and label, and only those few rows meet at the digest.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
                        .alias("part"), text.alias("text"), words.alias("words"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    flags = given.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                         (F.size("words") < 100).alias("A"),
                         (100 * F.size(F.array_distinct("words")) < 80 * F.size("words")).alias("B"),
                         (100 * capitals > 10 * F.length("text")).alias("C"),
                         F.col("text").rlike(r"[#$%&*|]").alias("D"))
    told = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = flags.join(told, "id", "left").fillna(False, ["good", "toxic"])
    kind = ["digest", "part", "A", "B", "C", "D", "good", "toxic"]
    # How many rows have each id, which is one unless ids repeat; then the least id of each kind and its rows.
    ids = known.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    least = ids.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("id").alias("id"), F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("at_id"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"))
    first = least.groupBy("digest").agg(F.min("id").alias("first"))
    both = least.join(first, "digest").withColumn(
        "original", F.col("no_id") + F.when(F.col("id") == F.col("first"), F.col("at_id")).otherwise(0))
    split = both.select(*kind[1:], F.explode(F.array(
        F.struct(F.lit(False).alias("E"), F.col("original").alias("n")),
        F.struct(F.lit(True).alias("E"), (F.col("n") - F.col("original")).alias("n")))).alias("x"))
    return split.select("part", "A", "B", "C", "D", "x.E", "good", "toxic", "x.n").filter("n > 0")
