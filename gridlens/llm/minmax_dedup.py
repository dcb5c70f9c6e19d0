"""MinHash near-dedup with min-max hashing.

Each permutation is evaluated once per shingle and gives two signature values, the least and the greatest hash.
Bands of such values bring candidates together; each candidate pair is confirmed on the full shingle sets.

Documents with equal sets form a class, and one class member stands for all. Within a band group no pairs are
laid out at first: every member is compared with the group's centre, the member whose other groups are largest
(the text that most others resemble). Only members that end up in different components are compared with each
other after that, so every candidate pair is either confirmed, refuted or already connected.

A pair is refuted without its texts when the sizes of its sets or their parity bits rule the similarity out: the
bits in which two parities differ are a lower bound of the shingles in which the sets differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.components import connected
from gridlens.llm.store import written
from gridlens.llm.textops import U64, flatten, mix, pieces, prepare, shingles, words

SHINGLE = 5
#: Similarity bound as a ratio of whole numbers.
NUMERATOR, DENOMINATOR = 75, 100
#: 50 permutations give 100 values; 25 bands of 4 miss a pair of similarity 0.75 about once in 13,000, of 0.8 once
#: in 500,000.
PERMUTATIONS, ROWS = 50, 4
BANDS = 2 * PERMUTATIONS // ROWS
#: 64-bit words of parity that a set carries.
PARITY = 16
_RNG = np.random.default_rng(0xD0C5)
_MUL = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * U64(2) + U64(1)
_XOR = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
#: Each band mixes values of different permutations, least and greatest alike.
_ORDER = _RNG.permutation(2 * PERMUTATIONS).reshape(BANDS, ROWS)
_ODD = _RNG.integers(1, 2**63, ROWS, dtype=np.uint64) * U64(2) + U64(1)


def distinct_shingles(buf: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, and the text of each."""
    hashes, _, owner = words(buf, offs)
    sh, owner = shingles(hashes, owner, len(offs) - 1, size)
    order = np.lexsort((sh, owner))
    sh, owner = sh[order], owner[order]
    first = np.ones(len(sh), bool)
    first[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    return sh[first], owner[first]


def signatures(sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least and greatest hash of each set under every permutation: sets x (2 * PERMUTATIONS)."""
    out = np.empty((len(starts), 2 * PERMUTATIONS), np.uint64)
    for j in range(PERMUTATIONS):
        h = (sh ^ _XOR[j]) * _MUL[j]
        h ^= h >> U64(32)
        out[:, j] = np.minimum.reduceat(h, starts)
        out[:, PERMUTATIONS + j] = np.maximum.reduceat(h, starts)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: set size, fingerprint of the set, parity bits, band hashes (none for an empty set)."""
    for batch in batches:
        buf, offs = flatten(batch.column(1))
        for a, b in pieces(offs):
            sh, owner = distinct_shingles(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            size = np.bincount(owner, minlength=b - a)
            has = np.flatnonzero(size)
            f1, f2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
            bands = np.zeros((0, BANDS), np.uint64)
            if len(has):
                starts = np.concatenate([[0], np.cumsum(size[has])[:-1]])
                f1[has] = np.add.reduceat(mix(sh), starts)
                f2[has] = np.add.reduceat(mix(sh ^ U64(0xA5A5A5A55A5A5A5A)), starts)
                values = signatures(sh, starts)
                bands = mix((values[:, _ORDER] * _ODD).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
            at = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
            place = owner * (64 * PARITY) + (sh % U64(64 * PARITY)).astype(np.int64)
            odd = np.bincount(place, minlength=(b - a) * 64 * PARITY).astype(np.uint8) & 1
            parity = pa.array(np.packbits(odd, bitorder="little").view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(size.astype(np.int64)), pa.array(f1.view(np.int64)),
                 pa.array(f2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * PARITY, PARITY, np.int32)), parity),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(bands.ravel().view(np.int64)))],
                names=["doc", "n", "f1", "f2", "odd", "bands"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose full shingle sets are similar enough."""
    for batch in batches:
        left, right = flatten(batch.column(2)), flatten(batch.column(3))
        both = np.diff(left[1]) + np.diff(right[1])
        keep = np.zeros(batch.num_rows, bool)
        for a, b in pieces(np.concatenate([[0], np.cumsum(both)])):
            sets = []
            for buf, offs in (left, right):
                sh, owner = distinct_shingles(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                sets.append((sh, owner, np.bincount(owner, minlength=b - a)))
            sh = np.concatenate([sets[0][0], sets[1][0]])
            owner = np.concatenate([sets[0][1], sets[1][1]])
            order = np.lexsort((sh, owner))
            sh, owner = sh[order], owner[order]
            common = np.bincount(owner[1:][(sh[1:] == sh[:-1]) & (owner[1:] == owner[:-1])], minlength=b - a)
            union = sets[0][2] + sets[1][2] - common
            keep[a:b] = (union > 0) & (DENOMINATOR * common >= NUMERATOR * union)
        where = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where)], names=["a", "b"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links. A hot document is on side ``a``, whose join adaptive execution can split."""
    first = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("left")), "a")
    second = first.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("right")), "b")
    return second.select("a", "b", "left", "right").mapInArrow(_shared, "a long, b long")


def _possible() -> str:
    """SQL over sizes n, m and parities odd, other: false only where the similarity is under the bound."""
    differ = " + ".join(f"bit_count(odd[{i}] ^ other[{i}])" for i in range(PARITY))
    most = f"({DENOMINATOR - NUMERATOR} * (n + m))"
    return (f"{DENOMINATOR} * least(n, m) >= {NUMERATOR} * greatest(n, m)"
            f" AND {DENOMINATOR + NUMERATOR} * ({differ}) <= {most}")


def link_components(docs: DataFrame, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc, text) the signed rows (doc, n, f1, f2), and the component of each class (n, f1, f2)."""
    signed = written(docs.mapInArrow(_sign, "doc long, n long, f1 long, f2 long, odd array<long>, bands array<long>"), "signed", made)
    sets = ["n", "f1", "f2"]
    classes = (signed.filter("n > 0 AND doc IS NOT NULL").groupBy(*sets)
               .agg(F.min("doc").alias("rep"), F.first("odd").alias("odd"), F.first("bands").alias("bands")))
    classes = written(classes, "classes", made)
    banded = classes.select("rep", F.explode("bands").alias("h"))
    several = banded.groupBy("h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    live = written(banded.join(several, "h"), "live", made)
    weight = live.groupBy("rep").agg(F.sum("size").alias("weight"))
    centre = (live.join(weight, "rep").groupBy("h")
              .agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("best"))
              .select("h", (-F.col("best.rep")).alias("a")))
    first = classes.select(F.col("rep").alias("a"), F.col("n").alias("m"), F.col("odd").alias("other"))
    stars = (live.join(centre, "h").filter("rep <> a").select("a", "rep").distinct().join(first, "a")
             .join(classes.select("rep", "n", "odd"), "rep").filter(_possible()).select("a", F.col("rep").alias("b")))
    stars = written(stars, "stars", made)
    wanted = live.select(F.col("rep").alias("doc")).distinct()
    texts = written(docs.join(wanted, "doc"), "texts", made)
    links = written(confirm(stars, texts), "links", made)
    found = connected(links, made)
    placed = (live.join(found.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("root", F.coalesce("root", "rep")))
    split = placed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = (placed.join(split.select("h"), "h").select("h", "rep", "root")
             .join(classes.select("rep", "n", "odd"), "rep"))
    open_ = written(open_, "open", made)
    others = open_.select("h", F.col("rep").alias("b"), F.col("n").alias("m"), F.col("root").alias("s"),
                          F.col("odd").alias("other"))
    crossing = (open_.withColumnRenamed("rep", "a").join(others, "h").filter(f"root < s AND {_possible()}")
                .select("a", "b").distinct())
    tested = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    crossing = written(crossing.join(tested, ["a", "b"], "left_anti"), "crossing", made)
    more = written(confirm(crossing, texts), "more", made)
    # The stars found stand for the links that made them.
    stars_so_far = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = connected(stars_so_far.unionByName(more), made)
    of_class = (classes.select(*sets, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                .select(*sets, F.coalesce("root", "rep").alias("root")))
    return signed.drop("bands", "odd"), of_class


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles`` (size of its set), ``component_id``, ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a set holds the distinct runs of five, or all
    words as one if there are fewer. Texts that are null or without words have an empty set and link with nothing.
    ``component_id`` is the smallest id reachable by links of similarity 0.75 or more, the document itself included;
    ``kept`` marks that document. Rows with a null id link with nothing, have a null component and are kept. Rows
    that share an id are one node, linked with all that any of them links with. Other columns are not carried.
    An empty table gives an empty table.
    """
    prepare(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    made: list[str] = []
    signed, of_class = link_components(docs, made)
    out = signed.join(of_class, ["n", "f1", "f2"], "left")
    root = F.when(F.col("doc").isNotNull(), F.coalesce("root", "doc"))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), root.alias("component_id"),
                      F.coalesce(root == F.col("doc"), F.lit(True)).alias("kept"))
