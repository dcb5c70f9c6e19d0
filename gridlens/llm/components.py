"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.store import remove, written


def _print(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.bit_xor(F.xxhash64(mark))).first())


def connected(links: DataFrame, made: list[str]) -> DataFrame:
    """(node, root) of every node of the links (a, b), which are read from a written table: root is the smallest node
    it reaches.

    Alternating stars: each node hangs its larger neighbours, then its smaller ones, on the smallest it knows,
    until nothing changes. Edges never outnumber the links; a round is grouped minima and joins on them, whose
    hot nodes adaptive execution can split. Each round is a written table, so lineage stays short and a lost
    executor costs one round's share.
    """
    spark = links.sparkSession
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path: list[str] = []
    before, passing = _print(edges), []
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Written, so that the join deals out both sides anew and a node with many neighbours can be split.
        least = written(least, "least", passing)
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        new_path: list[str] = []
        edges = written(small, "edges", new_path)
        remove(spark, path)
        remove(spark, passing)
        path = new_path
        after = _print(edges)
        if after == before:
            break
        before = after
    made += path
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
