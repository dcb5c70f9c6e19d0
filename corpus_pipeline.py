"""A training corpus from `documents`: quality, lines, near-duplicates, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return
the columns of `documents`. No SQL can express the fitted classifier or the token ids, so ORACLE_SQL is None; the
tests hold every stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import quality
from gridlens.llm.bpe import encode_documents
from gridlens.llm.decontaminate import mark_leaks
from gridlens.llm.line_dedup import dedup_lines
from gridlens.llm.minmax_dedup import near_duplicates
from gridlens.llm.store import written
from gridlens.session import tune

ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose combined score is under a half go: junk, toxic texts, texts without a word.

    The evidence is computed twice, for the sites' posteriors and for the rows kept: texts are not shuffled.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    site = (F.col("source"), F.col("lang"))
    sites = quality.site_levels(written(quality.evidence(docs, model, *site, []), "evidence"))
    return quality.combine(quality.evidence(docs, model, *site, COLUMNS), sites).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds too go; documents of which nothing is left go with them."""
    out = dedup_lines(docs, carry=("lang", "source")).filter("n_dropped = 0 OR trim(text) <> ''")
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return mark_leaks(docs, benchmark, COLUMNS).filter(F.size("leaked_items") == 0).select(*COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with the digest of the text that they decode to."""
    out = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each reads what the one before it has written."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
