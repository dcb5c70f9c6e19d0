"""Registered queries against their reference SQL, or against brute force where SQL is none."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from gridlens.llm import catalog  # noqa: E402

duckdb = pytest.importorskip("duckdb")
TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    return sorted((tuple(None if x is None or x != x else x for x in r)
                   for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_reference_sql(spark, sf_dir, duck, name):
    ours = catalog.queries()[name](spark, sf_dir).toPandas()
    theirs = duck.execute(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_near_duplicates_match_all_pairs(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in catalog.queries()["op4_minmax_dedup"](spark, sf_dir).collect()}
    want = brute.near_groups(documents)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == d) for d, r in got.items())


def test_repeats_match_brute_force(spark, sf_dir, documents):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in catalog.queries()["op9_suffix_dedup"](spark, sf_dir).collect()}
    want = {d: (*w[:3], brute.sha(w[3])) for d, w in brute.without_repeats(documents).items()}
    assert got == want


def test_ids_match_the_tokenizers_library(spark, sf_dir, documents):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in catalog.queries()["op5_bpe"](spark, sf_dir).collect()}
    want = {}
    for d, text in documents.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want[d] = (len(ids), brute.sha(packed), brute.sha(library.decode(ids, skip_special_tokens=False)))
    assert got == want


def test_vectors_match_all_pairs(spark, sf_dir):
    import numpy as np
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in given]
    unit = np.array([r["embedding"] for r in given], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    groups = brute.Groups(ids)
    for i, j in zip(*np.nonzero(near)):
        groups.link(ids[i], ids[j])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in catalog.queries()["op2_embedding_links"](spark, sf_dir).collect()}
    assert got == {v: (int(near[i].sum()) - 1, groups.root(v), groups.root(v) == v) for i, v in enumerate(ids)}


def test_languages_of_held_out_documents(spark, sf_dir):
    told = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = catalog.queries()["op7_language"](spark, sf_dir).collect()
    assert len(got) == len(told) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and told[r["doc_id"]]]
    assert held and sum(r["lang_pred"] == told[r["doc_id"]] for r in held) >= 0.95 * len(held)


def shares_kept(kept, labels):
    """Shares kept of clean, junk and toxic documents (toxic ones of good quality)."""
    out = []
    for kind in ((1, 0), (0, None), (1, 1)):
        some = [kept[d] for d, (q, t) in labels.items() if d in kept and q == kind[0] and kind[1] in (None, t)]
        out.append(sum(some) / max(len(some), 1))
    return out


@pytest.mark.parametrize("fold", [0, 1, 2])
def test_quality_of_documents_whose_labels_were_not_seen(spark, fold):
    """Fitted on the labels of two thirds of the ids by hash, held against the labels of the last third."""
    import zlib
    from gridlens.llm import quality
    from gridlens.llm.store import written
    from pyspark.sql import functions as F
    big = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = quality.fit(docs, labels.where(third != fold))
    scored = written(quality.evidence(docs, model, F.col("source"), F.col("lang"), ["doc_id"]), "evidence")
    kept = {r["doc_id"]: r["kept"] for r in quality.combine(scored, quality.site_levels(scored)).collect()}
    told = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.collect()}
    held = {d: v for d, v in told.items() if zlib.crc32(str(d).encode()) % 3 == fold}
    clean, junk, toxic = shares_kept(kept, held)
    assert clean >= 0.98 and junk <= 0.05 and toxic <= 0.06


def test_quality_keeps_clean_documents_and_rejects_others(spark, sf_dir):
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["kept"] for r in catalog.queries()["op3_quality"](spark, sf_dir).collect()}
    clean, junk, toxic = shares_kept(kept, labels)
    assert clean >= 0.95 and junk <= 0.1 and toxic <= 0.25


def test_short_items_are_found_by_the_reference_sql_too(spark, tmp_path):
    """Items of one to nine words, whose halves are shorter than a shingle."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    items = ["alpha beta gamma delta epsilon zeta", "solo", "two words", "one two three four five six seven eight nine", " "]
    filler = " ".join(f"w{i}" for i in range(40))
    texts = [f"{filler} {items[0].upper()} {filler}", "solo", "nothing here", f"{filler} two {filler} words", "a two words b",
             f"{filler}\n{items[3]}", "alpha beta gamma", None, "", "delta epsilon zeta alpha beta gamma"]
    pq.write_table(pa.table({"item_id": pa.array(range(len(items)), pa.int64()), "text": items}), tmp_path / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    ours = catalog.queries()["op6_decontaminate"](spark, str(tmp_path)).toPandas()
    assert rows(ours) == rows(con.execute(catalog.SQL["op6_decontaminate"]).df())
    found = dict(zip(ours["doc_id"], ours["items"]))
    longest = 2 * max(len(t.split()) for t in items)
    for d, text in enumerate(texts):
        assert found[d] == ",".join(map(str, brute.leaks(text, dict(enumerate(items)), longest)))
    assert found[0] == "0" and found[1] == "1" and found[5] == "3"


def test_pipeline_stages_match_brute_force(spark, sf_dir):
    import corpus_pipeline as pipeline
    import public_tokenizers
    from tokenizers import Tokenizer
    assert [f.__name__ for _, f in pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in catalog.queries()["op3_quality"](spark, sf_dir).collect() if r["kept"]}
    stage = dict(pipeline.STAGES)
    first = stage["quality_classifier"](spark, docs, sf_dir).cache()
    assert {r["doc_id"] for r in first.collect()} == kept
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean, junk, toxic = shares_kept({r["doc_id"]: r["doc_id"] in kept for r in docs.select("doc_id").collect()}, labels)
    assert clean >= 0.95 and junk <= 0.1 and toxic <= 0.25
    texts = {r["doc_id"]: r["text"] for r in first.collect()}
    second = stage["line_dedup"](spark, first, sf_dir).cache()
    lines = {d: t for d, (_, n, t) in brute.deduped_lines(texts).items() if not n or t.strip(" ")}
    assert {r["doc_id"]: r["text"] for r in second.collect()} == lines
    third = stage["minhash_near_dedup"](spark, second, sf_dir).cache()
    groups = brute.near_groups(lines)
    assert {r["doc_id"] for r in third.collect()} == {d for d, (_, root) in groups.items() if d == root}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    longest = max(len(t.split()) for t in items.values())
    fourth = stage["benchmark_decontamination"](spark, third, sf_dir).cache()
    assert all(f.columns == docs.columns for f in (first, second, third, fourth))
    left = {r["doc_id"]: r["text"] for r in fourth.collect()}
    assert left == {r["doc_id"]: r["text"] for r in third.collect() if not brute.leaks(r["text"], items, 2 * longest)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in stage["bpe_encoding"](spark, fourth, sf_dir).collect():
        assert r["ids"] == library.encode(left[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"]) and r["decoded_sha256"] == brute.sha(left[r["doc_id"]] or "")
