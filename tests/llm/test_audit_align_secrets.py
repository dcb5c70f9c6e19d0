"""Filter audit, token alignment and secret scans against plain versions, and their edge cases."""

import itertools
import math
import os
import random
import string
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from gridlens.llm import catalog, filter_audit, secret_scan, token_alignment  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, lang string, secrets string, groups string, mask int, part string, n long"
LABEL = "doc_id long, quality int, toxic int"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, lang, "x", "y", -1, "z", 7) for d, t, lang in rows], DOC)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Hostile texts as the tables that queries read."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = random.Random(4)
    b64 = string.ascii_letters + string.digits + "+/=_-"
    texts = [None, "", 'token="abc"', "TOKEN = abcdef", "api_key==abcdefgh", "ApIkEy: 'q1w2e3r4", "paſſword=abcdefgh",
             "toKen=abcdefgh", "password password=secret=token=abcdef1", "token\n=abcdefg", "é" * 7 + " AKIA" + "A" * 16,
             "AKIAKIA" + "9" * 30, "AKIA AKIAB", "AKIA" + "A" * 15, "0" * 23, "0" * 24, "DEADBEEF0123456789ab" * 2,
             "\U0001f600 0a1b2c3d4e5f6789ABCDEF01", "abcdefghijklmnopqrstuvwxyz0123456789",
             "https://example.org/en/1234/some-long-slug-Title-2024-11-12-x", "550e8400-e29b-41d4-a716-446655440000",
             "a1B2" * 3000, "".join(rng.choice(b64) for _ in range(20000)), "日" * 3000 + " aB3dE5gH7jK9mN1pQ2rS"]
    for _ in range(200):
        letters = rng.choice([b64, b64, string.ascii_lowercase + string.digits, string.hexdigits, string.digits, "ab1"])
        body = "".join(rng.choice(letters) for _ in range(rng.choice([18, 20, 21, 25, 40, 60, 200])))
        texts.append(rng.choice(["", "word ", "ß\t"]) + rng.choice(["", 'token = "', "secret:", "AKIA", "é ", "x\n"]) + body
                     + rng.choice(["", '"', " tail", "-" + "a" * 30, "é"]) + rng.choice(["", " " + body]))
    texts += rng.choices(texts, k=80)
    ids = rng.sample(range(1000), len(texts))
    folder = tmp_path_factory.mktemp("hostile")
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                             "lang": [rng.choice(["en", "fr", None]) for _ in ids]}), folder / "documents.parquet")
    told = [i for i in ids if i % 3] + ids[:5]
    pq.write_table(pa.table({"doc_id": pa.array([*told, None], pa.int64()),
                             "quality": pa.array([*(rng.choice([0, 1, None]) for _ in told), 1], pa.int32()),
                             "toxic": pa.array([*(rng.choice([0, 1, None]) for _ in told), 1], pa.int32())}),
                   folder / "labels.parquet")
    return str(folder)


def as_rows(frame):
    return sorted((tuple(r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_secret_scan"])
def test_hostile_texts_match_reference_sql(spark, tables, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    ours, theirs = catalog.queries()[name](spark, tables).toPandas(), con.execute(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and as_rows(ours) == as_rows(theirs)


# --- filter audit

def test_removal_steps_are_the_min_plus_product():
    orders = list(itertools.permutations(range(4)))
    masks = (np.arange(16)[:, None] >> np.arange(4)) & 1 == 1
    got = filter_audit.removal_steps(masks, filter_audit.position_matrix(orders, 4))
    for m, o in itertools.product(range(16), range(len(orders))):
        failing = [s for s, f in enumerate(orders[o], 1) if masks[m, f]]
        assert got[m, o] == min(failing, default=5)


def test_audit_matches_filters_applied_one_after_another(spark):
    rng = random.Random(2)
    docs = [(rng.choice(["x", "y", None]), *(rng.choice([True, False, False, None]) for _ in range(4))) for _ in range(300)]
    df = spark.createDataFrame(docs, "lang string, b boolean, ab boolean, c boolean, good boolean")
    got = filter_audit.audit_filters(df, ["b", "ab", "c"], F.col("lang"), {"good": F.col("good")}).collect()
    assert len(got) == 3 * 6 * 3
    for r in got:
        part = [d for d in docs if (d[0] or "") == r["part"]]
        order = r["filter_order"].split(",")
        at = {"b": 1, "ab": 2, "c": 3}
        left, gone = part, []
        for f in order[: r["step"]]:
            gone_before, gone = gone, [d for d in left if d[at[f]]]
            left = [d for d in left if not d[at[f]]]
        f = order[r["step"] - 1]
        assert r["filter"] == f and r["kept"] == len(left) and r["removed"] == len(gone)
        assert r["good_lost"] == sum(bool(d[4]) for d in gone)
        assert r["redundant"] == sum(bool(d[at[f]]) for d in part) - len(gone)
        assert r["unique_fails"] == sum(bool(d[at[f]]) and not any(d[at[g]] for g in at if g != f) for d in part)
    for part, f in {(r["part"], r["filter"]) for r in got}:
        mine = [r for r in got if r["part"] == part and r["filter"] == f]
        assert {r["shapley"] for r in mine} == {sum(r["removed"] for r in mine)}


def test_audit_of_given_orders_weights_and_bad_input(spark):
    df = spark.createDataFrame([("p", True, True, 5), ("p", False, True, None), ("p", False, False, 2)],
                               "part string, A boolean, B boolean, n int")
    got = filter_audit.audit_filters(df, "AB", F.col("part"), weight=F.col("n"), orders=["BA"]).collect()
    assert [(r["filter_order"], r["step"], r["kept"], r["removed"], r["redundant"], r["shapley"])
            for r in sorted(got, key=lambda r: r["step"])] == [("BA", 1, 2, 5, 0, 5), ("BA", 2, 2, 0, 5, 0)]
    assert filter_audit.audit_filters(df.limit(0), "AB", F.col("part")).count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit_filters(df, "AB", F.col("part"), orders=["BB"])
    with pytest.raises(ValueError):
        filter_audit.audit_filters(df, "ABCDEFGH", F.col("part"))


def test_copies_across_parts_ids_and_nulls(spark):
    rows = [(5, "same", "en"), (3, "same", "fr"), (3, "same", "en"), (9, "same", None), (None, "same", "en"),
            (1, None, "en"), (2, "", "en"), (2, "", "en"), (None, "only", "en")]
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 1), (9, 0, None), (None, 1, 1)], LABEL)
    got = filter_audit.document_failures(docs_of(spark, rows), labels).collect()
    count = Counter()
    for r in got:
        assert r["A"] and not (r["B"] or r["C"] or r["D"])
        count[r["part"], r["E"], r["good"], r["toxic"]] += r["n"]
    assert count == {("en", True, False, False): 1 + 2, ("fr", False, True, True): 1, ("en", False, True, True): 1,
                     ("", True, False, False): 1, ("en", False, False, False): 1 + 1 + 1}
    none = docs_of(spark, rows).limit(0)
    assert filter_audit.document_failures(none, labels).count() == 0
    assert filter_audit.document_failures(docs_of(spark, rows), labels.limit(0)).agg(F.sum("n")).first()[0] == len(rows)


def test_a_group_of_copies_does_not_travel_row_by_row(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "copied words").otherwise(
        F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([], LABEL)
    got = filter_audit.document_failures(docs, labels)
    assert got.filter("E").agg(F.sum("n")).first()[0] == 20000 - 6666 - 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "text" not in [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]


# --- token alignment

def plain_alignment(docs):
    """doc -> row of the query, by byte sets and pairs of overlapping ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    decoder = {}
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    decoder.update({chr(b): b for b in plain})
    decoder.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    links, out = {}, {}
    for d, text in docs:
        links[d], out[d] = [], (0, 0, 0, 0, "")
        if not text:
            continue
        whole = (" " + text).encode()
        a = [(i, bytes(decoder[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            continue
        spans = []
        for tokens in (a, b):
            at, mine = 0, []
            for i, raw in tokens:
                mine.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(mine)
        x, y = spans
        cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups, since = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in tokens if since < e <= cut) for tokens in spans))
            since = cut
        links[d] = [(i, j) for s, e, i in x for t, f, j in y if s < f and t < e]
        out[d] = (len(x), len(y), len(groups), len(links[d]), ";".join(groups))
    counts = Counter(p for pairs in links.values() for p in pairs)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return {d: (*out[d], sum(counts[p] == best[p[1]] for p in links[d]), sum(counts[p] for p in links[d])) for d in out}


def aligned(frame):
    return {r["doc_id"]: tuple(r)[1:] for r in frame.collect()}


def test_alignment_matches_overlapping_ranges(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 3000").select("doc_id", "text", "lang").collect()
    given = [(r[0], r[1], r[2]) for r in rows][:80]
    more = ["<|endoftext|> and </s> <s>", "  two  spaces ", "\t\n x\r\n", "日本語のテキスト", "é́ﬁ①", "\U0001f600\U0001f9d1‍\U0001f4bb",
            "▁x ▁▁", "<0x41> <0xE9>", "a" * 500, " ", "don't we'll", "x y", None, "", "same text", "same text", "12345 678", "\x00 \x01"]
    given += [(10_000 + i, t, None) for i, t in enumerate(more)]
    want = plain_alignment([(d, t) for d, t, _ in given])
    docs = docs_of(spark, given).repartition(3)
    assert aligned(token_alignment.align_documents(docs, A, B)) == want
    for common in (0, 7):  # how many counts a task holds changes no result
        assert aligned(token_alignment.align_documents(docs, A, B, common=common)) == want
    digest = token_alignment.align_documents(docs, A, B, groups_as="sha256")
    assert {r["doc_id"]: r["groups"] for r in digest.collect()} == {d: brute.sha(w[4]) if w[4] else "" for d, w in want.items()}


def test_alignment_of_repeated_and_missing_ids_and_of_no_rows(spark):
    docs = docs_of(spark, [(1, "one two", "x"), (1, "one two", "x"), (None, "one two", None), (2, None, None)])
    got = [tuple(r) for r in token_alignment.align_documents(docs, A, B).collect()]
    one = [r for r in got if r[1]]
    assert len(got) == 4 and len(one) == 3 and {r[1:] for r in one} == {one[0][1:]}
    assert one[0][4] == one[0][6] and one[0][7] == 3 * one[0][4]
    assert token_alignment.align_documents(docs.limit(0), A, B).count() == 0
    assert all(r[1:5] == (0, 0, 0, 0) for r in token_alignment.align_documents(docs.filter("doc_id = 2"), A, B).collect())


def test_counts_that_outgrow_a_task_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 5)
    monkeypatch.setattr(token_alignment, "AT_ONCE", 10)
    given = [(i, f"word {i} and {i % 7} more", "x") for i in range(60)]
    want = plain_alignment([(d, t) for d, t, _ in given])
    assert aligned(token_alignment.align_documents(docs_of(spark, given).coalesce(1), A, B)) == want


def test_links_inside_a_slice():
    a_upto, b_upto, left, right = token_alignment.align(np.array([3, 3, 2]), np.array([2, 4, 1, 1]))
    assert a_upto.tolist() == [2, 3] and b_upto.tolist() == [2, 4]
    assert list(zip(left, right)) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3)]


# --- secrets

def test_window_sums_equal_counts_of_each_window():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 5, 200)
    run = np.repeat([0, 1, 4], [90, 30, 80])
    got = secret_scan.window_sums(codes, run, 20)
    for j in range(200):
        window = [c for c, r in zip(codes[max(0, j - 19) : j + 1], run[max(0, j - 19) : j + 1]) if r == run[j]]
        want = sum(n * math.log2(n) for n in Counter(window).values())
        assert abs(got[j] / (1 << 32) - want) < 1e-7


def spans(spark, *texts, **params):
    df = docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secrets"]]
            for r in secret_scan.scan_secrets(df, ["doc_id", "secrets"], **params).collect()}


def test_entropy_finds_what_rules_do_not(spark):
    key = "aB3dE5gH7jK9mN1pQ2rS"
    got = spans(spark, f"é {key}.", f"token={key}", "the quick brown fox jumps over " * 40, "DE4DBE3F0123456789AC" * 2,
                "wordwordwordwordwordwordword", "https://example.org/en/1234/some-long-slug-Title-2024-11-12-x",
                "550e8400-e29b-41d4-a716-446655440000", "abcdefghijklmnopqrstuvwxyz0123456789", "9f8a7b6c5d4e3f2a1b0c" + "zyxw9vu8ts7rq6po5nm4")
    assert got[0] == [("entropy_base64", 2, 22)]
    assert got[1] == [("assign", 0, 26)]
    assert got[3] and {k for k, _, _ in got[3]} == {"entropy_hex"}
    assert got[8] and all(k.startswith("entropy") for k, _, _ in got[8])
    assert not any(got[i] for i in (2, 4, 5, 6, 7))
    loud = spans(spark, f"é {key}.", allowed_texts=[f"-{key}-"])
    assert loud[0] == []
    assert spans(spark, "abcdefghijklmnopqrstuvwxyz0123456789", allowed_texts=[], allowed_patterns=[])[0]


def test_redaction_joins_overlapping_spans(spark):
    df = docs_of(spark, [(1, 'é token = "40d78a45c418324758e099eb" end', None), (2, None, None), (3, "AKIA" + "A" * 16, None),
                         (4, "plain", None), (5, "secret=abcdefg AKIA" + "B" * 16 + "!", None)])
    out = {r["doc_id"]: r["text"] for r in secret_scan.redact(secret_scan.scan_secrets(df, ["doc_id", "text"])).collect()}
    assert out == {1: 'é [SECRET]" end', 2: None, 3: "[SECRET]", 4: "plain", 5: "[SECRET] [SECRET]!"}
    assert secret_scan.redact(secret_scan.scan_secrets(df.limit(0), ["doc_id", "text"])).count() == 0
