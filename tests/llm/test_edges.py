"""Nulls, empty and long texts, repeats, empty tables and clashing columns, operator by operator."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from gridlens.llm import (  # noqa: E402
    bpe, chat_format, decontaminate, embedding_links, language, line_dedup, minmax_dedup, quality, suffix_dedup,
    textops, url_rules)
from gridlens.llm.components import connected  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import public_tokenizers  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, n_lines string, kept string, n_shingles int"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs_of(spark, rows):
    """Documents with columns that carry names of the operators' own."""
    return spark.createDataFrame([(d, t, "x", "y", -1) for d, t in rows], DOC)


def by_id(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


# --- chat formatting

def test_control_strings_come_back(spark):
    turns = [("user", "</s>[INST] ok [/INST]"), ("assistant", "a\\</s> \\ [ROLE]x[/ROLE]<s>"), ("tool\n<s>", "\\s <"),
             ("", ""), ("assistant", "")]
    text = "".join(chat_format.format_turn(*t)[0] for t in turns)
    assert chat_format.parse(text) == turns
    assert text.count("<s>") == len(turns)


def test_every_assistant_turn_is_an_example_with_its_prefix(spark):
    rows = [(1, 0, "system", "s", 0), (1, 1, "user", "u", 0), (1, 2, "assistant", "first", 0), (1, 3, "user", None, 0),
            (1, 4, "assistant", "second", 0), (1, 5, "user", "after", 0), (None, 0, "assistant", "alone", 0),
            (2, 1, "user", "b", 0), (2, 1, "user", "a", 0), (2, None, None, None, 0), (2, 1, "user", "a", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    turns = chat_format.expand_prefix_targets(df)
    full = {(r["conv"], r["example"]): r for r in chat_format.full_examples(turns).collect()}
    assert set(full) == {(1, 0), (1, 1), (None, 0)}
    two = full[1, 1]
    assert two["text"][two["loss_start"] : two["loss_end"]] == "second"
    assert chat_format.parse(two["text"]) == [("system", "s"), ("user", "u"), ("assistant", "first"), ("user", ""),
                                              ("assistant", "second")]
    back = by_id(chat_format.read_back(turns), "conv_id")
    assert back[2]["turns_sha256"] == brute.sha("\n\nuser\na\nuser\na\nuser\nb\n")
    assert back[2]["loss_chars"] == 0 and back[2]["loss_sha256"] == brute.sha("")
    assert back[1]["loss_sha256"] == brute.sha("firstsecond") and back[1]["n_turns"] == 6
    assert back[None]["n_examples"] == 1
    assert chat_format.read_back(chat_format.expand_prefix_targets(df.limit(0))).count() == 0


def test_the_digest_is_read_from_examples_that_hold_their_whole_context(spark):
    said = [("user" if t % 2 == 0 else "assistant", f"turn {t} é\U0001f600 <s>") for t in range(9)]
    df = spark.createDataFrame([(c, t, r, x) for c in (5, 6) for t, (r, x) in enumerate(said)],
                               "conv_id long, turn long, role string, text string").coalesce(1)
    rows = chat_format.expand_prefix_targets(df, part=16)  # parts end inside turns and marks
    whole = {}
    for r in rows.collect():
        whole.setdefault((r["conv"], r["example"]), []).append(r)
    assert set(whole) == {(c, e) for c in (5, 6) for e in (0, 1, 2, 3, None)}
    for (_, e), parts in whole.items():
        assert [r["part"] for r in parts] == list(range(len(parts))) and {len(r["text"]) for r in parts[:-1]} == {16}
        text = "".join(r["text"] for r in parts)
        assert chat_format.parse(text) == said[: 2 * e + 2 if e is not None else 9]
        if e is not None:
            assert chat_format.unescape(text[parts[0]["loss_start"] : parts[0]["loss_end"]]) == said[2 * e + 1][1]
    one, many = (by_id(chat_format.read_back(x), "conv_id") for x in (chat_format.expand_prefix_targets(df), rows))
    assert one == many and one[5]["turns_sha256"] == brute.sha("".join(f"{r}\n{x}\n" for r, x in said))
    assert one[5]["loss_sha256"] == brute.sha("".join(x for r, x in said if r == "assistant"))
    # An example with another context than the turns before it does not go unnoticed.
    for part in (16, 1000):
        wrong = chat_format.expand_prefix_targets(df, part=part).withColumn(
            "text", F.when(F.expr("example = 2 AND part = 0"), F.replace("text", F.lit("turn 0"), F.lit("turn 8"))).otherwise(F.col("text")))
        with pytest.raises(Exception, match="context of an example"):
            chat_format.read_back(wrong).collect()


# --- embeddings

def test_vectors_that_cannot_link(spark):
    one, nan = [1.0, 0.0], [float("nan"), 1.0]
    rows = [(1, one, "x"), (2, [2.0, 0.0], "x"), (3, None, "x"), (4, [0.0, 0.0], "x"), (5, nan, "x"), (6, [None, 1.0], "x"),
            (7, [], "x"), (8, [1.0, 0.0, 0.0], "x"), (9, one, "x"), (None, one, "x"), (10, [1e300, 1e299], "x"),
            (11, [0.0, 1.0], "x"), (12, [float("inf"), 1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    got = by_id(embedding_links.near_vectors(df), "vec_id")
    assert {v: (r["n_links"], r["component_id"], r["kept"]) for v, r in got.items()} == {
        1: (3, 1, True), 2: (3, 1, False), 9: (3, 1, False), 10: (3, 1, False), None: (0, None, True),
        **{v: (0, v, True) for v in (3, 4, 5, 6, 7, 8, 11, 12)}}
    assert embedding_links.near_vectors(df.limit(0)).count() == 0


def test_chains_and_blocks_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "BLOCK", 64)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((12, 16))
    v = np.concatenate([base[rng.integers(0, 12, 300)] + 0.25 * rng.standard_normal((300, 16)),
                        rng.standard_normal((100, 16))]).astype(np.float32)
    ids = rng.permutation(len(v)).tolist()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<float>")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    groups = brute.Groups(ids)
    for i, j in zip(*np.nonzero(near)):
        groups.link(ids[i], ids[j])
    got = by_id(embedding_links.near_vectors(df), "vec_id")
    assert near.sum() > 2000
    assert {v: (r["n_links"], r["component_id"]) for v, r in got.items()} == {
        v: (int(near[i].sum()) - 1, groups.root(v)) for i, v in enumerate(ids)}


def test_blocks_are_not_dealt_out_by_pair(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding_links, "BLOCK", 32)
    v = np.random.default_rng(8).standard_normal((640, 16)).astype(np.float32)
    v[1::8] = v[::8] + np.float32(0.2) * v[2::8]
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    plans, links = [], embedding_links._links

    def told(*given):
        out = links(*given)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(embedding_links, "_links", told)
    monkeypatch.setattr("gridlens.session.checkpoint_root", lambda spark: f"file://{tmp_path}")
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_links.near_vectors(df).collect()}
    assert got == {i: int(n) - 1 for i, n in enumerate((unit @ unit.T >= 0.9).sum(1))} and sum(got.values()) > 100
    # A shuffle here would move each block once for every block it meets.
    assert len(plans) == 1 and "Exchange" not in plans[0]
    kept = {p.name.split("-")[1] for p in (tmp_path / "gridlens").iterdir()}
    assert not kept & {"vectors", "blocks", "pairs"}


def test_pairs_by_keys_are_those_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((4000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    side = rng.standard_normal((4000, 64))
    side -= (side * v).sum(1)[:, None] * v
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.89, 0.92, 4000)[:, None]
    w = cosine * v + np.sqrt(1 - cosine**2) * side
    planes = embedding_links._planes(64)
    blocks = [embedding_links._Block(x.astype("<f4").tobytes(), planes, "<f4") for x in (v, w)]
    units = [embedding_links._units(b.raw) for b in blocks]
    want = {(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(units[0] @ units[1].T >= 0.9)))}

    def linked(a, b):
        return [(i, j) for r, c in embedding_links._linked(a, b) for i, j in zip(r.tolist(), c.tolist())]

    assert embedding_links.KEYS > 200 and len(embedding_links._by_keys(*blocks)) < 8000
    assert len(want) > 2000 and sorted(linked(*blocks)) == sorted(want)
    both = embedding_links._Block(np.concatenate([b.raw for b in blocks]).tobytes(), planes, "<f4")
    assert embedding_links._by_keys(both, both) is not None
    assert sorted(x for x in linked(both, both) if x[0] != x[1]) == sorted(
        y for i, j in want for y in ((i, j + 4000), (j + 4000, i)))
    monkeypatch.setattr(embedding_links, "HELD", 2000)
    assert embedding_links._by_keys(*blocks) is None and sorted(linked(*blocks)) == sorted(want)


def test_vectors_of_one_group_join_across_blocks():
    parent = np.arange(9)
    embedding_links._join(parent, np.array([7, 5, 3, 8]), np.array([5, 3, 2, 7]))
    embedding_links._join(parent, np.array([1, 4, 1]), np.array([0, 4, 6]))
    assert embedding_links._root(parent, np.arange(9)).tolist() == [0, 0, 2, 2, 4, 2, 0, 2, 2]


def test_count_is_calibrated():
    assert embedding_links.calibrated_count(10, 50.0, 1e-8) == 10
    assert 30 <= embedding_links.calibrated_count() < 48


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    made = []
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long"), made).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}}
    assert connected(spark.createDataFrame([], "a long, b long"), made).count() == 0


# --- quality

def test_sites_are_shrunk_and_leave_the_document_out(spark):
    rows = [("a", "x", 0.9)] * 50 + [("a", "y", 0.2)] * 50 + [("b", "x", 0.5)] + [("c", "x", 0.8)] * 10
    df = spark.createDataFrame(rows, "site_host string, site_path string, evidence double")
    sites = quality.site_levels(df)
    assert sites.mean == pytest.approx(sum(r[2] for r in rows) / len(rows))
    out = {(r["site_host"], r["site_path"]): r for r in quality.combine(df, sites).collect()}
    a, n = sites.host_strength, 100
    host = (a * sites.mean + 50 * 1.1 - 0.9) / (a + n - 1)
    assert out["a", "x"]["host_posterior"] == pytest.approx(host)
    b = sites.path_strength
    assert out["a", "x"]["path_posterior"] == pytest.approx((b * host + 45 - 0.9) / (b + 49))
    assert out["b", "x"]["path_posterior"] == pytest.approx(sites.mean)
    assert out["a", "y"]["path_posterior"] < out["c", "x"]["path_posterior"] < out["a", "x"]["path_posterior"] + 0.2


def test_quality_of_odd_rows(spark):
    good = [(i, words(40, i), "en", "h") for i in range(60)]
    bad = [(100 + i, "|||| %%% " * 30 + words(3, i), "en", "h") for i in range(60)]
    odd = [(900, None, None, None), (901, "", "en", "h"), (902, " \n", None, "h"), (903, words(20000, 1), "en", "h"),
           (None, words(40, 3), "en", "h"), (1, words(40, 1), "en", "h")]
    df = spark.createDataFrame([(*r, 0.5) for r in good + bad + odd],
                               "doc_id long, text string, lang string, source string, evidence double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, None) for i in range(60)] +
                                   [(None, 1, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels)
    scored = quality.evidence(df, model, F.col("source"), F.col("lang"), ["doc_id", "evidence"])
    assert scored.columns == ["doc_id", "site_host", "site_path", "evidence"]
    out = quality.combine(scored, quality.site_levels(scored)).collect()
    assert len(out) == df.count()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(60))
    assert not kept[900] and not kept[901] and not kept[902] and kept[903] and kept[None]
    none = quality.evidence(df.limit(0), model, F.col("source"), F.col("lang"), ["doc_id"])
    assert quality.combine(none, quality.site_levels(none)).count() == 0
    neutral = quality.fit(df, labels.limit(0))
    assert quality.evidence(df, neutral, F.col("source"), F.col("lang"), ["doc_id"]).count() == df.count()


# --- near duplicates

def test_near_groups_of_edited_copies(spark):
    rng, rows = random.Random(2), []
    for k in range(6):
        base = words(120, 1000 + k).split()
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 8)):
                own[rng.randrange(len(own))] = "edit%d" % rng.randrange(10**6)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    docs = dict(enumerate(rows)) | {500: None, 501: "", 502: " \t\n", 503: "one two", 504: "ONE  two", 505: "one two three",
                                    506: words(30000, 9), 507: words(30000, 9) + " tail"}
    got = by_id(minmax_dedup.near_duplicates(docs_of(spark, [*docs.items(), (None, rows[0]), (3, docs[3])])))
    want = brute.near_groups(docs)
    assert got.pop(None).asDict() == {"doc_id": None, "n_shingles": len(brute.shingle_set(rows[0])),
                                      "component_id": None, "kept": True}
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert got[504]["component_id"] == 503 and got[507]["component_id"] == 506 and got[500]["n_shingles"] == 0
    assert minmax_dedup.near_duplicates(docs_of(spark, [])).count() == 0


def test_signatures_are_least_and_greatest_hashes():
    sh = np.sort(np.random.default_rng(0).integers(0, 2**63, 40, dtype=np.uint64))
    got = minmax_dedup.signatures(sh, np.array([0, 15]))
    for j in range(minmax_dedup.PERMUTATIONS):
        h = (sh ^ minmax_dedup._XOR[j]) * minmax_dedup._MUL[j]
        h ^= h >> np.uint64(32)
        assert got[0, j] == h[:15].min() and got[1, minmax_dedup.PERMUTATIONS + j] == h[15:].max()


# --- BPE

def test_joins_are_repaired_for_any_text(spark, monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(VOCABULARY)
    monkeypatch.setattr(bpe.cut_places, "__defaults__", (16,))
    rng = random.Random(4)
    parts = ["a", " ", "  ", "'", "'ll", "l", "<|endoftext|>", "<|", "end", "é", "\n", "7", "!", "漢", "😀", " the", "\u00a0"]
    texts = ["".join(rng.choice(parts) for _ in range(2000)) for _ in range(12)]
    texts += [None, "", " ", "x" * 20000, "ab " * 5000, "漢字" * 3000, words(20000, 1)]
    rows = [*enumerate(texts), (0, texts[0]), (None, "null id")]
    out = bpe.encode_documents(docs_of(spark, rows), VOCABULARY)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == want[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
    assert bpe.encode_documents(docs_of(spark, []), VOCABULARY, ids_as="binary").count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


# --- decontamination

def test_items_are_found_where_both_halves_are(spark):
    items = {i: words(14 + 5 * i, 50 + i) for i in range(20)} | {50: "", 51: "two words"}
    whole, half = items[7], " ".join(items[8].split()[:20])
    noise = words(200, 99)
    rows = {1: f"{noise} {whole} {noise}", 2: f"{noise} {half} {noise}", 3: whole.upper(), 4: None, 5: "", 6: noise,
            7: f"{noise} {noise} {noise} {items[19]}", 8: f"{items[0]} {noise}\n{items[1]}", 9: words(30000, 3) + " " + items[3],
            10: "two words", 11: f"{whole[:len(whole) // 2]} {noise} {whole[len(whole) // 2:]}"}
    bench = spark.createDataFrame([*items.items(), (None, "x"), (60, None)], "item_id long, text string")
    df = spark.createDataFrame([(d, t, [1]) for d, t in rows.items()] + [(None, whole, None)],
                               "doc_id long, text string, leaked_items array<long>")
    got = by_id(decontaminate.mark_leaks(df, bench, ["doc_id", "text", "leaked_items"]))
    window = 2 * max(len(t.split()) for t in items.values())
    assert {d: r["leaked_items"] for d, r in got.items() if d is not None} == {
        d: brute.leaks(t, items, window) for d, t in rows.items()}
    assert got[1]["leaked_items"] == [7] and got[2]["leaked_items"] == [] and got[8]["leaked_items"] == [0, 1]
    assert got[None]["leaked_items"] == [7]
    assert all(r["leaked_items"] == [] for r in decontaminate.mark_leaks(df, bench.limit(0), ["doc_id"]).collect())
    assert decontaminate.mark_leaks(df.limit(0), bench, ["doc_id"]).count() == 0


def test_shards_find_what_one_index_finds(spark):
    items = {i: words(20, i) for i in range(30)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert [len(s.items) for s in decontaminate.shards(bench, size=12)] == [12, 12, 6]
    buf, offs = textops.flatten(__import__("pyarrow").array([f"{items[3]} {items[29]}"]))
    found = [int(s.items[i]) for s in decontaminate.shards(bench, size=12) for i in decontaminate.find(s, buf, offs)[0]]
    assert found == [3, 29]


def test_small_indexes_find_what_one_index_finds_in_spread_copies(spark, monkeypatch):
    items = {i: words(20 + i, i) for i in range(4)} | {9: words(120, 9)}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").coalesce(1)
    own = items[0].split()
    spread = " ".join([*own[:10], *words(40, 77).split(), *own[10:]])  # longer than a passage of the short items
    df = spark.createDataFrame([(1, spread), (2, items[9]), (3, words(60, 5))], "doc_id long, text string")
    one = by_id(decontaminate.mark_leaks(df, bench, ["doc_id"]))
    assert one[1]["leaked_items"] == [0] and one[2]["leaked_items"] == [9]
    whole = {int(i): index for index in decontaminate.shards(bench) for i in index.items}
    monkeypatch.setattr(decontaminate, "SHARD", 2)
    assert by_id(decontaminate.mark_leaks(df, bench, ["doc_id"])) == one
    for index in decontaminate.shards(bench, size=2):
        for place, item in enumerate(index.items.tolist()):
            full = whole[item]
            impacts = lambda x, at: np.sort(x.posting_impact[x.posting_item == at])
            assert np.allclose(impacts(index, place), impacts(full, full.items.tolist().index(item)))
            assert index.window == full.window
    assert [len(x.items) for x in decontaminate.shards(bench, most_words=44)] == [2, 1, 1, 1]


# --- language

def test_language_of_odd_rows(spark):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(60))
    rows = [(i, make("abcdef" if i % 2 else "uvwxyz"), "low" if i % 2 else "high") for i in range(200)]
    odd = [(900, None, "low"), (901, "", None), (902, "123 !? 漢".replace("漢", ""), "low"), (None, make("abcdef"), "low"),
           (903, make("abcdef") * 200, None), (5, rows[5][1], "low")]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd], "doc_id long, text string, lang string, score int")
    model = language.train(df, F.lit(True))
    assert model.languages == ["high", "low"]
    out = language.predict(df, model).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r["doc_id"]: r for r in out}
    assert all(got[i]["lang_pred"] == ("low" if i % 2 else "high") for i in range(200))
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "low", "low"]
    nothing = language.train(df.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(df.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [2, 4, 5, 9])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n
    assert all(abs(c.sum()) < n for c in code.T)


def test_nearest_codeword_survives_a_wrong_bit():
    model = language.Model(list("abcd"), language.codewords(4), np.zeros((1, 7)), np.zeros(7))
    margins = model.code[2].astype(float) * 3
    margins[0] *= -0.3
    best, score, close = language.decode(model, margins[None, :])
    assert best[0] == 2 and score[0] > 0.5 and not close[0]
    assert language.decode(model, np.zeros((1, 7)))[2][0]


# --- lines

def test_lines_match_brute_force(spark):
    rng = random.Random(3)
    pool = [words(rng.randint(1, 5), i) for i in range(60)] + ["", " ", "Menu  ", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "x" * 10, "X" * 10,
                                                               "\tPadded line here \r", "padded LINE here"]
    docs = {d: "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for d in range(80)}
    docs |= {200: None, 201: "", 202: "\n\n", 203: "\n".join(rng.choice(pool) for _ in range(20000))}
    rows = [*docs.items(), (None, docs[5])]
    for batches in (1, 5):
        out = line_dedup.dedup_lines(docs_of(spark, rows), carry=["kept", "n_lines"], batches=batches)
        assert out.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept"]
        got = by_id(out)
        assert (got[None]["text"], got[None]["n_dropped"], got[None]["kept"]) == (docs[5], 0, "y")
        assert {d: (r["n_lines"], r["n_dropped"], r["text"]) for d, r in got.items() if d is not None} == \
            brute.deduped_lines(docs)
    twice = line_dedup.dedup_lines(docs_of(spark, [(1, "the same line"), (1, "the same line"), (2, "The same line ")]))
    assert sorted((r["doc_id"], r["n_dropped"]) for r in twice.collect()) == [(1, 0), (1, 0), (2, 1)]
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


# --- suffixes

@pytest.mark.parametrize("hoard", [1, 3000, 1 << 22])
def test_repeats_across_tasks_match_brute_force(spark, monkeypatch, hoard):
    monkeypatch.setattr(suffix_dedup, "HOARD", hoard)
    rng = random.Random(hoard)
    passages = [words(rng.randint(6, 40), 700 + i) for i in range(12)] + ["a" * 300, "ab" * 90, "é" * 60, "x" * 49, "y" * 50]
    docs = {}
    for d in range(60):
        parts = [words(rng.randint(0, 15), 9000 + d * 10 + j) + rng.choice(passages) for j in range(rng.randint(0, 4))]
        docs[d] = "".join(parts)
    docs |= {100: None, 101: "", 102: docs[7], 103: docs[7][:60], 104: docs[8][3:], 105: "a" * 49, 106: "a" * 50,
             107: words(20000, 5) + passages[0]}
    got = by_id(suffix_dedup.remove_repeats(docs_of(spark, [*docs.items(), (None, docs[7])])))
    assert (got[None]["n_removed"], bytes(got[None]["kept"])) == (0, docs[7].encode())
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for d, r in got.items() if d is not None} == \
        brute.without_repeats(docs)


def test_rows_of_one_id_do_not_cut_each_other(spark):
    text, other = words(30, 1), words(30, 2)
    rows = [(1, text), (1, text), (2, other + text), (2, text + other), (3, other)]
    out = sorted((r["doc_id"], r["n_removed"], r["n_bytes"]) for r in
                 suffix_dedup.remove_repeats(docs_of(spark, rows)).collect())
    n, m = len(text), len(other)
    assert out == sorted([(1, 0, n), (1, 0, n), (2, n, n + m), (2, n, n + m), (3, m, m)])
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0


# --- urls

def test_urls_of_odd_rows(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("x.com", "/a.b/", "block"), ("x.com", "/a.b/", "block"), ("net", "/q", "allow"), ("net", "/q", "block")]
    urls = {1: "http://www.example.org/es/1", 2: "http://EXAMPLE.org/es", 3: "https://notexample.org/es/", 4: None, 5: "",
            6: "example.org/es/", 7: "http://example.org?x=/es/", 8: "ftp://a://example.org/es/", 9: "http://x.com/a.b/c",
            10: "http://x.com/aXb/c", 11: "http://y.net/q/" + "z" * 50000, 12: "http://example.org/en/10#a", 13: "://",
            14: "http:///es/", 15: "http://sub.x.com/a.b/?u"}
    df = spark.createDataFrame([(i, u, "a", "b") for i, u in urls.items()] + [(None, urls[1], "a", "b"), (1, urls[1], "a", "b")],
                               "page_id long, url string, token string, verdict string")
    rows = url_rules.judge_urls(df, rules).collect()
    assert len(rows) == len(urls) + 2
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    allow = (None, "allow")
    assert got == {1: ("example.org/es/", "block"), 2: ("org/", "allow"), 3: ("org/", "allow"), 4: allow, 5: allow, 6: allow,
                   7: allow, 8: allow, 9: ("x.com/a.b/", "block"), 10: allow, 11: ("net/q", "block"),
                   12: ("example.org/en/1", "block"), 13: allow, 14: allow, 15: ("x.com/a.b/", "block"),
                   None: ("example.org/es/", "block")}
    assert {r["verdict"] for r in url_rules.judge_urls(df, [], default="block").collect()} == {"block"}
    assert url_rules.judge_urls(df.limit(0), rules).count() == 0
    assert "Python" not in url_rules.judge_urls(df, rules)._jdf.queryExecution().executedPlan().toString().replace("Pushed", "")
