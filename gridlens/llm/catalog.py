"""Queries over the given tables that apply each operator, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import (
    bpe, chat_format, decontaminate, embedding_links, filter_audit, language, line_dedup, minmax_dedup, quality,
    secret_scan, suffix_dedup, token_alignment, url_rules)
from gridlens.llm.store import written
from gridlens.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(tune(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return build
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


#: The rules that the query applies.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word_list(text: str) -> str:
    """DuckDB SQL: the words of a text."""
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+')"


def _reached(nodes: str) -> str:
    """DuckDB SQL: the smallest node that each of ``nodes`` reaches by the links (a, b), given both ways."""
    return f"""
reach AS (
  SELECT id, id AS r FROM {nodes} UNION SELECT link.a, reach.r FROM link JOIN reach ON link.b = reach.id),
least AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""


_ESCAPED = "replace(coalesce(text, ''), '\\', '\\\\')"
for _mark in chat_format.CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"
#: The conversation that the query adds.
ADDED_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op1_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, length({_ESCAPED}) + CASE
    WHEN role = 'user' THEN length('<s>[INST]  [/INST]') WHEN role = 'assistant' THEN length('<s> </s>')
    ELSE length('<s>[ROLE][/ROLE] </s>') + length(coalesce(role, '')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
FROM t GROUP BY conv_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED_CONVERSATION, given.schema)
    return chat_format.read_back(chat_format.expand_prefix_targets(given.unionByName(added)))


@query("op2_embedding_links", f"""
WITH RECURSIVE n AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT * FROM n WHERE len(e) > 0 AND list_count(e) = len(e) AND isfinite(list_sum(e)) AND list_sum(list_transform(e, lambda x: x * x)) > 0),
link AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_cosine_similarity(x.e, y.e) >= 0.9),
{_reached("n")},
degree AS (SELECT a AS id, count(*) AS k FROM link GROUP BY a)
SELECT id AS vec_id, coalesce(k, 0) AS n_links, component_id, component_id = id AS kept
FROM least LEFT JOIN degree USING (id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = written(quality.evidence(docs, model, F.col("source"), F.col("lang"), ["doc_id"]), "evidence")
    out = quality.combine(scored, quality.site_levels(scored))
    return out.select("doc_id", "evidence", "host_posterior", "path_posterior", "score", "kept")


@query("op4_minmax_dedup", f"""
WITH RECURSIVE n AS (SELECT doc_id AS id, {_word_list('text')} AS w FROM documents),
s AS (
  SELECT DISTINCT id, array_to_string(w[j:j + 4], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS j FROM n WHERE len(w) > 0)),
size AS (SELECT id, count(*) AS k FROM s GROUP BY id),
pair AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY x.id, y.id),
link AS (
  SELECT a, b FROM pair JOIN size p ON p.id = a JOIN size q ON q.id = b WHERE 100 * c >= 75 * (p.k + q.k - c)),
{_reached("n")}
SELECT id AS doc_id, coalesce(k, 0) AS n_shingles, component_id, component_id = id AS kept
FROM least LEFT JOIN size USING (id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               ids_as="binary")
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_decontaminate", f"""
WITH bw AS (SELECT item_id, {_word_list('text')} AS w FROM benchmark),
half AS (SELECT greatest(max(len(w)), 5) AS h FROM bw),
part AS (
  SELECT item_id, 0 AS side, w[1:(len(w) + 1) // 2] AS w FROM bw
  UNION ALL SELECT item_id, 1, w[(len(w) + 1) // 2 + 1:] FROM bw),
sized AS (SELECT *, least(len(w), 5) AS sz FROM part WHERE len(w) > 0),
bs AS (
  SELECT DISTINCT item_id, side, sz, array_to_string(w[j:j + sz - 1], ' ') AS s
  FROM (SELECT item_id, side, w, sz, unnest(range(1, len(w) - sz + 2)) AS j FROM sized)),
need AS (SELECT item_id, side, count(*) AS n FROM bs GROUP BY item_id, side),
sides AS (SELECT item_id, count(*) AS sides FROM need GROUP BY item_id),
dw AS (SELECT doc_id, {_word_list('text')} AS w FROM documents),
ds AS (
  SELECT doc_id, sz, j - 1 AS p, greatest(1, CAST(ceil(words / h) AS BIGINT) - 1) AS passages, h,
         array_to_string(w[j:j + sz - 1], ' ') AS s
  FROM (SELECT doc_id, w, len(w) AS words, h, sz, unnest(range(1, len(w) - sz + 2)) AS j
        FROM dw, half, (SELECT DISTINCT sz FROM sized))),
hit AS (SELECT ds.*, bs.item_id, bs.side FROM ds JOIN bs USING (s, sz)),
seen AS (
  SELECT doc_id, item_id, side, k, count(DISTINCT s) AS n
  FROM (SELECT *, unnest([p // h, p // h - 1]) AS k FROM hit)
  WHERE k >= 0 AND k < passages AND p + sz <= (k + 2) * h GROUP BY doc_id, item_id, side, k),
found AS (
  SELECT DISTINCT doc_id, item_id FROM (
    SELECT doc_id, item_id, k FROM seen JOIN need USING (item_id, side) JOIN sides USING (item_id)
    WHERE seen.n >= 0.75 * need.n GROUP BY doc_id, item_id, k, sides HAVING count(*) = sides)),
of_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
  FROM found GROUP BY doc_id)
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0) AS n_items, coalesce(items, '') AS items
FROM documents LEFT JOIN of_doc USING (doc_id)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.mark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    n = F.size("leaked_items")
    return out.select("doc_id", (n > 0).alias("contaminated"), n.cast("long").alias("n_items"),
                      F.array_join("leaked_items", ",").alias("items"))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = language.train(docs, ~held_out)
    out = language.predict(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op8_line_dedup", rf"""
WITH l AS (
  SELECT doc_id, i, line, regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'),
         '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
o AS (SELECT k, min(doc_id) AS owner FROM l WHERE length(k) >= 10 GROUP BY k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner < doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (owner IS NULL OR owner >= doc_id), ''))
         AS kept_sha256
FROM l LEFT JOIN o USING (k) GROUP BY doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op9_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
o AS (SELECT k, min(doc_id) AS owner FROM w GROUP BY k),
lost AS (SELECT doc_id, i FROM w JOIN o USING (k) WHERE owner < doc_id),
marked AS (
  SELECT *, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM lost)),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM marked GROUP BY doc_id, run),
cut AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs),
kept AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS spans,
         string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
  FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_url_rules", rf"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                     '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
      THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
      THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


_FAILS = " ".join(f"WHEN strpos(fails, o[{i}]) > 0 THEN {i}" for i in range(1, 6))


@query("op11_filter_audit", rf"""
WITH letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
told AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN told USING (doc_id)),
mask AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x
  FROM judged GROUP BY part, fails),
gone AS (SELECT *, CASE {_FAILS} ELSE 6 END AS at_step FROM mask, orders),
steps AS (
  SELECT part, o, step, o[step] AS f, coalesce(sum(n) FILTER (at_step > step), 0) AS kept,
         coalesce(sum(n) FILTER (at_step = step), 0) AS removed,
         coalesce(sum(n) FILTER (at_step < step AND strpos(fails, o[step]) > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = o[step]), 0) AS unique_fails,
         coalesce(sum(g) FILTER (at_step = step), 0) AS good_lost,
         coalesce(sum(x) FILTER (at_step = step), 0) AS toxic_lost
  FROM gone, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) GROUP BY part, o, step)
SELECT part, o AS filter_order, step, f AS "filter", CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = filter_audit.document_failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit_filters(failures, "ABCDE", F.col("part"), {"good": F.col("good"), "toxic": F.col("toxic")},
                                      F.col("n"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_alignment.align_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), groups_as="sha256")
    return out.withColumnRenamed("groups", "groups_sha256")


def _found(rank: int, kind: str, pattern: str, keep: str = "true", group: int = 0) -> str:
    """DuckDB SQL: places and texts of the matches of a pattern."""
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, m[k] AS body, m[k] AS "all",
         CAST(list_sum(list_transform(p[:k], lambda x: length(x))) + coalesce(
           list_sum(list_transform(m[:k - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (
    SELECT doc_id, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m,
           regexp_extract_all(t, '{pattern}', {group}) AS g FROM d)) WHERE {keep}"""


def _by_entropy(rank: int, c: secret_scan.CharacterClass) -> str:
    """DuckDB SQL: the same for places that lie in a window of enough bits."""
    w, count = c.width, f"({c.width} - length(replace(w, c, '')))"
    some = " AND ".join(f"length(regexp_replace(w, '[^{x}]', '', 'g')) >= {least}" for x, least in (
        ("0-9", c.digits), ("A-Za-z", c.letters), ("A-Z", c.capitals), ("a-z", c.small)))
    return f"""
  SELECT doc_id, {rank} AS rank, '{c.kind}' AS kind, substr("all", min(i) + 1, max(i) + {w} - min(i)) AS body, "all",
         s + min(i) AS s
  FROM (
    SELECT *, sum(CASE WHEN i <= before + {w} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, s ORDER BY i) AS run
    FROM (
      SELECT *, lag(i) OVER (PARTITION BY doc_id, s ORDER BY i) AS before
      FROM (SELECT *, substr("all", i + 1, {w}) AS w
            FROM (SELECT *, unnest(range(0, length("all") - {w - 1})) AS i
                  FROM ({_found(rank, c.kind, f"[{c.characters}]{{{w},}}")})))
      WHERE log2({w}) - list_sum(list_transform(list_distinct(string_split(w, '')),
              lambda c: {count} * log2({count}))) / {w} >= {c.bits} AND {some}))
  GROUP BY doc_id, s, "all", run"""


_EITHER = "(" + "|".join("".join(f"[{x.upper()}{x}]" if x.isalpha() else "_?" for x in word) for word in (
    "password", "passwd", "secret", "token", "api_key")) + ")"
_ASSIGN = _EITHER + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_ALLOWED = "|".join(f"({p})" for p in secret_scan.ALLOWED_PATTERNS)
_TEXTS = ", ".join(f"'{t}'" for t in secret_scan.ALLOWED_TEXTS)


@query("op13_secret_scan", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_found(0, "assign", _ASSIGN, "length(g[k]) >= 6", 2)}
  UNION ALL {_found(1, "access", "AKIA[A-Z0-9]+", "length(m[k]) >= 20")}
  UNION ALL {_found(2, "hex", "[0-9a-f]+", "length(m[k]) >= 24")}),
more AS (
  SELECT * FROM ({" UNION ALL ".join(_by_entropy(3 + i, c) for i, c in enumerate(secret_scan.CLASSES))})
  WHERE NOT regexp_full_match("all", '{_ALLOWED}') AND len(list_filter([{_TEXTS}], lambda x: strpos(x, body) > 0)) = 0),
spot AS (SELECT *, s + length(body) AS e FROM (SELECT * FROM base UNION ALL SELECT * FROM more)),
span AS (
  SELECT doc_id, rank, s, e, kind || ':' || s || ':' || e AS x FROM spot b
  WHERE rank < 3 OR NOT EXISTS (
    SELECT 1 FROM spot o WHERE o.doc_id = b.doc_id AND o.rank < b.rank AND o.s <= b.s AND b.e <= o.e))
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
       count(*) FILTER (rank = 2) AS n_hex,
       sha256(coalesce(string_agg(x, ',' ORDER BY s, rank, e) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(x, ',' ORDER BY s, rank, e), '') AS spans
FROM documents LEFT JOIN span USING (doc_id) GROUP BY doc_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    rules = [r[0] for r in secret_scan.RULES]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def of_kind(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    return out.select("doc_id", *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in rules],
                      F.sha2(joined(of_kind(*rules)), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
