"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host and a path prefix. Every label of its host, and every segment of its path that a slash
closes, stands as a whole token in each url the rule fits. The rule is filed under the one of its tokens that
is rarest among the urls judged. A url fetches the rules filed under its tokens; only those run their regular
expression. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
Rule = tuple[str, str, str]
DEFAULT_VERDICT = "allow"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _tokens(host: Column, path: Column) -> Column:
    segments = F.split(path, "/")
    closed = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 2, F.lit(0)))
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    return F.array_distinct(F.concat(labels, F.transform(closed, lambda x: F.concat(F.lit("p:"), x))))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules with their regular expressions; a rule given twice counts once."""
    schema = "array<struct<rule_host:string,rule_path:string,rule_verdict:string>>"
    cells = [F.struct(*[F.lit(x) for x in rule]) for rule in dict.fromkeys(rules)]
    table = spark.range(1).select(F.inline(F.array(*cells).cast(schema) if cells else F.lit(None).cast(schema)))
    quoted = F.regexp_replace(F.concat("rule_host", "rule_path"), r"([^A-Za-z0-9])", r"\\$1")
    return table.withColumn("pattern", F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted))


def index_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """File each rule under its rarest token. ``urls`` has ``tokens``; all of them are counted."""
    of_rules = rules.withColumn("token", F.explode(_tokens(F.col("rule_host"), F.col("rule_path"))))
    wanted = of_rules.select("token").distinct()
    seen = (urls.select(F.explode("tokens").alias("token"))
            .join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")
    return (of_rules.join(seen, "token", "left")
            .groupBy("rule_host", "rule_path", "rule_verdict", "pattern").agg(F.min(rank).alias("rarest"))
            .select(F.col("rarest.token").alias("token"), "rule_host", "rule_path", "rule_verdict", "pattern"))


def judge_urls(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per input row: ``id_col``, ``host``, ``path``, ``rule``, ``verdict``.

    A rule fits its host and all its subdomains when the path starts with the rule's. The longest wins; of
    equally long ones a block, then the greater text. Without a fitting rule ``rule`` is null and the verdict
    is ``default``. A null url or one without ``://`` has an empty host and path, which no rule fits. Repeated
    rows and ids are judged one by one, null ids too. Other columns of the input are not carried, so their names
    cannot clash. An empty table gives an empty table; no rules at all give ``default`` throughout.
    """
    url = F.col(f"`{url_col}`")
    urls = df.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.withColumn("tokens", _tokens(F.col("host"), F.col("path")))
    index = index_rules(urls, rule_table(df.sparkSession, rules))
    # The tokens of a row lie together in a task: it groups them to one row before anything is shuffled.
    fetched = (urls.withColumn("row", F.monotonically_increasing_id())
               .select("row", "id", "host", "path", F.explode_outer("tokens").alias("token"))
               .join(index, "token", "left"))
    fits = F.col("pattern").isNotNull() & F.rlike(F.concat("host", "path"), F.col("pattern"))
    rule = F.concat("rule_host", "rule_path")
    won = F.when(fits, F.struct(F.length(rule).alias("n"), (F.col("rule_verdict") == "block").alias("block"),
                                rule.alias("rule"), F.col("rule_verdict").alias("verdict")))
    best = fetched.groupBy("row", "id", "host", "path").agg(F.max(won).alias("won"))
    return best.select(F.col("id").alias(id_col), "host", "path", F.col("won.rule").alias("rule"),
                       F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
