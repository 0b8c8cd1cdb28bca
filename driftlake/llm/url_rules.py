"""URL filters: hashed host-suffix and path-prefix expressions joined to rules.

Each URL is expanded to the expressions a rule could be written as (its last n labels,
its first m path characters, for the n and m that rules have).  Expressions meet rules
on the first eight digits of their SHA-256; the full digest confirms, the longest rule wins.

Defined results: a null URL, or one without ``://``, has an empty host and path and no
rule.  Repeated rows each get a row.  A rule with a null part is ignored; of an allow and
a block rule for the same place, block wins.  Empty tables give empty results.  Columns
of the pages other than ``page_id`` and ``url`` are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given, lower_ascii, written

#: Hexadecimal digits of a digest that expressions and rules are joined on.
SHORT = 8

#: The rules of the registered query, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``; path: from there up to ``?`` or ``#``."""
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(raw), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _rule_table(rules: DataFrame) -> DataFrame:
    """Rules with digests, lengths and label counts; one verdict for each place."""
    host = lower_ascii(F.col("host"))
    return (
        rules.dropna(subset=["verdict", "host", "path"])
        .select("verdict", host.alias("host"), "path")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
        .select(
            "verdict",
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            F.length("path").alias("path_length"),
            F.size(F.split("host", r"\.")).alias("labels"),
            _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        )
        .withColumn("rule_short", F.substring("rule_digest", 1, SHORT))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``.  What goes to the
    driver are the distinct label counts and path lengths of the rules: at most as many
    numbers as the longest rule has characters.
    """
    table = written(_rule_table(rules), "url-rules")
    shape = table.agg(
        F.sort_array(F.collect_set("labels")).alias("labels"),
        F.sort_array(F.collect_set("path_length")).alias("lengths"),
    ).first()
    labels, lengths = list(shape["labels"]), list(shape["lengths"])
    longest = max(lengths, default=0)

    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "_head", F.substring("path", 1, longest) if longest else F.lit("")
    )
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in labels]).cast("array<int>"), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_head")),
        lambda n: F.substring(F.col("_head"), F.lit(1), n),
    )
    expressions = (
        parsed.select("host", "_head")
        .distinct()
        .select("host", "_head", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "_head", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "_head", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    place = F.struct("path_length", "host_length", "rule", "verdict")
    ruled = (
        expressions.join(
            table, (expressions["short"] == table["rule_short"]) & (expressions["digest"] == table["rule_digest"])
        )
        .withColumn("size", F.col("path_length") + F.col("host_length"))
        .groupBy("host", "_head")
        .agg(F.max_by(place, F.struct("size", "host_length")).alias("best"))
        .select(F.col("host").alias("_host"), F.col("_head").alias("_path"), "best.rule", "best.verdict")
    )
    ruled = written(ruled, "url-verdicts")
    return parsed.join(
        ruled, (parsed["host"] == ruled["_host"]) & (parsed["_head"] == ruled["_path"]), "left"
    ).select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    return judge_urls(given(spark, folder, "pages"), rules)


ORACLE = """
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
parsed AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
judged AS (SELECT p.page_id, p.host, p.path,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parsed p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id, p.host, p.path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged
"""
