"""URL rules by expressions of host suffix and path prefix, looked up by short hash prefixes. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import free_names

#: Hexadecimal digits of SHA-256 that the first lookup compares (32 bits).
SHORT = 8

RULE_SCHEMA = "verdict string, host string, path string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for addresses without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: str = "url") -> Column:
    """The part between the first ``://`` and the next ``/ ? #``, with A-Z lower-cased and nothing else changed."""
    return F.translate(F.regexp_extract(_after_scheme(F.col(url)), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    """From the host's end up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(F.col(url)), r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as (verdict, host suffix, path prefix) rows."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _present(values: Iterable[Column]) -> Column:
    return F.filter(F.array(*values).cast("array<string>"), lambda v: v.isNotNull())


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Give each row of ``pages`` the columns ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule
    (characters of host and path together) wins, then the longer host, then block before allow.
    Without a rule, ``rule`` is null and the verdict is ``default``.

    Null addresses and those without ``://`` have an empty host and path and fit no rule. Columns
    of ``pages`` with the names of the four results are replaced; all others, and repeated rows,
    stay. Rules with a null or empty host or a null path fit nothing.

    Method: rows are cut to distinct (host, path up to the longest rule's), so that a hot host is
    decided once. Each is expanded into suffixes with as many labels as some rule has, and
    prefixes as long as some rule's; the equi-join is on the first 32 bits of SHA-256, and the
    full digest of the expression confirms. Neither join needs a key's rows together, so skewed ones are split.
    """
    spark = pages.sparkSession
    rules = (
        rules.where("length(host) > 0 and path is not null")
        .select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path").distinct()
        .withColumn("labels", F.size(F.split("host", r"\.")))
        .withColumn("chars", F.length("path"))
        .withColumn("text", F.concat("host", "path"))
        .withColumn("digest", F.sha2(F.concat("host", F.lit("\n"), "path"), 256))
    )
    # At most as many numbers as the longest rule has labels and characters.
    shape = rules.agg(F.sort_array(F.collect_set("labels")), F.sort_array(F.collect_set("chars"))).first()
    labels, chars = shape[0] or [], shape[1] or []
    longest = max(chars, default=0)

    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path, head, rule_of, verdict_of = free_names(pages, "host_of", "path_of", "head", "rule_of", "verdict_of")
    judged = pages.withColumns({host: host_of(url), path: path_of(url)})
    judged = judged.withColumn(head, F.substring(path, 1, longest))
    keys = judged.where(f"{host} <> ''").select(host, head).distinct()
    parts = F.split(host, r"\.")
    keys = keys.withColumn("__n", F.size(parts)).withColumn("__l", F.length(head))
    suffixes = _present(F.when(F.col("__n") >= n, F.substring_index(host, ".", -n)) for n in labels)
    prefixes = _present(F.when(F.col("__l") >= n, F.substring(head, 1, n)) for n in chars)
    expressions = (
        keys.select(host, head, F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select(host, head, "suffix", F.explode("prefixes").alias("prefix"))
        .withColumn("digest", F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256))
    )
    found = expressions.withColumn("short", F.left("digest", F.lit(SHORT))).join(
        rules.select(
            F.left("digest", F.lit(SHORT)).alias("short"), F.col("digest").alias("full"), "verdict", "text",
            F.length("host").alias("host_chars"),
        ),
        "short",
    ).where(F.col("digest") == F.col("full"))
    best = found.groupBy(host, head).agg(
        F.max(F.struct(
            F.length("text").alias("chars"), "host_chars", F.col("verdict").alias("verdict"), F.col("text").alias("rule")
        )).alias("best")
    ).select(host, head, F.col("best.rule").alias(rule_of), F.col("best.verdict").alias(verdict_of))
    return judged.join(best, [host, head], "left").select(
        *own, F.col(host).alias("host"), F.col(path).alias("path"), F.col(rule_of).alias("rule"),
        F.coalesce(verdict_of, F.lit(default)).alias("verdict"),
    )
