"""URL filter lists: host-suffix and path-prefix expressions against hashed rules.

Each URL is expanded into host suffixes, which meet the hosts of the rules, and
then into the path prefixes that these hosts' rules could have. Either time the
digests meet in an equi-join on a short hash prefix and the full digest confirms
a match; the longest rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.text import ascii_lower, packed

ALLOW, BLOCK = "allow", "block"
#: Hexadecimal digits of the digest that the join compares first: 32 bits.
SHORT = 8

RULE_SCHEMA = "host string, path string, verdict string"


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host to the next ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # The host's length comes first, so no two pairs of host and path give the same string.
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit("\t"), host, path), 256)


def _labels(host: Column) -> Column:
    return F.when(host == "", 0).otherwise(F.size(F.split(host, r"\.")))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = ALLOW) -> DataFrame:
    """Host, path, deciding rule and verdict of every row, whose columns come back in ``row``.

    A rule fits its host and all subdomains if the URL's path starts with the
    rule's path. The longest rule (host and path together) wins, ``block``
    before ``allow`` among equals, then the smaller rule. URLs without a rule
    get ``default`` and a null rule. A null URL or one without ``://`` has an
    empty host and path and fits no rule, unless a rule has both empty.

    The verdict depends on host and path alone, so each pair is judged once,
    however often it occurs. Its host suffixes meet the rules' hosts first, and
    only the path prefixes that the hosts it met ask for are tried after that:
    the work grows with the matches, not with the rules. The driver reads the
    distinct label counts of the rules' hosts (at most 127 for names that DNS
    allows). A rule side is broadcast only if Spark finds it small enough.
    """
    listed = rules.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).select("*", _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"))
    listed = listed.withColumn("rule_short", F.substring("rule_digest", 1, SHORT))
    # One row per host of the rules, with the path lengths that its rules have.
    hosts = (
        listed.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("path_lengths"))
        .select("path_lengths", F.sha2("rule_host", 256).alias("host_digest"))
        .withColumn("host_short", F.substring("host_digest", 1, SHORT))
    )
    label_counts = [r.n for r in listed.select(_labels(F.col("rule_host")).alias("n")).distinct().orderBy("n").collect()]
    rows = pages.select(
        packed(pages).alias("row"), url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path")
    )
    if not label_counts:
        return rows.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    targets = rows.select(F.col("host").alias("t_host"), F.col("path").alias("t_path")).distinct()
    # The empty host is nobody's parent.
    fitting = F.filter(
        F.array(*map(F.lit, label_counts)),
        lambda n: F.when(n == 0, F.col("n_labels") == 0).otherwise(n <= F.col("n_labels")),
    )
    suffixes = (
        targets.withColumn("n_labels", _labels(F.col("t_host")))
        .select("t_host", "t_path", F.explode(fitting).alias("labels"))
        .withColumn("suffix", F.expr("if(labels = 0, '', substring_index(t_host, '.', -labels))"))
        .withColumn("suffix_digest", F.sha2("suffix", 256))
        .withColumn("suffix_short", F.substring("suffix_digest", 1, SHORT))
    )
    reachable = F.filter("path_lengths", lambda n: n <= F.length("t_path"))
    expanded = (
        suffixes.join(hosts, F.col("suffix_short") == F.col("host_short"))
        .filter(F.col("suffix_digest") == F.col("host_digest"))
        .select("t_host", "t_path", "suffix", F.explode(reachable).alias("chars"))
        .select("t_host", "t_path", _digest(F.col("suffix"), F.expr("substring(t_path, 1, chars)")).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    rule = F.concat("rule_host", "rule_path")
    best = (
        expanded.join(listed, F.col("short") == F.col("rule_short"))
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("t_host", "t_path")
        .agg(
            F.min(
                F.struct(
                    (-F.length(rule)).alias("o1"),
                    (F.col("rule_verdict") != BLOCK).alias("o2"),
                    rule.alias("rule"),
                    F.col("rule_verdict").alias("verdict"),
                )
            ).alias("best")
        )
    )
    judged = rows.join(best, (F.col("host") == F.col("t_host")) & (F.col("path") == F.col("t_path")), "left")
    return judged.select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
