"""URL filters by a sort-merge range join, with DataFrame functions only.

A rule is a host and a path; it fits urls of the host and of its subdomains whose path starts
with the rule's, and the longest rule wins. Written with the host's labels reversed, the rule
is a prefix, so it covers one interval of the sorted keys, and intervals are nested or apart.
A url has one key per number of labels that rule hosts have. Keys of rules and urls are sorted
together and swept once: at every url the last rule that began brings the stack of rules that
enclose it, and those which have not ended before the url are active.

The sweep is cut into ranges that carry the stack over their borders, so it needs no single
task, and urls are made distinct before, so that one url on a third of all rows is one key.

Defined results: a NULL url, or one without ``://``, has an empty host and path and fits no
rule. Repeated rows get the same verdict each. Without rules, or without a fitting one, the
verdict is ``default`` and the rule is NULL. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.ordered import carry_forward

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Ends the host in a key, so that a rule for a host is no prefix of longer labels.
_END = "\0"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    found = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column, depth: Column | None = None) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    some = labels if depth is None else F.slice(labels, 1, depth)
    return F.concat(F.array_join(some, "."), F.lit(_END), path)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``verdict, host, path`` rows from literal rules."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _stacks(rules: DataFrame) -> DataFrame:
    """``key, stack``: each rule with the rules that enclose it and itself, the longest last."""
    own = rules.select(
        _key(F.col("host"), F.col("path")).alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            _key(F.col("host"), F.col("path")).alias("key"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("_rule"),
    )
    # Of two rules with one key the first verdict by code point holds.
    own = own.groupBy("key").agg(F.min("_rule").alias("_rule"))
    prefixes = own.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("_n"))
    prefixes = prefixes.select("key", F.substring(F.col("key"), F.lit(1), F.col("_n")).alias("_prefix"))
    enclosing = own.select(F.col("key").alias("_prefix"), "_rule")
    return prefixes.join(enclosing, "_prefix").groupBy("key").agg(F.sort_array(F.collect_list("_rule")).alias("stack"))


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``host, path, rule, verdict`` of each distinct ``host, path`` row that a rule fits."""
    depths = [
        r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().orderBy(F.lit(1)).collect()
    ]  # as many as labels in a host name
    if not depths:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")).limit(0)
    labels = F.size(F.split("host", r"\."))
    deep = F.filter(F.array(*map(F.lit, depths)), lambda d: d <= labels)
    asked = urls.select("host", "path").distinct().withColumn("_depth", F.explode(deep))
    asked = asked.withColumn("key", _key(F.col("host"), F.col("path"), F.col("_depth")))
    stacks = _stacks(rules)
    stack_type = stacks.schema["stack"].dataType
    events = stacks.select(
        "key", F.lit(0).alias("_asked"), F.lit("").alias("host"), F.lit("").alias("path"), "stack"
    ).unionByName(
        asked.select("key", F.lit(1).alias("_asked"), "host", "path", F.lit(None).cast(stack_type).alias("stack"))
    )
    swept = carry_forward(events, [], ["key", "_asked", "host", "path"], "stack").where("_asked = 1")
    active = F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"]))
    found = swept.select("host", "path", F.array_max(active).alias("_rule")).where("_rule IS NOT NULL")
    found = found.groupBy("host", "path").agg(F.max("_rule").alias("_rule"))
    return found.select("host", "path", "_rule.rule", "_rule.verdict")


def filter_urls(df: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` of every row of ``df``."""
    rows = df.select(F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    judged = judge(rows, rules, default)
    return rows.join(judged, ["host", "path"], "left").select(
        F.col(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
