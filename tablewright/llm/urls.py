"""Lists of blocked and allowed hosts and paths, matched by hash prefixes.

Every distinct url is expanded into the expressions a rule could have been written as: suffixes of its host (whole
labels) with prefixes of its path. An expression is hashed; a short prefix of the digest joins it to the
rules, the full digest confirms the match, and of the confirmed rules the longest wins. Only suffixes and prefixes
of lengths that some rule has are formed, so the expansion is bounded by the rules and not by the url.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: what follows up to
``?``, ``#`` or the end. Both are empty without a ``://`` and for null. A url that no rule fits gets the
``default`` verdict and a null rule. Of rules of equal text, ``block`` wins. Rows are kept as they are, repeated ones too.
An empty list of rules leaves the default for all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.sizing import broadcast_if_small


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules as a table of ``verdict``, ``host`` and ``path``."""
    rows = [(r.verdict, r.host, r.path) for r in rules]
    return spark.createDataFrame(rows, "verdict string, host string, path string")


def _lower(host: Column) -> Column:
    """A-Z in lower case, and nothing else, for urls and rules alike."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, letters, letters.lower())


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _suffixes(host: Column, labels: Sequence[int]) -> Column:
    """The last so many labels of the host, for every number in ``labels`` that it has."""
    parts = F.split(host, r"\.", -1)
    found = [
        F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in sorted(labels)
    ]
    return F.array_compact(F.array(*found))


def _prefixes(path: Column, lengths: Sequence[int]) -> Column:
    found = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths)]
    return F.array_compact(F.array(*found))


def verdicts(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Per distinct url: ``url``, ``host``, ``path``, ``rule`` and ``verdict``."""
    rules = rules.where("host is not null and verdict is not null").select(
        _lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    # Distinct lengths of what the rules are made of: a few dozen numbers however long the list is.
    labels = [r[0] for r in rules.select(F.size(F.split("host", r"\.", -1))).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    listed = rules.select(
        _digest(_expression(F.col("host"), F.col("path"))).alias("rule_digest"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("rule_verdict"),
    ).withColumn("short", _short(F.col("rule_digest")))

    distinct = urls.select(F.col(f"`{url}`").alias("url")).distinct()
    parts = distinct.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not labels:
        empty = F.lit(None).cast("string")
        return parts.select("*", empty.alias("rule"), F.lit(default).alias("verdict"))
    expanded = parts.withColumn("suffix", F.explode_outer(_suffixes(F.col("host"), labels)))
    expanded = expanded.withColumn("prefix", F.explode_outer(_prefixes(F.col("path"), lengths)))
    digest = _digest(_expression(F.col("suffix"), F.col("prefix")))
    expanded = expanded.select("url", "host", "path", digest.alias("digest")).withColumn("short", _short(F.col("digest")))
    matched = expanded.join(broadcast_if_small(listed), "short", "left")
    fits = F.col("digest") == F.col("rule_digest")
    choice = F.struct(
        F.length("rule").alias("size"), (F.col("rule_verdict") == "block").alias("block"), "rule", "rule_verdict"
    )
    best = matched.groupBy("url", "host", "path").agg(F.max(F.when(fits, choice)).alias("best"))
    return best.select(
        "url",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )


def judge(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """Per row of ``pages``: id, ``host``, ``path``, ``rule`` and ``verdict``.

    Each distinct url is judged once; a hot url then is a join key that adaptive execution splits.
    """
    found = verdicts(pages, rules, url, default).withColumnRenamed("url", "_url")
    rows = pages.select(F.col(f"`{id_column}`"), F.col(f"`{url}`").alias("_of"))
    joined = rows.join(found, F.col("_of").eqNullSafe(F.col("_url")), "left")
    return joined.select(id_column, "host", "path", "rule", "verdict")
