"""URL rules found through their rarest literal token.

A rule names a host and the beginning of a path, and becomes a regular expression over host and path. Its
whole host labels and whole path words are its literal tokens; the rarest of them, by the number of addresses it
occurs in, is its index key. The tokens of an address fetch the rules filed under them, and only those expressions
run. Of the rules that fit, the longest decides; without one the verdict is ``default``.

Each distinct address is judged once. Candidates are found by an equality join on the token; its small side is the
rule index, which Spark broadcasts only if it is small by its own measure, and splits a hot token otherwise.

Defined results: a NULL address or one without ``://`` has an empty host and path and no rule; of equally long rules
the smaller text decides; repeated rows are judged alike; empty tables give empty ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.llm.common import stored

Rule = tuple[str, str]  # verdict and "host/path"
WORD = r"[\p{L}\p{N}]+"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path, both without query and fragment."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, pattern, 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(url, pattern, 2)


def tokens(host: Column, path: Column) -> Column:
    """Distinct words of host and path; a host's carry a mark, so ``com`` in a path is another token."""
    of_host = F.transform(F.regexp_extract_all(host, F.lit(WORD), F.lit(0)), lambda w: F.concat(F.lit("@"), w))
    return F.array_distinct(F.concat(of_host, F.regexp_extract_all(path, F.lit(WORD), F.lit(0))))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(rule, decision, pattern, tokens). The last word of the path may go on in an address, so it is no token."""
    rows = []
    for decision, rule in rules:
        host, slash, path = rule.partition("/")
        host = "".join(c.lower() if c.isascii() else c for c in host)
        pattern = rf"(?s)^(.*\.)?{re.escape(host)}\n{re.escape(slash + path)}"
        whole = re.sub(r"\w+$", "", path)
        words = ["@" + w for w in re.findall(r"[^\W_]+", host)] + re.findall(r"[^\W_]+", whole)
        rows.append((rule, decision, pattern, sorted(set(words))))
    return spark.createDataFrame(rows, "rule string, decision string, pattern string, tokens array<string>")


def rule_index(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """Rules under their rarest token; ``url_tokens`` has one row per address and token."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    found = url_tokens.join(wanted, "token", "left_semi").groupBy("token").count()
    rated = rules.select("rule", "decision", "pattern", F.explode("tokens").alias("token")).join(found, "token", "left")
    rated = rated.withColumn("count", F.coalesce("count", F.lit(0)))
    key = F.min_by("token", F.struct("count", "token")).alias("token")
    return rated.groupBy("rule", "decision", "pattern").agg(key)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    places = stored(split.select("host", "path").distinct(), "addresses")
    listed = places.select("host", "path", F.explode(tokens(F.col("host"), F.col("path"))).alias("token"))
    index = stored(rule_index(rules, listed), "rule-index")
    fits = listed.join(index, "token").where(F.expr("concat(host, '\\n', path) rlike pattern"))
    best = fits.groupBy("host", "path").agg(
        F.min_by(F.struct("rule", "decision"), F.struct(-F.length("rule"), F.col("rule"))).alias("best")
    )
    judged = split.join(best, ["host", "path"], "left")
    verdict = F.coalesce("best.decision", F.lit(default)).alias("verdict")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict)
