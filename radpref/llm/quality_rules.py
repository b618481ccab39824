"""Quality rules per document, and verdicts per host from shrunken failure rates. Built-in functions only.

A document's rule failures are counted by host; a host's rate of failures is drawn towards that of all
hosts by a beta prior whose strength is fitted to the spread between hosts (method of moments); hosts
whose drawn-in rate is above a bound reject all their documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import SPACES, cut


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    symbol_percent: int = 10
    duplicate_lines_percent: int = 30
    max_host_rate: float = 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often a nested lambda refers to it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int) -> Column:
    """How many words stand in a window of words that occurs twice or more in the same text."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            near = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, near), lambda x: x["i"]))

        start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"))
        return F.aggregate(let(ordered, twice), start, step, lambda a: a["n"])

    def count(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (window - 1)), lambda i: F.xxhash64(F.slice(ws, i, window)))
        some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
        return F.when(F.size(ws) >= window, some).otherwise(F.lit(0).cast("long"))

    return count(words)


def document_rules(docs: DataFrame, p: QualityParams = QualityParams(), host: str = "source") -> DataFrame:
    """``doc_id, host`` and the counts and failures of each document; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    long = lambda c: c.cast("long")
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        let(words, lambda ws: F.struct(long(F.size(ws)).alias("n"), repeated_words(ws, p.window).alias("repeat"))).alias("w"),
        long(F.char_length(F.translate(text, " \t\n\x0b\x0c\r", ""))).alias("word_chars"),
        long(F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        let(lines, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
    ).select("doc_id", "host", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), F.col("w.repeat").alias("n_repeat_words"))
    base = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    more = (100 * F.col("n_symbols") > p.symbol_percent * F.col("word_chars")) | (100 * F.col("n_dup_lines") > p.duplicate_lines_percent * F.col("n_lines"))
    return out.withColumns({"base_failed": base, "rule_failed": base | more})


def host_rates(rules: DataFrame) -> DataFrame:
    """``host, host_docs, host_failed, host_rate``: rates drawn towards the mean by the fitted prior."""
    hosts = cut(rules.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("rule_failed").cast("long")).alias("host_failed")), "hosts")
    n, k = F.col("host_docs"), F.col("host_failed")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(k).alias("k"), F.count("*").alias("h"), F.sum(k * k / n).alias("kk")).first()
    if not total["n"]:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean = total["k"] / total["n"]
    within = mean * (1 - mean)
    between = max(total["kk"] / total["n"] - mean * mean - within * total["h"] / total["n"], 0.0)
    strength = min(max(within / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return hosts.withColumn("host_rate", (k + mean * strength) / (n + strength))


def quality_rules(docs: DataFrame, p: QualityParams = QualityParams(), host: str = "source") -> DataFrame:
    """Counts, base verdict and final verdict of each document.

    Empty or null text: all counts 0 and ``base_failed``. Documents of no host form a host of their own.
    Repeated rows count and return one by one. An empty table gives an empty result.
    """
    rules = cut(document_rules(docs, p, host), "rules")
    rates = host_rates(rules).withColumnRenamed("host", "rated_host")
    out = rules.join(rates, F.col("host").eqNullSafe(F.col("rated_host")), "left")
    kept = ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= p.max_host_rate)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "host_rate")
