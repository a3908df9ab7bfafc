"""URL verdicts from a rule list of any size.

Each URL is expanded into (host suffix, path prefix) expressions, which meet the rules in an
equi-join on the first four bytes of their SHA-256; a full digest confirms each meeting, and the
longest rule decides. Path prefixes are cut at the lengths that occur among the rules, so a rule's
path may end anywhere.

Defined results: a URL that is NULL or lacks ``://`` has empty host and path; no rule means the
default verdict and a NULL rule; a rule with a NULL host, path or verdict fits nothing; of rules of
the same length the one with the longer host wins, then block before allow; repeated rows get the
same verdict; empty tables give empty results, or defaults; columns called like the result's are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracetally.llm.common import lower_ascii, stored, without

#: Hex digits of a digest that the join compares.
PREFIX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z), and the path up to ``?`` or ``#``; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _suffixes(host: Column) -> Column:
    """The host and what follows each of its dots."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."),
    )


def judge(
    urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``urls`` with ``host``, ``path``, the ``rule`` that decides (host and path) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block); it may be small or as large
    as the URLs, Spark picks the join. A pair of host and path is judged once, however many rows
    have it, and what a pair meets is reduced where it is found, before anything is shuffled by it.
    Only the lengths of rule paths reach the driver: numbers up to the longest path.
    """
    listed = rules.select(
        lower_ascii(F.col("host")).alias("_host"),
        F.col("path").alias("_path"),
        F.col("verdict").alias("_verdict"),
    ).dropna()
    lengths = sorted(
        row[0] for row in listed.select(F.length("_path").alias("n")).distinct().collect()
    )
    full = _digest(F.col("_host"), F.col("_path"))
    listed = listed.select(
        F.struct(
            (F.length("_host") + F.length("_path")).alias("length"),
            F.length("_host").alias("host"),
            (F.col("_verdict") == "block").alias("blocks"),
            F.concat("_host", "_path").alias("rule"),
            F.col("_verdict").alias("verdict"),
        ).alias("_rule"),
        full.alias("_full"),
        F.substring(full, 1, PREFIX).alias("_short"),
    )
    host, path = host_and_path(F.col(url))
    rows = without(urls, "host", "path", "rule", "verdict")
    names = rows.columns
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    if not lengths:
        return rows.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    pairs = rows.select("host", "path").distinct()
    expressions = (
        pairs.select(
            "host", "path", F.explode(_suffixes(F.col("host"))).alias("_suffix"), fitting.alias("_n")
        )
        .select("host", "path", "_suffix", F.explode("_n").alias("_n"))
        .select(
            "host",
            "path",
            _digest(F.col("_suffix"), F.substring(F.col("path"), F.lit(1), F.col("_n"))).alias(
                "_digest"
            ),
        )
        .withColumn("_short", F.substring("_digest", 1, PREFIX))
    )
    met = expressions.join(listed, "_short").where(F.col("_digest") == F.col("_full"))
    decided = (
        met.groupBy(F.col("host").alias("_host"), F.col("path").alias("_path"))
        .agg(F.max("_rule").alias("_rule"))
    )
    here = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return rows.join(decided, here, "left").select(
        *names,
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.lit(default)).alias("verdict"),
    )
