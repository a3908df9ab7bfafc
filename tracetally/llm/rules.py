"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the row's own text, so a table of any size is one scan
without a shuffle, and a text of any length is seen whole.

Defined results: NULL and empty text have no words, symbols or lines, and fail the base rule (fewer
than 50 words); repeated rows get equal results; an empty table gives an empty result; columns
called like the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracetally.llm.common import white_words, without


class Threshold(NamedTuple):
    """``metric`` has to lie between ``low`` and ``high``, both included; None is no bound."""

    metric: str
    low: float | None = None
    high: float | None = None


#: The method's verdict for texts that pass the base rule. Wide enough for ordinary prose in the
#: languages of STOP_WORDS; the symbol and line bounds are the usual ones for web text.
THRESHOLDS = (
    Threshold("mean_word_chars", 2.0, 15.0),
    Threshold("symbol_ratio", None, 0.1),
    Threshold("stop_word_ratio", 0.02, None),
    Threshold("dup_line_ratio", None, 0.5),
)
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "a", "is", "was", "for", "it",
    "le", "la", "les", "de", "des", "et", "un", "une", "dans", "est", "que",
    "der", "die", "das", "und", "den", "dem", "zu", "ein", "eine", "ist", "mit", "von", "im",
    "el", "los", "las", "y", "en", "por", "del", "se",
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("mean_word_chars", "symbol_ratio", "stop_word_ratio", "dup_line_ratio")


def _sorted_windows() -> Column:
    """(hash, place) of each 3-word window, sorted, so that equal ones are neighbours.

    NULL where no window repeats, which spares most texts the sort. Windows are compared by a
    64-bit hash, and only within one text.
    """
    placed = F.transform("_windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    return F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(placed)
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the metrics BASE and RATIOS of each text.

    ``n_words``         maximal runs without ASCII white space
    ``word_chars``      code points in words
    ``n_symbols``       characters of #*$%&|<>
    ``n_dup_lines``     lines with a word that equal an earlier line
    ``n_repeat_words``  words in 3-word windows found twice or more, the first included
    """
    rows = without(docs, *BASE, *RATIOS)
    names = rows.columns
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "*",
        white_words(F.col(text)).alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    count = F.size("_words")
    windows = F.when(
        count > 2,
        F.transform(
            F.sequence(F.lit(0), count - 3),
            lambda at: F.xxhash64(
                F.get("_words", at), F.get("_words", at + 1), F.get("_words", at + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    stop = F.filter("_words", lambda word: F.lower(F.rtrim(word, F.lit(",.;:"))).isin(*STOP_WORDS))
    rows = rows.select("*", windows.alias("_windows"), F.size(stop).alias("_stops"))
    rows = rows.select("*", _sorted_windows().alias("_sorted"))
    same = lambda a, b: (a.isNotNull() & b.isNotNull()) & (a == b)
    twice = F.filter(
        "_sorted",
        lambda w, at: same(F.get("_sorted", at - 1)["h"], w["h"])
        | same(F.get("_sorted", at + 1)["h"], w["h"]),
    )
    covered = F.flatten(
        F.transform(twice, lambda w: F.array(w["at"], w["at"] + 1, w["at"] + 2))
    )
    n = count.cast("bigint")
    word_chars = F.length(F.array_join("_words", "")).cast("bigint")
    some = F.greatest(n, F.lit(1))
    dup_lines = F.size("_lines") - F.size(F.array_distinct("_lines"))
    repeat = F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
    metrics = F.struct(
        n.alias("n_words"),
        word_chars.alias("word_chars"),
        "n_symbols",
        dup_lines.cast("bigint").alias("n_dup_lines"),
        repeat.cast("bigint").alias("n_repeat_words"),
        (word_chars / some).alias("mean_word_chars"),
        (F.col("n_symbols") / F.greatest(word_chars, F.lit(1))).alias("symbol_ratio"),
        (F.col("_stops") / some).alias("stop_word_ratio"),
        (dup_lines / F.greatest(F.size("_lines"), F.lit(1))).alias("dup_line_ratio"),
    )
    # Through inline, a later filter on a metric can't be moved below, where it would put the
    # expressions into each other and split the text anew for every word.
    return rows.select(*names, F.inline(F.array(metrics)))


def compiled(thresholds: Sequence[Threshold]) -> Column:
    """The table as one condition: true where every threshold holds."""
    held = [F.lit(True)]
    for metric, low, high in thresholds:
        if low is not None:
            held.append(F.col(metric) >= low)
        if high is not None:
            held.append(F.col(metric) <= high)
    return reduce(and_, held)


def judge(
    docs: DataFrame, text: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS
) -> DataFrame:
    """``docs`` with the metrics, ``base_failed`` and ``kept``."""
    rows = measured(without(docs, "base_failed", "kept"), text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & compiled(thresholds)
    )
