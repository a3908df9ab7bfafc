"""Recipe rules held in a table: any number of prefixes, in joins instead of conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _matches(trace: DataFrame, rules: DataFrame, prefix: str) -> DataFrame:
    """Every different recipe id of ``trace`` with each rule that it starts with.

    An id is expanded to all its beginnings, which meet the rules by equality; so the work does not
    grow with the number of rules, and no id is compared with one it does not start with.
    """
    ids = trace.select("runRecipeId").where("runRecipeId IS NOT NULL").distinct()
    ends = F.sequence(F.lit(0), F.char_length("runRecipeId"))
    beginnings = ids.select("runRecipeId", F.explode(ends).alias("_end")).select(
        "runRecipeId", F.left("runRecipeId", "_end").alias("_prefix")
    )
    return beginnings.join(rules.withColumnRenamed(prefix, "_prefix"), "_prefix")


def under_any(trace: DataFrame, rules: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Rows whose recipe id starts with one of the ``prefix`` values of ``rules``, taken literally.

    The same rows as a filter with ``recipe_under`` of all of them.
    """
    wanted = _matches(trace, rules.select(prefix).distinct(), prefix).select("runRecipeId").distinct()
    return trace.join(wanted, "runRecipeId", "left_semi").select(*trace.columns)


def labelled(
    trace: DataFrame, rules: DataFrame, prefix: str = "prefix", label: str = "label"
) -> DataFrame:
    """``trace`` with ``label``, that of the longest prefix in ``rules`` that the recipe id starts
    with; NULL if there is none. Of equal prefixes the smallest label counts."""
    one = rules.groupBy(prefix).agg(F.min(label).alias("_label"))
    longest = (
        _matches(trace, one, prefix)
        .groupBy("runRecipeId")
        .agg(F.max(F.struct(F.char_length("_prefix"), "_label")).alias("_last"))
        .select("runRecipeId", F.col("_last._label").alias(label))
    )
    rest = trace.drop(label)
    return rest.join(longest, "runRecipeId", "left").select(*rest.columns, label)
