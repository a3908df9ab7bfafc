"""Trends kept by day and rolled up to any grain, with distinct counts that stay exact.

Distinct counts of days do not add up. So each different value of a counted column has a number, and
a day has a bitmap of the numbers seen; bitmaps unite to those of weeks, months, quarters and years,
and their bits are counted. A refresh rewrites the months it is given and no others, and reads the
trace of those months only.

``numbers``   column, value and number: written once and never changed, shared by all reports
``<report>``  in folders by month, by day: bitmaps in parts of 32,768 numbers, and sums

Values are numbered in the order of the day they came up, so that a day's numbers lie close together
and fill few parts. With ``approximate``, a day has an HLL sketch of some hundred bytes to 4 KB in
place of numbers and bitmaps; results are called ``approx_…``, as they can be off by some per cent.
One refresh at a time may write.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracetally.functions.columns import (
    GRAINS,
    SECURITY_PATTERNS,
    hours,
    not_succeeded,
    percentage,
    reached,
    recipe_like,
    succeeded,
    utc_day,
)
from tracetally.schema import REPORTS

_EFFORT = "runEstimatedEffortTimeSavingsMs"
_FIXED_FILES = "runFilesWithFixResults"
#: The measure that every day of a report has: its number of rows.
ROWS = ""

#: Parts of a month that are written by one task, as a power of two: 8 million numbers.
_PARTS_TOGETHER = 8

_NUMBERS = "column string, value string, number bigint"
_DAYS = "day date, measure string, part bigint, bits binary, sketch binary, amount bigint, of_month date"


@dataclass(frozen=True)
class Trend:
    """What a trend counts: rows, their day, distinct values and sums, by name of the result."""

    rows: Column
    time: str
    distinct: Mapping[str, tuple[str, Column | None]]
    sums: Mapping[str, Column] = field(default_factory=dict)


def _trends() -> dict[str, Trend]:
    effort = {"effort_ms": F.col(_EFFORT)}
    files = F.col(_FIXED_FILES)
    return {
        "build_success_trend": Trend(
            reached("build"),
            "buildStartTime",
            {
                "unique_repos": ("path", None),
                "total_builds": ("buildId", None),
                "successful_builds": ("buildId", succeeded("build")),
                "failed_builds": ("buildId", not_succeeded("build")),
            },
        ),
        "recipe_run_trend": Trend(
            reached("run"),
            "runStartTime",
            {
                "recipe_runs": ("runId", None),
                "distinct_recipes": ("runRecipeId", None),
                "unique_users": ("developer", None),
            },
        ),
        "dashboard_kpis_trend": Trend(
            reached("run"),
            "runStartTime",
            {
                "recipe_runs": ("runId", None),
                "commits": ("commitId", succeeded("commit")),
                "unique_users": ("developer", None),
                "unique_recipes": ("runRecipeId", None),
            },
            effort | {"files_changed": files},
        ),
        "commit_trend": Trend(
            reached("commit"),
            "commitStartTime",
            {
                "commit_jobs": ("commitId", None),
                "recipe_runs": ("runId", None),
                "unique_users": ("developer", None),
                "unique_recipes": ("runRecipeId", None),
                "repos_with_commits": ("path", None),
                "successful_commits": ("commitId", succeeded("commit")),
            },
            effort,
        ),
        "commit_activity": Trend(
            succeeded("commit"),
            "commitStartTime",
            {"unique_repos_changed": ("path", None)},
            effort | {"successful_commits": F.lit(1)},
        ),
        "security_recipe_run_trend": Trend(
            succeeded("commit") & recipe_like(*SECURITY_PATTERNS),
            "commitStartTime",
            {"distinct_recipes": ("runRecipeId", None), "unique_repos_fixed": ("path", None)},
            effort | {"successful_commits": F.lit(1), "files_remediated": files},
        ),
    }


def _trend(report: str) -> Trend:
    trends = _trends()
    if report not in trends:
        raise ValueError(f"{report!r} is not one of {', '.join(trends)}")
    return trends[report]


def _numbers(spark: SparkSession, into: str) -> DataFrame | None:
    try:
        return spark.read.schema(_NUMBERS).parquet(f"{into}/numbers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _number_new(spark: SparkSession, seen: DataFrame, into: str) -> DataFrame:
    """The numbers of all values, after those of ``seen`` (``column``, ``value``, ``day``) that had
    none are given some."""
    new = seen.groupBy("column", "value").agg(F.min("day").alias("day"))
    known, last = _numbers(spark, into), None
    if known is not None:
        new = new.join(known, ["column", "value"], "left_anti")
        last = known.agg(F.max("number")).first()[0]
    # monotonically_increasing_id numbers the rows of task t from t * 2^33; new ones start above.
    start = 1 if last is None else ((last >> 33) + 1 << 33) + 1
    place = ["column", F.asc_nulls_last("day"), "value"]
    numbered = (
        new.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .select("column", "value", (F.monotonically_increasing_id() + start).alias("number"))
    )
    numbered.write.mode("append").parquet(f"{into}/numbers")
    return _numbers(spark, into)


def _seen(rows: DataFrame, trend: Trend) -> DataFrame:
    """Each ``column`` and ``value`` of a ``day`` once, with a bit in ``measures`` for each measure
    of ``trend`` that counts it."""
    marks: dict[str, list[Column]] = {}
    for at, (column, condition) in enumerate(trend.distinct.values()):
        mark = F.lit(1 << at)
        marks.setdefault(column, []).append(
            mark if condition is None else F.when(condition, mark).otherwise(0)
        )
    records = [
        F.struct(
            F.lit(column).alias("column"),
            F.col(column).cast("string").alias("value"),
            reduce(Column.bitwiseOR, of_column).alias("measures"),
        )
        for column, of_column in marks.items()
    ]
    return (
        rows.select(F.col("_day").alias("day"), F.inline(F.array(*records)))
        .where("value IS NOT NULL AND measures != 0")
        .groupBy("day", "column", "value")
        .agg(F.bit_or("measures").alias("measures"))
    )


def _seen_by_measure(seen: DataFrame, trend: Trend) -> DataFrame:
    """``seen`` with a row for each ``measure``."""
    bits = [
        F.when(F.col("measures").bitwiseAND(1 << at) != 0, F.lit(name))
        for at, name in enumerate(trend.distinct)
    ]
    return seen.withColumn("measure", F.explode(F.array_compact(F.array(*bits))))


def _days(
    trace: DataFrame, report: str, into: str, months: Iterable[date] | None, approximate: bool
) -> DataFrame:
    """What :func:`refresh` writes, after new values have their numbers."""
    spark, trend = trace.sparkSession, _trend(report)
    rows = trace.where(trend.rows).withColumn("_day", utc_day(trend.time))
    firsts = None if months is None else sorted({day.replace(day=1) for day in months})
    if firsts is not None:
        rows = rows.where(F.trunc("_day", "month").isin(firsts))
        folder = f"{trend.time.removesuffix('StartTime')}_month"
        if folder in trace.columns:
            rows = rows.where(F.col(folder).isin(firsts))
    seen = _seen(rows, trend)
    sums = {name: F.sum(number.cast("bigint")) for name, number in trend.sums.items()}
    totals = rows.groupBy(F.col("_day").alias("day")).agg(
        F.count(F.lit(1)).alias("_rows"), *[total.alias(name) for name, total in sums.items()]
    )
    amounts = F.array(
        F.struct(F.lit(ROWS).alias("measure"), F.col("_rows").alias("amount")),
        *[F.struct(F.lit(name).alias("measure"), F.col(name).alias("amount")) for name in sums],
    )
    summed = totals.select("day", F.inline(amounts))
    if firsts:
        asked = spark.range(1).select(
            F.explode(F.array(*map(F.lit, firsts))).alias("day"),
            F.lit(ROWS).alias("measure"),
            F.lit(0).cast("bigint").alias("amount"),
        )
        summed = summed.unionByName(asked)
    if approximate:
        counted = _seen_by_measure(seen, trend).groupBy("day", "measure")
        every = counted.agg(F.hll_sketch_agg("value").alias("sketch")).unionByName(
            summed, allowMissingColumns=True
        )
        every = every.withColumns(
            {"part": F.lit(None), "bits": F.lit(None), "of_month": F.trunc("day", "month")}
        )
        # A few files a month: else every task would write one for each of them.
        return _as_days(every.hint("rebalance", "of_month"))
    numbered = seen.join(_number_new(spark, seen, into), ["column", "value"])
    placed = _seen_by_measure(numbered, trend).select(
        "day",
        "measure",
        F.bitmap_bucket_number("number").alias("part"),
        F.bitmap_bit_position("number").alias("position"),
    )
    every = placed.unionByName(summed, allowMissingColumns=True)
    every = every.withColumn("of_month", F.trunc("day", "month"))
    # Numbers travel, not bitmaps: one of 4 KB for each task and part would be sorted at the other
    # end. Sorted as groups, a bitmap is written before the next one begins. A month's tasks are
    # few, so its files are.
    near = every.withColumn("together", F.shiftright("part", _PARTS_TOGETHER)).repartition(
        "of_month", "together"
    )
    bits = near.groupBy("of_month", "day", "measure", "part", "together").agg(
        F.bitmap_construct_agg("position").alias("bits"), F.sum("amount").alias("amount")
    )
    bits = bits.withColumn("bits", F.when(F.col("part").isNotNull(), F.col("bits")))
    return _as_days(bits.withColumn("sketch", F.lit(None)))


def _as_days(every: DataFrame) -> DataFrame:
    kinds = dict(part.split() for part in _DAYS.split(", "))
    every = every.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])
    return every.sortWithinPartitions("of_month", "day", "measure", "part")


def refresh(
    trace: DataFrame,
    report: str,
    into: str,
    months: Iterable[date] | None = None,
    approximate: bool = False,
) -> None:
    """Works out the days of ``report`` anew from ``trace``: those of ``months``, given by any of
    their days, or all it has.

    Months without rows lose what they had. A trace from ``open_store`` is read for ``months`` only.
    """
    into = into.rstrip("/")
    days = _days(trace, report, into, months, approximate)
    writer = days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("of_month").parquet(f"{into}/{report}")


def rollup(spark: SparkSession, report: str, into: str, grain: str = "month") -> DataFrame:
    """``report`` per period of ``grain``, from the days at ``into``.

    The columns and values of the report itself; over days kept as sketches, its distinct counts
    are estimates and called ``approx_…``, and rates are left out.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain!r}")
    trend = _trend(report)
    days = spark.read.schema(_DAYS).parquet(f"{into.rstrip('/')}/{report}")
    month = F.trunc("day", grain).alias("month")
    approximate = not days.where("sketch IS NOT NULL").isEmpty()
    united = days.groupBy(month, "measure", "part").agg(
        *([F.hll_union_agg("sketch").alias("sketch")] if approximate else [F.bitmap_or_agg("bits").alias("bits")]),
        F.sum("amount").alias("amount"),
    )
    count = F.hll_sketch_estimate("sketch") if approximate else F.bitmap_count("bits")

    def of(name: str, value: Column) -> Column:
        return F.sum(F.when(F.col("measure") == name, value))

    label = "approx_" if approximate else ""
    counted = united.groupBy("month").agg(
        of(ROWS, F.col("amount")).alias("_rows"),
        *[F.coalesce(of(name, count), F.lit(0)).alias(label + name) for name in trend.distinct],
        *[of(name, F.col("amount")).alias(name) for name in trend.sums],
    )
    counted = counted.where("_rows > 0")
    if "effort_ms" in trend.sums:
        counted = counted.withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    if "total_builds" in counted.columns:
        rate = percentage(F.col("successful_builds"), F.col("total_builds"))
        counted = counted.withColumn("success_rate_pct", rate)
    names = [label + name if name in trend.distinct else name for name in REPORTS[report].names]
    return counted.select(*[name for name in names if name in counted.columns]).orderBy(
        F.asc_nulls_last("month")
    )
