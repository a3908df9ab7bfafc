"""Trends without holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sums, which are NULL and not 0 where nothing happened.
SUMS = ("files_changed", "files_remediated")


def dense(report: DataFrame, bucket: str = "month", grain: str = "month") -> DataFrame:
    """A trend with a row for every period between its first and its last one.

    Added periods have 0 for counts and NULL for sums, hours and rates. The row of the NULL period
    stays, as the last one. The report is worked out once: each of its rows, one a period, fills
    the gap up to the next.
    """
    steps = {"week": "7 DAYS", "month": "1 MONTH", "quarter": "3 MONTHS", "year": "1 YEAR"}
    if grain not in steps:
        raise ValueError(f"grain must be one of {', '.join(steps)}, not {grain!r}")
    after = F.lead(bucket).over(Window.orderBy(F.asc_nulls_last(bucket)))
    until = F.coalesce(F.date_sub(after, 1), F.col(bucket))
    periods = F.sequence(F.col(bucket), until, F.expr(f"INTERVAL {steps[grain]}"))
    filled = report.withColumn("_until", periods).select(
        *report.columns, F.explode_outer("_until").alias("_period")
    )
    given = F.col("_period").eqNullSafe(F.col(bucket))

    def value(name: str, kind: str) -> Column:
        if name == bucket:
            return F.col("_period").alias(name)
        missing = F.lit(0 if kind == "bigint" and name not in SUMS else None).cast(kind)
        return F.when(given, F.col(name)).otherwise(missing).alias(name)

    return filled.select(*[value(name, kind) for name, kind in report.dtypes]).orderBy(
        F.asc_nulls_last(bucket)
    )
