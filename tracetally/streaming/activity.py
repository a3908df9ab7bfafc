"""Committed output per period from a stream: what adds up is kept as state, by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracetally.functions.columns import GRAINS, hours, succeeded
from tracetally.sources.traces import CSV_OPTIONS, conform, loss_counts, raw_schema, sound
from tracetally.streaming.follow import LOSSES

_DAYS = "day date, successful_commits bigint, effort_ms bigint, batch bigint"


def follow_activity(
    spark: SparkSession,
    source: str,
    into: str,
    checkpoint: str,
    header: Sequence[str],
    late: str = "30 days",
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Adds every file in ``source`` once to the counts and sums of its days, and stops when it has
    caught up; call it again for the files that have come since.

    A day's state is kept until the latest commit seen is ``late`` ahead of its end. Until then rows
    may come in any order; later ones are dropped, and Spark counts them. Each batch writes the days
    it changed to a folder of its own, which a repeated batch replaces. Rows without a commit time
    are in no day. Distinct counts are not among them: they do not add up.
    """
    raw = (
        spark.readStream.schema(raw_schema(header))
        .options(maxFilesPerTrigger=files_per_batch, **CSV_OPTIONS)
        .csv(source)
    )
    days = (
        conform(sound(raw.observe(LOSSES, *loss_counts(raw))))
        .where(succeeded("commit"))
        .withWatermark("commitStartTime", late)
        .groupBy(F.window("commitStartTime", "1 day").alias("window"))
        .agg(
            F.count(F.lit(1)).alias("successful_commits"),
            F.sum("runEstimatedEffortTimeSavingsMs").alias("effort_ms"),
        )
    )
    day = F.date_from_unix_date((F.unix_seconds("window.start") / 86400).cast("int")).alias("day")

    def write(batch: DataFrame, number: int) -> None:
        changed = batch.select(day, "successful_commits", "effort_ms")
        changed.write.mode("overwrite").parquet(f"{into.rstrip('/')}/batch={number}")

    return (
        days.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def followed_activity(spark: SparkSession, into: str, grain: str = "month") -> DataFrame:
    """``month``, ``successful_commits`` and ``estimated_hours_saved`` of the days at ``into``, as the
    ``commit_activity`` report has them. A day counts as its last batch left it."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain!r}")
    last = F.max(F.struct("batch", "successful_commits", "effort_ms")).alias("last")
    return (
        spark.read.schema(_DAYS)
        .parquet(into)
        .groupBy("day")
        .agg(last)
        .groupBy(F.trunc("day", grain).alias("month"))
        .agg(
            F.sum("last.successful_commits").alias("successful_commits"),
            hours(F.sum("last.effort_ms")).alias("estimated_hours_saved"),
        )
        .orderBy("month")
    )
