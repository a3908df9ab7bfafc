"""Traces are published all the time: append new files to the stored trace as they arrive."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracetally.schema import TRACE
from tracetally.sources.latest import merge_latest
from tracetally.sources.traces import CSV_OPTIONS, conform, loss_counts, raw_schema, sound

#: Name of the counts in a batch's ``observedMetrics``.
LOSSES = "losses"


def follow_traces(
    spark: SparkSession,
    source: str,
    into: str,
    checkpoint: str,
    header: Sequence[str],
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Ingests every file in ``source`` once, those there now, and stops when it has caught up.

    Call it again, from a scheduler, for the files that have come since; ``checkpoint`` remembers
    those done, also across a lost driver, and the Parquet sink commits a batch whole or not at
    all. All files must share ``header``; a different one fails the batch, so use a source folder
    per stage. ``into`` must be a folder of its own, which ``open_trace`` reads together with
    others. Malformed lines and repeated headers are left out, and counted like all losses in each
    batch's ``observedMetrics``, as ``ingest`` counts them. Reports stay batch queries over the result: exact distinct counts need all of a period.
    """
    raw = (
        spark.readStream.schema(raw_schema(header))
        .options(maxFilesPerTrigger=files_per_batch, **CSV_OPTIONS)
        .csv(source)
    )
    return (
        conform(sound(raw.observe(LOSSES, *loss_counts(raw))))
        .writeStream.format("parquet")
        .option("path", into)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_latest(
    spark: SparkSession,
    source: str,
    into: str,
    checkpoint: str,
    header: Sequence[str],
    buckets: int = 256,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """As :func:`follow_traces`, but into a trace that :func:`tracetally.sources.latest.open_latest`
    reads: deeper files replace the rows of runs that they repeat.

    Use one call per stage's folder, with a checkpoint each and the same ``into``, one after the
    other. A batch is read once and set down in ``into`` before it is merged. It is named after its
    files, so one that is repeated after a lost driver, or under a new checkpoint, changes nothing.
    """
    raw = (
        spark.readStream.schema(raw_schema(header))
        .options(maxFilesPerTrigger=files_per_batch, **CSV_OPTIONS)
        .csv(source)
    )
    version = F.concat_ws("@", "_metadata.file_path", F.col("_metadata.file_modification_time").cast("string"))
    taken = f"{into.rstrip('/')}/taken"

    def merge(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(taken)
        rows = spark.read.schema(batch.schema).parquet(taken)
        # At most files_per_batch names.
        files = sorted(row[0] for row in rows.select("_file").distinct().collect())
        merge_latest(rows.select(*TRACE.names), into, hashlib.sha256(repr(files).encode()).hexdigest(), buckets)

    named = raw.withColumn("_file", version)
    return (
        conform(sound(named.observe(LOSSES, *loss_counts(raw))), keep=("_file",))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
