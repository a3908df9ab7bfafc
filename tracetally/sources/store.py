"""A stored trace that takes each published file once and is read by period.

``rows``   the trace, in folders by load and by the months in which commit, run and build started
``files``  path, length and modification time of every file, by load
``loads``  one row for each finished load: what is not listed here was never loaded

A load writes its rows, then its files, then its one row in ``loads``, a single small file that is
there or not. A run that dies before that leaves rows that nobody reads; the next run over the same
files has the same name, taken from the files, and replaces them. A file that was published again
with another length or time is loaded again, and the rows of its earlier version no longer count.
One load at a time may write.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Mapping
from datetime import date, datetime, time, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracetally.functions.columns import period_start, utc_timestamp
from tracetally.schema import TRACE
from tracetally.sources.traces import (
    as_path,
    conform_counting_rejects,
    header_groups,
    job_order,
    malformed_lines,
    read_group,
    refusing_malformed,
)

#: Stages whose month of start is a folder of its own.
MONTHS = {"commit": "commit_month", "run": "run_month", "build": "build_month"}
FILE, LOAD = "_file", "load"
_VERSION = (FILE, "bytes", "modified")

_ROWS = T.StructType(
    [
        *TRACE.fields,
        T.StructField(FILE, T.StringType()),
        T.StructField(LOAD, T.StringType()),
        *[T.StructField(name, T.DateType()) for name in MONTHS.values()],
    ]
)
_FILES = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField(LOAD, T.StringType()),
    ]
)
_LOADS = T.StructType(
    [T.StructField(LOAD, T.StringType()), T.StructField("number", T.LongType()), T.StructField("rows", T.LongType())]
)


def _open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def listing(spark: SparkSession, *paths: str) -> DataFrame:
    """The files below ``paths``: name, length, modification time, and which of the paths it was.
    Nothing is read of them."""
    found = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.lit(at).alias("source"),
        )
        for at, path in enumerate(paths)
    ]
    return reduce(DataFrame.union, found).groupBy(*_VERSION).agg(F.min("source").alias("source"))


def _loads(spark: SparkSession, into: str) -> DataFrame:
    """Each finished load with the number of its last time."""
    rows = _open(spark, f"{into}/loads", _LOADS)
    return rows.groupBy(LOAD).agg(F.max("number").alias("number"))


def _versions(spark: SparkSession, into: str) -> DataFrame:
    """Every version of every file in finished loads."""
    return _open(spark, f"{into}/files", _FILES).join(_loads(spark, into), LOAD)


def loaded_files(spark: SparkSession, into: str) -> DataFrame:
    """The files whose rows make up the trace at ``into``: the last version of each, and its load."""
    last = F.max(F.struct("number", "bytes", "modified", LOAD)).alias("last")
    return (
        _versions(spark, into)
        .groupBy(FILE)
        .agg(last)
        .select(FILE, "last.bytes", "last.modified", f"last.{LOAD}")
    )


def ingest_new(
    spark: SparkSession,
    *paths: str,
    into: str,
    mixed: bool = False,
    multi_line: bool = False,
    malformed: str = "aside",
    rebalance: bool = False,
) -> Mapping[str, int]:
    """Loads those trace files below ``paths`` that the trace at ``into`` does not have yet.

    As :func:`tracetally.sources.traces.ingest`, a path per stage or ``mixed``, and the same counts,
    with ``files``, how many there were. ``malformed`` lines are set aside in a folder of ``into``.
    Rows are written by the tasks that read them. ``rebalance`` shuffles them by month first, for a
    first load of many years, in which each task would write a file to each of them; Spark splits a
    month that is too large for a task.
    """
    if malformed not in ("aside", "fail"):
        raise ValueError(f"malformed must be aside or fail, not {malformed!r}")
    into = into.rstrip("/")
    listed = listing(spark, *paths)
    new = listed.join(loaded_files(spark, into).select(*_VERSION), list(_VERSION), "left_anti")
    # The names that any scan of these files holds on the driver.
    found = sorted(new.select(*[F.col(name).cast("string") for name in _VERSION], "source").collect())
    if not found:
        return {"rows": 0, "files": 0}
    load = hashlib.sha256(repr([tuple(row)[:3] for row in found]).encode()).hexdigest()[:32]

    by_path = defaultdict(list)
    for row in found:
        by_path[row.source].append(as_path(row[FILE]))
    files = [name for names in by_path.values() for name in names]
    groups = header_groups(spark, files) if mixed else list(by_path.values())
    raw = reduce(
        lambda united, scan: united.unionByName(scan, allowMissingColumns=True),
        [
            read_group(spark, names, multi_line).withColumn(FILE, F.col("_metadata.file_path"))
            for names in groups
        ],
    )
    if malformed == "fail":
        raw = refusing_malformed(raw)
    trace, rejects = conform_counting_rejects(raw, keep=(FILE,))
    months = {name: period_start(f"{stage}StartTime") for stage, name in MONTHS.items()}
    rows = trace.withColumns({LOAD: F.lit(load)} | months)
    if rebalance:
        rows = rows.hint("rebalance", *MONTHS.values())
    _replace(rows.sortWithinPartitions(*MONTHS.values(), *job_order()), f"{into}/rows", LOAD, *MONTHS.values())
    counts = {name: n for name, n in rejects.get.items() if n or name == "rows"}
    if counts.get("malformed"):
        malformed_lines(raw).write.mode("overwrite").text(f"{into}/malformed/{LOAD}={load}")
    versions = spark.createDataFrame([(row[FILE], row.source) for row in found], f"{FILE} string, source int")
    known = listed.join(versions, [FILE, "source"]).select(*_VERSION, F.lit(load).alias(LOAD))
    _replace(known, f"{into}/files", LOAD)
    _finish(spark, into, load, counts["rows"])
    return counts | {"files": len(found)}


def _replace(frame: DataFrame, path: str, *folders: str) -> None:
    """Writes ``frame`` in ``folders``, in place of what those that it has rows for held."""
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)


def _finish(spark: SparkSession, into: str, load: str, rows: int) -> None:
    last = _loads(spark, into).agg(F.max("number")).first()[0] or 0
    row = spark.range(1, numPartitions=1).select(
        F.lit(load).alias(LOAD), F.lit(last + 1).cast("long").alias("number"), F.lit(rows).cast("long").alias("rows")
    )
    row.write.mode("append").parquet(f"{into}/loads")


def open_store(spark: SparkSession, into: str) -> DataFrame:
    """The trace at ``into``, and the month columns that :func:`within` prunes by."""
    into = into.rstrip("/")
    # One short name for each load.
    finished = sorted(row[0] for row in _loads(spark, into).select(LOAD).collect())
    rows = _open(spark, f"{into}/rows", _ROWS).where(F.col(LOAD).isin(finished))
    current = loaded_files(spark, into).select(LOAD, FILE)
    replaced = _versions(spark, into).select(LOAD, FILE).join(current, [LOAD, FILE], "left_anti")
    if not replaced.isEmpty():
        rows = rows.join(replaced, [LOAD, FILE], "left_anti")
    return rows.select(*TRACE.names, *MONTHS.values())


def _midnight(day: date) -> Column:
    return F.lit(datetime.combine(day, time(), timezone.utc))


def within(trace: DataFrame, stage: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows whose ``stage`` started on the UTC day ``start`` or later, and before ``end``.

    Of a trace from :func:`open_store`, only the folders of those months are read, for the stages
    that have some. Rows without a time of that stage are in no period.
    """
    at, month = utc_timestamp(F.col(f"{stage}StartTime")), MONTHS.get(stage)
    wanted = [at.isNotNull()]
    if start is not None:
        wanted.append(at >= _midnight(start))
    if end is not None:
        wanted.append(at < _midnight(end))
    if month in trace.columns:
        if start is not None:
            wanted.append(F.col(month) >= F.lit(start.replace(day=1)))
        if end is not None:
            wanted.append(F.col(month) <= F.lit((end - timedelta(days=1)).replace(day=1)))
        wanted.append(F.col(month).isNotNull())
    return trace.where(reduce(Column.__and__, wanted))
