"""What several operators share: the shared folder, written intermediate tables, words."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
#: Rows for which a frame gets one more task, where a bound of its rows is known, and the same for
#: rows that hold texts, sets or signatures.
TASK_ROWS = 20_000
WIDE_ROWS = 2_000


def ship(module: str) -> None:
    """Sends the functions of ``module`` to executors by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only where the session names none, as in tests,
    a temporary folder takes its place.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='llm-')}"
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def few(frame: DataFrame, most: int, rows: int = TASK_ROWS) -> DataFrame:
    """``frame``, of at most ``most`` rows, in one task per ``rows`` of these but one per core at least,
    or four per core where rows are wide.

    A table that has few rows is thus not dealt to as many tasks as there are shuffle partitions; a
    large one stays as it is. Nothing is shuffled for it.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.coalesce(max(cores * (4 if rows < TASK_ROWS else 1), -(-most // rows)))


def stored(frame: DataFrame, folder: str | None = None, most: int | None = None) -> DataFrame:
    """``frame`` written to the shared folder and read again: lineage ends, and its size is known.

    Each task writes a file. ``most``, if known, is a bound of the rows, see ``few``.
    """
    if most is not None:
        frame = few(frame, most)
    path = folder or shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def white_words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def without(frame: DataFrame, *names: str) -> DataFrame:
    """``frame`` without the columns that an operator is about to add, in any case."""
    taken = {name.lower() for name in names}
    return frame.drop(*[name for name in frame.columns if name.lower() in taken])
