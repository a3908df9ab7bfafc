"""How long shuffle files stay."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query of the session go when it ends. Else they stay until
    the driver happens to collect its garbage, and those of several steps add up."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
