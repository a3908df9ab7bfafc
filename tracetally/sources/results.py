"""Report results as files: the CSV form charts and BI tools read, or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracetally.schema import REPORTS


def write_report(
    result: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", one_file: bool = False
) -> None:
    """Writes a result below ``path``, CSV with a header line.

    A sorted result keeps its order over the part files. ``one_file`` suits reports per period or
    tool and limited rankings, which stay small whatever the trace holds; it is one task.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"fmt must be csv or parquet, not {fmt!r}")
    writer = (result.coalesce(1) if one_file else result).write.mode(mode)
    if fmt == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    else:
        writer.parquet(path)


def read_report(spark: SparkSession, path: str, report: str, fmt: str = "csv") -> DataFrame:
    """Reads a stored result with its documented types; ``month`` comes back as a date.

    A CSV whose header is not that of ``report`` fails the read.
    """
    reader = spark.read.schema(REPORTS[report])
    if fmt == "parquet":
        return reader.parquet(path)
    return reader.options(header=True, quote='"', escape='"', enforceSchema=False).csv(path)
