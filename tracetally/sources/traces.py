"""Trace CSV files in, typed ``trace`` table out.

Trace files differ in their columns (each stage adds some) and in column order, and Spark applies
one header to all files of a scan, by position. So files that share a header are read together, as
text, and these groups meet by column name.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracetally.functions.columns import utc_timestamp
from tracetally.schema import COMMON_COLUMNS, STAGES, TRACE

def _typed(field: T.StructField, source: str | None, kind: T.DataType | None) -> Column:
    """The source column as the documented type: '' is NULL, and so is what does not parse."""
    if source is None:
        return F.lit(None).cast(field.dataType)
    value = F.col(_quoted(source))
    if isinstance(kind, T.StringType):
        value = F.nullif(value, F.lit(""))
    if kind == field.dataType:
        return value
    if isinstance(field.dataType, T.TimestampType):
        return utc_timestamp(value)
    return value.try_cast(field.dataType)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sources(raw: DataFrame) -> dict[str, tuple[str, T.DataType]]:
    """Documented column, in lower case -> its name and type in ``raw``; unknown ones left out."""
    documented = {name.lower() for name in TRACE.names}
    found: dict[str, tuple[str, T.DataType]] = {}
    for field in raw.schema.fields:
        key = field.name.strip().lower()
        if key in documented:
            if key in found:
                raise ValueError(f"column {field.name!r} occurs twice")
            found[key] = (field.name, field.dataType)
    return found


def conform(raw: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """``raw`` with exactly the documented columns and types, matched by name, in any case, and
    after them those in ``keep`` as they are.

    Unknown columns go, missing ones are typed NULLs (so run-only data has empty commit columns),
    empty strings become NULL, and text that does not parse as its type becomes NULL.
    """
    sources = _sources(raw)
    return raw.select(
        *[
            _typed(field, *sources.get(field.name.lower(), (None, None))).alias(field.name)
            for field in TRACE.fields
        ],
        *keep,
    )


#: Column of raw traces with the text of a line that has more or fewer cells than its header.
MALFORMED = "_malformed"


def _whole(raw: DataFrame) -> Column:
    """True for lines with as many cells as the header."""
    return F.col(MALFORMED).isNull() if MALFORMED in raw.columns else F.lit(True)


def _repeats_header(raw: DataFrame) -> Column:
    """True for a header line among the data, as in files that were put end to end.

    A header with other columns fails the query: what follows it would be in the wrong columns.
    """
    sources = _sources(raw)
    names = [name.lower() for name in COMMON_COLUMNS if name.lower() in sources]
    if MALFORMED not in raw.columns or not names:
        return F.lit(False)
    cells = {name: F.lower(F.trim(F.col(_quoted(sources[name][0])))) for name in names}
    same = reduce(and_, [F.coalesce(cells[name] == name, F.lit(False)) for name in names])
    documented = [name.lower() for name in TRACE.names]
    # In whole lines, a cell that names another column; in others, all common names in the line.
    other = reduce(and_, [F.coalesce(cell.isin(documented), F.lit(False)) for cell in cells.values()])
    longer = F.coalesce(_is_header(MALFORMED), F.lit(False))
    wrong = F.raise_error(F.lit("a file has another header further down")).cast("boolean")
    return F.when(longer | (_whole(raw) & other & ~same), wrong).otherwise(same)


def sound(raw: DataFrame) -> DataFrame:
    """The rows of a raw trace that are data, in lines with as many cells as their header."""
    return raw.where(_whole(raw) & ~_repeats_header(raw))


def malformed_lines(raw: DataFrame) -> DataFrame:
    """The text of the lines that :func:`sound` drops as malformed."""
    return raw.where(~_whole(raw) & ~_repeats_header(raw)).select(MALFORMED)


def refusing_malformed(raw: DataFrame) -> DataFrame:
    """``raw``, of which a malformed line fails the query."""
    refused = F.raise_error(F.concat(F.lit("malformed line: "), MALFORMED)).cast("boolean")
    return raw.where(F.when(_whole(raw), True).otherwise(refused))


def loss_counts(raw: DataFrame) -> list[Column]:
    """Aggregates to observe on a raw trace: rows, and what :func:`conform` and :func:`sound` lose."""
    sources = _sources(raw)
    whole, header = _whole(raw), _repeats_header(raw)
    kept = whole & ~header
    counts = [
        F.count_if(kept).alias("rows"),
        F.count_if(~whole).alias("malformed"),
        F.count_if(whole & header).alias("repeated_headers"),
    ]
    for field in TRACE.fields:
        source, kind = sources.get(field.name.lower(), (None, None))
        if source is None or kind == field.dataType:
            continue
        text = F.nullif(F.col(_quoted(source)).cast("string"), F.lit(""))
        lost = text.isNotNull() & _typed(field, source, kind).isNull()
        counts.append(F.count_if(kept & lost).alias(field.name))
    return counts


def conform_counting_rejects(
    raw: DataFrame, keep: Iterable[str] = ()
) -> tuple[DataFrame, Observation]:
    """:func:`conform` of the sound rows, and an observation of what was lost: how many values of
    each typed column did not parse, ``malformed`` lines and ``repeated_headers``.

    The counts are collected while the result is written or otherwise fully read; ``get`` waits.
    """
    counts = loss_counts(raw)
    rejects = Observation()
    return conform(sound(raw.observe(rejects, *counts)), keep), rejects


def _is_header(column: str = "value") -> Column:
    """True for a line that has all the common column names among its fields."""
    line = F.lower(column)
    # Substrings first: they rule out nearly every data line at a fraction of a pattern's cost.
    mentions = [line.contains(name) for name in COMMON_COLUMNS]
    fields = [line.rlike(rf'(^|,)\s*"?{name}"?\s*(,|$)') for name in COMMON_COLUMNS]
    return reduce(and_, mentions + fields)


def _lines(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(list(paths))


def header_groups(spark: SparkSession, paths: Iterable[str]) -> list[list[str]]:
    """Trace files below ``paths``, those with the same header together.

    One pass over the unparsed lines on the executors. The driver gets a name and a hash per file;
    the names it holds for any file scan. Should two headers ever share a hash, the scan of their
    group fails on the difference.
    """
    headers = (
        _lines(spark, paths)
        .where(F.col("_metadata.file_block_start") == 0)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.when(_is_header(), F.xxhash64("value")).alias("header"),
        )
        .distinct()
    )
    files: dict[str, list[int]] = defaultdict(list)
    for file, header in headers.collect():
        files[file] += [] if header is None else [header]
    groups: dict[int, list[str]] = defaultdict(list)
    for file, found in files.items():
        if len(found) != 1:
            raise ValueError(f"{file} has {len(found)} different trace headers instead of one")
        groups[found[0]].append(as_path(file))
    return list(groups.values())


def as_path(uri: str) -> str:
    """A file URI as a literal path for ``spark.read``, which would expand glob characters."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


#: How raw traces are read. A line with too many or too few cells is flagged, which takes looking
#: at all its cells. A file with another header than the scan's fails it instead of swapping columns.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "enforceSchema": False,
    "columnNameOfCorruptRecord": MALFORMED,
    "columnPruning": False,
}


def raw_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])


def read_group(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """Files that share a header, as text columns named by it."""
    first = _lines(spark, paths[:1]).where(_is_header()).first()
    if first is None:
        raise ValueError(f"no trace header below {paths[0]}")
    names = next(csv.reader([first.value]))
    reader = spark.read.schema(raw_schema(names)).options(
        recursiveFileLookup=True, multiLine=multi_line, **CSV_OPTIONS
    )
    return reader.csv(paths)


def read_raw_traces(
    spark: SparkSession,
    *paths: str,
    mixed: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """All trace files below ``paths`` as text columns, joined up by name, all lines included.

    The files below one path must share a header, so give a path per stage. It is taken from the
    first file; the scan checks every file and fails on a different header.
    :data:`MALFORMED` has the text of lines with a wrong number of cells; :func:`sound` drops them.

    ``mixed``       files with different headers lie below the same path: find out which in a pass
                    of its own, which reads every byte once more. Files that arrive between the
                    passes are taken only if all headers were the same.
    ``multi_line``  quoted fields may contain line breaks; such files cannot be split over tasks.
    """
    groups = header_groups(spark, paths) if mixed else [[path] for path in paths]
    if not groups:
        raise ValueError(f"no trace files below {', '.join(paths)}")
    if mixed and len(groups) == 1:
        groups = [list(paths)]
    return reduce(
        lambda united, scan: united.unionByName(scan, allowMissingColumns=True),
        [read_group(spark, files, multi_line) for files in groups],
    )


def read_traces(
    spark: SparkSession, *paths: str, mixed: bool = False, multi_line: bool = False
) -> DataFrame:
    """The typed trace straight from CSV. For more than one report, :func:`ingest` it first."""
    raw = read_raw_traces(spark, *paths, mixed=mixed, multi_line=multi_line)
    return conform(sound(raw))


def job_order() -> list[Column]:
    """The order of rows in a stored file: by depth, then by job."""
    jobs = ("commitOutcome", "runOutcome", "buildOutcome", "commitId", "runId", "buildId")
    return [F.asc_nulls_last(name) for name in jobs]


def clustered(trace: DataFrame) -> DataFrame:
    """Rows of each task ordered by depth and job, without a shuffle.

    Reports keep rows that reached a stage, so row groups and pages that hold none are skipped on
    their statistics, and rows of one job compress well and collapse early when counted.
    """
    return trace.sortWithinPartitions(*job_order())


def save_trace(trace: DataFrame, path: str, mode: str = "append") -> None:
    """Stores a trace as Parquet."""
    clustered(trace).write.mode(mode).parquet(path)


def ingest(
    spark: SparkSession,
    *paths: str,
    into: str,
    mode: str = "append",
    mixed: bool = False,
    multi_line: bool = False,
    malformed: str = "aside",
) -> Mapping[str, int]:
    """CSV files to the Parquet trace at ``into``, read and parsed once and without a shuffle.

    A path per stage, or ``mixed``; see :func:`read_raw_traces`.

    Returns the number of rows, and if there were any, of values that did not parse per column, of
    ``malformed`` lines (more or fewer cells than the header) and of ``repeated_headers``.

    ``malformed``  what becomes of such lines: with ``aside`` they are written as text to a folder
                   next to ``into`` that ends in ``_malformed``, for which the files are read again
                   if there are any; with ``fail`` nothing is stored. They are never in the trace.
    """
    if malformed not in ("aside", "fail"):
        raise ValueError(f"malformed must be aside or fail, not {malformed!r}")
    raw = read_raw_traces(spark, *paths, mixed=mixed, multi_line=multi_line)
    if malformed == "fail":
        raw = refusing_malformed(raw)
    trace, rejects = conform_counting_rejects(raw)
    save_trace(trace, into, mode)
    counts = {name: n for name, n in rejects.get.items() if n or name == "rows"}
    if counts.get("malformed"):
        malformed_lines(raw).write.mode(mode).text(f"{into.rstrip('/')}_malformed")
    return counts


def open_trace(spark: SparkSession, *paths: str) -> DataFrame:
    """The stored trace, of one or several folders.

    The fixed schema spares looking into the files for one. Folders are read one by one, so that
    each may be one that a stream fills, of which only finished batches count.
    """
    return reduce(DataFrame.unionByName, [spark.read.schema(TRACE).parquet(p) for p in paths])


def register_trace(trace: DataFrame, name: str = "trace") -> None:
    """Makes the trace available to SQL text under ``name``."""
    trace.createOrReplaceTempView(name)


def save_table(trace: DataFrame, table: str, mode: str = "append") -> None:
    """Stores a trace as a catalog table, which any SQL tool on the same catalog can query."""
    clustered(trace).write.mode(mode).format("parquet").saveAsTable(table)


def _stage_depth() -> Column:
    """How deep a row got: 1 for sync up to 7 for push, 0 for no stage."""
    depth = F.lit(0)
    for position, stage in enumerate(STAGES, 1):
        depth = F.when(F.col(f"{stage}Outcome").isNotNull(), position).otherwise(depth)
    return depth


#: What the rows of one repository in one run share.
RUN = ("origin", "path", "branch", "developer", "buildId", "runId")
#: What :func:`keyed_by_run` adds.
_KEYS = ("_depth", "_run", "_reached", "_later")


def _stage_position(column: str) -> int:
    """1 for a column of the sync stage up to 7 for one of push, 0 for a column of no stage."""
    for position, stage in enumerate(STAGES, 1):
        if re.match(rf"{stage}[A-Z]", column):
            return position
    return 0


def _digest(parts: Iterable[Column]) -> Column:
    """128 bits of SHA-256 over texts; each part is a text that tells where it ends."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _marked(name: str, kind: T.DataType) -> Column:
    """The value of a column as text with its length ahead; NULL is told from every value."""
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # as groups do, which don't tell -0.0 from 0.0
    value = value.cast("string")
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def keyed_by_run(rows: DataFrame) -> DataFrame:
    """``rows`` with what :func:`deepest_of_run` compares: ``_depth``, and digests of the run
    (``_run``) and of all columns of the stages that a row reached (``_reached``). ``_later`` are
    its columns of later stages, NULL if it has none."""
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    depth, by_stage = F.col("_depth"), {}
    for name in rows.columns:
        if name not in RUN and (at := _stage_position(name)):
            by_stage.setdefault(at, []).append(name)
    reached = [
        F.when(depth >= at, F.concat(*[_marked(name, kinds[name]) for name in names])).otherwise("")
        for at, names in by_stage.items()
    ]
    later = [
        F.when(depth < at, F.col(name)).alias(name) for at, names in by_stage.items() for name in names
    ]
    has_later = reduce(
        or_,
        [
            (depth < at) & F.coalesce(*[F.col(name).cast("string") for name in names]).isNotNull()
            for at, names in by_stage.items()
        ],
    )
    return rows.withColumn("_depth", _stage_depth()).withColumns(
        {
            "_run": _digest(_marked(name, kinds[name]) for name in RUN),
            "_reached": _digest(reached),
            "_later": F.when(has_later, F.struct(*later)),
        }
    )


def deepest_of_run(keyed: DataFrame, *near: str) -> DataFrame:
    """Of the rows of each run those of its deepest stage, and of these that agree in all they
    reached, the one with the largest rest. Columns ``near`` depend on the run, and its rows lie
    together by them already."""
    others = [
        name
        for name in keyed.columns
        if name not in (*RUN, *near, *_KEYS) and not _stage_position(name)
    ]
    rest = [F.desc_nulls_last(name) for name in ("_later", *others)]
    run = Window.partitionBy(*near, "_run").orderBy(F.desc("_depth"), "_reached", *rest)
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = keyed.withColumns(
        {"_deepest": F.first("_depth").over(so_far), "_before": F.lag("_reached").over(run)}
    )
    again = F.col("_reached").eqNullSafe(F.col("_before"))
    return marked.where((F.col("_depth") == F.col("_deepest")) & ~again).drop(*_KEYS, "_deepest", "_before")


def deepest_stage(trace: DataFrame) -> DataFrame:
    """Drops rows of a run that a later stage's trace repeats. Optional; reports do not call it.

    A later command repeats all earlier stages, so loading the run files and the commit files of
    the same work counts its rows and sums twice (distinct counts are immune). Of the rows with
    the same repository, branch, developer, build and run, those of the deepest stage stay, and of
    these, one of each that agree in all columns of the stages they reached: a repository that got
    equally far in both files counts once, several commits of one run all stay. Rows without a run
    stay as they are and take part in no shuffle.

    Rows travel once, and with the columns that are asked of the result: what is compared travels
    as digests of 128 bits. The rows of one run in one repository meet in one task, which needs no
    memory for them all.
    """
    with_run = trace.where(F.col("runId").isNotNull())
    return trace.where(F.col("runId").isNull()).unionByName(deepest_of_run(keyed_by_run(with_run)))
