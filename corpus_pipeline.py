"""Training corpus: quality, near duplicates, decontamination, mixing, shards.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns rows
with the columns of documents; the last one adds ``shard`` and ``slot``. Filters decide row by row,
on a row's own text, whether or not its id is NULL or repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracetally.llm import mixing, neardup, phrases, quality, sharding
from tracetally.llm.common import stored, without


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _own_names(docs: DataFrame) -> list[str]:
    """A name for each column that no operator uses, so that any column comes back as it was."""
    return [f"_own{at}" for at in range(len(docs.columns))]


def _aside(docs: DataFrame, *needed: str | Column) -> DataFrame:
    """All columns of ``docs`` under names of their own, and those ``needed`` under theirs."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in docs.columns]
    own = [F.col(name).alias(at) for name, at in zip(quoted, _own_names(docs), strict=True)]
    return docs.select(*own, *needed)


def _back(rows: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` from rows that have them aside, and ``more``."""
    own = [F.col(at).alias(name) for name, at in zip(docs.columns, _own_names(docs), strict=True)]
    return rows.select(*own, *more)


def _numbered(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` aside, with ``_row``: a number for every row, the same whenever it is read.

    It is made of the name of the row's file and its place there, so ``docs`` is read from files;
    any other table is stored first.
    """
    rows = _aside(docs, *needed)
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at")]
    try:
        placed = None if "_metadata" in docs.columns else _aside(docs, *needed, *place)
    except AnalysisException:
        placed = None
    while placed is None or not _same_hash(placed).isEmpty():
        placed = stored(rows).select("*", *place)
    # Places in a file stay below 2^41, so two rows have one number only if their files share a hash.
    row = F.xxhash64("_path").cast("decimal(20,0)") * F.lit(1 << 41).cast("decimal(13,0)") + F.col("_at")
    return placed.select(*rows.columns, row.cast("decimal(38,0)").alias("_row"))


def _same_hash(placed: DataFrame) -> DataFrame:
    """Hashes that two files have."""
    files = placed.select("_path").distinct().groupBy(F.xxhash64("_path").alias("_hash"))
    return files.agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = quality.classify(_aside(docs, "doc_id", "text"), _table(spark, sf_dir, "labels"))
    return _back(scored.where("predicted = 1"), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near duplicates. Rows that repeat an id
    are told apart by their place; rows without an id come last."""
    rows = _numbered(docs, "doc_id", "text")
    found = neardup.near_duplicates(rows, key="_row", percent=80)
    groups = stored(found.select("_row", F.col("component_id").alias("_group")))
    ids = rows.select("_row", "doc_id")
    # Rows that are alone are in no group, and most are.
    most = groups.count()
    several = stored(
        groups.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), most=most
    )
    members = stored(groups.join(several, "_group").select("_row", "_group").join(ids, "_row"))
    first = members.groupBy("_group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row")
    )
    others = stored(members.select("_row").join(first.select("_row"), "_row", "left_anti"))
    return _back(rows.join(others, "_row", "left_anti"), docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a run of ten words, or a whole shorter item, of the benchmark."""
    rows = _numbered(docs, "text")
    texts = rows.select("_row", "text")
    found = phrases.decontaminate(texts, _table(spark, sf_dir, "benchmark"), key="_row")
    dirty = stored(found.where("contaminated").select("_row"))
    return _back(rows.join(dirty, "_row", "left_anti"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    taken = mixing.mix(_aside(docs, "doc_id", "source", "text")).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return _back(taken.select("*", copies), docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ``shard`` of eight and its ``slot`` there, in place of columns of those
    names."""
    docs = without(docs, "shard", "slot")
    return _back(sharding.shard(_aside(docs, "doc_id"), "doc_id", shards=8), docs, "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]
#: A trained classifier has no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of the documents in ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
