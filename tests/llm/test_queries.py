"""The registered corpus queries and the pipeline on the test tables."""

from __future__ import annotations

import struct
import zlib

import brute
import duckdb
import pytest
import xxhash
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tracetally.llm import queries
from tracetally.llm.common import stored

TABLES = ("documents", "pages", "benchmark", "labels")
NATIVE = ("op1_decontamination", "op2_sharding", "op3_secrets", "op5_urls", "op7_mixing", "op8_rules")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run
    assert queries.oracle_sql().keys() <= names.keys()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_matches_duckdb(spark, tables, name):
    got = queries.queries()[name](spark, SF_DIR)
    want = tables.execute(queries.oracle_sql()[name])
    assert got.columns == [column[0] for column in want.description]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan_has_no_python(spark, name):
    plan = queries.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_sharding_query(spark, tables):
    docs = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    got = queries.queries()["op2_sharding"](spark, SF_DIR).toPandas()
    assert list(got.columns) == ["doc_id", "size", "text_crc32", "law", "shard", "grown_shard", "slot"]
    want = []
    for doc, text in docs:
        raw = (text or "").encode()
        key = xxhash.xxh64_intdigest(struct.pack("<q", doc), 42)
        want.append((doc, len(raw) + 1, zlib.crc32(raw), "key", brute.jump(key, 8), brute.jump(key, 9)))
    assert sorted(got.drop(columns="slot").itertuples(index=False, name=None)) == sorted(want)
    assert set(got["shard"]) == set(range(8))
    for _, rows in got.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))


def test_mixing_query(spark, tables):
    docs = tables.execute("SELECT doc_id, source, text FROM documents").fetchall()
    size = {doc: len(brute.WHITE_WORD.findall(text or "")) for doc, _, text in docs}
    of = {}
    for doc, source, _ in docs:
        of[source] = of.get(source, 0) + size[doc]
    want = brute.targets(of)
    query = queries.queries()["op7_mixing"]
    got = query(spark, SF_DIR).collect()
    assert sorted(row.doc_id for row in got) == sorted(doc for doc, _, _ in docs)
    source, taken = {doc: source for doc, source, _ in docs}, dict.fromkeys(of, 0)
    for row in got:
        assert row["size"] == size[row.doc_id] and row.source_size == of[source[row.doc_id]]
        assert row.target == pytest.approx(want[source[row.doc_id]])
        assert row.taken % max(row["size"], 1) == 0 and 0 <= row.taken <= 2 * row["size"]
        taken[source[row.doc_id]] += row.taken
    assert all(abs(taken[source] - want[source]) <= 0.01 * want[source] + 1 for source in of)
    again = query(spark, SF_DIR).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_near_duplicates_query(spark, tables):
    docs = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    got = queries.queries()["op6_neardup"](spark, SF_DIR).collect()
    assert {tuple(row) for row in got} == brute.near(docs, 85)


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF_DIR)))
    rows = lambda frame: [tuple(r) for r in frame.select("doc_id", "text").collect()]
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    assert all(frame.columns == columns for frame in kept[:-1])
    scores = queries.queries()["op4_quality"](spark, SF_DIR).where("predicted = 1")
    assert ids(kept[1]) == ids(scores)
    assert ids(kept[2]) == {doc for doc, _, _, alone in brute.near(rows(kept[1]), 80) if alone}
    items = tables.execute("SELECT item_id, text FROM benchmark").fetchall()
    dirty = {row[0] for row in brute.contaminated(rows(kept[2]), items) if row[5]}
    assert dirty and ids(kept[3]) == ids(kept[2]) - dirty
    assert ids(kept[4]) <= ids(kept[3])
    assert kept[4].groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    last = kept[5].toPandas()
    assert len(last) == kept[4].count()
    for _, shard in last.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(last)


def test_pipeline_stages_take_empty_tables_and_nulls(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(20)
    odd = docs.select(*[F.lit(None).cast(kind).alias(name) for name, kind in docs.dtypes])
    for rows in (docs.limit(0), docs.limit(3).union(odd.limit(2)).union(docs.limit(3))):
        rows = stored(rows)
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF_DIR).count() >= 0


def test_pipeline_filters_decide_row_by_row(spark, tables):
    item = tables.execute("SELECT text FROM benchmark ORDER BY length(text) DESC").fetchone()[0]
    prose = [" ".join(f"{name}{at}" for at in range(40)) for name in "abc"]
    rows = [(None, prose[0]), (None, prose[0]), (7, prose[0]), (7, prose[0]), (7, prose[1])]
    rows += [(8, prose[1]), (9, prose[1] + " z"), (None, prose[2]), (None, prose[2]), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for table in (docs, stored(docs.repartition(3))):
        got = corpus_pipeline.one_of_each(spark, table, SF_DIR).collect()
        want = [(7, prose[0]), (7, prose[1]), (None, prose[2]), (10, None)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    rows = [(None, item), (None, prose[0]), (7, item), (7, prose[0]), (7, prose[0]), (8, None)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = corpus_pipeline.uncontaminated(spark, docs, SF_DIR).collect()
    want = [row for row in rows if row[1] != item]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_pipeline_leaves_all_columns_as_they_are(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["file_path", "row_index", "_row", "_file", "_path", "_at", "score", "predicted", "size", "target", "rate",
             "copies", "taken", "_copy", "_key", "_nth", "_of", "_gap", "mean", "_held0", "_own0", "a`b", "c.d", "id",
             "label", "quality", "n", "hash", "row", "pos", "t", "_start", "_place", "_metadata", "component_id"]
    wide = docs.withColumns({name: F.lit(at) for at, name in enumerate(names)})
    plain, kept = stored(docs), stored(wide)
    for _, stage in corpus_pipeline.STAGES:
        plain, kept = stored(stage(spark, plain, SF_DIR)), stored(stage(spark, kept, SF_DIR))
        assert kept.columns[: len(wide.columns)] == wide.columns
        quoted = [F.col("`" + name.replace("`", "``") + "`") for name in names]
        assert [tuple(row) for row in kept.select(*quoted).distinct().collect()] == [tuple(range(len(names)))]
        rows = lambda frame: sorted(map(tuple, frame.select("doc_id", "text").collect()))
        assert rows(plain) == rows(kept)
    assert kept.columns == [*wide.columns, "shard", "slot"]
