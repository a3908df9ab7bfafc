"""The stored trace that takes each file once and is read by period."""

from __future__ import annotations

from datetime import date

import pytest
from micro import S, as_tuples
from pyspark.sql import functions as F
from test_ingest import COMMIT, RUN, commit_line, run_line, write

from tracetally.plans import reports
from tracetally.schema import TRACE
from tracetally.sources import store
from tracetally.sources.store import ingest_new, loaded_files, open_store, within

RUN_COMMIT = "origin,path,branch,developer,runOutcome,runStartTime,runId,commitOutcome,commitStartTime,commitId"


def activity(spark, into):
    return as_tuples(reports.commit_activity(open_store(spark, into)))


def rows_of(spark, into):
    return sorted(map(repr, open_store(spark, into).select(*TRACE.names).collect()))


def at(day, path="o/a", run="2024-01-05T00:00:00Z", commit="c1"):
    return f"gh,{path},main,al,{S},{run},u1,{S},{day},{commit}"


def test_the_same_files_again_add_nothing(spark, tmp_path):
    source, into = str(tmp_path / "in"), str(tmp_path / "trace")
    write(tmp_path / "in" / "a.csv", COMMIT, commit_line("o/a"), commit_line("o/b"))
    assert ingest_new(spark, source, into=into) == {"rows": 2, "files": 1}
    first = activity(spark, into)
    assert ingest_new(spark, source, into=into) == {"rows": 0, "files": 0}
    assert activity(spark, into) == first and first[0][1] == 2
    write(tmp_path / "in" / "deeper" / "b.csv", COMMIT, commit_line("o/c"))
    assert ingest_new(spark, source, into=into) == {"rows": 1, "files": 1}
    assert activity(spark, into)[0][1] == 3
    assert ingest_new(spark, source, source, into=into) == {"rows": 0, "files": 0}


def test_a_path_per_stage_or_mixed_headers(spark, tmp_path):
    into = [str(tmp_path / name) for name in "xy"]
    write(tmp_path / "in" / "run" / "a.csv", RUN, run_line("o/a"), run_line("o/b", "u2"))
    write(tmp_path / "in" / "commit" / "b.csv", COMMIT, commit_line("o/c", "u3"))
    paths = [str(tmp_path / "in" / name) for name in ("run", "commit")]
    assert ingest_new(spark, *paths, into=into[0]) == {"rows": 3, "files": 2}
    assert ingest_new(spark, str(tmp_path / "in"), into=into[1], mixed=True) == {"rows": 3, "files": 2}
    assert rows_of(spark, into[0]) == rows_of(spark, into[1])
    with pytest.raises(Exception, match="(?i)header"):
        ingest_new(spark, str(tmp_path / "in"), into=str(tmp_path / "z"))


@pytest.mark.parametrize("step", ["_finish", "_replace"])
def test_a_load_that_died_repeats_to_the_same_table(spark, tmp_path, monkeypatch, step):
    source, into = str(tmp_path / "in"), str(tmp_path / "trace")
    write(tmp_path / "in" / "a.csv", COMMIT, commit_line("o/a"))
    ingest_new(spark, source, into=into)
    write(tmp_path / "in" / "b.csv", COMMIT, commit_line("o/b"), commit_line("o/c"))
    real, calls = getattr(store, step), []

    def dies(*args):
        calls.append(args)
        if step == "_finish" or len(calls) == 2:
            raise KeyboardInterrupt
        real(*args)

    monkeypatch.setattr(store, step, dies)
    with pytest.raises(KeyboardInterrupt):
        ingest_new(spark, source, into=into)
    monkeypatch.undo()
    assert activity(spark, into)[0][1] == 1
    assert ingest_new(spark, source, into=into) == {"rows": 2, "files": 1}
    assert activity(spark, into)[0][1] == 3
    # A third file that comes after a dead load makes another load; the dead one stays unread.
    monkeypatch.setattr(store, "_finish", dies)
    write(tmp_path / "in" / "c.csv", COMMIT, commit_line("o/d"))
    if step == "_finish":
        with pytest.raises(KeyboardInterrupt):
            ingest_new(spark, source, into=into)
    monkeypatch.undo()
    write(tmp_path / "in" / "d.csv", COMMIT, commit_line("o/e"))
    assert ingest_new(spark, source, into=into) == {"rows": 2, "files": 2}
    assert activity(spark, into)[0][1] == 5


def test_a_file_published_again_replaces_its_rows(spark, tmp_path):
    source, into = str(tmp_path / "in"), str(tmp_path / "trace")
    write(tmp_path / "in" / "a.csv", COMMIT, commit_line("o/a"), commit_line("o/b"))
    write(tmp_path / "in" / "b.csv", COMMIT, commit_line("o/c"))
    ingest_new(spark, source, into=into)
    write(tmp_path / "in" / "a.csv", COMMIT, commit_line("o/a"), commit_line("o/b"), commit_line("o/x"))
    assert ingest_new(spark, source, into=into) == {"rows": 3, "files": 1}
    assert activity(spark, into)[0][1] == 4
    assert sorted(r.path for r in open_store(spark, into).collect()) == ["o/a", "o/b", "o/c", "o/x"]
    assert loaded_files(spark, into).count() == 2
    assert ingest_new(spark, source, into=into)["files"] == 0


def test_odd_names_malformed_lines_and_nothing_at_all(spark, tmp_path):
    source, into = str(tmp_path / "in"), str(tmp_path / "trace")
    (tmp_path / "in").mkdir()
    assert ingest_new(spark, source, into=into) == {"rows": 0, "files": 0}
    assert open_store(spark, into).isEmpty() and loaded_files(spark, into).isEmpty()
    write(tmp_path / "in" / "a b[1]{x}%20é.csv", COMMIT, commit_line(), "gh,short", "gh,o/a,main,al,,not a time,,,,,,")
    got = ingest_new(spark, source, into=into)
    assert got == {"rows": 2, "files": 1, "malformed": 1, "runStartTime": 1}
    assert [r[0] for r in spark.read.text(f"{into}/malformed").select("value").collect()] == ["gh,short"]
    with pytest.raises(Exception, match="malformed line"):
        ingest_new(spark, source, into=str(tmp_path / "other"), malformed="fail")
    assert open_store(spark, str(tmp_path / "other")).isEmpty()
    assert ingest_new(spark, source, into=into) == {"rows": 0, "files": 0}


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("months")
    days = ["2024-01-31T23:59:59Z", "2024-02-01T00:00:00Z", "2024-02-29T12:00:00Z", "2024-03-01T00:00:00+01:00",
            "2024-03-01T00:00:00Z", "2024-04-15T08:00:00Z", "no time", ""]
    lines = [at(day, f"o/{n}", commit=f"c{n}") for n, day in enumerate(days)]
    write(folder / "in" / "a.csv", RUN_COMMIT, *lines)
    ingest_new(spark, str(folder / "in"), into=str(folder / "trace"), rebalance=True)
    return str(folder / "trace")


def scans(frame):
    leaves = frame._jdf.queryExecution().sparkPlan().collectLeaves()
    return [leaves.apply(at) for at in range(leaves.size())]


@pytest.mark.parametrize(
    ("start", "end", "paths"),
    [
        (date(2024, 2, 1), date(2024, 3, 1), {"o/1", "o/2", "o/3"}),
        (date(2024, 2, 29), None, {"o/2", "o/3", "o/4", "o/5"}),
        (None, date(2024, 2, 1), {"o/0"}),
        (date(2024, 3, 1), date(2024, 3, 2), {"o/4"}),
        (date(2025, 1, 1), date(2025, 2, 1), set()),
        (None, None, {f"o/{n}" for n in range(6)}),
    ],
)
def test_a_period_is_the_same_with_and_without_folders(spark, months, start, end, paths):
    trace = open_store(spark, months)
    pruned = within(trace, "commit", start, end)
    assert {row.path for row in pruned.collect()} == paths
    plain = within(trace.select(*TRACE.names), "commit", start, end)
    assert as_tuples(reports.commit_trend(pruned)) == as_tuples(reports.commit_trend(plain))


def test_a_report_over_a_period_reads_its_months_only(spark, months):
    trace = within(open_store(spark, months), "commit", date(2024, 2, 1), date(2024, 3, 1))
    (scan,) = scans(reports.commit_trend(trace))
    filters = scan.metadata().apply("PartitionFilters")
    assert "commit_month" in filters and "load" in filters
    assert "IsNotNull(commitOutcome)" in scan.metadata().apply("PushedFilters")
    read = spark.read.parquet(f"{months}/rows").where("commit_month = DATE '2024-02-01'")
    names = lambda f: set(f.select("_metadata.file_path").distinct().toPandas().file_path)
    assert names(trace) == names(read) != names(open_store(spark, months))
    runs = within(open_store(spark, months), "run", date(2024, 2, 1), date(2024, 3, 1))
    assert "run_month" in scans(reports.top_users(runs))[0].metadata().apply("PartitionFilters")
    assert runs.isEmpty()


def test_stages_without_folders_are_filtered_by_time(spark, months):
    pushed = open_store(spark, months).withColumn("pushStartTime", F.col("commitStartTime"))
    assert within(pushed, "push", date(2024, 4, 1)).count() == 1
