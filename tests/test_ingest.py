from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from micro import FEB, IMPORTS, S, as_tuples

from tracetally.plans import reports
from tracetally.schema import REPORTS, TRACE
from tracetally.sources.results import read_report, write_report
from tracetally.sources.traces import (
    conform,
    deepest_stage,
    header_groups,
    ingest,
    open_trace,
    read_raw_traces,
    read_traces,
    save_table,
)
from tracetally.streaming.follow import follow_traces

COMMON = "origin,path,branch,developer"
RUN = f"{COMMON},runOutcome,runStartTime,runId,runRecipeId,runEstimatedEffortTimeSavingsMs"
COMMIT = f"{RUN},commitOutcome,commitStartTime,commitId"


def write(path, *lines, eol="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(eol.join(lines) + eol, encoding="utf-8")
    return str(path)


def run_line(path="o/a", run="u1", effort=3600000):
    return f"gh,{path},main,al,{S},{FEB},{run},{IMPORTS},{effort}"


def commit_line(path="o/a", run="u1", commit="c1", outcome=S):
    return f"{run_line(path, run)},{outcome},{FEB},{commit}"


def test_values_land_by_name_whatever_the_column_order(spark, tmp_path):
    write(tmp_path / "1.csv", "path,developer,origin,branch,runId", "o/a,al,gh,main,u1")
    write(tmp_path / "2.csv", "runId,branch,path,origin,developer", "u2,main,o/b,gh,bo")
    got = read_traces(spark, str(tmp_path), mixed=True).select(
        "origin", "path", "branch", "developer", "runId"
    )
    assert sorted(as_tuples(got)) == [
        ("gh", "o/a", "main", "al", "u1"),
        ("gh", "o/b", "main", "bo", "u2"),
    ]


def test_columns_and_types_are_the_documented_ones(spark, tmp_path):
    write(tmp_path / "1.csv", COMMON, "gh,o/a,main,al")
    got = read_traces(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in TRACE]


def test_stages_unite_and_missing_columns_are_null(spark, tmp_path):
    write(tmp_path / "run" / "a.csv", RUN, run_line("o/a", "u1"), run_line("o/b", "u2"))
    write(tmp_path / "deep" / "er" / "b.csv", COMMIT, commit_line("o/c", "u3"))
    for trace in (
        read_traces(spark, str(tmp_path), mixed=True),
        read_traces(spark, str(tmp_path / "run"), str(tmp_path / "deep")),
    ):
        assert as_tuples(reports.top_users(trace)) == [("al", 3, 1)]
    run_only = read_traces(spark, str(tmp_path / "run"))
    assert as_tuples(reports.top_users(run_only)) == [("al", 2, 0)]


def test_push_columns_mid_file_and_unknown_columns(spark, tmp_path):
    write(
        tmp_path / "p.csv",
        "origin,path,pushOutcome,pushElapsedTimeMs,execOutcome,branch,developer",
        f"gh,o/a,{S},12,whatever,main,al",
    )
    row = read_traces(spark, str(tmp_path)).first()
    assert (row.pushOutcome, row.pushElapsedTimeMs, row.branch) == (S, 12, "main")
    assert "execOutcome" not in row.asDict()


def test_quoted_fields(spark, tmp_path):
    write(
        tmp_path / "q.csv",
        f'{COMMON},runRecipeOptions,"runRecipeInstanceName"',
        'gh,"o/a,b",main,al,"{""k"":""v, w""}","say ""hi"""',
    )
    row = read_traces(spark, str(tmp_path)).first()
    assert (row.path, row.runRecipeOptions) == ("o/a,b", '{"k":"v, w"}')
    assert row.runRecipeInstanceName == 'say "hi"'


def test_line_breaks_in_quotes_when_asked_for(spark, tmp_path):
    write(tmp_path / "m.csv", f"{COMMON},runRecipeOptions", 'gh,o/a,main,al,"one\ntwo"')
    got = read_traces(spark, str(tmp_path), multi_line=True)
    assert got.first().runRecipeOptions == "one\ntwo"
    assert got.count() == 1


def test_windows_line_ends_byte_order_mark_and_case(spark, tmp_path):
    write(tmp_path / "w.csv", "﻿ORIGIN,Path,branch,developer,RUNID", "gh,o/a,main,al,u1", eol="\r\n")
    row = read_traces(spark, str(tmp_path)).first()
    assert (row.origin, row.path, row.runId) == ("gh", "o/a", "u1")


def test_empty_cells_are_null(spark, tmp_path):
    write(tmp_path / "e.csv", f"{COMMON},runOutcome,runId", 'gh,o/a,main,"",,""')
    row = read_traces(spark, str(tmp_path)).first()
    assert (row.developer, row.runOutcome, row.runId) == (None, None, None)


def test_empty_strings_from_other_sources_are_null(spark):
    got = conform(spark.createDataFrame([("", "", " ")], "path string, buildStartTime string, branch string"))
    row = got.first()
    assert (row.path, row.buildStartTime, row.branch) == (None, None, " ")


def test_odd_file_names(spark, tmp_path):
    write(tmp_path / "a b{1}" / "t[1]*?.csv", COMMON, "gh,o/a,main,al")
    write(tmp_path / "100%20.csv", f"{COMMON},runId", "gh,o/b,main,al,u1")
    assert read_traces(spark, str(tmp_path), mixed=True).count() == 2
    assert read_traces(spark, *[str(p) for p in tmp_path.iterdir() if p.is_file()]).count() == 1


def test_rejects_are_counted_not_fatal(spark, tmp_path):
    write(
        tmp_path / "in" / "r.csv",
        f"{COMMON},buildOutcome,buildStartTime,buildElapsedTimeMs,runStreaming,runPomCacheHitRate",
        f"gh,o/a,main,al,{S},{FEB},5,false,0.9",
        f"gh,o/b,main,al,{S},yesterday,many,maybe,",
        f"gh,o/c,main,al,{S},,6,true,1.0",
    )
    out = str(tmp_path / "out")
    assert dict(ingest(spark, str(tmp_path / "in"), into=out)) == {
        "rows": 3, "buildStartTime": 1, "buildElapsedTimeMs": 1, "runStreaming": 1,
    }
    trace = open_trace(spark, out)
    assert trace.count() == 3
    months = [row[0] for row in as_tuples(reports.build_success_trend(trace))]
    assert months[-1] is None and len(months) == 2


def test_a_file_without_header_is_refused(spark, tmp_path):
    bad = write(tmp_path / "x.csv", "gh,o/a,main,al")
    with pytest.raises(ValueError, match="x.csv has 0"):
        header_groups(spark, [bad])


def test_a_folder_without_any_header_is_refused(spark, tmp_path):
    write(tmp_path / "x.csv", "#v1", "gh,o/a,main,al")
    with pytest.raises(ValueError, match="no trace header"):
        read_traces(spark, str(tmp_path))


@pytest.mark.parametrize("mixed", [True, False])
def test_trailing_comma_spaces_and_quotes_in_the_header(spark, tmp_path, mixed):
    write(tmp_path / "t.csv", '"origin", path,branch ,developer,', "gh,o/a,main,al,")
    row = read_traces(spark, str(tmp_path), mixed=mixed).first()
    assert (row.origin, row.path, row.branch, row.developer) == ("gh", "o/a", "main", "al")


def test_files_are_grouped_by_header(spark, tmp_path):
    for name in "abc":
        write(tmp_path / f"{name}.csv", COMMON, "gh,o/a,main,al")
    write(tmp_path / "d.csv", RUN, run_line())
    assert sorted(len(files) for files in header_groups(spark, [str(tmp_path)])) == [1, 3]


def test_empty_files_are_ignored(spark, tmp_path):
    write(tmp_path / "1.csv", COMMON, "gh,o/a,main,al")
    write(tmp_path / "2.csv", f"{COMMON},runId")
    (tmp_path / "3.csv").write_text("")
    assert read_traces(spark, str(tmp_path), mixed=True).count() == 1


def test_column_twice_is_refused(spark):
    frame = spark.createDataFrame([("a", "b")], ["path", "path "])
    with pytest.raises(ValueError, match="twice"):
        conform(frame)


def test_files_of_a_path_must_share_a_header(spark, tmp_path):
    write(tmp_path / "1.csv", COMMON, "gh,o/a,main,al")
    assert read_traces(spark, str(tmp_path)).count() == 1
    write(tmp_path / "2.csv", "path,origin,branch,developer", "o/b,gh,main,al")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_traces(spark, str(tmp_path)).collect()


def test_a_large_file_read_in_splits(spark, tmp_path):
    lines = [f"gh,o/{i},main,dev{i}@example.com" for i in range(20000)]
    write(tmp_path / "big.csv", COMMON, *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        trace = read_traces(spark, str(tmp_path))
        assert trace.rdd.getNumPartitions() > 4
        assert trace.select("path").distinct().count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_stages_double_sums_unless_reduced_to_the_deepest(spark, tmp_path):
    write(tmp_path / "run.csv", RUN, run_line("o/a", "u1"), run_line("o/b", "u2"))
    write(
        tmp_path / "commit.csv", COMMIT,
        commit_line("o/a", "u1", "c1", "Failed"), commit_line("o/a", "u1", "c2"),
    )
    trace = read_traces(spark, str(tmp_path), mixed=True)
    assert as_tuples(reports.dashboard_kpis_summary(trace)) == [(2, 1, 1, 1, None, 4.0)]
    reduced = deepest_stage(trace)
    # Both commits of u1 stay, its run-only copy goes, u2 stays.
    assert as_tuples(reports.dashboard_kpis_summary(reduced)) == [(2, 1, 1, 1, None, 3.0)]
    assert reduced.columns == trace.columns
    once = deepest_stage(read_traces(spark, str(tmp_path / "run.csv")))
    assert once.count() == 2


def test_a_repository_without_a_commit_counts_once(spark, tmp_path):
    write(tmp_path / "run.csv", RUN, run_line("o/a"), run_line("o/b"))
    uncommitted = f"{run_line('o/b')},,,"
    write(tmp_path / "commit.csv", f"{COMMIT},organization",
          f"{commit_line('o/a')},acme", f"{uncommitted},acme", f"{run_line('o/c', '')},,,,acme",
          f"{run_line('o/c', '')},,,,acme")
    trace = read_traces(spark, str(tmp_path / "run.csv"), str(tmp_path / "commit.csv"))
    reduced = deepest_stage(trace)
    rows = reduced.select("path", "commitId", "organization").collect()
    # Rows without a run stay, repeats included.
    assert sorted(map(tuple, rows), key=repr) == [
        ("o/a", "c1", "acme"), ("o/b", None, "acme"), ("o/c", None, "acme"), ("o/c", None, "acme"),
    ]
    with_run = reduced.where("runId IS NOT NULL")
    assert as_tuples(reports.dashboard_kpis_summary(with_run))[0][-1] == 2.0
    assert reduced.schema.names == trace.schema.names


def test_each_byte_is_read_once(spark, tmp_path):
    rows = [f"gh,o/{i},main,dev{i}@example.com" for i in range(100_000)]
    for name in "abcd":
        write(tmp_path / "in" / f"{name}.csv", COMMON, *rows)
    size = sum(file.stat().st_size for file in (tmp_path / "in").iterdir())

    def read() -> int:
        statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(one.getBytesRead() for one in statistics if one.getScheme() == "file")

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1048576")
    try:
        before = read()
        raw = read_raw_traces(spark, str(tmp_path / "in"))
        assert read() - before < 0.05 * size
        before = read()
        raw.write.format("noop").mode("overwrite").save()
        assert 0.9 * size < read() - before < 1.15 * size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_table_is_open_to_sql(spark, tmp_path):
    write(tmp_path / "1.csv", COMMIT, commit_line())
    save_table(read_traces(spark, str(tmp_path)), "stored_trace", mode="overwrite")
    try:
        got = spark.sql("SELECT count(DISTINCT commitid) FROM stored_trace WHERE commitOutcome = 'Succeeded'")
        assert got.first()[0] == 1
    finally:
        spark.sql("DROP TABLE stored_trace")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_reports_round_trip(spark, tmp_path, fmt):
    write(tmp_path / "in" / "1.csv", COMMIT, commit_line(), commit_line("o/b", "u2", "c2"))
    trace = read_traces(spark, str(tmp_path / "in"))
    for name in ("commit_trend", "top_recipes", "dashboard_kpis_summary"):
        result = getattr(reports, name)(trace)
        out = tmp_path / name
        write_report(result, str(out), fmt, one_file=True)
        assert len(list(out.glob("part-*"))) == 1
        back = read_report(spark, str(out), name, fmt)
        assert as_tuples(back) == as_tuples(result)
        assert back.schema == REPORTS[name]


def test_reading_another_report_is_refused(spark, tmp_path):
    path = write(tmp_path / "r.csv", "month,builds", "2026-01-01,3")
    with pytest.raises(Exception, match="(?i)header"):
        read_report(spark, path, "commit_activity").collect()


def test_following_a_folder_takes_each_file_once(spark, tmp_path):
    source, out, done = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "done")

    def follow():
        follow_traces(spark, str(source), out, done, COMMIT.split(",")).awaitTermination(60)
        return as_tuples(reports.commit_activity(open_trace(spark, out)))

    write(source / "1.csv", COMMIT, commit_line())
    assert [row[1] for row in follow()] == [1]
    write(source / "2.csv", COMMIT, commit_line("o/b", "u2", "c2"))
    assert [row[1] for row in follow()] == [2]
    assert [row[1] for row in follow()] == [2]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    head = "origin,path,branch,developer,runId,runOutcome,runEstimatedEffortSavings,commitId,commitOutcome"
    good = 'gh,o/a,main,al,r1,Succeeded,5,c1,Succeeded'
    quoted = 'gh,"o/b, ""x""",main,al,r1,Succeeded,5,c1,Succeeded'
    longer, shorter = 'gh,o/a,b,main,al,r1,Succeeded,5,c2,Succeeded', "gh,o/c,main"
    empty = "," * head.count(",")
    write(tmp_path / "in" / "t.csv", head, good, longer, quoted, shorter, head, empty)
    out = str(tmp_path / "out")
    counts = ingest(spark, str(tmp_path / "in"), into=out)
    assert counts == {"rows": 3, "malformed": 2, "repeated_headers": 1}
    trace = open_trace(spark, out)
    assert {row.path for row in trace.collect()} == {"o/a", 'o/b, "x"', None}
    assert trace.where("commitId IS NOT NULL").count() == 2
    assert {row.value for row in spark.read.text(f"{out}_malformed").collect()} == {longer, shorter}
    assert read_traces(spark, str(tmp_path / "in")).select("path").count() == 3
    with pytest.raises(Exception, match="malformed line"):
        ingest(spark, str(tmp_path / "in"), into=f"{out}2", malformed="fail")


def test_another_header_further_down_is_refused(spark, tmp_path):
    head = "origin,path,branch,developer,runId"
    for name, other in (("a", "path,origin,branch,developer,runId"), ("b", f"{head},commitId")):
        write(tmp_path / name / "t.csv", head, "gh,o/a,main,al,r1", other, "o/a,gh,main,al,r1")
        with pytest.raises(Exception, match="header"):
            ingest(spark, str(tmp_path / name), into=str(tmp_path / f"{name}-out"))


def test_following_counts_what_it_leaves_out(spark, tmp_path):
    out = str(tmp_path / "out")
    write(tmp_path / "in" / "1.csv", COMMIT, commit_line(), "gh,o/c,main", COMMIT)
    query = follow_traces(
        spark, str(tmp_path / "in"), out, str(tmp_path / "done"), COMMIT.split(",")
    )
    query.awaitTermination(60)
    assert open_trace(spark, out).count() == 1
    (lost,) = [p.observedMetrics["losses"] for p in query.recentProgress if p.observedMetrics]
    assert (lost["rows"], lost["malformed"], lost["repeated_headers"]) == (1, 1, 1)


def test_an_unlimited_ranking_is_written_by_several_tasks(spark, tmp_path):
    names = spark.range(0, 4000, 1, 4).selectExpr("concat('u', id) AS user", "id % 97 AS runs")
    result = names.orderBy(F.desc("runs"), "user")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(result, str(tmp_path / "r"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "r").glob("part-*"))
    assert len(parts) > 1
    lines = [line for part in parts for line in part.read_text().splitlines()[1:]]
    assert lines == [f"{row.user},{row.runs}" for row in result.collect()]
