"""What is kept between runs: daily roll-ups and streamed sums; and reports by table and by SQL."""

from __future__ import annotations

import os
from datetime import date

import pytest
from micro import S, as_tuples
from pyspark.sql import functions as F
from test_ingest import write

from contract.trace_fixture import fixture_trace
from tracetally.functions.columns import recipe_under
from tracetally.operators.calendar import dense
from tracetally.operators.rules import labelled, under_any
from tracetally.plans import reports, rollups
from tracetally.plans.rollups import refresh, rollup
from tracetally.schema import REPORTS
from tracetally.sources.sql import RANKINGS, TRENDS, register_reports
from tracetally.sources.traces import conform, open_trace, save_trace
from tracetally.streaming.activity import follow_activity, followed_activity

HEADER = ["origin", "path", "branch", "developer", "runId", "runEstimatedEffortTimeSavingsMs",
          "commitOutcome", "commitStartTime", "commitId"]


@pytest.fixture(scope="module")
def trace(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trace"))
    save_trace(conform(fixture_trace(spark, "/root/testdata/sf0.001")), path, "overwrite")
    return open_trace(spark, path).cache()


# Roll-ups

def files(folder):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    }


@pytest.mark.parametrize("name", ["build_success_trend", "dashboard_kpis_trend", "commit_trend"])
def test_bitmaps_are_neither_shuffled_nor_sorted(spark, trace, tmp_path, name):
    days = rollups._days(trace, name, str(tmp_path), None, False)
    plan = days._jdf.queryExecution().executedPlan().toString()
    writing = plan[: plan.index("Exchange")]
    assert "partial_bitmap_construct_agg" in writing
    assert "Sort [" not in writing[: writing.index("partial_bitmap_construct_agg")]
    assert plan.count("bitmap_construct_agg(") == 2


def test_a_measure_counts_only_values_of_its_own(spark, tmp_path):
    day = "2025-03-01 10:00:00"
    rows = spark.createDataFrame(
        [("o/a", S, day, "1"), ("o/b", "Failed", day, "1"), ("o/a", "Failed", day, "2"), (None, S, day, None)]
        + [("o/a", S, "2025-03-02 10:00:00", "2"), ("o/a", S, None, "3")],
        "path string, buildOutcome string, buildStartTime string, buildId string",
    )
    rows = conform(rows)
    refresh(rows, "build_success_trend", str(tmp_path))
    kept = spark.read.parquet(f"{tmp_path}/build_success_trend")
    counts = kept.groupBy("day", "measure").agg(F.sum(F.bitmap_count("bits")), F.sum("amount")).collect()
    first = {row[1]: (row[2], row[3]) for row in counts if row[0] == date(2025, 3, 1)}
    assert first == {
        "": (None, 4),
        "unique_repos": (2, None),
        "total_builds": (2, None),
        "successful_builds": (1, None),
        "failed_builds": (2, None),
    }
    assert as_tuples(rollup(spark, "build_success_trend", str(tmp_path))) == as_tuples(
        reports.build_success_trend(rows)
    )


def test_a_refresh_rewrites_its_months_only(spark, trace, tmp_path):
    into = str(tmp_path)
    some = trace.where("commitStartTime < '1994-06-01'")
    refresh(some, "commit_trend", into)
    assert as_tuples(rollup(spark, "commit_trend", into)) == as_tuples(reports.commit_trend(some))
    before, numbers = files(f"{into}/commit_trend"), files(f"{into}/numbers")
    # Rows are added to a month that was kept, and a month that was not is added.
    added = trace.where("commitStartTime < '1994-08-01'")
    late = trace.where("commitStartTime >= '1995-01-01'").withColumn("commitStartTime", F.lit("1994-03-09").cast("timestamp"))
    added = added.unionByName(late)
    refresh(added, "commit_trend", into, months=[date(1994, 3, 9), date(1994, 6, 2), date(1994, 7, 31)])
    after = files(f"{into}/commit_trend")
    assert {name for name in before if before[name] != after.get(name)} == {n for n in before if "of_month=1994-03-01" in n}
    assert all("=1994-0" in name for name in after.keys() - before.keys())
    assert numbers.items() <= files(f"{into}/numbers").items()
    for grain in ("week", "month", "quarter", "year"):
        want = as_tuples(reports.commit_trend(added, grain))
        assert as_tuples(rollup(spark, "commit_trend", into, grain)) == want
    # A month that lost all its rows goes; the numbers of its values stay.
    gone = added.where("commitStartTime < '1994-03-01' OR commitStartTime >= '1994-04-01'")
    refresh(gone, "commit_trend", into, months=[date(1994, 3, 1)])
    assert as_tuples(rollup(spark, "commit_trend", into)) == as_tuples(reports.commit_trend(gone))
    given = spark.read.parquet(f"{into}/numbers")
    assert given.count() == given.select("column", "value").distinct().count() == given.select("number").distinct().count()


@pytest.mark.parametrize("report", TRENDS)
def test_every_trend_rolls_up(spark, trace, tmp_path, report):
    refresh(trace, report, str(tmp_path))
    for grain in ("month", "year"):
        got = rollup(spark, report, str(tmp_path), grain)
        assert got.columns == REPORTS[report].names
        assert as_tuples(got) == as_tuples(getattr(reports, report)(trace, grain))


def test_numbers_of_a_day_lie_close_together(spark, trace, tmp_path):
    refresh(trace, "commit_trend", str(tmp_path))
    jobs = spark.read.parquet(f"{tmp_path}/commit_trend").where("measure = 'commit_jobs'")
    assert jobs.count() < 1.1 * jobs.select("day").distinct().count()


def test_sketches_unite_and_are_labelled(spark, trace, tmp_path):
    refresh(trace, "commit_trend", str(tmp_path), approximate=True)
    got = rollup(spark, "commit_trend", str(tmp_path), "year")
    assert got.columns == [n if n in ("month", "estimated_hours_saved") else f"approx_{n}" for n in REPORTS["commit_trend"].names]
    year = F.trunc("commitStartTime", "year").alias("month")
    direct = trace.where("commitOutcome IS NOT NULL").groupBy(year).agg(
        *[F.hll_sketch_estimate(F.hll_sketch_agg(column)).alias(name)
          for name, column in (("commit_jobs", "commitId"), ("unique_users", "developer"))]
    )
    want = {row.month: (row.commit_jobs, row.unique_users) for row in direct.collect()}
    assert {row.month: (row.approx_commit_jobs, row.approx_unique_users) for row in got.collect()} == want
    for row, exact in zip(got.collect(), reports.commit_trend(trace, "year").collect(), strict=True):
        for name in ("commit_jobs", "unique_users", "recipe_runs"):
            assert abs(row[f"approx_{name}"] - exact[name]) <= 0.05 * exact[name] + 1


def test_unknown_reports_and_grains_are_refused(spark, trace, tmp_path):
    with pytest.raises(ValueError, match="is not one of"):
        refresh(trace, "top_users", str(tmp_path))
    with pytest.raises(ValueError, match="grain"):
        rollup(spark, "commit_trend", str(tmp_path), "day")


def test_an_empty_trace_rolls_up_to_nothing(spark, trace, tmp_path):
    refresh(trace.limit(0), "commit_trend", str(tmp_path), months=[date(2024, 1, 1)])
    assert rollup(spark, "commit_trend", str(tmp_path)).isEmpty()


# Streamed sums

def line(day, path="o/a", effort="1800000", outcome=S):
    return f"gh,{path},main,al,u1,{effort},{outcome},{day},c1"


def follow(spark, tmp_path, **options):
    query = follow_activity(
        spark, str(tmp_path / "in"), str(tmp_path / "days"), str(tmp_path / "state"), HEADER, **options
    )
    query.awaitTermination()
    return query


def batch_report(spark, folder, grain):
    raw = spark.read.csv(str(folder), header=True)
    return as_tuples(reports.commit_activity(conform(raw), grain).drop("unique_repos_changed").where("month IS NOT NULL"))


def test_streamed_sums_equal_the_batch_report(spark, tmp_path):
    header = ",".join(HEADER)
    write(tmp_path / "in" / "1.csv", header, line("2024-01-31T23:59:59Z"), line("2024-02-01T00:00:00Z", "o/b", ""),
          line("2024-02-02T10:00:00Z", outcome="Failed"), line("no time"))
    write(tmp_path / "in" / "2.csv", header, line("2024-02-01T12:00:00Z"), line("2024-01-31T05:00:00Z", "o/c"))
    follow(spark, tmp_path, files_per_batch=1)
    check = lambda: [
        as_tuples(followed_activity(spark, str(tmp_path / "days"), grain)) for grain in ("week", "month", "year")
    ] == [batch_report(spark, tmp_path / "in", grain) for grain in ("week", "month", "year")]
    assert check()
    # After a restart the state goes on: rows for kept days, late ones within the bound, new days.
    write(tmp_path / "in" / "3.csv", header, line("2024-01-31T07:00:00Z"), line("2024-02-20T00:00:00Z"))
    follow(spark, tmp_path)
    assert check()
    follow(spark, tmp_path)
    assert check()


def test_rows_later_than_the_bound_are_dropped_and_counted(spark, tmp_path):
    header = ",".join(HEADER)
    write(tmp_path / "in" / "1.csv", header, line("2024-03-10T00:00:00Z"))
    follow(spark, tmp_path, late="2 days")
    write(tmp_path / "in" / "2.csv", header, line("2024-03-09T00:00:00Z"), line("2024-03-01T00:00:00Z"))
    query = follow(spark, tmp_path, late="2 days")
    days = spark.read.parquet(str(tmp_path / "days"))
    assert {str(row.day) for row in days.collect()} == {"2024-03-10", "2024-03-09"}
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 1


# Rules in a table

def test_ten_thousand_rules_are_one_join(spark, trace):
    prefixes = [f"com.acme.rule{at}." for at in range(10_000)]
    prefixes += ["org.openrewrite.java.s", "org.openrewrite.java.OrderImports", "org.openrewrite.static%", "", "org.openrewrite.java.security."][:3]
    rules = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    got = under_any(trace, rules.union(rules.limit(1)))
    assert got.columns == trace.columns
    want = trace.where(recipe_under("org.openrewrite.java.s", "org.openrewrite.java.OrderImports", "org.openrewrite.static%"))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert under_any(trace, rules.limit(0)).isEmpty()


def test_the_longest_rule_labels(spark, trace):
    rows = [("org.", "o"), ("org.openrewrite.java.security.", "z"), ("org.openrewrite.java.security.", "s"), (None, "n")]
    rules = spark.createDataFrame(rows, "start string, label string")
    got = labelled(trace.withColumn("label", F.lit(1)), rules, prefix="start")
    assert got.count() == trace.count()
    ids = {row.runRecipeId: row.label for row in got.select("runRecipeId", "label").distinct().collect()}
    assert ids[None] is None
    assert all(label == ("s" if ".security." in recipe else "o") for recipe, label in ids.items() if recipe)


# Trends without holes

@pytest.mark.parametrize(
    ("grain", "days", "want"),
    [
        ("month", ["2024-01-01", "2024-04-01"], ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]),
        ("week", ["2024-12-23", "2025-01-13"], ["2024-12-23", "2024-12-30", "2025-01-06", "2025-01-13"]),
        ("quarter", ["2023-10-01", "2024-04-01"], ["2023-10-01", "2024-01-01", "2024-04-01"]),
        ("year", ["2020-01-01", "2022-01-01"], ["2020-01-01", "2021-01-01", "2022-01-01"]),
    ],
)
def test_dense(spark, grain, days, want):
    rows = [(date.fromisoformat(day), 7, 3, 1.5) for day in days] + [(None, 2, None, None)]
    trend = spark.createDataFrame(rows, "month date, commits long, files_changed long, rate double")
    got = as_tuples(dense(trend.repartition(3), grain=grain))
    filled = [(date.fromisoformat(d), *((7, 3, 1.5) if d in days else (0, None, None))) for d in want]
    assert got == [*filled, (None, 2, None, None)]
    assert dense(trend.limit(0), grain=grain).isEmpty()
    assert as_tuples(dense(trend.where("month IS NULL"), grain=grain)) == [(None, 2, None, None)]


# SQL functions

def test_every_report_is_a_function(spark, trace):
    register_reports(trace, "some_trace")
    for report in REPORTS:
        want = as_tuples(getattr(reports, report)(trace))
        assert sorted(map(repr, as_tuples(spark.sql(f"SELECT * FROM {report}()")))) == sorted(map(repr, want))
    for report in TRENDS:
        for grain in ("week", "quarter", "year"):
            got = spark.sql(f"SELECT * FROM {report}('{grain}')")
            assert got.schema.names == REPORTS[report].names
            assert sorted(map(repr, as_tuples(got))) == sorted(map(repr, as_tuples(getattr(reports, report)(trace, grain))))
    for report in RANKINGS:
        got = spark.sql(f"SELECT * FROM {report}(wanted => 3)")
        assert sorted(as_tuples(got)) == sorted(as_tuples(getattr(reports, report)(trace, limit=3)))
        assert spark.sql(f"SELECT * FROM {report}(0)").isEmpty()
    for grain in ("'day'", "NULL"):
        with pytest.raises(Exception, match="grain must be one of"):
            spark.sql(f"SELECT * FROM commit_trend({grain})").collect()
    assert spark.sql("SELECT count(*) AS n FROM some_trace").first().n == trace.count()


def test_only_the_period_asked_for_is_planned(spark, trace):
    register_reports(trace)
    plan = spark.sql("SELECT * FROM commit_trend('week')")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("InMemoryRelation") == 1
    assert "week" in plan and "quarter" not in plan


# The state of a repository

def test_a_repository_that_moved_on_is_not_counted(spark):
    rows = [
        ("gh", "o/moved", "main", S, "2024-01-01T00:00:00Z", "b1", "3.6.3"),
        ("gh", "o/moved", "main", S, "2024-02-01T00:00:00Z", "b2", "3.9.6"),
        ("gh", "o/moved", "main", "Failed", "2024-03-01T00:00:00Z", "b3", "3.6.3"),
        ("gh", "o/stays", "main", S, "2024-02-01T00:00:00Z", "b2", "3.6.3"),
        ("gh", "o/stays", "main", S, "2023-02-01T00:00:00Z", "b0", "3.9.6"),
        ("gh", "o/branch", "main", S, "2024-02-01T00:00:00Z", "b2", "3.9.6"),
        ("gh", "o/branch", "old", S, "2024-01-01T00:00:00Z", "b1", "3.6.1"),
        ("gl", "o/tie", "main", S, "2024-01-01T00:00:00Z", "b1", "3.6.1"),
        ("gl", "o/tie", "main", S, "2024-01-01T00:00:00Z", "b1", "3.9.1"),
        ("gl", "o/timeless", "main", S, "never", "b1", "3.6.1"),
        ("gl", "o/timeless", "main", S, "2020-01-01T00:00:00Z", "b1", "3.8.1"),
    ]
    columns = "origin string, path string, branch string, buildOutcome string, buildStartTime string, buildId string, buildMavenVersion string"
    now = conform(spark.createDataFrame(rows, columns))
    assert as_tuples(reports.repos_still_on_tool_version(now, "Maven", "3.6")) == [("Maven", "3.6", 2)]
    assert as_tuples(reports.repos_on_tool_version(now, "Maven", "3.6")) == [("Maven", "3.6", 5)]
    assert as_tuples(reports.current_tool_versions(now)) == [
        ("Maven", "3.9.6", 2), ("Maven", "3.6.1", 1), ("Maven", "3.6.3", 1), ("Maven", "3.8.1", 1), ("Maven", "3.9.1", 1)]
    assert as_tuples(reports.repos_still_on_tool_version(now.limit(0), "Maven", "3.6")) == [("Maven", "3.6", 0)]
