"""Every registered query against DuckDB, properties that hold on any trace, and plan checks."""

from __future__ import annotations

import math
from pathlib import Path

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from contract import oracles, registry
from contract.trace_fixture import TRACE_SQL, fixture_trace
from tracetally.operators import shaping
from tracetally.plans import reports
from tracetally.schema import TRACE
from tracetally.sources.traces import conform, open_trace, save_trace

QUERIES, ORACLES = registry.queries(), oracles.oracle_sql()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert len(QUERIES) == 74
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_duckdb(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLES[name])
    assert result.columns == [column[0] for column in answer.description]
    got = [tuple(row) for row in result.collect()]
    want = answer.fetchall()
    assert len(got) > 0
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if "ORDER BY" in ORACLES[name].rsplit(")", 1)[-1]:
        assert got == want


def test_answers_owe_nothing_to_the_library(spark, duck, monkeypatch):
    assert "tracetally" not in Path(oracles.__file__).read_text()
    points, ((column, _), *rest) = shaping.SERIES["top_users"]
    monkeypatch.setitem(shaping.SERIES, "top_users", (points, ((column, "Wrong"), *rest)))
    got = {row.series for row in QUERIES["top_users_long"](spark, SF_DIR).collect()}
    want = {row[2] for row in duck.execute(oracles.oracle_sql()["top_users_long"]).fetchall()}
    assert got - want == {"Wrong"}


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def trace(spark):
    return conform(fixture_trace(spark, SF_DIR)).cache()


def test_derived_rows_agree(spark, duck):
    ours = fixture_trace(spark, SF_DIR)
    sql = TRACE_SQL.format(lineitem="lineitem", orders="orders")
    theirs = {tuple(row) for row in duck.execute(sql).fetchall()}
    assert {tuple(row) for row in ours.collect()} == theirs


def test_build_counts(trace):
    for row in reports.build_success_trend(trace).collect():
        assert row.successful_builds <= row.total_builds
        assert row.successful_builds + row.failed_builds >= row.total_builds


def test_distinct_counts_do_not_add_up_over_periods(trace):
    months = reports.recipe_run_trend(trace).collect()
    for year in reports.recipe_run_trend(trace, "year").collect():
        of_year = [m for m in months if m.month.year == year.month.year]
        for metric in ("recipe_runs", "distinct_recipes", "unique_users"):
            assert max(m[metric] for m in of_year) <= year[metric]
            assert year[metric] <= sum(m[metric] for m in of_year)


def test_commit_rows_and_commit_jobs(trace):
    jobs = {r.month: r.successful_commits for r in reports.commit_trend(trace).collect()}
    rows = {r.month: r.successful_commits for r in reports.commit_activity(trace).collect()}
    assert all(rows[month] >= jobs[month] for month in rows)
    assert sum(rows.values()) > sum(jobs.values())


def test_additive_totals(trace):
    summary = reports.dashboard_kpis_summary(trace).first()
    months = reports.dashboard_kpis_trend(trace).collect()
    assert summary.files_changed == sum(m.files_changed for m in months)
    hours = math.fsum(m.estimated_hours_saved or 0 for m in months)
    assert abs(summary.estimated_hours_saved - hours) <= 0.05 * (len(months) + 1)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("name", QUERIES)
def test_no_python_cross_join_or_expand_in_any_plan(spark, name, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop", "Expand"):
        assert node not in plan, node


@pytest.fixture(scope="module")
def stored(spark, trace, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "trace")
    save_trace(trace, path)
    return open_trace(spark, path)


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("commit_trend", "IsNotNull(commitOutcome)", 8),
        ("commit_activity", "EqualTo(commitOutcome,Succeeded)", 4),
        ("build_tool_summary", "EqualTo(buildOutcome,Succeeded)", 9),
        ("top_recipes", "IsNotNull(runOutcome)", 6),
        ("security_recipe_run_trend", "StringStartsWith(runRecipeId,", 6),
    ],
)
def test_filters_and_columns_reach_the_scan(stored, name, pushed, columns):
    report = getattr(reports, name)(stored)
    scan = report._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert pushed in scan.metadata().apply("PushedFilters")
    assert len(scan.requiredSchema().fieldNames()) == columns < len(TRACE.names)


def test_stored_trace_gives_the_same(trace, stored):
    for name in ("commit_trend", "build_tool_versions", "top_users"):
        report = getattr(reports, name)
        assert report(stored).collect() == report(trace).collect()


def test_a_hot_job_changes_no_distinct_count(spark, trace):
    hot = trace.where(F.col("commitOutcome").isNotNull()).limit(1)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(20000))).alias("n")).drop("n")
    skewed = trace.unionByName(copies.repartition(8))
    want = [tuple(row)[:-1] for row in reports.commit_trend(trace).collect()]
    assert [tuple(row)[:-1] for row in reports.commit_trend(skewed).collect()] == want
