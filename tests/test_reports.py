from __future__ import annotations

from datetime import date

import pytest
from micro import (
    EXPECTED,
    FAILED,
    FEB,
    FEB_START,
    FEBRUARY,
    IMPORTS,
    JANUARY,
    ROWS,
    S,
    SEC,
    as_tuples,
    micro_trace,
    raw_trace,
)
from pyspark.sql import functions as F

from tracetally.functions.columns import period_start, recipe_is, recipe_like, recipe_under
from tracetally.operators.tally import tally
from tracetally.plans import reports
from tracetally.schema import REPORTS, TRACE
from tracetally.sources.traces import conform, register_trace

TRENDS = [name for name, schema in REPORTS.items() if schema.names[0] == "month"]


@pytest.fixture(scope="module")
def micro(spark):
    return micro_trace(spark).cache()


@pytest.mark.parametrize("name", EXPECTED)
def test_micro_fixture(micro, name):
    result = getattr(reports, name)(micro)
    assert as_tuples(result) == EXPECTED[name]
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in REPORTS[name]
    ]


@pytest.mark.parametrize("name", EXPECTED)
def test_empty_trace(micro, name):
    rows = as_tuples(getattr(reports, name)(micro.limit(0)))
    assert rows == ([(0, 0, 0, 0, None, None)] if name == "dashboard_kpis_summary" else [])


@pytest.mark.parametrize("name", TRENDS)
def test_text_times_give_the_same(spark, name):
    text = raw_trace(spark).replace("", None)
    assert as_tuples(getattr(reports, name)(text)) == EXPECTED[name]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_periods_are_utc_in_any_session_zone(spark, zone):
    trace = micro_trace(spark)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in TRENDS:
            assert as_tuples(getattr(reports, name)(trace)) == EXPECTED[name]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("grain", "text", "first_day"),
    [
        ("week", "2026-03-01T00:00:00.000Z", date(2026, 2, 23)),
        ("month", "2026-03-31T23:59:59.999Z", date(2026, 3, 1)),
        ("quarter", "2026-05-05T05:00:00.000Z", date(2026, 4, 1)),
        ("year", "2026-12-31T23:59:59.999Z", date(2026, 1, 1)),
        ("month", "1969-12-31T23:59:59.999Z", date(1969, 12, 1)),
        ("month", "nonsense", None),
        ("month", "", None),
    ],
)
def test_period_start(spark, grain, text, first_day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(period_start("t", grain)).first()[0] == first_day


def test_unknown_grain_is_refused(micro):
    with pytest.raises(ValueError, match="grain"):
        reports.commit_trend(micro, grain="day")


def test_bucket_name(micro):
    assert reports.commit_trend(micro, "quarter", bucket_name="quarter").columns[0] == "quarter"


def test_outcome_without_any_id_has_no_rate(spark):
    row = ("o/a", "al", S, FEB, *[None] * 13)
    assert as_tuples(reports.build_success_trend(micro_trace(spark, [row]))) == [
        (FEBRUARY, 0, 0, 0, None, 1)
    ]


def test_unparsable_time_is_a_null_period_and_comes_last(spark):
    row = ("o/a", "al", S, "nonsense", "b9", *[None] * 12)
    got = as_tuples(reports.build_success_trend(micro_trace(spark, [*ROWS, row])))
    assert got == [*EXPECTED["build_success_trend"], (None, 1, 1, 0, 100.0, 1)]


def test_outcome_is_case_sensitive(spark):
    row = ("o/a", "al", "succeeded", FEB, "b9", *[None] * 12)
    assert as_tuples(reports.build_success_trend(micro_trace(spark, [row])))[0][2:4] == (0, 1)


def test_null_recipe_and_ties(spark):
    run = (None,) * 5
    rows = [
        ("o/a", d, S, FEB, "b", None, None, S, FEB, u, r, n, None, None, *run[:3])
        for d, u, r, n in [
            ("al", "u1", None, "x"),
            ("al", "u2", "r.b", "y"),
            ("al", "u3", "r.a", "z"),
            ("al", "u4", "r.a", "ä"),
        ]
    ]
    trace = micro_trace(spark, rows)
    assert as_tuples(reports.top_recipes(trace)) == [
        ("r.a", "ä", 2, 1, 1),
        ("r.b", "y", 1, 1, 1),
        (None, "x", 1, 1, 1),
    ]
    assert [r[0] for r in as_tuples(reports.top_recipes(trace, limit=2))] == ["r.a", "r.b"]


def test_limits(micro):
    assert as_tuples(reports.top_users(micro, 2)) == EXPECTED["top_users"][:2]
    assert as_tuples(reports.top_recipes_with_commits(micro, 1)) == EXPECTED[
        "top_recipes_with_commits"
    ]


def test_run_only_data(spark):
    run_columns = [c for c in raw_trace(spark).columns if not c.startswith("commit")]
    trace = conform(raw_trace(spark).select(*run_columns))
    assert as_tuples(reports.top_users(trace)) == [("alice", 1, 0), ("bob", 1, 0), (None, 1, 0)]
    assert as_tuples(reports.dashboard_kpis_summary(trace)) == [(2, 0, 2, 2, 6, 1.6)]
    assert as_tuples(reports.commit_trend(trace)) == []


def test_recipe_filters(spark):
    ids = ["a.b.C", "a.bX.C", "a_b.C", None]
    rows = [
        ("o/a", "al", S, FEB, "b", None, None, S, FEB, "u", r, "n", "0", "1", S, FEB_START, "c")
        for r in ids
    ]
    trace = micro_trace(spark, rows)

    def hits(recipes):
        got = as_tuples(reports.security_recipe_run_trend(trace, recipes=recipes))
        return got[0][1] if got else 0

    assert hits(recipe_like("a.b.%")) == 1
    assert hits(recipe_like("a.b.%", "a.bX.%")) == 2
    assert hits(recipe_like("a_b%")) == 3  # an underscore matches any character
    assert hits(recipe_under("a_b")) == 1  # here it does not
    assert hits(recipe_is("a.b.C", "a_b.C")) == 2
    assert hits(recipe_is("nope")) == 0


def test_repos_on_tool_version(micro):
    assert as_tuples(reports.repos_on_tool_version(micro, "Maven", "3.")) == [("Maven", "3.", 1)]
    assert as_tuples(reports.repos_on_tool_version(micro, "Gradle", "8")) == [("Gradle", "8", 1)]
    # Gradle 7.6.1 hides behind the Maven version of the same row.
    assert as_tuples(reports.repos_on_tool_version(micro, "Gradle", "7")) == [("Gradle", "7", 0)]


def test_gap_equals_the_join_of_both_reports(spark):
    orphan = ("o/z", "al", S, FEB, "b", None, None, None, FEB, "u", "only.committed", "n", "0",
              "1", S, FEB_START, "c9")
    nameless = ("o/z", "al", S, FEB, "b", None, None, S, FEB, "u7", None, "n", "0",
                "1", S, FEB_START, "c9")
    trace = micro_trace(spark, [*ROWS, orphan, nameless])
    ran = reports.top_recipes(trace).alias("r")
    done = reports.top_recipes_with_commits(trace).alias("c")
    commits = F.coalesce("c.commits", F.lit(0))
    joined = ran.join(done, F.expr("r.recipe_id <=> c.recipe_id"), "left").select(
        "r.recipe_id", "r.recipe_name", "r.recipe_runs", commits.alias("commits"),
        (F.col("r.recipe_runs") - commits).alias("gap"),
    )
    got = as_tuples(reports.recipe_run_commit_gap(trace))
    assert sorted(got, key=repr) == sorted(as_tuples(joined), key=repr)
    assert got == [(IMPORTS, "Order imports v2", 1, 0, 1), (SEC, "Sec A", 1, 1, 0),
                   (None, "n", 1, 1, 0)]


def test_plain_sql_on_the_registered_trace(spark, micro):
    register_trace(micro)
    got = spark.sql("""
        SELECT date_trunc('MONTH', CAST(COMMITSTARTTIME AS TIMESTAMP)) AS month, count(*) AS n
        FROM trace WHERE commitoutcome = 'Succeeded' GROUP BY 1 ORDER BY month""")
    assert [row.n for row in got.collect()] == [1]
    assert len(TRACE.names) == 79


def test_tally_against_count_distinct(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("k"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 91).cast("string")).alias("a"),
        F.concat(F.lit("v"), F.hash("id") % 300).alias("b"),
        (F.hash("id") % 3 == 0).alias("p"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.hash("id") % 2 == 0).alias("q"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("n"),
    ).withColumn("k", F.when(F.col("k") != "6", F.col("k")))
    got = tally(
        rows,
        by={"k": F.col("k")},
        distinct={
            "a": "a_all",
            "b": {"b_all": None, "b_p": F.col("p"), "b_q": F.col("q")},
            "n": {"n_p": F.col("p")},
        },
        sums={"total": F.col("n"), "rows": F.lit(1)},
        largest={"top": F.col("b")},
    )
    want = rows.groupBy("k").agg(
        F.max("b").alias("top"),
        F.count_distinct("a").alias("a_all"),
        F.count_distinct("b").alias("b_all"),
        F.count_distinct(F.when(F.col("p"), F.col("b"))).alias("b_p"),
        F.count_distinct(F.when(F.col("q"), F.col("b"))).alias("b_q"),
        F.count_distinct(F.when(F.col("p"), F.col("n"))).alias("n_p"),
        F.sum("n").alias("total"),
        F.count("*").alias("rows"),
    )
    assert got.columns == want.columns
    assert sorted(as_tuples(got), key=repr) == sorted(as_tuples(want), key=repr)


def test_failed_rows_count_as_commit_jobs(micro):
    # c1 succeeded in one repository and failed in the other: one job, two repositories.
    month, jobs, *_, repos, succeeded, hours = as_tuples(reports.commit_trend(micro))[0]
    assert (month, jobs, repos, succeeded, hours) == (FEBRUARY, 1, 2, 1, 0.6)
    assert FAILED in {row.commitOutcome for row in micro.select("commitOutcome").collect()}
    assert JANUARY < FEBRUARY


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_times_without_a_zone_are_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = spark.sql(
            "SELECT timestamp_ntz'2026-03-01 00:00:00' AS ntz, '2026-03-01 00:00:00' AS text, "
            "'2026-03-01' AS day, date'2026-03-01' AS date, '2026-03-01T00:00:00Z' AS utc, "
            "'2026-02-28T23:30:00.5-01:00' AS offset, timestamp'2026-03-01 00:00:00Z' AS instant"
        )
        got = times.select(*[period_start(name) for name in times.columns]).first()
        assert {str(day) for day in got} == {"2026-03-01"}
        typed = conform(times.select(F.col("ntz").alias("commitStartTime")))
        assert str(typed.select(period_start("commitStartTime")).first()[0]) == "2026-03-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
