"""Seven hand-made trace rows and the answer of every report, worked out by hand."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tracetally.sources.traces import conform

S, FAILED = "Succeeded", "Failed"
JAN_END = "2026-01-31T23:59:59.999Z"
FEB_START = "2026-02-01T00:00:00.000Z"
FEB = "2026-02-10T08:00:00.000Z"
SEC, IMPORTS = "org.openrewrite.java.security.A", "org.openrewrite.java.OrderImports"

COLUMNS = (
    "path developer buildOutcome buildStartTime buildId buildMavenVersion buildGradleVersion "
    "runOutcome runStartTime runId runRecipeId runRecipeInstanceName "
    "runEstimatedEffortTimeSavingsMs runFilesWithFixResults "
    "commitOutcome commitStartTime commitId"
).split()

ROWS = [
    ("o/a", "alice", S, JAN_END, "b1", "3.9.6", None, S, JAN_END, "u1", SEC, "Sec A",
     "1800000", "3", S, FEB_START, "c1"),
    ("o/b", "alice", S, JAN_END, "b1", "", "8.5", S, JAN_END, "u1", SEC, "Sec A",
     "180000", "2", FAILED, FEB_START, "c1"),
    ("o/c", "bob", FAILED, "2026-01-15T10:00:00.000Z", "b1", "3.9.6", *[None] * 11),
    ("o/a", "bob", S, FEB, "b2", "3.8.4", "7.6.1", S, FEB, "u2", IMPORTS, "Order imports",
     None, "0", None, None, None),
    ("o/d", None, S, FEB, "b2", None, None, FAILED, FEB, "u2", IMPORTS, "Order imports v2",
     "3600000", "1", None, None, None),
    ("o/e", "carol", *[None] * 15),
    ("o/f", "carol", *[""] * 15),
]

JANUARY, FEBRUARY = date(2026, 1, 1), date(2026, 2, 1)

EXPECTED = {
    "build_success_trend": [(JANUARY, 1, 1, 1, 100.0, 3), (FEBRUARY, 1, 1, 0, 100.0, 2)],
    "build_tool_summary": [("Gradle", 1, 1), ("Maven", 1, 2), ("Other", 1, 1)],
    "build_tool_versions": [
        ("Gradle", "8.5", 1, 1),
        ("Maven", "3.8.4", 1, 1),
        ("Maven", "3.9.6", 1, 1),
        ("Other", "Unknown", 1, 1),
    ],
    "recipe_run_trend": [(JANUARY, 1, 1, 1), (FEBRUARY, 1, 1, 1)],
    "top_recipes": [(IMPORTS, "Order imports v2", 1, 1, 2), (SEC, "Sec A", 1, 1, 2)],
    "dashboard_kpis_summary": [(2, 1, 2, 2, 6, 1.6)],
    "dashboard_kpis_trend": [(JANUARY, 1, 1, 1, 1, 5, 0.6), (FEBRUARY, 1, 0, 1, 1, 1, 1.0)],
    "commit_trend": [(FEBRUARY, 1, 1, 1, 1, 2, 1, 0.6)],
    "commit_activity": [(FEBRUARY, 1, 1, 0.5)],
    "top_users": [("alice", 1, 1), ("bob", 1, 0), (None, 1, 0)],
    "top_recipes_with_commits": [(SEC, "Sec A", 1, 1, 0.5)],
    "security_recipe_run_trend": [(FEBRUARY, 1, 1, 3, 0.5, 1)],
}


def raw_trace(spark: SparkSession, rows=ROWS) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in COLUMNS))


def micro_trace(spark: SparkSession, rows=ROWS) -> DataFrame:
    return conform(raw_trace(spark, rows))


def as_tuples(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
