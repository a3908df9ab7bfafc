from __future__ import annotations

from datetime import date

from micro import as_tuples

from tracetally.operators import shaping
from tracetally.schema import REPORTS

MONTH = date(2026, 2, 1)


def frame(spark, report, *rows):
    return spark.createDataFrame(list(rows), REPORTS[report])


def test_share_legend_and_label(spark):
    summary = frame(
        spark, "build_tool_summary", ("Maven", 482, 1248), ("Gradle", 218, 612),
        ("Python", 45, 98), ("Node.js", 32, 74), (".NET", 18, 42), ("Bazel", 8, 21),
    )
    rows = shaping.build_tool_share(summary).collect()
    assert [r.legend_label for r in rows] == [
        f"{tool} — {repos} repos ({repos / 803 * 100:.1f}%)"
        for tool, repos in [("Maven", 482), ("Gradle", 218), ("Python", 45), ("Node.js", 32),
                            (".NET", 18), ("Bazel", 8)]
    ]
    assert [r.show_label for r in rows] == [True, True, True, False, False, False]
    assert abs(sum(r.repo_share_pct for r in rows) - 100) < 1e-9


def test_share_rounds_ties_as_printf_does(spark):
    summary = frame(spark, "build_tool_summary", ("A", 49, 1), ("B", 351, 1))
    assert [r.legend_label for r in shaping.build_tool_share(summary).collect()] == [
        f"A — 49 repos ({12.25:.1f}%)", f"B — 351 repos ({87.75:.1f}%)"
    ]


def test_version_labels(spark):
    versions = frame(spark, "build_tool_versions", ("Maven", "3.9.6", 2, 3))
    assert shaping.build_tool_version_labels(versions).first().label == "Maven 3.9.6"


def test_kpi_cards(spark):
    summary = frame(spark, "dashboard_kpis_summary", (1785, 1924, 24, 375, 105420, 6920.0))
    assert as_tuples(shaping.kpi_cards(summary)) == [
        (1, "Total Recipe Runs", "1,785"),
        (2, "Total Commits", "1,924"),
        (3, "Unique Users", "24"),
        (4, "Unique Recipes", "375"),
        (5, "Files Changed", "105,420"),
        (6, "Est. Hours Saved", "6,920.0"),
    ]
    nothing = frame(spark, "dashboard_kpis_summary", (0, 0, 0, 0, None, None))
    assert [r.value for r in shaping.kpi_cards(nothing).collect()] == ["0"] * 4 + [None] * 2


def test_long_series_keep_order(spark):
    trend = frame(spark, "recipe_run_trend", (MONTH, 9, 3, 2))
    assert as_tuples(shaping.report_series(trend, "recipe_run_trend")) == [
        (MONTH, 1, "Recipe Runs", 9.0),
        (MONTH, 2, "Distinct Recipes", 3.0),
        (MONTH, 3, "Unique Users", 2.0),
    ]


def test_every_series_exists_in_its_report():
    for report, (points, series) in shaping.SERIES.items():
        assert {*points, *[column for column, _ in series]} <= set(REPORTS[report].names)


def test_stack(spark):
    trend = frame(spark, "build_success_trend", (MONTH, 10, 8, 3, 80.0, 5))
    assert as_tuples(shaping.build_success_stack(trend)) == [
        (MONTH, 1, "Successful Builds", 0, 8),
        (MONTH, 2, "Failed Builds", 8, 11),
    ]


def test_labels(spark):
    trend = frame(spark, "commit_activity", (MONTH, 1, 1, 12345678.5), (None, 1, 1, None))
    months = [r.month_label for r in shaping.month_label(trend).collect()]
    assert months == ["Feb 2026", None]
    assert [r.hours_label for r in shaping.hours_label(trend).collect()] == ["12345678.5h", None]
