"""Chart-ready shaping of report results: shares, labels, KPI cards, long and stacked series.

All of it is per-row work on a finished report except the share, which needs the overall total.
Row order is kept, so a sorted report stays sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The smallest share, in per cent, that still gets a label on its slice.
LABEL_FROM_PCT = 5

# The KPI cards in order, with the number of decimals shown.
KPI_CARDS = (
    ("total_recipe_runs", "Total Recipe Runs", 0),
    ("total_commits", "Total Commits", 0),
    ("unique_users", "Unique Users", 0),
    ("unique_recipes", "Unique Recipes", 0),
    ("files_changed", "Files Changed", 0),
    ("estimated_hours_saved", "Est. Hours Saved", 1),
)

# Per report the columns naming a point, then the charted series in order.
SERIES = {
    "build_success_trend": (
        ("month",),
        (
            ("successful_builds", "Successful Builds"),
            ("failed_builds", "Failed Builds"),
            ("success_rate_pct", "Success Rate %"),
        ),
    ),
    "recipe_run_trend": (
        ("month",),
        (
            ("recipe_runs", "Recipe Runs"),
            ("distinct_recipes", "Distinct Recipes"),
            ("unique_users", "Unique Users"),
        ),
    ),
    "dashboard_kpis_trend": (
        ("month",),
        (
            ("recipe_runs", "Recipe Runs"),
            ("commits", "Commits"),
            ("estimated_hours_saved", "Est. Hours Saved"),
        ),
    ),
    "commit_trend": (
        ("month",),
        (
            ("recipe_runs", "Recipe Runs"),
            ("successful_commits", "Successful Commits"),
            ("repos_with_commits", "Repos with Commits"),
            ("unique_users", "Unique Users"),
            ("unique_recipes", "Unique Recipes"),
            ("estimated_hours_saved", "Est. Hours Saved"),
        ),
    ),
    "commit_activity": (
        ("month",),
        (
            ("successful_commits", "Successful Commits"),
            ("unique_repos_changed", "Unique Repos Changed"),
            ("estimated_hours_saved", "Est. Hours Saved"),
        ),
    ),
    "security_recipe_run_trend": (
        ("month",),
        (
            ("successful_commits", "Successful Commits"),
            ("unique_repos_fixed", "Unique Repos Fixed"),
            ("distinct_recipes", "Distinct Recipes"),
            ("files_remediated", "Files Remediated"),
            ("estimated_hours_saved", "Est. Hours Saved"),
        ),
    ),
    "top_recipes": (
        ("recipe_id", "recipe_name"),
        (
            ("repos_searched", "Repos Searched"),
            ("unique_users", "Unique Users"),
            ("recipe_runs", "Recipe Runs"),
        ),
    ),
    "top_recipes_with_commits": (
        ("recipe_id", "recipe_name"),
        (("commits", "Commits"), ("unique_users", "Unique Users")),
    ),
    "top_users": (("developer",), (("recipe_runs", "Recipe Runs"), ("commits", "Commits"))),
}


def build_tool_share(summary: DataFrame) -> DataFrame:
    """Adds each tool's share of all repositories, its legend text, and whether to label its slice.

    The window spans the whole summary, which has at most one row per known build tool.
    """
    total = F.sum("repos").over(Window.partitionBy())
    shared = summary.withColumn("repo_share_pct", F.col("repos").cast("double") / total * 100)
    return shared.withColumns(
        {
            # format_number rounds the binary value half even, as printf-style "%.1f" does.
            "legend_label": F.format_string(
                "%s — %d repos (%s%%)",
                "build_tool",
                "repos",
                F.format_number("repo_share_pct", 1),
            ),
            "show_label": F.col("repo_share_pct") >= LABEL_FROM_PCT,
        }
    )


def build_tool_version_labels(versions: DataFrame) -> DataFrame:
    return versions.withColumn("label", F.concat_ws(" ", "build_tool", "tool_version"))


def kpi_cards(summary: DataFrame) -> DataFrame:
    """The one summary row as six rows: position, label, and the value with thousands separators."""
    cards = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(label).alias("label"),
            F.format_number(column, decimals).alias("value"),
        )
        for position, (column, label, decimals) in enumerate(KPI_CARDS, 1)
    ]
    return summary.select(F.inline(F.array(*cards)))


def long_series(
    result: DataFrame, points: Sequence[str], series: Sequence[tuple[str, str]]
) -> DataFrame:
    """Wide to long: a row per point and series, with the series' order, name and value."""
    values = [
        F.struct(
            F.lit(order).alias("series_order"),
            F.lit(label).alias("series"),
            F.col(column).cast("double").alias("value"),
        )
        for order, (column, label) in enumerate(series, 1)
    ]
    return result.select(*points, F.inline(F.array(*values)))


def report_series(result: DataFrame, report: str) -> DataFrame:
    """:func:`long_series` with the series charted for ``report``."""
    return long_series(result, *SERIES[report])


def stacked_series(
    result: DataFrame, points: Sequence[str], series: Sequence[tuple[str, str]]
) -> DataFrame:
    """Long form of stacked bars: each series starts (y0) where the one before it ends (y1)."""
    bars, base = [], F.lit(0).cast("bigint")
    for order, (column, label) in enumerate(series, 1):
        top = base + F.col(column)
        bars.append(
            F.struct(
                F.lit(order).alias("series_order"),
                F.lit(label).alias("series"),
                base.alias("y0"),
                top.alias("y1"),
            )
        )
        base = top
    return result.select(*points, F.inline(F.array(*bars)))


def build_success_stack(trend: DataFrame) -> DataFrame:
    """Successful builds below, failed builds on top."""
    points, series = SERIES["build_success_trend"]
    return stacked_series(trend, points, series[:2])


def month_label(result: DataFrame, column: str = "month") -> DataFrame:
    """Adds the axis label, such as ``Feb 2026``."""
    return result.withColumn("month_label", F.date_format(column, "MMM yyyy"))


def hours_label(result: DataFrame) -> DataFrame:
    """Adds the annotation, such as ``840.5h``."""
    shown = F.col("estimated_hours_saved").cast("decimal(28,1)").cast("string")
    return result.withColumn("hours_label", F.concat(shown, F.lit("h")))
