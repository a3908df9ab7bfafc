"""The twelve reports, and the two questions their documentation asks on top of them.

Every function takes a ``trace`` DataFrame (columns of :data:`tracetally.schema.TRACE`; start times
may be timestamps or ISO-8601 text) and returns a lazy result with the columns of
:data:`tracetally.schema.REPORTS`. A trace row is one repository x one command, and job ids are
shared by all repositories of a command: jobs are counted as distinct ids, repositories as rows
or distinct paths. Ties in a ranking are broken by its key, and NULL keys come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracetally.functions.columns import (
    SECURITY_PATTERNS,
    build_tool,
    hours,
    not_succeeded,
    percentage,
    period_start,
    reached,
    recipe_like,
    succeeded,
    tool_version,
    utc_timestamp,
)
from tracetally.operators.tally import tally
from tracetally.schema import REPORTS

_EFFORT = "runEstimatedEffortTimeSavingsMs"
_FIXED_FILES = "runFilesWithFixResults"


def _result(counted: DataFrame, report: str, bucket_name: str = "month") -> DataFrame:
    names = [bucket_name if name == "month" else name for name in REPORTS[report].names]
    return counted.select(*names)


def _ranked(result: DataFrame, metric: str, key: str, limit: int | None) -> DataFrame:
    ordered = result.orderBy(F.desc(metric), F.asc_nulls_last(key))
    return ordered if limit is None else ordered.limit(limit)


def build_success_trend(
    trace: DataFrame, grain: str = "month", bucket_name: str = "month"
) -> DataFrame:
    """Build health per period.

    Builds are distinct build ids, not attempts per repository. An id with both good and bad
    repositories counts as successful *and* failed, so the two may add up to more than the total.
    """
    counted = tally(
        trace.where(reached("build")),
        by={bucket_name: period_start("buildStartTime", grain)},
        distinct={
            "path": "unique_repos",
            "buildId": {
                "total_builds": None,
                "successful_builds": succeeded("build"),
                "failed_builds": not_succeeded("build"),
            },
        },
    ).withColumn(
        "success_rate_pct", percentage(F.col("successful_builds"), F.col("total_builds"))
    )
    return _result(counted, "build_success_trend", bucket_name).orderBy(
        F.asc_nulls_last(bucket_name)
    )


def build_tool_summary(trace: DataFrame) -> DataFrame:
    """Repositories and builds per build tool, over successful builds.

    A repository that changed its tool counts once for each.
    """
    counted = tally(
        trace.where(succeeded("build")),
        by={"build_tool": build_tool()},
        distinct={"path": "repos", "buildId": "builds"},
    )
    return _ranked(_result(counted, "build_tool_summary"), "repos", "build_tool", None)


def build_tool_versions(trace: DataFrame) -> DataFrame:
    """Repositories and builds per build tool and version, over successful builds."""
    counted = tally(
        trace.where(succeeded("build")),
        by={"build_tool": build_tool(), "tool_version": tool_version()},
        distinct={"path": "repos", "buildId": "builds"},
    )
    return _result(counted, "build_tool_versions").orderBy(
        "build_tool", F.desc("repos"), "tool_version"
    )


def repos_on_tool_version(trace: DataFrame, tool: str, version_prefix: str) -> DataFrame:
    """One row: how many repositories built successfully with such a version of ``tool``."""
    on_version = trace.where(
        succeeded("build")
        & (build_tool() == tool)
        & tool_version().startswith(version_prefix)
    )
    return on_version.agg(F.count_distinct("path").alias("repos")).select(
        F.lit(tool).alias("build_tool"), F.lit(version_prefix).alias("version_prefix"), "repos"
    )


def current_builds(trace: DataFrame) -> DataFrame:
    """Build tool and version of each repository and branch by its last successful build.

    Of builds that started at the same time, the one with the greatest tool and version counts.
    A repository's history collapses to its different versions before anything sorts.
    """
    repository = ("origin", "path", "branch")
    versions = (
        trace.where(succeeded("build"))
        .groupBy(*repository, build_tool().alias("build_tool"), tool_version().alias("tool_version"))
        .agg(F.max(utc_timestamp(F.col("buildStartTime"))).alias("at"))
    )
    return (
        versions.groupBy(*repository)
        .agg(F.max(F.struct("at", "build_tool", "tool_version")).alias("last"))
        .select(*repository, "last.build_tool", "last.tool_version")
    )


def current_tool_versions(trace: DataFrame) -> DataFrame:
    """Repositories per build tool and version that their last successful build used."""
    return (
        current_builds(trace)
        .groupBy("build_tool", "tool_version")
        .agg(F.count_distinct("path").alias("repos"))
        .orderBy("build_tool", F.desc("repos"), "tool_version")
    )


def repos_still_on_tool_version(trace: DataFrame, tool: str, version_prefix: str) -> DataFrame:
    """One row: how many repositories have such a version of ``tool`` in their last successful
    build. Unlike :func:`repos_on_tool_version`, those that have moved on do not count."""
    now = current_builds(trace)
    on_version = now.where((F.col("build_tool") == tool) & F.col("tool_version").startswith(version_prefix))
    return on_version.agg(F.count_distinct("path").alias("repos")).select(
        F.lit(tool).alias("build_tool"), F.lit(version_prefix).alias("version_prefix"), "repos"
    )


def recipe_run_trend(
    trace: DataFrame, grain: str = "month", bucket_name: str = "month"
) -> DataFrame:
    """Adoption per period: runs, recipes and users."""
    counted = tally(
        trace.where(reached("run")),
        by={bucket_name: period_start("runStartTime", grain)},
        distinct={
            "developer": "unique_users",
            "runRecipeId": "distinct_recipes",
            "runId": "recipe_runs",
        },
    )
    return _result(counted, "recipe_run_trend", bucket_name).orderBy(
        F.asc_nulls_last(bucket_name)
    )


def top_recipes(trace: DataFrame, limit: int | None = None) -> DataFrame:
    """Recipes by number of runs. The name shown is the greatest one used, not the latest."""
    counted = tally(
        trace.where(reached("run")),
        by={"recipe_id": F.col("runRecipeId")},
        distinct={
            "developer": "unique_users",
            "path": "repos_searched",
            "runId": "recipe_runs",
        },
        largest={"recipe_name": F.col("runRecipeInstanceName")},
    )
    return _ranked(_result(counted, "top_recipes"), "recipe_runs", "recipe_id", limit)


def dashboard_kpis_summary(trace: DataFrame) -> DataFrame:
    """All-time totals, always one row; on run-only traces the commits are 0."""
    counted = tally(
        trace.where(reached("run")),
        by={},
        distinct={
            "developer": "unique_users",
            "runRecipeId": "unique_recipes",
            "runId": "total_recipe_runs",
            "commitId": {"total_commits": succeeded("commit")},
        },
        sums={"files_changed": F.col(_FIXED_FILES), "effort_ms": F.col(_EFFORT)},
    ).withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    return _result(counted, "dashboard_kpis_summary")


def dashboard_kpis_trend(
    trace: DataFrame, grain: str = "month", bucket_name: str = "month"
) -> DataFrame:
    """The summary per period. Commits are dated by their run, unlike in the commit reports."""
    counted = tally(
        trace.where(reached("run")),
        by={bucket_name: period_start("runStartTime", grain)},
        distinct={
            "developer": "unique_users",
            "runRecipeId": "unique_recipes",
            "runId": "recipe_runs",
            "commitId": {"commits": succeeded("commit")},
        },
        sums={"files_changed": F.col(_FIXED_FILES), "effort_ms": F.col(_EFFORT)},
    ).withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    return _result(counted, "dashboard_kpis_trend", bucket_name).orderBy(
        F.asc_nulls_last(bucket_name)
    )


def commit_trend(
    trace: DataFrame, grain: str = "month", bucket_name: str = "month"
) -> DataFrame:
    """Runs against committed impact per period.

    Every row that reached the commit stage counts, failed commits too; only
    ``successful_commits`` (distinct commit ids) asks for success.
    """
    counted = tally(
        trace.where(reached("commit")),
        by={bucket_name: period_start("commitStartTime", grain)},
        distinct={
            "developer": "unique_users",
            "runRecipeId": "unique_recipes",
            "path": "repos_with_commits",
            "runId": "recipe_runs",
            "commitId": {
                "commit_jobs": None,
                "successful_commits": succeeded("commit"),
            },
        },
        sums={"effort_ms": F.col(_EFFORT)},
    ).withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    return _result(counted, "commit_trend", bucket_name).orderBy(F.asc_nulls_last(bucket_name))


def commit_activity(
    trace: DataFrame, grain: str = "month", bucket_name: str = "month"
) -> DataFrame:
    """Committed output per period. Here successful commits are rows, one per repository."""
    return (
        trace.where(succeeded("commit"))
        .groupBy(period_start("commitStartTime", grain).alias(bucket_name))
        .agg(
            F.count("*").alias("successful_commits"),
            F.count_distinct("path").alias("unique_repos_changed"),
            hours(F.sum(_EFFORT)).alias("estimated_hours_saved"),
        )
        .orderBy(F.asc_nulls_last(bucket_name))
    )


def top_users(trace: DataFrame, limit: int | None = None) -> DataFrame:
    """Developers by number of runs, with their distinct succeeded commit ids."""
    counted = tally(
        trace.where(reached("run")),
        by={"developer": F.col("developer")},
        distinct={"runId": "recipe_runs", "commitId": {"commits": succeeded("commit")}},
    )
    return _ranked(_result(counted, "top_users"), "recipe_runs", "developer", limit)


def top_recipes_with_commits(trace: DataFrame, limit: int | None = None) -> DataFrame:
    """Recipes by number of distinct succeeded commit ids."""
    counted = tally(
        trace.where(succeeded("commit")),
        by={"recipe_id": F.col("runRecipeId")},
        distinct={"developer": "unique_users", "commitId": "commits"},
        sums={"effort_ms": F.col(_EFFORT)},
        largest={"recipe_name": F.col("runRecipeInstanceName")},
    ).withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    return _ranked(_result(counted, "top_recipes_with_commits"), "commits", "recipe_id", limit)


def recipe_run_commit_gap(trace: DataFrame) -> DataFrame:
    """Per recipe that was run: its runs, its commits, and how far the commits fall short.

    Equal to :func:`top_recipes` left-joined with :func:`top_recipes_with_commits`, but read in
    one pass: a recipe stays if a run was reached, and each count keeps the filter of its report.
    """
    ran, committed = reached("run"), succeeded("commit")
    counted = tally(
        trace.where(ran | committed),
        by={"recipe_id": F.col("runRecipeId")},
        distinct={"runId": {"recipe_runs": ran}, "commitId": {"commits": committed}},
        sums={"run_rows": F.when(ran, 1)},
        largest={"recipe_name": F.when(ran, F.col("runRecipeInstanceName"))},
    )
    gap = counted.where(F.col("run_rows") > 0).select(
        "recipe_id",
        "recipe_name",
        "recipe_runs",
        "commits",
        (F.col("recipe_runs") - F.col("commits")).alias("gap"),
    )
    return _ranked(gap, "gap", "recipe_id", None)


def security_recipe_run_trend(
    trace: DataFrame,
    grain: str = "month",
    bucket_name: str = "month",
    recipes: Column | None = None,
) -> DataFrame:
    """Committed security fixes per period; successful commits are rows, one per repository.

    ``recipes`` replaces the default filter: see ``recipe_like``, ``recipe_under``, ``recipe_is``.
    """
    wanted = recipe_like(*SECURITY_PATTERNS) if recipes is None else recipes
    counted = tally(
        trace.where(succeeded("commit") & wanted),
        by={bucket_name: period_start("commitStartTime", grain)},
        distinct={"runRecipeId": "distinct_recipes", "path": "unique_repos_fixed"},
        sums={
            "successful_commits": F.lit(1),
            "files_remediated": F.col(_FIXED_FILES),
            "effort_ms": F.col(_EFFORT),
        },
    ).withColumn("estimated_hours_saved", hours(F.col("effort_ms")))
    return _result(counted, "security_recipe_run_trend", bucket_name).orderBy(
        F.asc_nulls_last(bucket_name)
    )
