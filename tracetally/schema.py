"""Column names and types: the wide ``trace`` fact table and the twelve report results."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _struct(text: str) -> T.StructType:
    pairs = (field.split() for field in text.replace("\n", " ").split(",") if field.strip())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The documented trace columns, in documented order. The push columns have no
# documented position, so they come last; nothing may rely on position.
TRACE = _struct("""
    origin string, path string, branch string, developer string,

    syncOutcome string, syncCloneUri string, syncLstDownloadUri string, syncStartTime timestamp,
    syncEndTime timestamp, syncChangeset string, syncElapsedTimeMs long,

    buildOutcome string, buildStartTime timestamp, buildEndTime timestamp, buildId string,
    buildDependencyResolutionTimeMs long, buildChangeset string, buildMavenVersion string,
    buildGradleVersion string, buildBazelVersion string, buildDotnetVersion string,
    buildPythonVersion string, buildNodeVersion string, buildOsName string, buildOsVersion string,
    buildOsEol string, buildGitAutocrlf string, buildGitEol string, buildSourceFileCount long,
    buildLineCount long, buildParseErrorCount long, buildWeight long, buildMaxWeight long,
    buildMaxWeightSourceFile string, buildCliVersion string, buildElapsedTimeMs long,

    runOutcome string, runStartTime timestamp, runEndTime timestamp, runId string,
    runUnlicensedAttempt boolean, runStreaming boolean, runRecipeId string,
    runRecipeInstanceName string, runRecipeOptions string, runRecipeArtifact string,
    runEstimatedEffortTimeSavingsMs long, runDependencyResolutionTimeMs long,
    runPomCacheHitRate double, runResolvedPomCacheHitRate double, runFilesWithFixResults long,
    runFilesWithSearchResults long, runFilesWithErrors long, runFilesSearched long,
    runDataTables long, runThread string, runElapsedTimeMs long,

    applyOutcome string, applyStartTime timestamp, applyEndTime timestamp, applyId string,
    applyElapsedTimeMs long,

    addOutcome string, addStartTime timestamp, addEndTime timestamp, addId string,
    addElapsedTimeMs long,

    commitOutcome string, commitStartTime timestamp, commitEndTime timestamp, commitId string,
    commitBranch string, commitElapsedTimeMs long,

    organization string,

    pushOutcome string, pushStartTime timestamp, pushEndTime timestamp, pushId string,
    pushElapsedTimeMs long
""")

# The stages of the workflow, shallowest first; each embeds those before it.
STAGES = ("sync", "build", "run", "apply", "add", "commit", "push")

# Columns every trace has, whatever its stage. A header line is known by them.
COMMON_COLUMNS = ("origin", "path", "branch", "developer")

# Result columns of each report, in order.
REPORTS = {
    "build_success_trend": _struct("""
        month date, total_builds long, successful_builds long, failed_builds long,
        success_rate_pct double, unique_repos long"""),
    "build_tool_summary": _struct("build_tool string, repos long, builds long"),
    "build_tool_versions": _struct(
        "build_tool string, tool_version string, repos long, builds long"),
    "recipe_run_trend": _struct(
        "month date, recipe_runs long, distinct_recipes long, unique_users long"),
    "top_recipes": _struct("""
        recipe_id string, recipe_name string, recipe_runs long, unique_users long,
        repos_searched long"""),
    "dashboard_kpis_summary": _struct("""
        total_recipe_runs long, total_commits long, unique_users long, unique_recipes long,
        files_changed long, estimated_hours_saved double"""),
    "dashboard_kpis_trend": _struct("""
        month date, recipe_runs long, commits long, unique_users long, unique_recipes long,
        files_changed long, estimated_hours_saved double"""),
    "commit_trend": _struct("""
        month date, commit_jobs long, recipe_runs long, unique_users long, unique_recipes long,
        repos_with_commits long, successful_commits long, estimated_hours_saved double"""),
    "commit_activity": _struct("""
        month date, successful_commits long, unique_repos_changed long,
        estimated_hours_saved double"""),
    "top_users": _struct("developer string, recipe_runs long, commits long"),
    "top_recipes_with_commits": _struct("""
        recipe_id string, recipe_name string, commits long, unique_users long,
        estimated_hours_saved double"""),
    "security_recipe_run_trend": _struct("""
        month date, successful_commits long, unique_repos_fixed long, files_remediated long,
        estimated_hours_saved double, distinct_recipes long"""),
}
