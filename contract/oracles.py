"""DuckDB SQL that recomputes every registered query from the same parquet tables."""

from __future__ import annotations

from contract.trace_fixture import TRACE_SQL

# The charted series per long key, spelled out here on purpose, so that the answers
# owe nothing to the library's own lists.
_LONG = {
    "build_success_trend_long": (
        "build_success_trend",
        "month",
        "successful_builds Successful Builds, failed_builds Failed Builds, "
        "success_rate_pct Success Rate %",
    ),
    "trend_long": (
        "recipe_run_trend",
        "month",
        "recipe_runs Recipe Runs, distinct_recipes Distinct Recipes, unique_users Unique Users",
    ),
    "dashboard_kpis_trend_long": (
        "dashboard_kpis_trend",
        "month",
        "recipe_runs Recipe Runs, commits Commits, estimated_hours_saved Est. Hours Saved",
    ),
    "commit_trend_long": (
        "commit_trend",
        "month",
        "recipe_runs Recipe Runs, successful_commits Successful Commits, "
        "repos_with_commits Repos with Commits, unique_users Unique Users, "
        "unique_recipes Unique Recipes, estimated_hours_saved Est. Hours Saved",
    ),
    "commit_activity_long": (
        "commit_activity",
        "month",
        "successful_commits Successful Commits, unique_repos_changed Unique Repos Changed, "
        "estimated_hours_saved Est. Hours Saved",
    ),
    "security_recipe_run_trend_long": (
        "security_recipe_run_trend",
        "month",
        "successful_commits Successful Commits, unique_repos_fixed Unique Repos Fixed, "
        "distinct_recipes Distinct Recipes, files_remediated Files Remediated, "
        "estimated_hours_saved Est. Hours Saved",
    ),
    "top_recipes_long": (
        "top_recipes",
        "recipe_id, recipe_name",
        "repos_searched Repos Searched, unique_users Unique Users, recipe_runs Recipe Runs",
    ),
    "top_recipes_with_commits_long": (
        "top_recipes_with_commits",
        "recipe_id, recipe_name",
        "commits Commits, unique_users Unique Users",
    ),
    "top_users_long": ("top_users", "developer", "recipe_runs Recipe Runs, commits Commits"),
}

_TRACE = TRACE_SQL.format(lineitem="lineitem", orders="orders").strip()
_HOURS = "round(CAST(sum(runEstimatedEffortTimeSavingsMs) AS DOUBLE) / 3600000, 1)"
_TOOLS = ["Maven", "Gradle", "Bazel", ".NET", "Python", "Node.js"]
_VERSIONS = [f"build{name}Version" for name in ("Maven", "Gradle", "Bazel", "Dotnet", "Python", "Node")]
_TOOL = ", ".join(f"CASE WHEN {v} <> '' THEN '{t}' END" for t, v in zip(_TOOLS, _VERSIONS))
_VERSION = ", ".join(f"CASE WHEN {v} <> '' THEN {v} END" for v in _VERSIONS)
_SECURITY = ["org.openrewrite.java.security.", "org.openrewrite.staticanalysis."]
_DEPENDENCIES = "org.openrewrite.java.dependencies."


def _period(column: str, grain: str) -> str:
    return f"CAST(date_trunc('{grain}', CAST({column} AS TIMESTAMP)) AS DATE)"


def _starts(prefixes: list[str]) -> str:
    return " OR ".join(f"starts_with(runRecipeId, '{prefix}')" for prefix in prefixes)


def _build_success_trend(grain: str = "month") -> str:
    return f"""
        SELECT month, total_builds, successful_builds, failed_builds,
               round(100.0 * successful_builds / nullif(total_builds, 0), 1) AS success_rate_pct, unique_repos
        FROM (SELECT {_period("buildStartTime", grain)} AS month,
                     count(DISTINCT buildId) AS total_builds,
                     count(DISTINCT buildId) FILTER (buildOutcome = 'Succeeded') AS successful_builds,
                     count(DISTINCT buildId) FILTER (buildOutcome <> 'Succeeded') AS failed_builds,
                     count(DISTINCT path) AS unique_repos
              FROM trace WHERE buildOutcome IS NOT NULL GROUP BY ALL)
        ORDER BY month"""


def _recipe_run_trend(grain: str = "month") -> str:
    return f"""
        SELECT {_period("runStartTime", grain)} AS month, count(DISTINCT runId) AS recipe_runs,
               count(DISTINCT runRecipeId) AS distinct_recipes,
               count(DISTINCT developer) AS unique_users
        FROM trace WHERE runOutcome IS NOT NULL GROUP BY ALL ORDER BY month"""


def _dashboard(commits: str, runs: str) -> str:
    return f"""
        count(DISTINCT runId) AS {runs},
        count(DISTINCT commitId) FILTER (commitOutcome = 'Succeeded') AS {commits},
        count(DISTINCT developer) AS unique_users, count(DISTINCT runRecipeId) AS unique_recipes,
        CAST(sum(runFilesWithFixResults) AS BIGINT) AS files_changed,
        {_HOURS} AS estimated_hours_saved
        FROM trace WHERE runOutcome IS NOT NULL"""


def _dashboard_kpis_summary() -> str:
    return f"SELECT {_dashboard('total_commits', 'total_recipe_runs')}"


def _dashboard_kpis_trend(grain: str = "month") -> str:
    return f"""SELECT {_period("runStartTime", grain)} AS month,
        {_dashboard('commits', 'recipe_runs')} GROUP BY ALL ORDER BY month"""


def _commit_trend(grain: str = "month") -> str:
    return f"""
        SELECT {_period("commitStartTime", grain)} AS month, count(DISTINCT commitId) AS commit_jobs,
               count(DISTINCT runId) AS recipe_runs, count(DISTINCT developer) AS unique_users,
               count(DISTINCT runRecipeId) AS unique_recipes,
               count(DISTINCT path) AS repos_with_commits,
               count(DISTINCT commitId) FILTER (commitOutcome = 'Succeeded') AS successful_commits,
               {_HOURS} AS estimated_hours_saved
        FROM trace WHERE commitOutcome IS NOT NULL GROUP BY ALL ORDER BY month"""


def _commit_activity(grain: str = "month") -> str:
    return f"""
        SELECT {_period("commitStartTime", grain)} AS month, count(*) AS successful_commits,
               count(DISTINCT path) AS unique_repos_changed, {_HOURS} AS estimated_hours_saved
        FROM trace WHERE commitOutcome = 'Succeeded' GROUP BY ALL ORDER BY month"""


def _security(grain: str = "month", recipes: str | None = None) -> str:
    return f"""
        SELECT {_period("commitStartTime", grain)} AS month, count(*) AS successful_commits,
               count(DISTINCT path) AS unique_repos_fixed,
               CAST(sum(runFilesWithFixResults) AS BIGINT) AS files_remediated,
               {_HOURS} AS estimated_hours_saved, count(DISTINCT runRecipeId) AS distinct_recipes
        FROM trace WHERE commitOutcome = 'Succeeded' AND ({recipes or _starts(_SECURITY)})
        GROUP BY ALL ORDER BY month"""


def _build_tool_summary() -> str:
    return f"""
        SELECT coalesce({_TOOL}, 'Other') AS build_tool, count(DISTINCT path) AS repos,
               count(DISTINCT buildId) AS builds
        FROM trace WHERE buildOutcome = 'Succeeded' GROUP BY ALL ORDER BY repos DESC, build_tool"""


def _build_tool_versions() -> str:
    return f"""
        SELECT coalesce({_TOOL}, 'Other') AS build_tool,
               coalesce({_VERSION}, 'Unknown') AS tool_version,
               count(DISTINCT path) AS repos, count(DISTINCT buildId) AS builds
        FROM trace WHERE buildOutcome = 'Succeeded' GROUP BY ALL
        ORDER BY build_tool, repos DESC, tool_version"""


def _top_recipes(limit: str = "") -> str:
    return f"""
        SELECT runRecipeId AS recipe_id, max(runRecipeInstanceName) AS recipe_name,
               count(DISTINCT runId) AS recipe_runs, count(DISTINCT developer) AS unique_users,
               count(DISTINCT path) AS repos_searched
        FROM trace WHERE runOutcome IS NOT NULL GROUP BY ALL
        ORDER BY recipe_runs DESC, recipe_id {limit}"""


def _top_users(limit: str = "", commits: str = "commitId") -> str:
    return f"""
        SELECT developer, count(DISTINCT runId) AS recipe_runs,
               count(DISTINCT {commits}) FILTER (commitOutcome = 'Succeeded') AS commits
        FROM trace WHERE runOutcome IS NOT NULL GROUP BY ALL
        ORDER BY recipe_runs DESC, developer {limit}"""


def _top_recipes_with_commits(limit: str = "") -> str:
    return f"""
        SELECT runRecipeId AS recipe_id, max(runRecipeInstanceName) AS recipe_name,
               count(DISTINCT commitId) AS commits, count(DISTINCT developer) AS unique_users,
               {_HOURS} AS estimated_hours_saved
        FROM trace WHERE commitOutcome = 'Succeeded' GROUP BY ALL
        ORDER BY commits DESC, recipe_id {limit}"""


def _long(wide: str, points: str, series: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {points}, {order} AS series_order, '{label}' AS series, "
        f"CAST({column} AS DOUBLE) AS value FROM wide"
        for order, (column, label) in enumerate((s.split(" ", 1) for s in series.split(", ")), 1)
    )
    return f"SELECT * FROM (WITH wide AS ({wide}) {rows})"


def _kpi_cards() -> str:
    cards = [
        ("Total Recipe Runs", "format('{:,}', total_recipe_runs)"),
        ("Total Commits", "format('{:,}', total_commits)"),
        ("Unique Users", "format('{:,}', unique_users)"),
        ("Unique Recipes", "format('{:,}', unique_recipes)"),
        ("Files Changed", "format('{:,}', files_changed)"),
        (
            "Est. Hours Saved",
            "format('{:,}', CAST(floor(estimated_hours_saved) AS BIGINT)) || '.' || "
            "CAST(CAST(round(estimated_hours_saved * 10) AS BIGINT) % 10 AS VARCHAR)",
        ),
    ]
    rows = " UNION ALL ".join(
        f"SELECT {position} AS position, '{label}' AS label, {value} AS value FROM kpis"
        for position, (label, value) in enumerate(cards, 1)
    )
    return f"SELECT * FROM (WITH kpis AS ({_dashboard_kpis_summary()}) {rows})"


def _build_tool_share() -> str:
    return f"""
        SELECT build_tool, repos, builds, repo_share_pct,
               printf('%s — %d repos (%.1f%%)', build_tool, repos, repo_share_pct) AS legend_label,
               repo_share_pct >= 5 AS show_label
        FROM (SELECT *, CAST(repos AS DOUBLE) / (sum(repos) OVER ()) * 100 AS repo_share_pct
              FROM ({_build_tool_summary()}))"""


def _build_success_stack() -> str:
    return f"""
        SELECT * FROM (WITH wide AS ({_build_success_trend()})
        SELECT month, 1 AS series_order, 'Successful Builds' AS series, CAST(0 AS BIGINT) AS y0,
               successful_builds AS y1 FROM wide
        UNION ALL
        SELECT month, 2, 'Failed Builds', successful_builds, successful_builds + failed_builds
        FROM wide)"""


def _recipe_run_commit_gap() -> str:
    return f"""
        SELECT r.recipe_id, r.recipe_name, r.recipe_runs, coalesce(c.commits, 0) AS commits,
               r.recipe_runs - coalesce(c.commits, 0) AS gap
        FROM ({_top_recipes()}) r LEFT JOIN ({_top_recipes_with_commits()}) c
          ON r.recipe_id IS NOT DISTINCT FROM c.recipe_id
        ORDER BY gap DESC, r.recipe_id"""


def _repos_on_tool_version(tool: str, prefix: str) -> str:
    return f"""
        SELECT '{tool}' AS build_tool, '{prefix}' AS version_prefix, count(DISTINCT path) AS repos
        FROM trace WHERE buildOutcome = 'Succeeded' AND coalesce({_TOOL}, 'Other') = '{tool}'
          AND starts_with(coalesce({_VERSION}, 'Unknown'), '{prefix}')"""


def _current_builds() -> str:
    """Origin and branch are constants in the derived trace, so the path names the repository."""
    return f"""
        SELECT path, tool AS build_tool, version AS tool_version
        FROM (SELECT path, CAST(buildStartTime AS TIMESTAMP) AS started,
                     coalesce({_TOOL}, 'Other') AS tool, coalesce({_VERSION}, 'Unknown') AS version
              FROM trace WHERE buildOutcome = 'Succeeded')
        QUALIFY row_number() OVER (
            PARTITION BY path ORDER BY started DESC NULLS LAST, tool DESC, version DESC) = 1"""


def _commit_trend_dense(grain: str) -> str:
    counts = ["commit_jobs", "recipe_runs", "unique_users", "unique_recipes", "repos_with_commits"]
    counted = ", ".join(f"coalesce({name}, 0) AS {name}" for name in [*counts, "successful_commits"])
    step = {"week": "7 DAYS", "month": "1 MONTH", "quarter": "3 MONTHS", "year": "1 YEAR"}[grain]
    return f"""
        SELECT * FROM (WITH wide AS ({_commit_trend(grain)}),
        calendar AS (
            SELECT CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP),
                CAST(max(month) AS TIMESTAMP), INTERVAL {step})) AS DATE) AS month FROM wide)
        SELECT month, {counted}, estimated_hours_saved FROM calendar LEFT JOIN wide USING (month)
        UNION ALL SELECT * FROM wide WHERE month IS NULL)
        ORDER BY month"""


def _deepest_stage_kpis() -> str:
    """The KPIs over the trace and its run-only copy, each repository of a run once.

    The fixture's origin and branch are constants, so path and developer name the repository.
    """
    columns = {2: [*_VERSIONS, "buildOutcome", "buildStartTime"]}
    columns[3] = [f"run{name}" for name in (
        "Outcome", "StartTime", "RecipeId", "RecipeInstanceName", "EstimatedEffortTimeSavingsMs",
        "FilesWithFixResults",
    )]
    columns[6] = ["commitOutcome", "commitStartTime", "commitId"]
    reached = ", ".join(
        f"CASE WHEN depth >= {depth} THEN {name} END AS {name}"
        for depth, names in columns.items()
        for name in names
    )
    kpis = _dashboard_kpis_summary().replace("FROM trace", "FROM reduced")
    return f"""
        SELECT * FROM (WITH twice AS (
            SELECT * FROM trace
            UNION ALL BY NAME SELECT * EXCLUDE (commitOutcome, commitStartTime, commitId) FROM trace),
        deep AS (
            SELECT *, CASE WHEN commitOutcome IS NOT NULL THEN 6 WHEN runOutcome IS NOT NULL THEN 3
                           WHEN buildOutcome IS NOT NULL THEN 2 ELSE 0 END AS depth FROM twice),
        latest AS (
            SELECT * FROM deep WHERE runId IS NOT NULL
            QUALIFY depth = max(depth) OVER (PARTITION BY path, developer, buildId, runId)),
        reduced AS (
            SELECT * FROM deep WHERE runId IS NULL
            UNION ALL BY NAME SELECT DISTINCT path, developer, buildId, runId, depth, {reached}
            FROM latest)
        {kpis})"""


_TRENDS = {
    "build_success_trend": _build_success_trend,
    "recipe_run_trend": _recipe_run_trend,
    "dashboard_kpis_trend": _dashboard_kpis_trend,
    "commit_trend": _commit_trend,
    "commit_activity": _commit_activity,
    "security_recipe_run_trend": _security,
}
_TABLES = {
    "build_tool_summary": _build_tool_summary,
    "build_tool_versions": _build_tool_versions,
    "top_recipes": _top_recipes,
    "dashboard_kpis_summary": _dashboard_kpis_summary,
    "top_users": _top_users,
    "top_recipes_with_commits": _top_recipes_with_commits,
}


def report_selects() -> dict[str, str]:
    """Every query over a relation ``trace``."""
    selects = {name: make() for name, make in {**_TRENDS, **_TABLES}.items()}
    for name, make in _TRENDS.items():
        for grain in ("week", "quarter", "year"):
            selects[f"{name}_{grain}"] = make(grain)
    for key, (report, points, series) in _LONG.items():
        selects[key] = _long(selects[report], points, series)
    selects |= {
        "top_recipes_limit": _top_recipes("LIMIT 3"),
        "top_users_limit": _top_users("LIMIT 20"),
        "top_recipes_with_commits_limit": _top_recipes_with_commits("LIMIT 3"),
        "top_users_run_only": _top_users(commits="CAST(NULL AS VARCHAR)"),
        "security_trend_extra_patterns": _security(recipes=_starts([*_SECURITY, _DEPENDENCIES])),
        "security_trend_exact_recipe": _security(
            recipes="runRecipeId = 'org.openrewrite.java.security.OwaspA01'"
        ),
        "repos_on_tool_version": _repos_on_tool_version("Maven", "3.6"),
        "repos_still_on_tool_version": f"""
            SELECT 'Maven' AS build_tool, '3.6' AS version_prefix, count(DISTINCT path) AS repos
            FROM ({_current_builds()})
            WHERE build_tool = 'Maven' AND starts_with(tool_version, '3.6')""",
        "current_tool_versions": f"""
            SELECT build_tool, tool_version, count(DISTINCT path) AS repos
            FROM ({_current_builds()}) GROUP BY ALL ORDER BY build_tool, repos DESC, tool_version""",
        "commit_trend_between": _commit_trend().replace(
            "WHERE commitOutcome IS NOT NULL",
            "WHERE commitOutcome IS NOT NULL AND CAST(commitStartTime AS TIMESTAMP) >= '1993-03-15' "
            "AND CAST(commitStartTime AS TIMESTAMP) < '1995-02-02'",
        ),
        "security_trend_rule_table": _security(),
        "recipe_label_runs": """
            SELECT CASE WHEN runRecipeId IS NULL THEN NULL
                        WHEN starts_with(runRecipeId, 'org.openrewrite.java.security.') THEN 'Security'
                        WHEN starts_with(runRecipeId, 'org.openrewrite.java.dep') THEN 'Dependencies'
                        WHEN starts_with(runRecipeId, 'org.openrewrite.java.') THEN 'Java'
                        WHEN starts_with(runRecipeId, 'x_') THEN 'X' ELSE 'Other' END AS label,
                   count(DISTINCT runId) AS recipe_runs
            FROM trace WHERE runOutcome IS NOT NULL GROUP BY ALL""",
        "commit_trend_sql": _commit_trend("quarter"),
        "top_users_sql": _top_users("LIMIT 20"),
        "recipe_run_commit_gap": _recipe_run_commit_gap(),
        "commit_trend_typed": _commit_trend(),
        "commit_trend_zoneless": _commit_trend(),
        "deepest_stage_kpis": _deepest_stage_kpis(),
        "merged_stage_kpis": _deepest_stage_kpis(),
        "build_tool_share": _build_tool_share(),
        "build_tool_version_labels": f"""
            SELECT *, build_tool || ' ' || tool_version AS label
            FROM ({_build_tool_versions()})""",
        "kpi_cards": _kpi_cards(),
        "build_success_stack": _build_success_stack(),
        "month_label": f"""
            SELECT *, strftime(month, '%b %Y') AS month_label FROM ({_commit_trend()})""",
        "hours_label": f"""
            SELECT *, printf('%.1fh', estimated_hours_saved) AS hours_label
            FROM ({_top_recipes_with_commits()})""",
    }
    for grain in ("week", "month", "quarter", "year"):
        end = "" if grain == "month" else f"_{grain}"
        selects[f"commit_trend_rollup{end}"] = _commit_trend(grain)
        selects[f"commit_trend_dense{end}"] = _commit_trend_dense(grain)
    for name in ("build_success_trend", "dashboard_kpis_trend"):
        selects[f"{name}_rollup"] = _TRENDS[name]()
    return selects


def oracle_sql() -> dict[str, str]:
    return {
        name: f"WITH trace AS ({_TRACE})\n{select}" for name, select in report_selects().items()
    }
