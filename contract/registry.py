"""Every report and shaping operator as a query over the derived trace."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.folders import working_folder
from contract.trace_fixture import fixture_trace
from tracetally.functions.columns import GRAINS, SECURITY_PATTERNS, recipe_is, recipe_like
from tracetally.operators import shaping
from tracetally.operators.calendar import dense
from tracetally.operators.rules import labelled, under_any
from tracetally.plans import reports
from tracetally.plans.rollups import refresh, rollup
from tracetally.schema import TRACE
from tracetally.sources.latest import merge_latest, open_latest
from tracetally.sources.shuffles import dropping_shuffles
from tracetally.sources.sql import register_reports
from tracetally.sources.store import within
from tracetally.sources.traces import conform, deepest_stage, open_trace

Query = Callable[[SparkSession, str], DataFrame]

_TRENDS = (
    "build_success_trend",
    "recipe_run_trend",
    "dashboard_kpis_trend",
    "commit_trend",
    "commit_activity",
    "security_recipe_run_trend",
)
_TABLES = (
    "build_tool_summary",
    "build_tool_versions",
    "top_recipes",
    "dashboard_kpis_summary",
    "top_users",
    "top_recipes_with_commits",
)
_COMMIT_AND_LATER = [name for name in TRACE.names if name.startswith(("commit", "push"))]


def _zoneless(trace: DataFrame) -> DataFrame:
    """``trace`` with TIMESTAMP_NTZ times, as other tools write them to Parquet."""
    wall = F.regexp_replace(F.col("commitStartTime").cast("string"), "Z$", "")
    return trace.withColumn("commitStartTime", wall.try_cast("timestamp_ntz"))


#: Recipe rules as a table: prefix and label.
_RULES = (
    ("", "Other"),
    ("org.openrewrite.java.", "Java"),
    ("org.openrewrite.java.security.", "Security"),
    ("org.openrewrite.java.dep", "Dependencies"),
    ("x_", "X"),
)


def _rules(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(p).alias("prefix"), F.lit(label).alias("label")) for p, label in _RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _security_by_table(trace: DataFrame) -> DataFrame:
    """The security report, its recipes chosen by a table of prefixes."""
    prefixes = [pattern.removesuffix("%") for pattern in SECURITY_PATTERNS]
    rules = trace.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, prefixes))).alias("prefix"))
    return reports.security_recipe_run_trend(under_any(trace, rules), recipes=F.lit(True))


def _label_runs(trace: DataFrame) -> DataFrame:
    ran = labelled(trace, _rules(trace.sparkSession)).where("runOutcome IS NOT NULL")
    return ran.groupBy("label").agg(F.count_distinct("runId").alias("recipe_runs"))


def _rolled_up(trace: DataFrame, report: str, grain: str = "month") -> DataFrame:
    """The report from days that are stored first."""
    folder = working_folder(trace.sparkSession)
    refresh(trace, report, folder)
    return rollup(trace.sparkSession, report, folder, grain)


def _merged_kpis(trace: DataFrame) -> DataFrame:
    """The KPIs of a stored trace into which the run files come first, then the commit files."""
    spark, folder = trace.sparkSession, working_folder(trace.sparkSession)
    # Derived once: merges read their rows several times.
    with dropping_shuffles(spark):
        conform(trace).write.option("compression", "zstd").parquet(f"{folder}/derived")
    derived = open_trace(spark, f"{folder}/derived")
    merge_latest(conform(derived.drop(*_COMMIT_AND_LATER)), f"{folder}/latest", "run", buckets=16)
    merge_latest(conform(derived), f"{folder}/latest", "commit", buckets=16)
    return reports.dashboard_kpis_summary(open_latest(spark, f"{folder}/latest"))


def _by_sql(trace: DataFrame, call: str) -> DataFrame:
    register_reports(trace, "trace")
    return trace.sparkSession.sql(f"SELECT * FROM {call}")


def _over_trace(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(fixture_trace(spark, sf_dir))


def over_any_trace() -> dict[str, Callable[[DataFrame], DataFrame]]:
    plain = {name: getattr(reports, name) for name in (*_TRENDS, *_TABLES)}
    found: dict[str, Callable[[DataFrame], DataFrame]] = dict(plain)
    for name in _TRENDS:
        for grain in GRAINS:
            if grain != "month":
                found[f"{name}_{grain}"] = lambda t, r=plain[name], g=grain: r(t, grain=g)
    for name in shaping.SERIES:
        key = "trend_long" if name == "recipe_run_trend" else f"{name}_long"
        found[key] = lambda t, n=name: shaping.report_series(plain[n](t), n)
    found |= {
        "top_recipes_limit": lambda t: reports.top_recipes(t, limit=3),
        "top_users_limit": lambda t: reports.top_users(t, limit=20),
        "top_recipes_with_commits_limit": lambda t: reports.top_recipes_with_commits(t, limit=3),
        "top_users_run_only": lambda t: reports.top_users(conform(t.drop(*_COMMIT_AND_LATER))),
        "security_trend_extra_patterns": lambda t: reports.security_recipe_run_trend(
            t, recipes=recipe_like(*SECURITY_PATTERNS, "org.openrewrite.java.dependencies.%")
        ),
        "security_trend_exact_recipe": lambda t: reports.security_recipe_run_trend(
            t, recipes=recipe_is("org.openrewrite.java.security.OwaspA01")
        ),
        "repos_on_tool_version": lambda t: reports.repos_on_tool_version(t, "Maven", "3.6"),
        "repos_still_on_tool_version": lambda t: reports.repos_still_on_tool_version(t, "Maven", "3.6"),
        "current_tool_versions": reports.current_tool_versions,
        "commit_trend_between": lambda t: reports.commit_trend(
            within(t, "commit", date(1993, 3, 15), date(1995, 2, 2))
        ),
        "security_trend_rule_table": _security_by_table,
        "recipe_label_runs": _label_runs,
        "commit_trend_sql": lambda t: _by_sql(t, "commit_trend('quarter')"),
        "top_users_sql": lambda t: _by_sql(t, "top_users(20)"),
        "recipe_run_commit_gap": reports.recipe_run_commit_gap,
        "commit_trend_typed": lambda t: reports.commit_trend(conform(t)),
        "commit_trend_zoneless": lambda t: reports.commit_trend(conform(_zoneless(t))),
        "deepest_stage_kpis": lambda t: reports.dashboard_kpis_summary(
            deepest_stage(conform(t).unionByName(conform(t.drop(*_COMMIT_AND_LATER))))
        ),
        "merged_stage_kpis": _merged_kpis,
        "build_tool_share": lambda t: shaping.build_tool_share(reports.build_tool_summary(t)),
        "build_tool_version_labels": lambda t: shaping.build_tool_version_labels(
            reports.build_tool_versions(t)
        ),
        "kpi_cards": lambda t: shaping.kpi_cards(reports.dashboard_kpis_summary(t)),
        "build_success_stack": lambda t: shaping.build_success_stack(
            reports.build_success_trend(t)
        ),
        "month_label": lambda t: shaping.month_label(reports.commit_trend(t)),
        "hours_label": lambda t: shaping.hours_label(reports.top_recipes_with_commits(t)),
    }
    for grain in GRAINS:
        end = "" if grain == "month" else f"_{grain}"
        found[f"commit_trend_rollup{end}"] = lambda t, g=grain: _rolled_up(t, "commit_trend", g)
        found[f"commit_trend_dense{end}"] = lambda t, g=grain: dense(reports.commit_trend(t, g), grain=g)
    for name in ("build_success_trend", "dashboard_kpis_trend"):
        found[f"{name}_rollup"] = lambda t, n=name: _rolled_up(t, n)
    return found


def queries() -> dict[str, Query]:
    return {name: _over_trace(report) for name, report in over_any_trace().items()}
