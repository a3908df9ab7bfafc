"""The reports as SQL table functions over a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tracetally.functions.columns import GRAINS
from tracetally.plans import reports
from tracetally.schema import REPORTS
from tracetally.sources.traces import register_trace

#: Reports by period, and rankings that take a limit.
TRENDS = tuple(name for name, columns in REPORTS.items() if columns.names[0] == "month")
RANKINGS = ("top_recipes", "top_users", "top_recipes_with_commits")


def _columns(report: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORTS[report].fields)


def register_reports(trace: DataFrame, name: str = "trace") -> None:
    """Makes the trace a view, and each report a function of the session.

    ``SELECT * FROM commit_trend('week')``, ``SELECT * FROM top_users(20)``; without an argument a
    trend is monthly and a ranking whole. A function chooses between views of the report's plans by
    its argument, which is known when a query is planned, so only the one asked for is left. Views
    and functions last as long as the session, and rows come in no given order.
    """
    spark = trace.sparkSession
    register_trace(trace, name)
    for report, columns in REPORTS.items():
        names = ", ".join(columns.names)
        make = getattr(reports, report)
        if report in TRENDS:
            for grain in GRAINS:
                make(trace, grain).createOrReplaceTempView(f"{report}_by_{grain}")
            known = ", ".join(f"'{grain}'" for grain in GRAINS)
            parts = [f"SELECT * FROM {report}_by_{grain} WHERE grain = '{grain}'" for grain in GRAINS]
            refused = ", ".join(
                f"CAST(raise_error('grain must be one of {', '.join(GRAINS)}') AS {f.dataType.simpleString()})"
                for f in columns.fields
            )
            parts.append(f"SELECT {refused} WHERE grain IS NULL OR grain NOT IN ({known})")
            takes, body = "grain STRING DEFAULT 'month'", " UNION ALL ".join(parts)
        elif report in RANKINGS:
            key = columns.names[0]
            metric = "commits" if report == "top_recipes_with_commits" else "recipe_runs"
            make(trace).createOrReplaceTempView(f"{report}_ranked")
            takes = "wanted INT DEFAULT NULL"
            body = (
                f"SELECT * FROM {report}_ranked WHERE wanted IS NULL UNION ALL "
                f"SELECT {names} FROM (SELECT *, row_number() OVER "
                f"(ORDER BY {metric} DESC, {key} ASC NULLS LAST) AS place FROM {report}_ranked) "
                "WHERE wanted IS NOT NULL AND place <= wanted"
            )
        else:
            make(trace).createOrReplaceTempView(f"{report}_all")
            takes, body = "", f"SELECT * FROM {report}_all"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {report}({takes}) "
            f"RETURNS TABLE ({_columns(report)}) RETURN {body}"
        )
