"""All queries on traces with NULLs, '' and repeats everywhere, against DuckDB."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from micro import as_tuples

from contract.oracles import report_selects
from contract.registry import over_any_trace
from tracetally.schema import TRACE
from tracetally.sources.traces import conform, deepest_stage

SELECTS, QUERIES = report_selects(), over_any_trace()


def random_rows(seed: int, n: int) -> list[dict[str, str | None]]:
    rng = random.Random(seed)

    def maybe(*values):
        return rng.choice([*values, None])

    def time():
        return f"{rng.choice([1969, 2024, 2025, 2026])}-{rng.randint(1, 12):02}-{rng.choice([1, 15, 28])}T" \
               f"{rng.choice(['00:00:00.000', '23:59:59.999'])}Z".replace("-1T", "-01T")

    def outcome():
        return rng.choice(["Succeeded", "Succeeded", "Failed", "Errored", "succeeded", None, ""])

    versions = ["buildMavenVersion", "buildGradleVersion", "buildBazelVersion",
                "buildDotnetVersion", "buildPythonVersion", "buildNodeVersion"]
    rows = []
    for _ in range(n):
        row = {
            "path": maybe("o/a", "o/b", "o/c", "o/d", ""),
            "developer": maybe("al", "bo", "ca"),
            "runRecipeId": maybe(
                "org.openrewrite.java.security.A", "org.openrewrite.java.security.OwaspA01",
                "org.openrewrite.java.securityX.A", "org.openrewrite.staticanalysis.B",
                "org.openrewrite.java.dependencies.C", "x_y",
            ),
            "runRecipeInstanceName": maybe("A", "Ä", "a", "zz", "日本"),
            "runEstimatedEffortTimeSavingsMs": maybe(*[str(rng.randint(0, 10**9)) for _ in "12"]),
            "runFilesWithFixResults": maybe("0", "1", "77"),
        }
        for version in versions:
            row[version] = rng.choice(["3.6.3", "3.60", "8.5", "", "", None, None, None])
        for stage in ("build", "run", "commit"):
            row[f"{stage}Outcome"] = outcome()
            row[f"{stage}StartTime"] = maybe(time(), time(), time())
            row[f"{stage}Id"] = maybe(*[f"{stage}{i}" for i in range(6)])
        rows.append(row)
    return rows * 2 if seed % 2 else rows


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    rows = random_rows(request.param, 150 * request.param)
    table = pa.Table.from_pylist(rows, pa.schema([(name, pa.string()) for name in rows[0]]))
    ours = conform(spark.createDataFrame(table)).repartition(3).cache()
    duck = duckdb.connect()
    duck.register("raw", table)
    numbers = ("runEstimatedEffortTimeSavingsMs", "runFilesWithFixResults")
    columns = ", ".join(
        f"CAST({name} AS BIGINT) AS {name}" if name in numbers else f"nullif({name}, '') AS {name}"
        for name in rows[0]
    )
    duck.execute(f"CREATE VIEW trace AS SELECT {columns} FROM raw")
    return ours, duck


@pytest.mark.parametrize("name", SELECTS)
def test_query_on_a_random_trace(both, name):
    ours, duck = both
    assert len(ours.columns) == len(TRACE.names)
    answer = duck.execute(SELECTS[name]).fetchall()
    got = as_tuples(QUERIES[name](ours))
    assert sorted(got, key=repr) == sorted(answer, key=repr)


def test_deepest_stage_on_a_random_trace(both):
    ours, duck = both
    staged = {"build": 1, "run": 2, "commit": 3}
    names = [d[0] for d in duck.execute("SELECT * FROM trace").description]
    named = ["path", "developer", "buildId", "runId"]
    reached = [
        f"CASE WHEN depth >= {depth} THEN {name} END AS {name}"
        for name in names
        if name not in named
        for stage, depth in staged.items()
        if name.startswith(stage)
    ]
    assert len(reached) + len(named) == len(names)
    deep = """SELECT *, CASE WHEN commitOutcome IS NOT NULL THEN 3 WHEN runOutcome IS NOT NULL THEN 2
                             WHEN buildOutcome IS NOT NULL THEN 1 ELSE 0 END AS depth FROM """
    columns = ", ".join([*named, *reached])
    # Times tell rows apart, but the two engines return them differently.
    shown = ", ".join(name for name in names if not name.endswith("StartTime"))
    answer = duck.execute(f"""
        WITH deep AS ({deep} trace), latest AS (
            SELECT * FROM deep WHERE runId IS NOT NULL
            QUALIFY depth = max(depth) OVER (PARTITION BY path, developer, buildId, runId))
        SELECT {shown} FROM (SELECT DISTINCT {columns} FROM latest
                             UNION ALL SELECT {columns} FROM deep WHERE runId IS NULL)""").fetchall()
    reduced = deepest_stage(ours)
    reduced.createOrReplaceTempView("reduced")
    got = as_tuples(
        reduced.sparkSession.sql(f"SELECT {shown} FROM (SELECT {columns} FROM ({deep} reduced))")
    )
    assert sorted(got, key=repr) == sorted(answer, key=repr)
    assert 0 < len(got) < ours.count()
