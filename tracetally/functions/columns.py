"""Column factories shared by the reports. Built-in expressions only, no session needed to plan."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one outcome literal ever compared, and the documented time grains.
SUCCEEDED = "Succeeded"
GRAINS = ("week", "month", "quarter", "year")

# Build tools in order of precedence with the column holding their version.
BUILD_TOOLS = (
    ("Maven", "buildMavenVersion"),
    ("Gradle", "buildGradleVersion"),
    ("Bazel", "buildBazelVersion"),
    (".NET", "buildDotnetVersion"),
    ("Python", "buildPythonVersion"),
    ("Node.js", "buildNodeVersion"),
)
OTHER_TOOL = "Other"
UNKNOWN_VERSION = "Unknown"

# The default security filter.
SECURITY_PATTERNS = ("org.openrewrite.java.security.%", "org.openrewrite.staticanalysis.%")


def reached(stage: str) -> Column:
    """True where the row got as far as ``stage``, whatever came of it."""
    return F.col(f"{stage}Outcome").isNotNull()


def succeeded(stage: str) -> Column:
    return F.col(f"{stage}Outcome") == SUCCEEDED


def not_succeeded(stage: str) -> Column:
    """Reached but not succeeded; NULL (hence not counted) where the stage was not reached."""
    return F.col(f"{stage}Outcome") != SUCCEEDED


# A time of day followed by an offset or a zone.
_ZONED = r"[T ][0-9:.]+\s*(Z|z|UTC|GMT|[+-][0-9:]+|[A-Za-z]+/[A-Za-z_/]+)$"


def utc_timestamp(value: Column) -> Column:
    """``value`` as a timestamp; what names no zone (text, TIMESTAMP_NTZ, DATE) is UTC.

    Unparsable text gives NULL. The type is known when the query is planned, so only one of the
    branches is left in the plan. Text that ends in Z, as traces have it, takes a single cast.
    """
    plain = value.cast("string")
    usual = plain.endswith("Z") & F.substring(plain, 11, 1).isin("T", " ")
    text = F.trim(plain)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = F.timestamp_micros(
        F.timestamp_diff("MICROSECOND", epoch, text.try_cast("timestamp_ntz"))
    )
    parsed = (
        F.when(usual, plain.try_cast("timestamp"))
        .when(text.rlike(_ZONED), text.try_cast("timestamp"))
        .otherwise(wall)
    )
    return F.when(F.typeof(value) == "timestamp", value.try_cast("timestamp")).otherwise(parsed)


def utc_day(column: str) -> Column:
    """The UTC day that ``column``, a timestamp or ISO-8601 text, falls in."""
    seconds = F.unix_seconds(utc_timestamp(F.col(column)))
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def period_start(column: str, grain: str = "month") -> Column:
    """First UTC day of the week (Monday), month, quarter or year that ``column`` falls in.

    ``column`` may be a timestamp or ISO-8601 text; unparsable text gives NULL. The day is taken
    from the epoch, so the result does not depend on ``spark.sql.session.timeZone``.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain!r}")
    return F.trunc(utc_day(column), grain)


def hours(milliseconds: Column) -> Column:
    """Milliseconds as hours to one decimal, rounded half up in DECIMAL; NULL stays NULL."""
    return F.round(milliseconds / F.lit(Decimal("3600000.0")), 1).cast("double")


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in per cent to one decimal; NULL when ``whole`` is 0."""
    return F.round(F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0)), 1).cast("double")


def present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def build_tool() -> Column:
    """Name of the first build tool, in order of precedence, whose version is filled."""
    (first, version), *others = BUILD_TOOLS
    choice = F.when(present(version), first)
    for name, version in others:
        choice = choice.when(present(version), name)
    return choice.otherwise(OTHER_TOOL)


def tool_version() -> Column:
    """Version of the tool that :func:`build_tool` names."""
    versions = [F.nullif(F.col(version), F.lit("")) for _, version in BUILD_TOOLS]
    return F.coalesce(*versions, F.lit(UNKNOWN_VERSION))


def recipe_like(*patterns: str) -> Column:
    """True where the recipe id matches any SQL LIKE pattern (``_`` is a wildcard too)."""
    return reduce(or_, [F.col("runRecipeId").like(pattern) for pattern in patterns])


def recipe_under(*prefixes: str) -> Column:
    """True where the recipe id starts with any of ``prefixes``, taken literally."""
    return reduce(or_, [F.col("runRecipeId").startswith(prefix) for prefix in prefixes])


def recipe_is(*recipe_ids: str) -> Column:
    return F.col("runRecipeId").isin(*recipe_ids)
