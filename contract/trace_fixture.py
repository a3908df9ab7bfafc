"""The test data has no ``trace`` table, so one is derived from ``lineitem`` and ``orders``.

One text runs in Spark (session time zone UTC) and DuckDB alike; ``{lineitem}`` and ``{orders}``
stand for the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRACE_SQL = """
SELECT
  'github.com' AS origin,
  'org' || CAST(l_suppkey % 10 AS STRING) || '/repo' || CAST(l_partkey % 400 AS STRING) AS path,
  'main' AS branch,
  'user' || CAST(o_custkey % 150 AS STRING) || '@example.com' AS developer,
  CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity <= 4 THEN 'Failed' ELSE 'Succeeded' END AS buildOutcome,
  CASE WHEN l_quantity = 1 THEN NULL ELSE REPLACE(CAST(l_shipdate AS STRING), ' ', 'T') || '.000Z' END AS buildStartTime,
  CASE WHEN l_quantity = 1 THEN NULL ELSE 'b-' || CAST(l_orderkey AS STRING) END AS buildId,
  CASE l_partkey % 9 WHEN 0 THEN '3.9.6' WHEN 1 THEN '3.8.4' WHEN 7 THEN '3.6.3' WHEN 8 THEN '' END AS buildMavenVersion,
  CASE l_partkey % 9 WHEN 2 THEN '8.5' WHEN 7 THEN '7.6.1' WHEN 0 THEN '' END AS buildGradleVersion,
  CASE l_partkey % 9 WHEN 3 THEN '7.0.2' END AS buildBazelVersion,
  CASE l_partkey % 9 WHEN 4 THEN '8.0.2' END AS buildDotnetVersion,
  CASE l_partkey % 9 WHEN 5 THEN '3.12.2' END AS buildPythonVersion,
  CASE l_partkey % 9 WHEN 6 THEN '20.11.1' END AS buildNodeVersion,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN CASE WHEN l_tax >= 0.08 THEN 'Failed' ELSE 'Succeeded' END END AS runOutcome,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN REPLACE(CAST(l_shipdate + INTERVAL 1 DAY AS STRING), ' ', 'T') || '.000Z' END AS runStartTime,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN 'r-' || CAST(l_orderkey AS STRING) END AS runId,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN
    CASE l_partkey % 7 WHEN 0 THEN 'org.openrewrite.java.security.FindSecurityHotspots'
      WHEN 1 THEN 'org.openrewrite.java.security.OwaspA01'
      WHEN 2 THEN 'org.openrewrite.staticanalysis.CommonStaticAnalysis'
      WHEN 3 THEN 'org.openrewrite.java.securityX.NearMiss'
      WHEN 4 THEN 'org.openrewrite.java.dependencies.DependencyVulnerabilityCheck'
      WHEN 5 THEN 'org.openrewrite.java.spring.boot3.UpgradeSpringBoot_3_4'
      ELSE 'org.openrewrite.java.OrderImports' END END AS runRecipeId,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN
    'Recipe ' || CAST(l_partkey % 7 AS STRING) || CASE WHEN l_returnflag = 'R' THEN ' (renamed)' ELSE '' END END AS runRecipeInstanceName,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 AND l_returnflag <> 'N' THEN CAST(FLOOR(l_extendedprice) AS BIGINT) * 10 END AS runEstimatedEffortTimeSavingsMs,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 THEN CAST(FLOOR(l_quantity) AS BIGINT) END AS runFilesWithFixResults,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 AND l_tax < 0.08 AND l_linestatus = 'F' THEN CASE WHEN l_discount >= 0.095 THEN 'Failed' ELSE 'Succeeded' END END AS commitOutcome,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 AND l_tax < 0.08 AND l_linestatus = 'F' THEN REPLACE(CAST(l_shipdate + INTERVAL 3 DAY AS STRING), ' ', 'T') || '.000Z' END AS commitStartTime,
  CASE WHEN l_quantity > 4 AND l_linenumber <= 5 AND l_tax < 0.08 AND l_linestatus = 'F' THEN 'c-' || CAST(l_orderkey AS STRING) END AS commitId
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


def fixture_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived trace over the whole tables in ``sf_dir``.

    The join is left to Spark: it broadcasts ``orders`` only while its size, known from the scan,
    is below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles both sides by order
    key, and adaptive execution splits a partition swollen by a hot key.
    """
    return spark.sql(
        TRACE_SQL,
        lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        orders=spark.read.parquet(f"{sf_dir}/orders.parquet"),
    )
