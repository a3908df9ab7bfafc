"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger remembers which
(blob, rule, rule version) were scanned and what was found; a scan reads only the texts of blobs
with an unseen pair, one text per blob, and joins all findings back to every path that has the
blob. A new rule version scans again, the findings of the old one stay in the ledger.

Positions without user functions: the pieces between matches and the matches alternate, so running
sums of their lengths give every start, in code points.

Defined results: NULL text is the empty text; a NULL path is a path like any other; repeated rows
get equal results; an empty table gives an empty result and scans nothing; columns called like the
result's are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracetally.llm.common import stored, without


class Rule(NamedTuple):
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` code points."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# The base rules. Where a match has a least length and its last part takes all it can,
# asking for that length in the pattern gives the same matches and spares the shorter ones.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
RULES = BASE_RULES + (
    Rule("github", 1, r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
SCANNED = "blob binary, rule string, version int"
FOUND = f"{SCANNED}, start bigint, end bigint"
ADDED = ("blob", "findings")


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class Ledger:
    """Two Parquet tables below ``folder``: the pairs scanned, and what was found.

    A scan appends its findings first. If it dies before it appends the pairs, the next scan finds
    the same again, and readers see each finding once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}").distinct()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition()):
                raise
            return self.spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("r")).select("r.*")

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def found(self) -> DataFrame:
        return self._read("found", FOUND)

    def add(self, scanned: DataFrame, found: DataFrame) -> None:
        found.write.mode("append").parquet(f"{self.folder}/found")
        scanned.write.mode("append").parquet(f"{self.folder}/scanned")


def _matches(text: Column, rule: Rule) -> Column:
    """The rule with lengths of the pieces before matches, and of matches and their groups."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    return F.struct(
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.version).alias("version"),
        F.lit(rule.least).alias("least"),
        pieces.alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("width"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("part"),
    )


def find(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Findings (``blob``, ``rule``, ``version``, ``start``, ``end``) in ``text`` per ``blob``.

    ``todo`` lists the rules, as kind@version, that each blob is to be scanned for.
    """
    wanted = [
        F.when(
            F.array_contains("todo", f"{r.kind}@{r.version}") & F.col("text").rlike(r.pattern),
            _matches(F.col("text"), r),
        )
        for r in rules
    ]
    hits = (
        texts.select("blob", F.explode(F.array_compact(F.array(*wanted))).alias("hit"))
        .select("blob", "hit.*")
        .select("blob", "rule", "version", "least", F.posexplode(F.arrays_zip("gap", "width", "part")))
    )
    so_far = Window.partitionBy("blob", "rule").orderBy("pos")
    gap, width, part = F.col("col.gap"), F.col("col.width"), F.col("col.part")
    end = F.sum(gap + F.coalesce(width, F.lit(0))).over(so_far)
    return (
        hits.select("blob", "rule", "version", "least", "pos", end.alias("end"), width.alias("w"), part.alias("p"))
        .where("w IS NOT NULL AND p >= least")
        .select("blob", "rule", "version", (F.col("end") - F.col("w")).alias("start"), "end")
    )


def scan(
    versions: DataFrame,
    ledger: Ledger,
    rules: Sequence[Rule] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``versions`` without its text, with ``blob`` and ``findings``, sorted by start, then rule.

    Texts are shuffled once, by path and blob, to pick the one that stands for its blob; those that
    repeat both are one before. Nothing is shuffled by blob but addresses and findings, and an
    address that many rows share is counted before. Findings are joined to paths on the blob, where Spark splits a hot blob at run time.
    """
    slim = stored(without(versions, *ADDED).withColumn("blob", blob_of(F.col(text))).drop(text))
    names = [f"{r.kind}@{r.version}" for r in rules]
    seen = (
        ledger.scanned()
        .groupBy(F.col("blob").alias("_blob"))
        .agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("_seen"))
    )
    todo = stored(
        slim.groupBy("blob")
        .agg(F.min(F.struct(F.col(path).isNull().alias("none"), F.col(path).alias("at"))).alias("_one"))
        .join(seen, F.col("blob") == F.col("_blob"), "left")
        .select(
            F.col("blob").alias("_blob"),
            F.struct(F.col("_one.at").alias("at")).alias("_at"),
            F.array_except(
                F.array(*[F.lit(n) for n in names]), F.coalesce("_seen", F.array().cast("array<string>"))
            ).alias("todo"),
        )
        .where(F.size("todo") > 0)
    )
    # A struct with a NULL equals another, so paths meet by plain equality and move once.
    texts = (
        versions.select(F.struct(F.col(path).alias("at")).alias("_path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .groupBy("_path", blob_of(F.col("text")).alias("blob"))
        .agg(F.first("text").alias("text"))
        .join(todo.hint("shuffle_hash"), (F.col("_path") == F.col("_at")) & (F.col("blob") == F.col("_blob")))
        .select("blob", "text", "todo")
    )
    pairs = todo.select("_blob", F.explode("todo").alias("pair")).select(
        F.col("_blob").alias("blob"),
        F.substring_index("pair", "@", 1).alias("rule"),
        F.substring_index("pair", "@", -1).cast("int").alias("version"),
    )
    ledger.add(pairs, find(texts, rules))
    order = F.create_map(*[x for at, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(at))])
    current = F.array(*[F.lit(n) for n in names])
    # Stored, so that the join below is plain and Spark can split the rows of a hot blob.
    found = stored(
        ledger.found()
        .where(F.array_contains(current, F.concat_ws("@", "rule", "version")))
        .groupBy(F.col("blob").alias("_blob"))
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", order[F.col("rule")].alias("at"), "rule", "end"))
            ).alias("findings")
        )
    )
    none = F.array().cast("array<struct<start:bigint,at:int,rule:string,end:bigint>>")
    return slim.join(found, F.col("blob") == F.col("_blob"), "left").select(
        *slim.columns, F.coalesce("findings", none).alias("findings")
    )

