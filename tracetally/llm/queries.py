"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracetally.llm import collocations, middle, mixing, neardup, phrases, quality, rules, secrets
from tracetally.llm import sharding, simhash, tokens, urls, warc
from tracetally.llm.common import shared_folder
from tracetally.llm.oracles import oracle_sql  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a run of 10 words, or a whole shorter item, of the benchmark."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrases.decontaminate(docs, _table(spark, sf_dir, "benchmark"), width=10)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 by jump hash of doc_id; NULL text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard(docs, "doc_id", shards=8, grown=9)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text, as kind:start:end."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.Ledger(spark, shared_folder(spark)), secrets.RULES)
    base = F.filter("findings", lambda f: f["rule"].isin(*[r.kind for r in secrets.BASE_RULES]))

    def joined(spans: Column) -> Column:
        one = lambda f: F.concat_ws(":", f["rule"], f["start"], f["end"])
        return F.array_join(F.transform(spans, one), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["rule"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score for quality, by a model of the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


# The rules of op5, as (verdict, host, path).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL; without a rule it is allowed."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
                    for v, h, p in URL_RULES
                ]
            )
        )
    )
    return urls.judge(pages, listed, "url", default="allow").drop("url")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of 0.85 on five-word shingles."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, percent=85)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighing 5, 2, 1 in turn share 150 % of all words, none above twice its size."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, cap=2).drop("source", "text")


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and verdict of the threshold table for every text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs).select("doc_id", *rules.BASE, "base_failed", "kept")


def op9_tokens(
    spark: SparkSession, sf_dir: str, pieces: str = "/opt/tokenizers/piece_bpe_32k.model"
) -> DataFrame:
    """Tokens of every text; ``pieces`` is the path of a published vocabulary."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.zipf_scores(tokens.load_pieces(pieces)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC bundles and read back."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(spark, pages, shared_folder(spark)).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of two to three words of each language that keep together best."""
    docs = _table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs, least=10, top=2000, covered=50)


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text rearranged, or not, for filling in the middle, and restored."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = middle.fill_in_middle(docs, seed=42, percent=50, suffix_first=80)
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints differ in at most three bits."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_sharding": op2_sharding,
        "op3_secrets": op3_secrets,
        "op4_quality": op4_quality,
        "op5_urls": op5_urls,
        "op6_neardup": op6_neardup,
        "op7_mixing": op7_mixing,
        "op8_rules": op8_rules,
        "op9_tokens": op9_tokens,
        "op10_warc": op10_warc,
        "op11_collocations": op11_collocations,
        "op12_middle": op12_middle,
        "op13_simhash": op13_simhash,
    }

