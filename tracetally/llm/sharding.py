"""Shards by jump consistent hashing: no ring table, and adding a shard moves rows only into it.

The hash is the published one (64-bit linear congruential steps, each a jump to a higher shard), so
shard numbers agree with other implementations for the same 64-bit key.

Defined results: a NULL key hashes like any other value; rows with the same key, repeated rows
included, share a shard and get slots of their own; an empty table gives an empty result; columns
called like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracetally.llm.common import stored, without

# Multiplier of the published generator, and its word size.
MULTIPLIER = 2862933555777941757
WORD = 1 << 64
#: Jumps tried at once. A key makes about ln(shards) of them; the few that need more get more.
JUMPS = 48
#: Starts are broadcast up to this many (a file's path and three numbers each, some 200 bytes).
BROADCAST_STARTS = 200_000


def _unsigned(key: Column) -> Column:
    value = key.cast("decimal(20,0)")
    return F.when(key < 0, value + F.lit(str(WORD)).cast("decimal(20,0)")).otherwise(value).cast(
        "decimal(20,0)"
    )


def _jumps(state: Column, shards: int, times: int) -> Column:
    multiplier = F.lit(str(MULTIPLIER)).cast("decimal(19,0)")
    word = F.lit(str(WORD)).cast("decimal(20,0)")

    def jump(at: Column, _: Column) -> Column:
        # Decimals hold the 126-bit product exactly; LONG would overflow, which ANSI mode refuses.
        drawn = ((at["seed"] * multiplier + F.lit(1)) % word).cast("decimal(20,0)")
        top = F.floor(drawn / F.lit(1 << 33)).cast("double")
        ahead = F.floor((at["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (top + 1)))
        moved = F.struct(
            drawn.alias("seed"), at["next"].alias("shard"), ahead.cast("bigint").alias("next")
        )
        return F.when(at["next"] < shards, moved).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(times)), state, jump)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in [0, ``shards``) of a 64-bit key, as INT."""
    if shards < 1:
        raise ValueError(f"shards must be at least 1, not {shards}")
    start = F.struct(
        _unsigned(key.cast("bigint")).alias("seed"),
        F.lit(-1).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("next"),
    )
    end = _jumps(start, shards, min(JUMPS, shards))
    if shards > JUMPS:
        # A jump goes up by one at least, so this many always suffice.
        end = F.when(end["next"] < shards, _jumps(end, shards, shards)).otherwise(end)
    return end["shard"].cast("int")


def shard(
    frame: DataFrame, key: str, shards: int, grown: int | None = None, numbered: bool = True
) -> DataFrame:
    """``frame`` with the ``shard`` of each row, and its ``slot``: 0, 1, ... within the shard.

    ``key``       column that alone decides the shard; it is hashed to 64 bits first
    ``grown``     also give ``grown_shard``, the shard among this many
    ``numbered``  without slots the result needs no intermediate table

    No row moves between tasks, whatever a key's share of them: the rows are stored with the rows
    of a shard next to each other in each file, and a row's slot is the number of the shard's rows
    in earlier files plus its place in the file. Per file and shard, one row is counted; beyond
    BROADCAST_STARTS of these, Spark chooses how they meet the rows.
    """
    rows = without(frame, "shard", "slot", "grown_shard")
    hashed = F.xxhash64(F.col(key))
    rows = rows.withColumn("shard", jump_hash(hashed, shards))
    if grown is not None:
        rows = rows.withColumn("grown_shard", jump_hash(hashed, grown))
    if not numbered:
        return rows
    names = rows.columns
    kept = stored(rows.sortWithinPartitions("shard")).select(
        *names,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    earlier = Window.partitionBy("shard").orderBy("_file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Stored, as their size is not known before; what Spark expects has it shuffle the rows.
    starts = stored(
        kept.groupBy("shard", "_file")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first"))
        .select("shard", "_file", "_start")
    )
    if starts.count() <= BROADCAST_STARTS:
        starts = F.broadcast(starts)
    return kept.join(starts, ["shard", "_file"]).select(
        *names, (F.col("_start") + F.col("_place")).alias("slot")
    )
