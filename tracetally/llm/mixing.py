"""Sources mixed to target weights by entropy balancing.

Among all document rates w between 0 and ``cap`` that give every source its target of tokens, the
one closest in relative entropy to "each document once" is w = min(cap, exp(l * size)), with one
multiplier l per source. Its convex dual is solved by Newton steps that run as aggregations over
(source, size) counts for all sources at once, with a bracket around each multiplier so that a step
can't run away. The rates are then rounded to whole copies.

Defined results: NULL text has no tokens; a NULL source is a source of its own, the last one;
documents without tokens are taken once and count nothing; rows that repeat source, key and text are
separate documents, which share out the copies that are due to them, so reruns agree on how many of
them get one more; keys may be NULL or repeat; an empty table gives an empty result; columns called
like the result's are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracetally.llm.common import stored, white_words, without

ADDED = ("size", "source_size", "target", "rate", "copies", "taken")
#: Newton stops when every source is this close to its target, relatively.
TOLERANCE = 1e-7
#: A Newton step that leaves its bracket halves it, so far fewer are ever needed.
MOST_STEPS = 400
#: Resolution of the rounding threshold.
BINS = 8192
#: Times that what rounding leaves of a source's target goes to documents that are no longer.
REPAIRS = 4
#: Equal rows are numbered this many (a power of two) at a time.
GROUP_BITS = 13
#: The golden ratio: its multiples lie evenly in [0, 1), also those of any stretch of numbers.
GOLDEN = 0.6180339887498949


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``target`` of each ``source`` from its ``source_size``, one row per source.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share ``share`` of all
    tokens. No target exceeds ``cap`` times its source; the excess goes to the others by weight.
    With sources sorted by the level at which they are full, the level at which all that is to be
    shared is placed follows from running sums, without repeating the sharing until it fits. The running
    sums are over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    full_at = F.col("_full") / F.col("_weight")
    by_level = Window.orderBy(full_at, F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.col("_all") * share - F.col("_placed")) / F.col("_left")
    # While the level exceeds what a source holds, that source is full; the first below it decides.
    return (
        sizes.withColumn("_weight", turn)
        .withColumn("_full", F.col("source_size") * cap)
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_placed", F.coalesce(F.sum("_full").over(before), F.lit(0.0)))
        .withColumn("_left", F.sum("_weight").over(after))
        .withColumn("_level", F.when(level <= full_at, level))
        .withColumn("_water", F.first("_level", ignorenulls=True).over(whole))
        .withColumn(
            "target",
            F.least(F.col("_full"), F.coalesce("_water", F.lit(math.inf)) * F.col("_weight")),
        )
        .select("source", "source_size", "target")
    )


def _rate(multiplier: Column, size: Column, mean: Column, cap: float) -> Column:
    exponent = F.least(multiplier * size / mean, F.lit(math.log(cap)))
    # Rounded, so that the last bit of an exponential decides no copy.
    return F.least(F.lit(float(cap)), F.round(F.exp(exponent), 9))


def multipliers(cells: DataFrame, wanted: DataFrame, cap: float) -> DataFrame:
    """The dual solution: one row per source with its ``multiplier`` and ``mean`` document size.

    ``cells`` counts documents (``_n``) per ``source`` and ``size``. All sums are over DECIMAL, so
    that reruns agree to the last digit.
    """
    spread = cells.where("size > 0").groupBy("source").agg(
        F.min("size").alias("_least"),
        (F.sum(F.col("size") * F.col("_n")) / F.sum("_n")).cast("double").alias("mean"),
    )
    top = F.lit(math.log(cap)) * F.col("mean") / F.col("_least")
    filled = F.col("target") >= F.col("source_size") * (cap * (1 - 1e-12))
    state = stored(
        wanted.join(spread, wanted["source"].eqNullSafe(spread["source"]))
        .select(
            wanted["source"],
            "target",
            "mean",
            top.alias("_high"),
            F.lit(-math.inf).alias("_low"),
            filled.alias("_done"),
            F.when(filled, top)
            .otherwise(F.least(F.log(F.col("target") / F.col("source_size")), top / 2))
            .alias("multiplier"),
        )
    )
    exact = "decimal(38,9)"
    steps = 0
    while not state.where("NOT _done").isEmpty():
        steps += 1
        if steps > MOST_STEPS:
            raise RuntimeError(f"rates did not reach their targets in {MOST_STEPS} steps")
        todo = state.where("NOT _done").select(F.col("source").alias("_of"), "multiplier", "mean")
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        tokens = (F.col("size") * F.col("_n")).cast("double") * rate
        steep = F.when(rate < cap, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            cells.where("size > 0")
            .join(todo, F.col("source").eqNullSafe(F.col("_of")))
            .groupBy("_of")
            .agg(
                F.sum(tokens.cast(exact)).cast("double").alias("_got"),
                F.sum(steep.cast(exact)).cast("double").alias("_slope"),
            )
        )
        at, gap = F.col("multiplier"), F.col("target") - F.col("_got")
        low = F.when(gap > 0, at).otherwise(F.col("_low"))
        high = F.when(gap < 0, at).otherwise(F.col("_high"))
        step = at + gap / F.nullif(F.col("_slope"), F.lit(0.0))
        halved = F.when(low == -math.inf, 2 * high - 1).otherwise((low + high) / 2)
        moved = F.when((step > low) & (step < high), step).otherwise(halved)
        closed = (high - low) <= F.abs(at) * 1e-15
        close = (F.abs(gap) <= F.col("target") * TOLERANCE) | closed
        open_ = ~F.col("_done") & F.col("_got").isNotNull()
        state = stored(
            state.join(sums, F.col("source").eqNullSafe(F.col("_of")), "left").select(
                "source",
                "target",
                "mean",
                F.when(open_, high).otherwise(F.col("_high")).alias("_high"),
                F.when(open_, low).otherwise(F.col("_low")).alias("_low"),
                F.coalesce(F.col("_done") | close, F.lit(True)).alias("_done"),
                F.when(open_ & ~close, moved).otherwise(at).alias("multiplier"),
            )
        )
    return state.select("source", "mean", "multiplier")


def _document_rate(cap: float) -> Column:
    rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
    return F.coalesce(rate, F.lit(1.0))


def _chance(salt: int) -> Column:
    """A number in [0, 1) for each row: a hash of its key, and for equal rows steps from there."""
    start = F.shiftrightunsigned(F.xxhash64("_key", F.lit(salt)), 11) / F.lit(float(1 << 53))
    moved = start + F.col("_nth") * F.lit(GOLDEN)
    return moved - F.floor(moved)


def _bin(rate: Column) -> Column:
    """Where the fraction of ``rate`` plus the row's chance lies; -1 for whole rates."""
    part = rate - F.floor(rate)
    return F.when(part > 0, F.floor((part + _chance(-1)) * (BINS // 2))).otherwise(-1).cast("int")


def _keyed(key: str) -> Column:
    """A hash of source, key and text. The numbers between keep NULLs in their places."""
    return F.xxhash64("source", F.lit(1), key, F.lit(2), "text")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (any order) with ``_nth``, from 0 up within each ``_key``.

    Rows of one key are numbered in groups of bounded size, whatever their number, and only the
    groups' sizes are added up by key.
    """
    group = F.shiftright(F.monotonically_increasing_id(), GROUP_BITS)
    rows = stored(rows.withColumn("_group", group))
    sizes = rows.groupBy("_key", "_group").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = stored(
        sizes.select("_key", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    )
    within = Window.partitionBy("_key", "_group").orderBy(F.lit(0))
    counted = rows.withColumn("_place", F.row_number().over(within)).join(ahead, ["_key", "_group"])
    return counted.withColumn("_nth", F.col("_ahead") + F.col("_place") - 1).drop(
        "_group", "_place", "_ahead"
    )


def _told_apart(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``rows`` with ``_nth``: a number within its key for rows whose key is in ``repeated``."""
    if repeated is None:
        return rows.withColumn("_nth", F.lit(0).cast("bigint"))
    alone = rows.join(repeated, "_key", "left_anti").withColumn("_nth", F.lit(0).cast("bigint"))
    return alone.unionByName(_numbered(rows.join(repeated, "_key", "left_semi")))


def _with_thresholds(slim: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """``plan`` with the bin from which a source's documents get one copy more, and the ``_gap``
    that this leaves to the target."""
    rate = _document_rate(cap)
    bins = (
        slim.join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "_source",
            _bin(rate).alias("_bin"),
            "size",
            (F.floor(rate) * F.col("size")).alias("_sure"),
        )
        .groupBy("_source", "_bin")
        .agg(F.sum("size").alias("_more"), F.sum("_sure").alias("_sure"))
        .withColumnRenamed("_source", "_of")
    )
    of_source = Window.partitionBy("_of")
    from_here = of_source.orderBy(F.col("_bin").desc())
    best = (
        bins.withColumn("_sure", F.sum("_sure").over(of_source))
        .withColumn("_above", F.sum("_more").over(from_here))
        .join(
            plan.select(F.col("_source").alias("_from"), F.col("target").alias("_aim")),
            F.col("_of").eqNullSafe(F.col("_from")),
        )
        .withColumn("_gap", F.col("_aim") - F.col("_sure") - F.col("_above"))
        .withColumn("_off", F.abs("_gap"))
        .groupBy("_of")
        .agg(
            F.min(F.when(F.col("_bin") >= 0, F.struct("_off", "_bin", "_gap"))).alias("_best"),
            F.min(F.col("_aim") - F.col("_sure")).alias("_none"),
        )
        .withColumn("_better", F.coalesce(F.col("_best._off") < F.abs("_none"), F.lit(False)))
        .select(
            "_of",
            F.when(F.col("_better"), F.col("_best._bin")).otherwise(BINS).alias("_threshold"),
            F.when(F.col("_better"), F.col("_best._gap")).otherwise(F.col("_none")).alias("_gap"),
        )
    )
    return plan.join(best, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def _turn(repair: int) -> Column:
    return F.floor(_chance(repair) * BINS).cast("int")


def _with_extra(rows: DataFrame, cap: float, repairs: int) -> DataFrame:
    """``rows`` with ``_extra``, 1 for a copy beyond the whole part of the rate, else 0."""
    rate = _document_rate(cap)
    extra = F.when(_bin(rate) >= F.col("_threshold"), 1).otherwise(0)
    steps = [
        F.struct(
            F.col(f"_from{at}").alias("held"),
            F.col("size").between(1, F.col(f"_limit{at}")).alias("short"),
            (_turn(at) < F.col(f"_below{at}")).alias("chosen"),
        )
        for at in range(repairs)
    ]
    if steps:
        # A fold: the steps written into each other would grow threefold with each.
        extra = F.aggregate(
            F.array(*steps),
            extra,
            lambda now, step: F.when(
                step["short"] & step["chosen"] & (step["held"] == now), 1 - now
            ).otherwise(now),
        )
    return rows.withColumn("_extra", F.when(rate > F.floor(rate), extra).otherwise(0))


def _repaired(slim: DataFrame, plan: DataFrame, cap: float, repair: int) -> DataFrame:
    """``plan`` with one repair more, and the ``_gap`` that remains.

    Where one long document decides, a source of few documents stays far from its target. The
    choice is then turned for short ones, in an order by hash, as long as that comes nearer; what
    remains is at most half of one of them, if there are enough.
    """
    plan = plan.withColumn(f"_limit{repair}", F.floor(F.abs("_gap"))).withColumn(
        f"_from{repair}", F.when(F.col("_gap") > 0, 0).otherwise(1)
    )
    rows = slim.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    rate = _document_rate(cap)
    bins = (
        _with_extra(rows, cap, repair)
        .where(F.col("size").between(1, F.col(f"_limit{repair}")) & (rate > F.floor(rate)))
        .where(F.col("_extra") == F.col(f"_from{repair}"))
        .groupBy(
            F.col("_source").alias("_of"),
            F.abs("_gap").alias("_left"),
            _turn(repair).alias("_bin"),
        )
        .agg(F.sum("size").alias("_more"))
    )
    so_far = F.sum("_more").over(Window.partitionBy("_of").orderBy("_bin"))
    best = (
        bins.withColumn("_sum", so_far)
        .withColumn("_off", F.abs(F.col("_left") - F.col("_sum")))
        .where("_off < _left")
        .groupBy("_of")
        .agg(F.min(F.struct("_off", "_bin", "_sum")).alias("_best"))
    )
    names = [name for name in plan.columns if name != "_gap"]
    moved = F.signum("_gap") * F.coalesce("_best._sum", F.lit(0))
    return plan.join(best, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
        *names,
        (F.col("_gap") - moved).alias("_gap"),
        F.coalesce(F.col("_best._bin") + 1, F.lit(0)).alias(f"_below{repair}"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: int = 2,
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, the source's ``target``, the balanced
    ``rate``, the whole number of ``copies`` to take, and the words ``taken`` by them.

    Rounding: a document gets one more than the whole part of its rate if the rest plus a hash of
    its key and text reaches a threshold. The threshold is its source's own, set from a histogram of those
    sums so that the source comes as close to its target as whole documents in that order allow;
    short documents then make up for what is left, REPAIRS times.

    Only (source, size) counts, histograms, one hash per row and one row per source are shuffled;
    documents stay where they are while the table of sources is under Spark's broadcast threshold,
    and beyond it Spark splits a hot source at run time. Rows that repeat are stored and numbered.
    """
    if not 0 < share <= cap:
        raise ValueError("share must be above 0 and at most cap")
    docs = without(docs, *ADDED)
    size = F.size(white_words(F.col("text"))).cast("bigint")
    slim = stored(docs.select("source", _keyed(key).alias("_key"), size.alias("size")))
    repeated = slim.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    repeated = stored(repeated)
    if repeated.isEmpty():
        repeated = None
    slim = _told_apart(slim, repeated)
    if repeated is not None:
        slim = stored(slim)
    cells = stored(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("_n")))
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    wanted = stored(targets(sizes, weights, share, cap))
    solved = multipliers(cells, wanted, cap).withColumnRenamed("source", "_of")
    plan = stored(
        wanted.join(solved, F.col("source").eqNullSafe(F.col("_of")), "left").select(
            F.col("source").alias("_source"), "source_size", "target", "mean", "multiplier"
        )
    )
    plan = stored(_with_thresholds(slim, plan, cap))
    for repair in range(REPAIRS):
        plan = stored(_repaired(slim, plan, cap, repair))
    # Under names of their own, the columns of docs can't clash with those of the plan.
    held = [f"_held{at}" for at in range(len(docs.columns))]
    rows = docs.select(
        F.col("source"),
        _keyed(key).alias("_key"),
        size.alias("size"),
        *[F.col(f"`{name}`").alias(at) for name, at in zip(docs.columns, held)],
    )
    rows = _told_apart(rows, repeated).join(plan, F.col("source").eqNullSafe(F.col("_source")), "left")
    rate = _document_rate(cap)
    copies = (F.floor(rate) + F.col("_extra")).cast("int")
    return _with_extra(rows, cap, REPAIRS).select(
        *[F.col(at).alias(name) for name, at in zip(docs.columns, held)],
        "size",
        "source_size",
        "target",
        rate.alias("rate"),
        copies.alias("copies"),
        (copies * F.col("size")).cast("bigint").alias("taken"),
    )
