"""Benchmark decontamination with a positional inverted index of the training texts.

The index is a Parquet table of postings (term, document, position), sorted by term within each
file, so that a term's postings are read by the files' statistics. A search takes, for each window
of an item, the rarest two terms by their document postings, shifts their positions back to the
item's start, and keeps the (document, shift) pairs where the lists meet. Only those are compared
with the postings of the whole window. Consecutive matching windows come out as runs of words.

Words are maximal runs of digits, letters a to z after lower-casing A to Z, and all characters
from U+0080 on. An item is cut into windows of ``width`` words; a shorter one is a window itself.

Defined results: NULL text has no words and no window; an item without words matches nothing; an
item that repeats, or whose id does, counts once per id, a NULL id as the text ``null``; each row
of a repeated document gets the result of its own text; an empty table gives an empty result, or
documents without hits; columns called like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracetally.llm.common import lower_ascii, stored, without

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
#: The end of a document is a posting of this term, at the position after its last word.
END = ""
#: A vocabulary of at most this many terms is broadcast (about 100 bytes each), a larger one
#: is joined by shuffling the words.
BROADCAST_TERMS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(
        F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD), ""
    )


def vocabulary(items: DataFrame) -> DataFrame:
    """``term`` and its number ``t``, from 1, of all words of the items; number 0 is the end."""
    # The numbers are of no order, and kept as they are by storing them.
    terms = (
        items.select(F.explode(words(F.col("text"))).alias("term"))
        .distinct()
        .select("term", (F.monotonically_increasing_id() + 1).alias("t"))
    )
    end = terms.sparkSession.range(1).select(F.lit(END), F.lit(0).cast("bigint"))
    return stored(terms.union(end))


def build_index(docs: DataFrame, terms: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored postings (``t``, ``row``, ``pos``) of the listed terms in ``docs``.

    ``row`` numbers the table's rows; the posting of the end, which gives a document's length, also
    has its ``key``. Words that no item has can't be part of a match and are dropped where they are
    read. Nothing is shuffled; a task sorts its own postings.
    """
    known = F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms
    ended = F.concat(words(F.col("text")), F.array(F.lit(END)))
    postings = (
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(key).alias("_key"), ended.alias("w")
        )
        .select("row", "_key", F.posexplode("w").alias("pos", "term"))
        .join(known, "term")
        .select("t", "row", "pos", F.when(F.col("t") == 0, F.col("_key")).alias(key))
    )
    return stored(postings.sortWithinPartitions("t", "row", "pos"))


def _windows(items: DataFrame, terms: DataFrame, width: int) -> DataFrame:
    """One row per item, window and word: ``item``, ``first``, ``last``, ``at``, ``t``.

    ``item`` numbers the items; ``at`` is the word's place in the item, ``first`` and ``last``
    those of the window.
    """
    placed = items.select(
        "item", F.size("_w").alias("n"), F.posexplode("_w").alias("at", "term")
    ).join(terms, "term")
    starts = F.sequence(
        F.greatest(F.lit(0), F.col("at") - (width - 1)),
        F.greatest(F.lit(0), F.least(F.col("at"), F.col("n") - width)),
    )
    return placed.select("item", "n", "at", "t", F.explode(starts).alias("first")).select(
        "item", "first", F.least(F.col("first") + width, F.col("n")).alias("stop"), "at", "t"
    )


def search(index: DataFrame, items: DataFrame, terms: DataFrame, width: int) -> DataFrame:
    """Exact matches of the items' windows: ``row``, ``item``, ``start``, ``stop`` (words), the
    longest runs of words that matching windows cover.

    ``items`` has ``item`` and its words ``_w``.
    """
    counts = stored(index.where("t > 0").groupBy("t").agg(F.count(F.lit(1)).alias("n_postings")))
    windows = _windows(items, terms, width).join(counts, "t", "left")
    by_rarity = Window.partitionBy("item", "first").orderBy("n_postings", "t", "at")
    of_window = Window.partitionBy("item", "first")
    live = stored(
        windows.withColumn("_seen", F.count("n_postings").over(of_window))
        # A window with a word that no document has can't occur.
        .where(F.col("_seen") == F.col("stop") - F.col("first"))
        .withColumn("rarity", F.row_number().over(by_rarity))
        .select("item", "first", "stop", "at", "t", "rarity")
    )

    def shifted(rarity: int) -> DataFrame:
        return (
            live.where(F.col("rarity") == rarity)
            .select("item", "first", "stop", F.col("at").alias(f"at{rarity}"), F.col("t").alias(f"t{rarity}"))
        )

    # The rarest and the next rarest term of each window; windows of one word have just one.
    pairs = shifted(1).join(shifted(2), ["item", "first", "stop"], "left")
    rare = stored(
        pairs.select(
            "item", "first", F.explode(F.array(F.struct("at1", "t1"), F.struct(F.col("at2").alias("at1"), F.col("t2").alias("t1")))).alias("x")
        )
        .where("x.t1 IS NOT NULL")
        .select("item", F.col("x.at1").alias("at"), F.col("x.t1").alias("t"))
        .distinct()
    )
    met = (
        index.where("t > 0")
        .join(rare, "t")
        .select("row", "item", (F.col("pos") - F.col("at")).alias("shift"), "at")
    )
    met = stored(met)
    # Windows that share their two rarest terms are looked for together.
    couples = stored(pairs.select("item", "at1", "at2").distinct())
    once = met.withColumnRenamed("at", "at1").join(couples, ["item", "at1"])
    again = met.withColumnRenamed("at", "at2")
    twice = once.where("at2 IS NOT NULL").join(again, ["row", "item", "shift", "at2"], "left_semi")
    found = twice.unionByName(once.where("at2 IS NULL")).alias("found")
    window = pairs.select("item", "at1", "at2", "first", "stop").alias("window")
    same = [
        F.col("found.item") == F.col("window.item"),
        F.col("found.at1") == F.col("window.at1"),
        F.col("found.at2").eqNullSafe(F.col("window.at2")),
    ]
    candidates = stored(found.join(window, same).select("row", "found.item", "shift", "first", "stop"))
    # The words that the candidates call for, each once, against what the documents have there.
    called = (
        candidates.select(
            "row", "item", "shift", F.explode(F.sequence(F.col("first"), F.col("stop") - 1)).alias("at")
        )
        .distinct()
        .join(items_words(items, terms), ["item", "at"])
        .select("item", "shift", "at", "t", "row", (F.col("shift") + F.col("at")).alias("pos"))
    )
    held = (
        index.where("t > 0")
        .join(candidates.select("row").distinct(), "row", "left_semi")
        .select("t", "row", "pos")
        # What is called for follows the corpus: a small file may stand for many rows here.
        .join(called.hint("merge"), ["row", "pos", "t"])
        .select("row", "item", "shift", "at")
    )
    # Runs of matching places on one shift: place minus rank is constant within a run.
    on_shift = Window.partitionBy("row", "item", "shift").orderBy("at")
    shortest = items.select("item", F.least(F.size("_w"), F.lit(width)).alias("_least"))
    return (
        held.withColumn("_run", F.col("at") - F.row_number().over(on_shift))
        .groupBy("row", "item", "shift", "_run")
        .agg(F.min("at").alias("_from"), F.max("at").alias("_to"))
        .join(shortest, "item")
        .where(F.col("_to") - F.col("_from") + 1 >= F.col("_least"))
        .select(
            "row",
            "item",
            (F.col("shift") + F.col("_from")).alias("start"),
            (F.col("shift") + F.col("_to") + 1).alias("stop"),
        )
    )


def items_words(items: DataFrame, terms: DataFrame) -> DataFrame:
    return (
        items.select("item", F.posexplode("_w").alias("at", "term"))
        .join(terms, "term")
        .select("item", "at", "t")
    )


def proximity(
    index: DataFrame, items: DataFrame, terms: DataFrame, within: int, least: int
) -> DataFrame:
    """Loose matches: ``row``, ``item``, ``n_terms``, ``start``, ``stop``, where at least ``least``
    different words of an item lie within ``within`` consecutive words of a document.

    Only words rarer than the item's ``least - 1`` most frequent ones start such a span: any
    ``least`` different words have one of them.
    """
    counts = index.where("t > 0").groupBy("t").agg(F.count(F.lit(1)).alias("n_postings"))
    of_item = Window.partitionBy("item").orderBy(F.col("n_postings").desc(), "t")
    ranked = (
        items_words(items, terms)
        .select("item", "t")
        .distinct()
        .join(counts, "t")
        .withColumn("_rank", F.row_number().over(of_item))
    )
    anchors = (
        index.where("t > 0")
        .join(ranked.where(F.col("_rank") >= least), "t")
        .select(F.col("row").alias("_row"), F.col("item").alias("_item"))
        .distinct()
    )
    postings = (
        index.where("t > 0")
        .join(ranked.select("t", "item"), "t")
        .join(anchors, (F.col("row") == F.col("_row")) & (F.col("item") == F.col("_item")), "left_semi")
    )
    near = Window.partitionBy("row", "item").orderBy("pos").rangeBetween(0, within - 1)
    return (
        postings.withColumn("n_terms", F.size(F.collect_set("t").over(near)))
        .withColumn("stop", F.max("pos").over(near) + 1)
        .where(F.col("n_terms") >= least)
        .select("row", "item", "n_terms", F.col("pos").alias("start"), "stop")
    )


def numbered_items(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Different texts of the items, numbered, with the ids that have them."""
    different = items.select(
        words(F.col("text")).alias("_w"), F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id")
    ).where(F.size("_w") > 0)
    return stored(
        different.groupBy("_w")
        .agg(F.collect_set("id").alias("ids"))
        .select(F.monotonically_increasing_id().alias("item"), "_w", "ids")
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, width: int = 10, key: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``n_hit`` (words inside any match), ``n_items``,
    ``items_sha256`` (of the ids, sorted as strings, comma-joined) and ``contaminated``.
    """
    listed = numbered_items(items, item_id)
    terms = vocabulary(items)
    index = build_index(docs, terms, key)
    matches = stored(search(index, listed, terms, width))
    # Words hit, where matches overlap: a match adds what reaches beyond all earlier ones.
    earlier = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(
        Window.unboundedPreceding, -1
    )
    hits = (
        matches.select("row", "start", "stop")
        .distinct()
        .withColumn("_reach", F.coalesce(F.max("stop").over(earlier), F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum(
                F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.col("_reach")))
            ).alias("n_hit")
        )
    )
    ids = (
        matches.select("row", "item")
        .distinct()
        .join(listed.select("item", "ids"), "item")
        .select("row", F.explode("ids").alias("id"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    found = hits.join(ids, "row")
    lengths = index.where("t = 0").select(key, "row", F.col("pos").cast("bigint").alias("n_words"))
    return lengths.join(found, "row", "left").select(
        key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
