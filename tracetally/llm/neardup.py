"""Near duplicates: banded MinHash candidates, sequential Bayesian pruning, exact verification.

Two texts are linked if their sets of five-word shingles have a Jaccard similarity of at least
``percent`` in a hundred; a group is what links connect.

1. Every text becomes its set's size, a 128-bit hash of the set and a MinHash signature. Texts with
   equal sets are one class from here on.
2. The signature is cut into bands; classes that share a band are a bucket. Bands are as long as
   they can be while two classes at the threshold share none with a probability below MISS.
3. In each bucket all members are compared with one hub, the member whose other buckets are the
   largest: in a group of edited copies that is the original. That is one pair per member.
4. A pair's signatures are compared batch by batch, and the pair goes as soon as the posterior
   probability that it reaches the threshold falls below MISS. What remains is verified on the sets.
5. Links make components. Buckets that still hold several get a second hub, the best connected
   member outside the first hub's component: a group far from the first hub gathers around it.
6. In buckets that hold several even then, pairs of different components are compared the same way,
   but only those that can reach the threshold at all: a shingle that no other member of such
   buckets has can't be in an intersection, which bounds the similarity of each pair exactly.
7. Members of large buckets (LARGE) are not paired like that. What a text does not have in common
   with its bucket's hub, in either direction, is a small set in a group of edited copies; two such
   sets differ exactly as the texts do, and two texts of different components can only be similar
   enough if the sets share one of their rarest elements. Ids meet on those; how many they share, and
   how many could follow, bounds a pair's similarity before its signatures and sets are fetched.
8. Components of all links are the result.

No step brings a bucket or a component into one task, and none pairs the members of a bucket that
are already linked. Words are maximal runs without ASCII white space, after lower-casing A to Z;
shingles are compared by 64-bit hashes.

Defined results: a text with one to four words is one shingle; a text without words (or NULL) has
none and is linked with nothing; repeated rows are linked; rows that share an id are one document
with the links of all its texts; rows with a NULL id are kept and take no part; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracetally.llm.common import WIDE_ROWS, few, ship, stored
from tracetally.llm.components import components

ship(__name__)

SHINGLE = 5
HASHES = 192
#: Pairs are compared this many hashes at a time.
BATCH = 32
#: Chosen probability of losing a pair at the threshold, to banding and to pruning.
MISS = 1e-6
#: Members of buckets above this size meet through their hub.
LARGE = 64
#: Shingles permuted at once: bounds a task's memory whatever a text's length.
CHUNK = 512
#: Bytes of sets that go into one Arrow batch.
FILL = 4 << 20
SEED = 20240229
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))


def band_rows(percent: int) -> int:
    """Hashes in a band."""
    for rows in range(HASHES, 1, -1):
        if (1 - (percent / 100) ** rows) ** (HASHES // rows) <= MISS:
            return rows
    raise ValueError(f"{HASHES} hashes are too few for a similarity of {percent} %")


def shingles(text: str | None) -> np.ndarray:
    """The sorted different 64-bit hashes of a text's shingles."""
    # bytes.split() splits at the six ASCII white space characters and nothing else.
    words = (text or "").encode().translate(bytes.maketrans(UPPER, LOWER)).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(SHINGLE, len(words))
    mixed = np.full(len(words) - span + 1, len(words) if span < SHINGLE else 0, np.uint64)
    for at in range(span):
        # One round of a 64-bit mixer per word, so that the order of words counts.
        mixed ^= hashes[at : len(words) - span + 1 + at]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 1 << 63, HASHES, np.uint64)


def signature(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least of each permutation's high 32 bits over the set."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[None, at : at + CHUNK] * factors[:, None]
        part += offsets[:, None]
        np.minimum(least, (part.min(axis=1) >> np.uint64(32)).astype(np.uint32), out=least)
    return least


def sketches(docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """``id``, ``hash`` (64 bits, of the text), ``n`` (set size), ``set`` (128-bit hash), ``sig``,
    ``bands`` of every text."""
    wide = band_rows(percent)
    bands = HASHES // wide

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = _permutations()
        for batch in batches:
            sizes, sets, signatures, keys = [], [], [], []
            for value in batch.column(2):
                hashes = shingles(value.as_py())
                sizes.append(len(hashes))
                if not len(hashes):
                    sets.append(b""), signatures.append(b""), keys.append([])
                    continue
                least = signature(hashes, factors, offsets)
                sets.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                signatures.append(least.tobytes())
                rows = least[: bands * wide].reshape(bands, wide)
                values = [xxhash.xxh3_64_intdigest(row.tobytes()) for row in rows]
                keys.append(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["id", "hash", "n", "set", "sig", "bands"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.xxhash64(text), F.col(text)).mapInArrow(
        sketch, f"id {kind}, hash bigint, n bigint, set binary, sig binary, bands array<bigint>"
    )


def _least_matches(percent: int) -> list[int]:
    """Fewest matches after each batch that keep a pair: with a uniform prior, the posterior of the
    similarity after m matches of h is Beta(m + 1, h - m + 1)."""
    grid = (np.arange(20000) + 0.5) / 20000
    above = grid >= percent / 100
    found = []
    for hashes in range(BATCH, HASHES + 1, BATCH):
        for matches in range(hashes + 1):
            log = matches * np.log(grid) + (hashes - matches) * np.log1p(-grid)
            density = np.exp(log - log.max())
            if density[above].sum() >= MISS * density.sum():
                found.append(matches)
                break
    return found


def pruned(pairs: DataFrame, percent: int) -> DataFrame:
    """(``u``, ``v``) of those ``pairs`` (``u``, ``v``, ``sig_u``, ``sig_v``) that may be links."""
    least = _least_matches(percent)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, np.int64)
            sides = [
                np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint32).reshape(-1, HASHES)
                for at in (2, 3)
            ]
            for at, needed in enumerate(least):
                cut = slice(at * BATCH, (at + 1) * BATCH)
                matches[alive] += (sides[0][alive, cut] == sides[1][alive, cut]).sum(axis=1)
                alive = alive[matches[alive] >= needed]
            yield batch.select([0, 1]).take(pa.array(alive))

    kind = pairs.schema["u"].dataType.simpleString()
    return pairs.select("u", "v", "sig_u", "sig_v").mapInArrow(prune, f"u {kind}, v {kind}")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Those of the pairs (``u``, ``v``; at most ``most``) whose ``sets`` (``id``, ``hashes``) are
    similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[at].as_py(), np.uint64) for c in (2, 3))
                both = len(a) + len(b) - len(np.union1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    keep.append(at)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    kind = pairs.schema["u"].dataType.simpleString()
    of = sets.select(F.col("id").alias("u"), F.col("hashes").alias("hashes_u"))
    other = sets.select(F.col("id").alias("v"), F.col("hashes").alias("hashes_v"))
    both = pairs.join(of, "u").join(other, "v").select("u", "v", "hashes_u", "hashes_v")
    return few(both, most, WIDE_ROWS).mapInArrow(verify, f"u {kind}, v {kind}")


def _filled(rows: Iterable[tuple], columns: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches that end when their last column holds FILL bytes."""
    schema = pa.schema(list(columns.items()))

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(column, field.type) for column, field in zip(zip(*part), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    part, held = [], 0
    for row in rows:
        part.append(row)
        held += memoryview(row[-1]).nbytes
        if held >= FILL:
            yield batch()
            part, held = [], 0
    if part:
        yield batch()


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """``id`` and ``hashes`` (the set), one row of each class in ``wanted`` (``id``, ``rep``,
    ``hash``, ``set``; at most ``most``), stored."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at in range(batch.num_rows):
                    found = shingles(batch.column(1)[at].as_py()).tobytes()
                    # Different texts of one document can only meet here if their hashes collide.
                    if xxhash.xxh3_128_digest(found) == batch.column(2)[at].as_py():
                        yield batch.column(0)[at].as_py(), found

        yield from _filled(rows(), {"id": pa.int64(), "hashes": pa.binary()})

    texts = (
        docs.select(F.col(key).alias("rep"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
        .join(wanted.select("id", "rep", "hash", "set").hint("shuffle_hash"), ["rep", "hash"])
        .select("id", "text", "set")
    )
    found = stored(
        few(texts, most, WIDE_ROWS)
        .mapInArrow(sets, "id bigint, hashes binary")
        .withColumn("row", F.monotonically_increasing_id())
    )
    # Rows that repeat id and text are all found; as one set each they'd multiply every join.
    one = stored(
        found.groupBy("id").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("rows")), most=most
    )
    if one.where("rows > 1").isEmpty():
        return found.drop("row")
    again = found.select("id", "row").join(one.where("rows > 1").select("id", F.col("row").alias("_one")), "id")
    again = stored(again.where("row <> _one").select("row"))
    return stored(found.join(again, "row", "left_anti").drop("row"))


def _with(pairs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """The pairs (at most ``most``) with both signatures."""
    u = classes.select(F.col("id").alias("u"), F.col("sig").alias("sig_u"))
    v = classes.select(F.col("id").alias("v"), F.col("sig").alias("sig_v"))
    return few(pairs.join(u, "u").join(v, "v"), most, WIDE_ROWS)


def _linked(
    pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """The links among stored ``pairs``: pruned by signatures, then verified on the sets."""
    most = pairs.count()
    return verified(stored(pruned(_with(pairs, classes, most), percent)), sets, percent, most)


def links(
    docs: DataFrame, sketched: DataFrame, key: str, text: str, percent: int
) -> tuple[DataFrame, int]:
    """Links (``u``, ``v``) between classes, named by their smallest id, that connect all groups, and
    a bound of their number.

    In here ``id`` numbers the classes, so that several texts of one document stay apart.
    """
    ranked = sketched.where("n > 0 AND id IS NOT NULL")
    rows = sketched.count()
    classes = (
        ranked.groupBy("set")
        .agg(
            F.min(F.struct("id", "hash")).alias("least"),
            F.first("n").alias("n"),
            F.first("sig").alias("sig"),
            F.first("bands").alias("bands"),
        )
        .select(
            F.monotonically_increasing_id().alias("id"),
            F.col("least.id").alias("rep"),
            F.col("least.hash").alias("hash"),
            *("set", "n", "sig", "bands"),
        )
    )
    classes = stored(few(classes, rows, WIDE_ROWS))
    banded = classes.select("id", "n", F.posexplode("bands").alias("band", "value"))
    sizes = stored(
        banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1"),
        most=rows * (HASHES // band_rows(percent)) // 2,
    )
    members = stored(banded.join(sizes, ["band", "value"]))
    # No table of ids, buckets or pairs with a hub has more rows.
    bound = members.count()
    ids = stored(
        members.groupBy("id")
        .agg(F.sum("members").alias("crowd"))
        .join(classes.select("id", "rep", "hash", "set"), "id"),
        most=min(rows, bound),
    )
    sets = _sets(docs, ids, key, text, min(rows, bound))
    alone = members.withColumn("label", F.col("id"))
    hubs = stored(_hubs(alone, ids), most=bound)
    stars = stored(_stars(alone, hubs), most=bound)
    found = stored(_linked(stars, classes, sets, percent))
    labels = stored(components(found, bound))
    unsettled = stored(_mixed(members, labels, bound))

    of_hub = hubs.join(labels, F.col("v") == F.col("node"), "left").select(
        "band", "value", F.coalesce("component", "v").alias("of")
    )
    outside = unsettled.join(of_hub, ["band", "value"]).where("label <> of").drop("of")
    second = stored(_hubs(outside, ids), most=bound)
    more = stored(_stars(unsettled, second).join(stars, ["u", "v"], "left_anti"), most=bound)
    stars = stars.union(more)
    gathered = stored(_linked(more, classes, sets, percent))
    if not gathered.isEmpty():
        found = found.union(gathered)
        labels = stored(components(found, 2 * bound))
        unsettled = stored(_mixed(members, labels, bound))

    # What the members of buckets of several components can still reach.
    around = stored(unsettled.select("id").distinct(), most=min(rows, bound))
    own = stored(_own(sets.join(around, "id")), most=min(rows, bound))
    # |A & B| is at most what A shares with anybody, and at least this share of |A| + |B|.
    share = percent / (100 + percent)
    most = F.floor((F.col("n") - F.coalesce("own", F.lit(0))) / share + 1e-6) - F.col("n")
    open_ = stored(
        unsettled.join(own, "id", "left").select(
            "band", "value", "id", "n", "label", most.cast("bigint").alias("most")
        )
    )
    # Buckets without a small enough other member for anybody have no pair to look at.
    reach = open_.groupBy("band", "value").agg(F.max("most").alias("_most"), F.min("n").alias("_n"))
    reachable = stored(
        open_.join(stored(reach, most=bound), ["band", "value"]).where("n <= _most AND most >= _n").drop("_most", "_n")
    )
    crowds = stored(
        reachable.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("members"))
        .join(hubs.select("band", "value", F.col("v").alias("hub")), ["band", "value"]),
        most=bound,
    )
    small = reachable.join(crowds.where(F.col("members") <= LARGE).select("band", "value"), ["band", "value"])
    a, b = small.alias("a"), small.alias("b")
    crossed = (
        a.join(
            b,
            (F.col("a.band") == F.col("b.band"))
            & (F.col("a.value") == F.col("b.value"))
            & (F.col("a.id") > F.col("b.id"))
            & (F.col("a.label") != F.col("b.label"))
            & (F.col("a.n") <= F.col("b.most"))
            & (F.col("b.n") <= F.col("a.most"))
            & (100 * F.col("a.n") >= percent * F.col("b.n"))
            & (100 * F.col("b.n") >= percent * F.col("a.n")),
        ).select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))
    )
    # A member meets the others of each large bucket through that bucket's own hub.
    main = stored(
        reachable.join(crowds.where(F.col("members") > LARGE), ["band", "value"])
        .where("id <> hub")
        .select("id", "n", "label", "hub")
        .distinct(),
        most=bound,
    )
    rest = stored(
        crossed.union(_through_hubs(main, sets, percent)).distinct().join(stars, ["u", "v"], "left_anti")
    )
    found = found.union(_linked(rest, classes, sets, percent))
    names = classes.select("id", "rep")
    u = names.select(F.col("id").alias("u"), F.col("rep").alias("_u"))
    v = names.select(F.col("id").alias("v"), F.col("rep").alias("_v"))
    named = found.join(u, "u").join(v, "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    return named, 2 * bound + rest.count()


def _hubs(members: DataFrame, ids: DataFrame) -> DataFrame:
    """Per bucket of ``members`` its hub ``v``, the member with the largest ``crowd`` in all its
    buckets, and the component ``of`` the hub."""
    best = F.max(F.struct("crowd", "id", "label"))
    return (
        members.join(ids.select("id", "crowd"), "id")
        .groupBy("band", "value")
        .agg(best.alias("hub"))
        .select("band", "value", F.col("hub.id").alias("v"), F.col("hub.label").alias("of"))
    )


def _stars(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """One pair (``u`` > ``v``) for each member and hub of its buckets in different components."""
    return (
        members.join(hubs, ["band", "value"])
        .where("label <> of")
        .select(F.greatest("id", "v").alias("u"), F.least("id", "v").alias("v"))
        .distinct()
    )


def _mixed(members: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """The ``members`` (at most ``most``) of buckets of several components, with their component
    ``label``."""
    labelled = stored(
        members.join(labels, F.col("id") == F.col("node"), "left").select(
            "band", "value", "id", "n", F.coalesce("component", "id").alias("label")
        )
    )
    mixed = (
        labelled.groupBy("band", "value")
        .agg(F.min("label").alias("_least"), F.max("label").alias("_most"))
        .where("_least <> _most")
        .select("band", "value")
    )
    return labelled.join(stored(mixed, most=most), ["band", "value"])


def _through_hubs(main: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``u``, ``v``) that may be links between different components among texts (``id``,
    ``n``, ``label``) of one ``hub``; all links are among them.

    With D the symmetric difference of a text and the hub, |A ^ B| = |Da ^ Db|, so a pair is a link
    if |Da ^ Db| <= k (|A| + |B|), k = (100 - percent) / (100 + percent). One of two texts of
    different components is no link of the hub. From that it follows that a text shares with its
    partner at least half of what its |D| exceeds the hub's bound by, if it is no link itself, and
    at least (1 - k) / 2 of its elements, if the partner is none. So the two share one of the first
    elements of each, in any common order; with the rarest first, few texts meet.

    The join has ids, sizes and places only. In a common order, the elements that a pair shares are
    those it met on, and others after the last of them in both, which bounds |Da & Db|.
    """

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at in range(batch.num_rows):
                    known = [batch.column(c)[at].as_py() for c in range(4)]
                    a, b = (np.frombuffer(batch.column(c)[at].as_py(), np.int64) for c in (4, 5))
                    yield *known, len(b), np.setxor1d(a, b, assume_unique=True)

        names = ("id", "n", "label", "hub", "n_hub")
        yield from _filled(rows(), dict.fromkeys(names, pa.int64()) | {"diff": pa.list_(pa.int64())})

    of = sets.select("id", F.col("hashes").alias("hashes_u"))
    hub = sets.select(F.col("id").alias("hub"), F.col("hashes").alias("hashes_v"))
    k = (100 - percent) / (100 + percent)
    beyond = (F.col("size") - k * (F.col("n") + F.col("n_hub"))) / 2
    half = F.greatest(F.lit(1), F.ceil(F.col("size") * (1 - k) / 2 - 1e-9))
    shared = F.when(beyond > 0, F.greatest(F.lit(1), F.ceil(beyond - 1e-9))).otherwise(half)
    both = main.join(of, "id").join(hub, "hub").select("id", "n", "label", "hub", "hashes_u", "hashes_v")
    texts = stored(
        few(both, main.count(), WIDE_ROWS)
        .mapInArrow(
            differences,
            "id bigint, n bigint, label bigint, hub bigint, n_hub bigint, diff array<bigint>",
        )
        .withColumn("size", F.size("diff"))
        .withColumn("first", F.col("size") - shared + 1)
        # Between two texts that are no links of the hub, the second bound holds for both.
        .withColumn("linked", beyond <= 0)
        .withColumn("first_unlinked", F.col("size") - half + 1)
    )
    about = ("hub", "id", "n", "label", "size", "first", "linked", "first_unlinked")
    elements = texts.select(*about, F.explode("diff").alias("element"))
    most = texts.agg(F.sum("size")).first()[0] or 0
    counts = stored(
        elements.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("texts")), most=most
    )
    rarest = Window.partitionBy("hub", "id").orderBy("texts", "element")
    firsts = stored(
        elements.join(counts, ["hub", "element"])
        .withColumn("place", F.row_number().over(rarest))
        # An element that one text alone has takes its place, but meets nothing.
        .where("place <= first AND texts > 1")
        .select(
            *("hub", "element", "id", "n", "label", "size", "linked", "place"),
            (F.col("place") <= F.col("first_unlinked")).alias("early"),
        ),
        most=most,
    )
    a, b = firsts.alias("a"), firsts.alias("b")
    met = (
        a.join(
            b,
            (F.col("a.hub") == F.col("b.hub"))
            & (F.col("a.element") == F.col("b.element"))
            & (F.col("a.id") > F.col("b.id"))
            & (F.col("a.label") != F.col("b.label"))
            & (F.col("a.linked") | F.col("b.linked") | (F.col("a.early") & F.col("b.early")))
            & (100 * F.col("a.n") >= percent * F.col("b.n"))
            & (100 * F.col("b.n") >= percent * F.col("a.n")),
        )
        .groupBy("a.hub", F.col("a.id").alias("u"), F.col("b.id").alias("v"))
        .agg(
            F.count(F.lit(1)).alias("met"),
            F.first(F.col("a.size") + F.col("b.size")).alias("sizes"),
            F.first(F.col("a.n") + F.col("b.n")).alias("total"),
            # The fewest elements that come after the last one that both have.
            F.least(
                F.min(F.col("a.size") - F.col("a.place")), F.min(F.col("b.size") - F.col("b.place"))
            ).alias("after"),
        )
    )
    apart = F.col("sizes") - 2 * (F.col("met") + F.col("after"))
    return met.where(100 * (F.col("total") - apart) >= percent * (F.col("total") + apart)).select("u", "v")


def _own(sets: DataFrame) -> DataFrame:
    """``id`` and ``own``, how many shingles no other of the ``sets`` has."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at in range(batch.num_rows):
                    yield batch.column(0)[at].as_py(), np.frombuffer(batch.column(1)[at].as_py(), np.int64)

        yield from _filled(rows(), {"id": pa.int64(), "shingles": pa.list_(pa.int64())})

    return (
        sets.select("id", "hashes")
        .mapInArrow(spread, "id bigint, shingles array<bigint>")
        .select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("_other"))
        .where("id = _other")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("own"))
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest id of the group) and ``kept`` (the
    document is that one) of every row."""
    sketched = stored(sketches(docs, key, text, percent))
    found, most = links(docs, sketched, key, text, percent)
    # Documents of one class, and texts of one id, hang on the class's smallest id.
    rows = sketched.count()
    of_class = stored(
        sketched.where("n > 0 AND id IS NOT NULL").groupBy("set").agg(F.min("id").alias("rep")),
        most=rows,
    )
    same = (
        sketched.where("n > 0 AND id IS NOT NULL")
        .join(of_class, "set")
        .where("id <> rep")
        .select(F.col("id").alias("u"), F.col("rep").alias("v"))
        .distinct()
    )
    groups = stored(components(found.union(same), most + rows))
    return sketched.join(groups, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("id")), F.lit(True)).alias("kept"),
    )
