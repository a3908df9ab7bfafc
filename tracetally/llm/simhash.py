"""SimHash near duplicates: fingerprints compared at the anchors of a covering code.

A text's fingerprint has the bits that are set in more than half of the hashes of its three-word
shingles. Fingerprints that differ in at most three bits are linked.

1. Of three differing bits, one half of the fingerprint has at most one. Of each half, 31 bits are
   looked at (a bit left out can only bring two halves closer).
2. The anchors are the 2^26 words of the Hamming code of length 31, whose covering radius is one:
   every half is an anchor, or one bit from exactly one, its home. A fingerprint is replicated to
   all anchors within covering radius plus threshold, two bits: one, or one at a distance of one and
   fifteen at a distance of two. If two halves differ in one bit at most, the home of either is
   within two bits of the other, so the two meet there.
3. Only anchors that are somebody's home and have company are looked at. The members of an anchor are
   compared as whole fingerprints; pairs of which neither is at home are left to other anchors. Up
   to SMALL members put out all their links. More grow trees: a member that has been linked is never
   compared again as a target, so a crowd of m gives at most m - 1 links. Anchors above BLOCK
   members are dealt out by hash to parts, and each two parts are compared in a task of their own.
4. Links make components.

Only different fingerprints take part, so repeated texts and copies cost nothing after step 0.

Defined results: a text of one or two words is one shingle; texts without words, and NULL, have
fingerprint zero and are linked like any other; rows with a NULL id get the smallest id of their
group, NULL if nobody there has one; repeated rows get equal results; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracetally.llm import spans
from tracetally.llm.common import ship, stored
from tracetally.llm.components import components

ship(__name__)

SHINGLE = 3
SEED = 42
#: Differing bits of a link.
THRESHOLD = 3
#: Bits of a half that are looked at: the length of the Hamming code.
LENGTH = 31
SMALL, BLOCK = 16, 4096
#: Bytes of text, and shingles, that are looked at together.
WINDOW, CHUNK = 1_000_000, 65_536

WORDS = spans.kinds(b"\x20\x09\x0a\x0b\x0c\x0d")


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text."""
    words = spans.Layout(texts, WORDS)
    n = np.bincount(words.text, minlength=len(texts))
    shingles = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    of = np.repeat(np.arange(len(texts)), shingles)
    first = np.arange(len(of)) - (np.cumsum(shingles) - shingles)[of] + (np.cumsum(n) - n)[of]
    last = np.minimum(first + SHINGLE - 1, (np.cumsum(n) - 1)[of])
    line = words.line.tobytes()
    votes = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(of), CHUNK):
        part = slice(at, at + CHUNK)
        begin, end = words.first[first[part]].tolist(), words.stop[last[part]].tolist()
        hashes = np.array(
            [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(begin, end, strict=True)], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        turn = np.flatnonzero(np.diff(of[part], prepend=-1))
        votes[of[part][turn]] += np.add.reduceat(bits, turn, axis=0, dtype=np.int32)
    most = 2 * votes > shingles[:, None]
    return np.packbits(most, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` and ``print`` (a signed number) of every row."""

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, found, window, size = batch.column(1), [], [], 0
            for at in range(batch.num_rows):
                window.append(values[at].as_py())
                size += len(window[-1])
                if size >= WINDOW or at == batch.num_rows - 1:
                    found.append(fingerprints_of(window))
                    window, size = [], 0
            prints = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.coalesce(text, F.lit("")).cast("binary")).mapInArrow(
        fingerprint, f"id {kind}, print bigint"
    )


def _syndrome(values: np.ndarray) -> np.ndarray:
    """The exclusive or of the places, from 1, of the bits set in 31-bit ``values``."""
    found = np.zeros(len(values), np.uint64)
    for bit in range(5):
        mask = sum(1 << (place - 1) for place in range(1, LENGTH + 1) if place >> bit & 1)
        odd = np.bitwise_count(values & np.uint64(mask)).astype(np.uint64) & np.uint64(1)
        found |= odd << np.uint64(bit)
    return found


def _flip(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    return values ^ (np.uint64(1) << (place.astype(np.uint64) - np.uint64(1)))


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index into ``prints``, anchor, and whether it is the home, for every anchor within reach."""
    index, anchor, home = [], [], []
    every = np.arange(len(prints))

    def put(rows: np.ndarray, words: np.ndarray, half: int, at_home: bool) -> None:
        index.append(rows)
        anchor.append(words | np.uint64(half << LENGTH))
        home.append(np.full(len(rows), at_home))

    for half in (0, 1):
        word = (prints >> np.uint64(32 * half)) & np.uint64((1 << LENGTH) - 1)
        syndrome = _syndrome(word)
        put(every[syndrome == 0], word[syndrome == 0], half, True)
        off = every[syndrome > 0]
        word, syndrome = word[off], syndrome[off]
        put(off, _flip(word, syndrome), half, True)
        for place in range(1, LENGTH + 1):
            # Flipping two places whose numbers differ by the syndrome gives an anchor.
            other = syndrome ^ np.uint64(place)
            pick = other > place
            twice = _flip(_flip(word[pick], np.full(pick.sum(), place)), other[pick])
            put(off[pick], twice, half, False)
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def replicated(prints: DataFrame) -> DataFrame:
    """``anchor``, ``print``, ``home``: every fingerprint at every anchor within reach."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            index, anchor, home = anchors(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(values[index]), pa.array(home)],
                ["anchor", "print", "home"],
            )

    return prints.select("print").mapInArrow(replicate, "anchor bigint, print bigint, home boolean")


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= THRESHOLD


def _all_links(sizes: np.ndarray, values: np.ndarray, home: np.ndarray) -> list[np.ndarray]:
    """All links within groups of the given sizes, as two arrays."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    found = []
    for apart in range(1, int(sizes.max(initial=1))):
        at = np.flatnonzero(of[apart:] == of[:-apart])
        at = at[(home[at] | home[at + apart]) & _near(values[at], values[at + apart])]
        found.append(np.stack([values[at], values[at + apart]]))
    return found


def _trees(values: np.ndarray, home: np.ndarray) -> Iterator[np.ndarray]:
    """Links that connect what all links of a group connect."""
    left, left_home = values, home
    while len(left):
        grown = [(left[:1], left_home[:1])]
        left, left_home = left[1:], left_home[1:]
        while grown:
            some, at_home = grown.pop()
            for one, settled in zip(some, at_home, strict=True):
                hit = _near(left, one)
                if not settled:
                    hit &= left_home
                if hit.any():
                    new = left[hit]
                    yield np.stack([np.full(len(new), one), new])
                    grown.append((new, left_home[hit]))
                    left, left_home = left[~hit], left_home[~hit]


def _compared(groups: DataFrame) -> DataFrame:
    """Links (``u``, ``v``) within ``members``, arrays of at most two parts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
            flat = lists.flatten()
            values = flat.field("print").to_numpy().view(np.uint64)
            home = flat.field("home").to_numpy(zero_copy_only=False)
            small = np.repeat(sizes <= SMALL, sizes)
            found = _all_links(sizes[sizes <= SMALL], values[small], home[small])
            ends = np.cumsum(sizes)
            for at in np.flatnonzero(sizes > SMALL):
                part = slice(ends[at] - sizes[at], ends[at])
                found += _trees(values[part], home[part])
            if found:
                both = np.concatenate(found, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["u", "v"])

    return groups.select("members").mapInArrow(compare, "u bigint, v bigint")


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (``u``, ``v``) that connect all groups of the different ``print``."""
    sent = replicated(prints)
    used = stored(
        sent.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("settled"))
        .where("n > 1 AND settled")
        .select("anchor", F.ceil(F.col("n") / block).alias("parts"))
    )
    dealt = sent.join(used, "anchor").withColumn("part", F.pmod(F.xxhash64("print"), "parts"))
    groups = stored(
        dealt.groupBy("anchor", "parts", "part").agg(
            F.collect_list(F.struct("print", "home")).alias("members")
        )
    )
    large = groups.where("parts > 1").select("anchor", "part", "members")
    a, b = large.alias("a"), large.alias("b")
    meeting = (F.col("a.anchor") == F.col("b.anchor")) & (F.col("a.part") < F.col("b.part"))
    both = a.join(b, meeting).select(F.concat("a.members", "b.members").alias("members"))
    return stored(_compared(groups.where("parts = 1")).union(_compared(both)).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest id of the
    group) of every row."""
    printed = stored(fingerprints(docs, key, text))
    classes = stored(printed.groupBy("print").agg(F.min("id").alias("least")))
    found = stored(components(links(classes)))
    group = F.coalesce("component", "print").alias("group")
    grouped = classes.join(found, F.col("print") == F.col("node"), "left").select("print", "least", group)
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stored(grouped.join(least, "group").select("print", "component_id"))
    return printed.join(named, "print").select(
        F.col("id").alias(key),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )
