"""Fill in the middle: texts rearranged as prefix, suffix and middle, cut by arithmetic on words.

A unit is a run of characters other than ASCII white space with the white space before it, or the
white space at the end of a text. Texts of a batch lie one after the other, each padded with spaces
to whole 8-byte words, and are looked at as unsigned 64-bit numbers (SIMD within a register): a few
additions and masks set the top bit of every byte that ends a unit. The bits of each word are
counted, and the running total, searched for a unit's number, gives the word where it ends; within
the word, the place follows from the running totals of its eight bytes, which one multiplication
makes. No text is decoded or split.

Defined results: NULL text counts as empty; texts that are empty or hold one of the three marks
stay plain; a NULL key draws as the empty string does; equal keys draw equally, so repeated rows
get equal results; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracetally.llm.common import ship

ship(__name__)

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of text that are looked at together; a longer text is looked at alone.
WINDOW = 4_000_000
DRAWS = 4

ONES = np.uint64(0x0101010101010101)
TOP = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
SPACES = np.uint64(0x2020202020202020)
#: The bytes that go on a character: what remains without them is one byte a character.
GOING_ON = bytes(range(0x80, 0xC0))


def white_bytes(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is ASCII white space. No addition carries into a next byte."""
    low = words & LOW
    space = ~((low ^ SPACES) + LOW)
    control = (low + np.uint64(0x80 - 0x09) * ONES) & ~(low + np.uint64(0x80 - 0x0E) * ONES)
    return (space | control) & ~words & TOP


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The top bit of every byte that ends a unit; ``last`` are the places of the texts' last bytes."""
    white = white_bytes(words)
    after = white >> np.uint64(8)
    after[:-1] |= white[1:] << np.uint64(56)
    after[-1:] |= np.uint64(0x80 << 56)
    ends = after & ~white & TOP
    # Each text has words of its own, so no two of these share a word.
    ends[last >> 3] |= np.uint64(0x80) << (8 * (last & 7)).astype(np.uint64)
    return ends


class Units:
    """Where the units of several texts end."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ahead = np.concatenate([[0], np.cumsum((sizes >> 3) + 1)])
        self.first = ahead[:-1]
        padded = b"".join([t + b" " * (8 - (len(t) & 7)) for t in texts])
        words = np.frombuffer(padded, "<u8")
        some = sizes > 0
        self.ends = unit_ends(words, (8 * self.first + sizes - 1)[some])
        self.total = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)])
        self.before = self.total[self.first]
        self.n = self.total[ahead[1:]] - self.before

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """Bytes up to the end of the ``unit``-th unit (from 1) of each text; 0 for unit 0."""
        wanted = self.before + unit
        word = np.searchsorted(self.total[1:], wanted, "left").clip(max=len(self.ends) - 1)
        rank = (wanted - self.total[word]).astype(np.uint64)
        so_far = (self.ends[word] >> np.uint64(7)) * ONES
        reached = ((so_far | TOP) - rank * ONES) & TOP
        place = 8 * (word - self.first) + 9 - np.bitwise_count(reached).astype(np.int64)
        return np.where(unit > 0, place, 0)


def _characters(part: bytes) -> int:
    return len(part.translate(None, GOING_ON))


def _rearranged(texts: list[bytes], draws: np.ndarray, percent: int, suffix_first: int) -> list[tuple]:
    """(units, form, characters of prefix and middle, output) of each text."""
    units = Units(texts)
    cuts = draws[:2] % (units.n + 1)
    low, high = units.end_of(cuts.min(axis=0)).tolist(), units.end_of(cuts.max(axis=0)).tolist()
    chosen = (draws[2] % 100 < percent).tolist()
    swapped = (draws[3] % 100 < suffix_first).tolist()
    found = []
    for at, text in enumerate(texts):
        n = int(units.n[at])
        if not (chosen[at] and text) or PREFIX in text or SUFFIX in text or MIDDLE in text:
            found.append((n, "plain", None, None, text))
            continue
        prefix, middle, suffix = text[: low[at]], text[low[at] : high[at]], text[high[at] :]
        if swapped[at]:
            form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
        else:
            form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
        found.append((n, form, _characters(prefix), _characters(middle), b"".join(parts)))
    return found


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    percent: int = 50,
    suffix_first: int = 80,
) -> DataFrame:
    """``key``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of each row.

    Of the texts, ``percent`` in a hundred are rearranged, and of these ``suffix_first`` in a
    hundred have the suffix first (``spm``, the others ``psm``). The draws are the first groups of
    eight digits of the SHA-256 of seed and key, so they agree between runs.
    """

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(np.frombuffer(batch.column(5).buffers()[1], np.int32)[batch.column(5).offset :])
            begin = 0
            while begin < batch.num_rows:
                room = np.cumsum(sizes[begin : batch.num_rows], dtype=np.int64)
                part = batch.slice(begin, max(1, int(np.searchsorted(room, WINDOW, "right"))))
                begin += part.num_rows
                draws = np.stack([part.column(1 + at).to_numpy() for at in range(DRAWS)])
                found = _rearranged(part.column(5).to_pylist(), draws, percent, suffix_first)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, zip(*found, strict=True), kinds)],
                    ["key", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(drawn, 1 + 8 * at, 8), 16, 10).cast("bigint") for at in range(DRAWS)]
    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key), *draws, F.coalesce(text, F.lit("")).cast("binary"))
        .mapInArrow(
            rearrange,
            f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary",
        )
        .withColumn("output", F.col("output").cast("string"))
        .withColumnRenamed("key", key)
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A mark can't begin within a mark, and the text has
    none, so the three marks cut the output where they were put."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(parts, F.lit(at)) for at in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
        .otherwise(output)
    )
