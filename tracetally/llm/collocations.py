"""Collocations: frequent phrases whose words keep together, by fingerprints of all n-grams.

A text's words lie in one line, one space before each. With prefix sums S of table[byte] * base^place
modulo 2^64, the fingerprint of any stretch of the line is a difference of two sums times an inverse
power: a polynomial that does not depend on the place (Rabin and Karp), taken for all n-grams of a
batch at once. The language's hash is added, and the empty phrase stands for all words.

1. For phrases of one, two, three words in turn, tasks put out each fingerprint of a batch with its
   count and a tag: half of a second, independent fingerprint, and a pointer to an occurrence, half
   of the hash of its text. The shuffle adds the counts up and keeps the least and the largest tag.
   A phrase can only be frequent if its first and its last words but one are; n-grams whose parts
   are not in a table of frequent ones, of fixed size, are left out. Like a Bloom filter the table
   loses nothing; with a larger corpus more gets through.
2. Only frequent phrases are spelled: a second walk over the texts puts out the phrase where
   fingerprint and pointer are those wanted, again by such a table, and a join picks the right ones.
3. If the least and largest tag of a frequent fingerprint are of different second fingerprints,
   several phrases have collided. All their occurrences are put out as text and counted as text.
4. Counts of parts, scores and ranks are joins on the spelled phrases and exact decimals.

Long texts are cut into windows that overlap by the words a phrase can reach back, and an n-gram
counts where its last word is new. So memory is bounded, but for single words.

Defined results: NULL text is empty; a NULL language is ``und``; repeated rows count each; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracetally.llm import spans
from tracetally.llm.common import ship, stored

ship(__name__)

LONGEST = 3
#: Bytes of text that are looked at together.
WINDOW = 1_000_000
#: Bits of the number of a place in a table of fingerprints: 16 MB.
TABLE_BITS = 27
UNDEFINED = "und"
SEED = 20240301
BLANKS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
KINDS = spans.kinds(BLANKS, BREAKS)
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D.,;:!?]")
_TO_SPACE = bytes(0x20 if KINDS[at] else at for at in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


class Polynomial:
    """Fingerprints of stretches of a line of bytes."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.table = random.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(random.integers(0, 1 << 62)) * 4 + 3
        self.up = self.down = np.empty(0, np.uint64)

    def __call__(self, line: np.ndarray) -> np.ndarray:
        """The prefix sums of ``line``, from 0."""
        if len(line) > len(self.up):
            self.up = _powers(self.base, len(line))
            self.down = _powers(pow(self.base, -1, 1 << 64), len(line))
        sums = np.zeros(len(line) + 1, np.uint64)
        np.cumsum(self.table[line] * self.up[: len(line)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[first]) * self.down[first]


def windows(text: bytes, size: int = WINDOW, reach: int = LONGEST - 1) -> Iterator[tuple[bytes, int]]:
    """Parts of a text, cut at separators, and from which byte on a part's words are new: each part
    begins ``reach`` words before the end of the one before."""
    begin = cut = 0
    while True:
        fresh = cut - begin
        found = _SEPARATOR.search(text, min(cut + size, len(text)))
        cut = found.start() if found else len(text)
        part = text[begin:cut]
        yield part, fresh
        if cut == len(text):
            return
        words = part.translate(_TO_SPACE).rsplit(None, reach)
        if len(words) > reach:
            begin += len(words[0])


class Grams:
    """The n-grams of texts, given as (language, pointer, bytes, first new byte)."""

    def __init__(self, rows: list[tuple], polynomials: list[Polynomial]):
        self.polynomials = polynomials
        self.langs = [row[0] for row in rows]
        salt = [xxhash.xxh3_64_intdigest(lang.encode(), SEED) for lang in self.langs]
        self.salt = np.array(salt, np.uint64)
        self.pointer = np.array([row[1] for row in rows], np.uint64)
        self.words = spans.Layout([row[2] for row in rows], KINDS)
        fresh = np.array([row[3] for row in rows], np.int64)
        self.new = self.words.begin >= fresh[self.words.text]
        self.sums = [polynomial(self.words.line) for polynomial in polynomials]

    def at(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the first and last words of the n-grams that count here."""
        words = self.words
        first = np.arange(max(0, len(words.text) - size + 1))
        last = first + size - 1
        good = (words.piece[first] == words.piece[last]) & self.new[last]
        return first[good], last[good]

    def prints(self, first: np.ndarray, last: np.ndarray | None) -> np.ndarray:
        """Fingerprints of the n-grams, or without ``last`` of the empty phrase at each word."""
        return self._of(0, first, last) + self.salt[self.words.text[first]]

    def tags(self, first: np.ndarray, last: np.ndarray | None) -> np.ndarray:
        text = self.words.text[first]
        second = self._of(1, first, last) + self.salt[text] * np.uint64(0x9E3779B97F4A7C15)
        return second & np.uint64(0xFFFFFFFF00000000) | self.pointer[text]

    def _of(self, which: int, first: np.ndarray, last: np.ndarray | None) -> np.ndarray:
        if last is None:
            return np.zeros(len(first), np.uint64)
        begin, stop = self.words.first[first], self.words.stop[last]
        return self.polynomials[which].of(self.sums[which], begin, stop)


def _place(prints: np.ndarray) -> np.ndarray:
    return (prints >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _listed(table: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which of the ``prints`` may be in ``table``; those that are always are."""
    place = _place(prints)
    return (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _pairs(prints: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    """A hash of fingerprint and pointer; :func:`_pair` is the same on columns."""
    return (prints ^ pointer * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)


def _pair(frame: DataFrame) -> DataFrame:
    """``print`` is the hash of ``print`` and ``pointer``, worked out in tasks as :func:`_pairs`."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, pointer = (batch.column(at).to_numpy().view(np.uint64) for at in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_pairs(prints, pointer).view(np.int64))], ["print"])

    return frame.select("print", "pointer").mapInArrow(hashed, "print bigint")


def _table(frame: DataFrame) -> np.ndarray:
    """A bit for each place that a ``print`` of ``frame`` has. What comes to the driver is bounded:
    2^TABLE_BITS bits, in parts of 4 KB."""
    place = F.shiftrightunsigned("print", 64 - TABLE_BITS) + 1
    parts = (
        frame.select(place.alias("place"))
        .groupBy(F.expr("bitmap_bucket_number(place)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    )
    table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    for part, bits in parts.toLocalIterator():
        at = (part - 1) * 4096
        table[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return table


def _walk(batches: Iterator[pa.RecordBatch], mask: int) -> Iterator[Grams]:
    """The n-grams of batches of (language, text), some WINDOW of bytes at a time."""
    polynomials = [Polynomial(SEED), Polynomial(SEED + 1)]
    rows, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            pointer = xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF
            for part, fresh in windows(text):
                rows.append((lang, pointer, part, fresh))
                size += len(part) + 1
                if size >= WINDOW:
                    yield _Masked(rows, polynomials, mask)
                    rows, size = [], 0
    if rows:
        yield _Masked(rows, polynomials, mask)


class _Masked(Grams):
    """Fingerprints with fewer bits, so that tests see collisions."""

    def __init__(self, rows: list[tuple], polynomials: list[Polynomial], mask: int):
        super().__init__(rows, polynomials)
        self.mask = np.uint64(mask)

    def prints(self, first: np.ndarray, last: np.ndarray | None) -> np.ndarray:
        return super().prints(first, last) & self.mask


def _counted(docs: DataFrame, size: int, parts: object, mask: int) -> DataFrame:
    """``print``, ``n``, ``least`` and ``most`` (tags) of all phrases of ``size`` words; with those
    of one word, all words of a language as its empty phrase. ``parts`` is the broadcast table of
    the phrases that are shorter by a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _walk(batches, mask):
            first, last = grams.at(size)
            if size > 1:
                good = _listed(parts.value, grams.prints(first, last - 1))
                first, last = first[good], last[good]
                good = _listed(parts.value, grams.prints(first + 1, last))
                first, last = first[good], last[good]
            prints, tags = grams.prints(first, last), grams.tags(first, last)
            if size == 1:
                prints = np.concatenate([prints, grams.prints(first, None)])
                tags = np.concatenate([tags, grams.tags(first, None)])
            order = np.argsort(prints)
            prints, tags = prints[order], tags[order].view(np.int64)
            turn = np.flatnonzero(np.diff(prints, prepend=~prints[:1]))
            if not len(turn):
                continue
            columns = (
                prints[turn].view(np.int64),
                np.diff(turn, append=len(prints)),
                np.minimum.reduceat(tags, turn),
                np.maximum.reduceat(tags, turn),
            )
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["print", "n", "least", "most"])

    return (
        docs.mapInArrow(count, "print bigint, n bigint, least bigint, most bigint")
        .groupBy("print")
        .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    )


def _spelled(docs: DataFrame, wanted: object, collided: object | None, mask: int) -> DataFrame:
    """``print``, ``lang``, ``phrase`` and ``every`` where the hash of fingerprint and pointer is in
    the broadcast table ``wanted``, once a batch; where the fingerprint is in ``collided``, ``every``
    occurrence."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _walk(batches, mask):
            words, found = grams.words, []
            of_word = np.arange(len(words.text))
            for size in range(LONGEST + 1):
                if size:
                    first, last = grams.at(size)
                    prints = grams.prints(first, last)
                    begin, stop = words.first[first], words.stop[last]
                else:
                    first = of_word[grams.new]
                    prints = grams.prints(first, None)
                    begin = stop = words.first[first]
                hit = np.flatnonzero(_listed(wanted.value, _pairs(prints, grams.pointer[words.text[first]])))
                hit = hit[np.unique(prints[hit], return_index=True)[1]]
                found.append((hit, prints, begin, stop, first, False))
                if collided is not None:
                    hit = np.flatnonzero(_listed(collided.value, prints))
                    found.append((hit, prints, begin, stop, first, True))
            line = words.line.tobytes()
            for hit, prints, begin, stop, first, every in found:
                if not len(hit):
                    continue
                of = words.text[first[hit]].tolist()
                ends = zip(begin[hit].tolist(), stop[hit].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prints[hit].view(np.int64)),
                        pa.array([grams.langs[at] for at in of], pa.string()),
                        pa.array([line[a:b] for a, b in ends], pa.binary()),
                        pa.array(np.full(len(hit), every)),
                    ],
                    ["print", "lang", "phrase", "every"],
                )

    found = docs.mapInArrow(spell, "print bigint, lang string, phrase binary, every boolean")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def counts(docs: DataFrame, least: int = 10, text: str = "text", lang: str = "lang", mask: int = -1) -> DataFrame:
    """``lang``, ``phrase`` and ``a``, its occurrences, of all phrases of up to LONGEST words with at
    least ``least`` of them. The empty phrase counts all words. ``mask`` weakens fingerprints."""
    mask &= (1 << 64) - 1
    context = docs.sparkSession.sparkContext
    docs = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNDEFINED)).alias("lang"),
        F.coalesce(text, F.lit("")).cast("binary").alias("text"),
    )
    levels, table = [], None
    for size in range(1, LONGEST + 1):
        frequent = _counted(docs, size, table, mask).where(F.col("n") >= least)
        levels.append(
            stored(
                frequent.select(
                    "print",
                    "n",
                    F.col("least").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pointer"),
                    (F.shiftright("least", 32) != F.shiftright("most", 32)).alias("collided"),
                )
            )
        )
        if size < LONGEST:
            table = context.broadcast(_table(levels[-1]))
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.union(level)
    # Phrases of different lengths can collide as well.
    frequent = stored(
        frequent.groupBy("print").agg(
            F.sum("n").alias("n"),
            F.min("pointer").alias("pointer"),
            (F.max("collided") | (F.count(F.lit(1)) > 1)).alias("collided"),
        )
    )
    collided = frequent.where("collided").select("print")
    several = not collided.isEmpty()
    wanted = context.broadcast(_table(_pair(frequent.where("NOT collided"))))
    found = stored(_spelled(docs, wanted, context.broadcast(_table(collided)) if several else None, mask))
    one = found.where("NOT every").groupBy("print").agg(F.first(F.struct("lang", "phrase")).alias("of"))
    single = frequent.where("NOT collided").join(one, "print").select("of.lang", "of.phrase", F.col("n").alias("a"))
    if not several:
        return stored(single)
    again = (
        found.where("every")
        .join(collided, "print")
        .groupBy("lang", "phrase")
        .agg(F.count(F.lit(1)).alias("a"))
        .where(F.col("a") >= least)
    )
    return stored(single.union(again))


def collocations(
    docs: DataFrame,
    least: int = 10,
    top: int = 2000,
    covered: int = 50,
    text: str = "text",
    lang: str = "lang",
    mask: int = -1,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the ``top`` phrases of
    two to three words of each language.

    The score of a cut is 1,000,000 a^2 / (l r), rounded down, with a, l and r the occurrences of the
    phrase and its parts; the lowest one counts. A phrase that lies within a longer one with at least
    ``covered`` in a hundred of its occurrences is left out.
    """
    known = counts(docs, least, text, lang, mask)
    words = F.split("phrase", " ")
    listed = known.where("phrase <> ''").withColumn("words", words).withColumn("size", F.size("words"))
    candidates = listed.where("size > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    head = F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head")
    tail = F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail")
    cuts = candidates.select("lang", "phrase", "a", "words", "size", cut).select("lang", "phrase", "a", "k", head, tail)
    left = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    # Counts below 10^13 keep all products below 38 digits.
    score = (
        "CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(13,0)) * CAST(a AS DECIMAL(13,0))"
        " DIV (CAST(l AS DECIMAL(13,0)) * CAST(r AS DECIMAL(13,0)))"
    )
    scored = (
        cuts.join(left, ["lang", "head"])
        .join(right, ["lang", "tail"])
        .withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    )
    within = listed.where(F.col("size") == LONGEST).select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.array(*[F.array_join(F.slice("words", at, LONGEST - 1), " ") for at in (1, 2)])
        ).alias("phrase"),
    )
    longer = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True))
    )
    ranked = kept.withColumn(
        "rank",
        F.row_number()
        .over(Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase"))
        .cast("bigint"),
    ).where(F.col("rank") <= top)
    total = known.where("phrase = ''").select("lang", F.col("a").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", "rank", "phrase", "a", "low.l", "low.r", "n", F.col("low.score").alias("score")
    )
