"""Collocations, filling in the middle and SimHash against their brute-force versions."""

from __future__ import annotations

import random
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tracetally.llm import collocations, middle, phrases, quality, queries, simhash

DOCS = "doc_id long, text string"
ODD = ["", None, " \n\t", "a", "A b", " x  y\tz ", "one. two, three; four", "ü\x0bé ñ", "<P>", "a <S> b", "日本 語😀 x", "<M"]


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def prose(seed, rows, words, sizes=(1, 5, 40, 200)):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdeéXY", k=rnd.randint(1, 5))) for _ in range(words)]
    stops = [" "] * 8 + [", ", ". ", "\n", "  ", "\t"]
    return [
        "".join(rnd.choice(vocabulary) + rnd.choice(stops) for _ in range(rnd.choice(sizes)))
        for _ in range(rows)
    ]


# Collocations

@pytest.mark.parametrize("mask", [-1, 0xFFF, 0xFFF0000000000000])
def test_collocations(spark, mask):
    texts = prose(1, 80, 9) + ODD
    rows = [(random.Random(at).choice(["en", "de", None, ""]), text) for at, text in enumerate(texts)]
    rows += rows[:20] + [("one", "x x x x x x x x x x x"), ("few", "y y")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(docs.withColumn("print", F.lit(1)), mask=mask)
    same(got.collect(), brute.collocations(rows))
    assert collocations.collocations(docs, top=3, mask=mask).groupBy("lang").count().agg(F.max("count")).first()[0] == 3


def test_collocations_break_ties_by_bytes_and_count_overlaps(spark):
    rows = [("en", "b a. z é. Z z. ｚ 😀. " * 10), ("de", "x x x x\n" * 5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    same(collocations.collocations(docs).collect(), brute.collocations(rows))


def test_collocations_of_empty_tables_and_null_columns(spark):
    docs = spark.createDataFrame([(None, None)] * 3, "lang string, text string")
    assert collocations.collocations(docs).isEmpty()
    assert collocations.collocations(docs.limit(0)).isEmpty()


def test_windows_of_long_texts_lose_and_repeat_nothing(spark, monkeypatch):
    texts = [t for t in prose(3, 8, 12, (50, 300)) if t] + ["giant" * 50 + " b " + "c" * 300 + " d", "", "  ", "a b c d e"]
    for size in (1, 7, 40):
        for text in texts:
            raw = text.encode()
            whole = collocations.Grams([("x", 0, raw, 0)], [collocations.Polynomial(1)])
            parts = collocations.Grams(
                [("x", 0, part, fresh) for part, fresh in collocations.windows(raw, size)],
                [collocations.Polynomial(1)],
            )
            for n in (1, 2, 3):
                a, b = (sorted(g.prints(*g.at(n)).tolist()) for g in (whole, parts))
                assert a == b
            assert all(len(part) < size + 700 for part, _ in collocations.windows(raw, size))


# Filling in the middle

def test_middle(spark):
    texts = prose(2, 80, 50) + ODD + ["word " * 40_000, "x" * 100_001, " " * 65, "a" * 8, "a" * 7 + " ", " " * 8 + "b"]
    rows = [(at if at % 7 else None, text) for at, text in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, DOCS).withColumn("output", F.lit(1)).withColumn("n", F.lit("x"))
    got = middle.fill_in_middle(docs.repartition(3))
    same(got.collect(), [(doc, *brute.middle(doc, text)) for doc, text in rows])
    back = got.select("doc_id", middle.restored(F.col("output"), F.col("form")))
    same(back.collect(), [(doc, text or "") for doc, text in rows])
    assert middle.fill_in_middle(docs.limit(0)).isEmpty()


def test_units_of_random_bytes():
    rnd = random.Random(5)
    alphabet = [0, 8, 9, 10, 13, 14, 31, 32, 33, 65, 127, 128, 137, 141, 160, 255]
    texts = [bytes(rnd.choices(alphabet, k=rnd.randint(0, 40))) for _ in range(400)]
    units = middle.Units(texts)
    for at, text in enumerate(texts):
        ends, here = [0], 0
        for unit in brute.UNIT.findall(text.decode("latin-1")):
            here += len(unit)
            ends.append(here)
        assert units.n[at] == len(ends) - 1
        for unit, end in enumerate(ends):
            picked = np.where(np.arange(len(texts)) == at, unit, 0)
            assert units.end_of(picked)[at] == end


def test_rearranged_texts_of_any_chances(spark):
    rows = [(at, text) for at, text in enumerate(prose(4, 30, 20)) if text]
    docs = spark.createDataFrame(rows, DOCS)
    for chance, form in ((0, "psm"), (100, "spm")):
        got = middle.fill_in_middle(docs, percent=100, suffix_first=chance)
        assert {row.form for row in got.collect()} == {form}
        back = got.select("doc_id", middle.restored(F.col("output"), F.col("form")))
        same(back.collect(), rows)


# SimHash

def test_simhash(spark):
    rnd = random.Random(7)
    texts = [t for t in prose(6, 40, 60) for _ in range(2)] + ODD
    for text in [t for t in texts if t and len(t) > 300][:20]:
        words = text.split(" ")
        for _ in range(10):
            words[rnd.randrange(len(words))] = "Edit"
            texts.append(" ".join(words))
    rows = [(at if at % 9 else None, text) for at, text in enumerate(texts)]
    rows += rows[:30] + [(5, "another text of an id that repeats")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("print", F.lit(1))
    same(simhash.near_duplicates(docs.repartition(4)).collect(), brute.simhash_rows(rows))
    assert simhash.near_duplicates(docs.limit(0)).isEmpty()
    same(simhash.near_duplicates(docs.limit(0).union(spark.createDataFrame([(None, None, 1)], docs.schema))).collect(),
         [(None, "0" * 16, None)])


@pytest.mark.parametrize("block", [5, 64, 4096])
def test_links_of_crowds(spark, block):
    """A crowd around one fingerprint, chains, and halves that a third of all have in common."""
    rnd = np.random.default_rng(8)
    flips = lambda n: sum(1 << int(b) for b in rnd.choice(64, n, replace=False))
    center = int(rnd.integers(0, 1 << 63))
    values = [center ^ flips(int(n)) for n in rnd.integers(0, 7, 400)]
    values += [int(v) << 32 | 12345 for v in rnd.integers(0, 1 << 32, 400)]
    chain = center ^ (1 << 62) ^ 0xFFFF
    for _ in range(60):
        chain ^= flips(3)
        values.append(chain)
    values += [0, (1 << 64) - 1, 7, 15]
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in set(signed)], "print long")
    found = simhash.links(prints, block=block).collect()
    names = {v: v for v in signed}

    def root(v):
        while names[v] != v:
            v = names[v]
        return v

    for u, v in found:
        assert ((u ^ v) & ((1 << 64) - 1)).bit_count() <= 3
        names[root(u)] = root(v)
    want = brute.simhash_groups(values)
    got = {v: root(s) for v, s in zip(values, signed, strict=True)}
    assert len(set(want.values())) == len({(want[v], got[v]) for v in values}) == len(set(got.values()))


def test_homes_cover_every_half():
    prints = np.random.default_rng(9).integers(0, 1 << 64, 2000, np.uint64)
    index, anchor, home = simhash.anchors(prints)
    assert np.bincount(index[home]).tolist() == [2] * len(prints)
    half = (anchor >> np.uint64(31)).astype(np.int64)
    words = (prints[index] >> (32 * half).astype(np.uint64)) & np.uint64(0x7FFFFFFF)
    apart = np.bitwise_count(words ^ (anchor & np.uint64(0x7FFFFFFF)))
    assert apart[home].max() == 1 and apart[~home].tolist() == [2] * (~home).sum()
    assert (simhash._syndrome(anchor & np.uint64(0x7FFFFFFF)) == 0).all()


def test_fingerprints_of_long_texts_are_worked_out_in_parts(monkeypatch):
    texts = [t.encode() for t in prose(10, 10, 200, (3, 400))]
    want = [brute.simhash(t.decode()) for t in texts]
    for chunk in (1, 7, 1000):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert simhash.fingerprints_of(texts).tolist() == want


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    want = brute.simhash_rows([tuple(row) for row in docs.collect()])
    same(queries.queries()["op13_simhash"](spark, SF_DIR).collect(), want)


# Decontamination

def test_an_empty_benchmark_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (None, "")], DOCS)
    items = spark.createDataFrame([(1, "a b c"), (2, None), (3, " .")], "item_id long, text string")
    for none in (items.limit(0), items.where("item_id > 1")):
        got = phrases.decontaminate(docs, none)
        same(got.select("doc_id", "n_words", "n_hit", "contaminated").collect(), [(1, 3, 0, False), (2, 0, 0, False), (None, 0, 0, False)])
    assert phrases.decontaminate(docs.limit(0), items).isEmpty()


def test_a_long_item(spark):
    """An item of many words costs in proportion: no row has all of its windows."""
    words = [f"w{at % 5000}x{at // 5000}" for at in range(20_000)]
    rows = [(1, " ".join(words[3000:9000])), (2, " ".join(words[:9])), (3, " ".join(["q", *words[19_990:], "q"]))]
    items = [("long", " ".join(words)), ("short", "q q q")]
    got = phrases.decontaminate(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id string, text string"))
    same([tuple(row)[:6] for row in got.collect()], brute.contaminated(rows, items))
    assert dict(got.select("doc_id", "n_hit").collect()) == {1: 6000, 2: 0, 3: 10}


# Quality

@pytest.mark.parametrize("bad", [1, 2, 3])
def test_few_labels_still_teach(spark, bad, monkeypatch):
    """Also with a bound on n-grams that few rows fit in."""
    good = [f"a calm line of prose number {at} that goes on for a while" for at in range(12)]
    junk = [f"BUY!!! $$$ {at} $$$ CLICK >>> #### WIN {at} @@@@" for at in range(6)]
    texts = good + junk
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("score", F.lit("x"))
    held = {row.doc_id for row in docs.where(quality.held_out(F.col("doc_id"))).collect()}
    teach = [at for at in range(len(good), len(texts)) if at not in held][:bad]
    marks = [(at, 1) for at in range(len(good))] + [(at, 0) for at in teach] + [(teach[0], 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    for most in (quality.SAMPLE_FEATURES, 60):
        monkeypatch.setattr(quality, "SAMPLE_FEATURES", most)
        scores = {row.doc_id: row.score for row in quality.classify(docs, labels).collect()}
        assert min(scores[at] for at in range(len(good))) > max(scores[at] for at in range(len(good), len(texts)))
    repeated = quality.classify(docs.union(docs), labels.union(labels)).collect()
    assert len(repeated) == 2 * len(texts) and len({(r.doc_id, r.score) for r in repeated}) == len(texts)
    only = quality.classify(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert len(only) == 1


def test_a_text_scores_alike_around_the_size_of_a_window(spark):
    prose = "the quiet river runs past the old mill and on to the sea "
    rows = [(at, (prose * 2000)[: quality.WINDOW + size]) for at, size in enumerate((-1, 0, 1, 40_000))]
    rows += [(at, prose + str(at)) for at in range(10, 40)] + [(at, f"$$$ {at} !!! ### {at} >>>") for at in range(40, 70)]
    labels = spark.createDataFrame([(at, int(at < 40)) for at in range(10, 70)], "doc_id long, quality int")
    got = dict(quality.classify(spark.createDataFrame(rows, DOCS), labels).select("doc_id", "score").collect())
    assert max(got[at] for at in range(4)) - min(got[at] for at in range(4)) < 0.02 and got[0] > 0.9


def test_features_are_different_words_shapes_and_pairs():
    rnd = random.Random(3)
    texts = ["", " ", "\n\n", "a a", "x" * 300, "one\n\none\n", "ab\nabc\nab", "é \u3000ñ\tb\x0bb"]
    texts += ["".join(rnd.choices("aB1#é \n\t", k=rnd.randint(1, 900))) for _ in range(300)]
    for text in texts:
        features, shares = quality.ngrams(text)
        words, lines = text.encode().split(), [line for line in text.encode().split(b"\n") if line]
        assert (0 in features) == any(a == b for a, b in zip(words, words[1:]))
        assert (1 in features) == any(a == b for a, b in zip(lines, lines[1:]))
        shapes = [re.sub(r"(.)\1+", r"\1", word.translate(quality._SHAPE).decode()) for word in words]
        kinds = [words, list(zip(words, words[1:])), shapes, list(zip(shapes, shapes[1:]))]
        different = sum(len(set(kind)) for kind in kinds) + sum(at in features for at in (0, 1))
        assert different - 3 <= len(features) <= different  # two may share a number
        assert (shares == 1).all()


def test_quality_query_on_held_out_rows(spark):
    got = queries.queries()["op4_quality"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(row.doc_id for row in got) == sorted(row.doc_id for row in docs.select("doc_id").collect())
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in got)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in got)
    labels = dict(spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect())
    of = {side: [r.score for r in got if r.held_out and labels.get(r.doc_id) == side] for side in (0, 1)}
    wins = np.mean([(a > b) + (a == b) / 2 for a in of[1] for b in of[0]])
    assert wins > 0.98
