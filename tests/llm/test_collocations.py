"""Collocations against their SQL and a plain count, on edge cases and on texts that are cut into parts."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from faultline.llm import collocations
from tests.conftest import TESTDATA
from tests.llm.conftest import COLUMNS, EDGES, document

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]


def slow(rows, least, top):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            counts.update((lang, *words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    found = {g: f for g, f in counts.items() if len(g) > 2 and f >= least}
    inside = {(g[0], *g[i : i + m]) for g, f in found.items() for m in range(2, len(g) - 1) for i in range(1, len(g) - m + 1) if f == counts[(g[0], *g[i : i + m])]}
    out = {}
    for g, a in found.items():
        if g not in inside:
            lang = g[0]
            cuts = [(k, counts[g[: k + 1]], counts[(lang, *g[k + 1 :])]) for k in range(1, len(g) - 1)]
            score, k, left, right = min((1000 * a * n[lang] // (lo * hi), k, lo, hi) for k, lo, hi in cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(g[1:]).encode(), a, left, right, n[lang], score))
    return sorted((lang, i + 1, p.decode(), a, lo, hi, n, s) for lang, ps in out.items() for i, (_, _, p, a, lo, hi, n, s) in enumerate(sorted(ps)[:top]))


def by_sql(rows, least, top):
    connection = duckdb.connect()
    connection.register("documents", pa.table({"text": pa.array([r[0] for r in rows], pa.string()), "lang": pa.array([r[1] for r in rows], pa.string())}))
    out = connection.sql(collocations.oracle_sql(least, top))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(out.fetchall())


NAMES = ["New", "york", "ÉTÉ", "y", "the", "of", "a", "日本", "ß"]


def shuffled(seed, n):
    draw = random.Random(seed)
    fixed = ["new york city hall", "the end of the day and of the night", "a a a a a a a", "Été ß 日本"]
    return "".join((draw.choice(fixed) if draw.random() < 0.3 else draw.choice(NAMES)) + draw.choice(["  ", " ", "\t", ". ", ",", "\n", " "]) for _ in range(n))


TEXTS = EDGES + [document(40 + i, shuffled(i, 200), ("en", "fr", None, "und", "en", "en")[i % 6]) for i in range(18)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, COLUMNS).repartition(3).cache()


@pytest.mark.parametrize("least, top", [(20, 2000), (3, 40)])
def test_phrases_of_edges(spark, texts, least, top):
    rows = [(r[1], r[2]) for r in TEXTS]
    want = slow(rows, least, top)
    # The SQL takes very long for a piece of 30,000 words.
    short = [r for r in rows if len(r[0] or "") < 20_000]
    assert slow(short, least, top) == by_sql(short, least, top) and len(want) > 20
    assert sorted(map(tuple, collocations.collocations(texts, least, top).collect())) == want


def test_parts_of_long_texts(spark, monkeypatch):
    """A text in many parts, with bitmaps so small that most of their bits are set: the same phrases."""
    text = shuffled(99, 4000)
    want = slow([(text, "en")], 20, 2000)
    docs = spark.createDataFrame([document(1, text)], COLUMNS)
    monkeypatch.setattr(collocations, "PART", 1000)
    cuts = collocations._cuts(text.encode())
    assert b"".join(cuts) == text.encode() and len(cuts) > 15 and len(collocations._cuts(b"x" * 5000)) == 1
    parts = list(collocations._parts([pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], names=["text", "lang"])], 0, []))
    assert len(parts) > 15 and sum(len(p.sizes) for p in parts) == sum(map(len, pieces(text)))
    assert sorted(map(tuple, collocations.collocations(docs, 20).collect())) == want


@pytest.mark.parametrize("name, value", [("_BIT", np.uint64(15)), ("_KEY", np.uint64(63))])
def test_shared_bits_and_keys_change_nothing(spark, texts, monkeypatch, name, value):
    """Bitmaps with few bits, or keys that nearly all phrases share: every piece stays whole, and the phrases are the same."""
    want = slow([(r[1], r[2]) for r in TEXTS], 20, 2000)
    monkeypatch.setattr(collocations, name, value)
    part = next(collocations._parts([pa.RecordBatch.from_arrays([pa.array([shuffled(1, 50)]), pa.array(["en"])], names=["text", "lang"])], 0, []))
    full = [np.full(1 << 24, 255, np.uint8)] * 3
    found, at, keys = collocations._solid(part, full)
    assert found[0].all() and len(at) == len(keys) > 0
    monkeypatch.setattr(collocations, "_bitmap", lambda keys: zlib.compress(full[0].tobytes(), 1))
    assert sorted(map(tuple, collocations.collocations(texts, 20).collect())) == want


def test_words_that_share_a_hash(spark, texts, monkeypatch):
    """With one hash for all words of a seed, the next seed is taken."""
    want = slow([(r[1], r[2]) for r in TEXTS], 20, 2000)
    plain = collocations._parts

    def clumsy(batches, seed, names):
        for part in plain(batches, seed, names):
            yield part if seed else part._replace(hashes=part.hashes & np.uint64(3) | np.uint64(4))

    monkeypatch.setattr(collocations, "_parts", clumsy)
    assert collocations._graph(texts.select("text", "lang"), 20, 0) is None
    assert sorted(map(tuple, collocations.collocations(texts, 20).collect())) == want


def test_scores_beyond_64_bits(spark):
    """Counts near 2^40: products have 25 digits and more."""
    big = 1 << 40
    zeros = [0] * 4
    phrases = spark.createDataFrame([(1, *zeros, 1, big + 7), (2, *zeros, 1, big + 3), (1, 2, 0, 0, 0, 2, big - 1)], "w1 long, w2 long, w3 long, w4 long, w5 long, words int, n long")
    words = spark.createDataFrame([("en", "x", 1), ("en", "y", 2)], "lang string, word string, h long")
    n = 7 * big + 10
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    [row] = collocations.scored(phrases, phrases.where("words = 2"), words, totals).collect()
    assert (row["l"], row["r"], row["n"], row["score"]) == (big + 7, big + 3, n, 1000 * (big - 1) * n // ((big + 7) * (big + 3)))


def test_long_paths(spark):
    passage = " ".join(f"w{i}" for i in range(23))
    texts = [f"{passage}. x y z u v w" if i % 2 else f"q{i} {passage} r{i}" for i in range(40)]
    docs = spark.createDataFrame([document(i, t) for i, t in enumerate(texts)] + [document(None, None)], COLUMNS)
    got = sorted((r["lang"], r["phrase"], r["words"], r["n"]) for r in collocations.paths(docs, 10).collect())
    assert got == [("en", passage, 23, 40), ("en", "x y z u v w", 6, 20)]


def test_no_rows(nothing):
    assert collocations.collocations(nothing).collect() == [] and collocations.paths(nothing).collect() == []


def test_the_tables(spark, duck):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    want = sorted(duck("0.01").sql(collocations.oracle_sql()).fetchall())
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want and len(want) > 50
