"""Periodic runs against a search over all starts and periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from faultline.llm import periods
from tests.conftest import TESTDATA
from tests.llm.conftest import COLUMNS, EDGES, document

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def slow_runs(words, least=periods.LEAST, times=periods.TIMES):
    """Every maximal stretch with a period, kept if that is its smallest one."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                stretch = words[i : j + q]
                if not any(all(stretch[x] == stretch[x + d] for x in range(len(stretch) - d)) for d in range(1, q)):
                    found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def slow_digest(doc_id, text):
    words = planted(doc_id, WORD.findall((text or "").encode()))
    runs = slow_runs(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *shown, hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest())


def test_random_sequences():
    draw = random.Random(5)
    for least, times in ((1, 3), (6, 3), (4, 4), (24, 3)):
        for _ in range(150):
            texts = []
            for _ in range(draw.randint(1, 4)):
                words = draw.choices("ab" if draw.random() < 0.5 else "abcd", k=draw.randint(0, 40))
                for _ in range(draw.randint(0, 2)):
                    stretch = draw.choices("abc", k=draw.randint(1, 9))
                    words += stretch * draw.randint(2, 7) + stretch[: draw.randint(0, len(stretch))]
                texts.append(words)
            before = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            numbers = np.array([ord(w) for t in texts for w in t], np.int64)
            got = periods._of_each(periods.find_runs(numbers, before, least, times), before)
            assert got == [slow_runs(t, least, times) for t in texts]


REPEATING = EDGES + [
    document(30, "a " * 23),
    document(31, "a " * 24),
    document(32, "x " + "a b " * 12 + "a c"),
    document(33, ("a " * 30 + "b ") * 4),  # runs within a run
    document(34, " ".join(f"w{i % 100}" for i in range(299))),  # one word too short
    document(34, " ".join(f"w{i % 100}" for i in range(300))),
    document(35, "sand\tsand\nsand " * 9 + "é ñ " * 40),
]


def test_edges(spark):
    got = periods.digest(spark.createDataFrame(REPEATING, COLUMNS).repartition(3)).collect()
    want = [slow_digest(r[0], r[1]) for r in REPEATING if r[0] != 10]
    assert sorted((tuple(r) for r in got if r["doc_id"] != 10), key=str) == sorted(want, key=str)


def test_a_long_text_that_repeats():
    """The planted rule on a text of 30,000 words, whose run is known."""
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0 and zlib.crc32(str(i).encode()) // 10 % 8 == 4)
    n, g = 30_000, zlib.crc32(str(doc_id).encode()) // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    numbers = periods.repetition(doc_id, n)
    runs = periods.find_runs(numbers, np.array([0, n]))
    assert runs.tolist() == [[a, n - a, p]]
    assert np.flatnonzero(periods.repeated(runs, n)).tolist() == list(range(a + p, n))


def test_runs_and_collapsed_texts(spark):
    docs = spark.createDataFrame(REPEATING, COLUMNS)
    got = sorted(tuple(r) for r in periods.runs_of(docs).collect())
    want = sorted((r[0], *run) for r in REPEATING if r[0] in range(30, 40) for run in slow_runs(r[1].split()))
    assert got == want and len(got) > 7
    texts = {r["doc_id"]: r["text"] for r in periods.collapse(docs).collect()}
    assert texts[31] == "a" and texts[32] == "x a b c" and texts[4] is None and texts[5] == "" and texts[35] == "sand é ñ"


def test_fewer_repeats_are_refused():
    with pytest.raises(ValueError):
        periods.find_runs(np.arange(3), np.array([0, 3]), times=2)


def test_no_rows(nothing):
    assert periods.digest(nothing).collect() == [] and periods.runs_of(nothing).collect() == [] and periods.collapse(nothing).collect() == []


def test_the_tables(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    got = sorted(map(tuple, periods.digest(docs).collect()))
    short = {r["doc_id"]: r["text"] for r in docs.collect() if len((r["text"] or "").split()) <= 400}
    assert [r for r in got if r[0] in short] == sorted(slow_digest(i, t) for i, t in short.items())
    assert len(got) == docs.count() and sum(r[1] for r in got) > 5
