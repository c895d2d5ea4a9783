"""Runs of words that repeat with a period, by a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least max(LEAST, TIMES * q) words that cannot be made longer on either side.
TIMES is 3 or more.

Basic factors are the stretches of 1, 2, 4, 8, ... words. Each level names its factors from the names of two halves, so that equal
factors have equal names, and keeps only those that occur more than once. The successor of a factor is its next occurrence. Within a run of period q,
a factor of L >= q words has its successor exactly q words later, since a primitive word differs from all its rotations; so starts whose
successors are all d words away form progressions of difference d. Neighbouring starts with one such distance are one proposal: it begins where the run
begins, as one more word on the left would break the period, and with d words and a factor added to its last start it ends where the run ends.
Each period belongs to the level with L / 2 < q <= L, where q + L words fit into a run, so a run is proposed exactly once and its
proposal needs no further extension; distances from L to twice L propose again what the next level finds, and are left to it.

A batch of texts is one array of word numbers with a number of its own between texts, so no factor spans two texts and all steps are array
operations on whole batches. Words are compared as bytes, through a dictionary of the batch. A text is one row of a task, whatever its length.

Cases: a null text has no words and no runs. Equal texts get equal runs. Null ids are ids like any other (repetition() leaves their text as it is).
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from faultline.llm.common import slices, texts_of
from faultline.llm.words import spans as word_spans

LEAST = 24
TIMES = 3

Run = tuple[int, int, int]  # start, length, period


def numbered(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, the number of each word among them, and for each text the count of words before it (one more at the end)."""
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\x20".join(t or b"" for t in texts) + b"\x20", np.uint8)
    starts, stops = word_spans(data)
    before = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[stops] -= 1
    letters = data[np.cumsum(inside[:-1]).astype(bool)]
    ends = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), before


def _renamed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names 0, 1, ... of equal keys, and for each name how often it occurs."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts


def find_runs(numbers: np.ndarray, before: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """The runs of all sequences, as rows (place of the first word in numbers, length, period), by place and period.

    numbers: the words of all sequences as numbers; before: the count of words before each sequence, and one more at the end.
    """
    if times < 3:
        raise ValueError("a run has its period three times at least")
    found = [np.empty((0, 3), np.int64)]
    if len(numbers) == 0:
        return found[0]
    longest = int(np.diff(before).max())
    # The number of a gap is like no other, so no factor that spans two sequences occurs twice.
    gaps = before[1:-1]
    sequence = np.insert(numbers, gaps, -1 - np.arange(len(gaps)))
    own = np.arange(len(numbers)) + np.searchsorted(gaps, np.arange(len(numbers)), side="right")
    place = np.full(len(sequence), -1, np.int64)
    place[own] = np.arange(len(numbers))

    active, length = np.arange(len(sequence)), 1
    names, counts = _renamed(sequence)
    # A run of period q > length / 2 has at least times * q words.
    while len(active) and times * (length // 2 + 1) <= longest:
        often = counts[names] > 1
        active, names = active[often], names[often]
        order = np.argsort(names, kind="stable")
        same = names[order][1:] == names[order][:-1]
        distance = np.zeros(len(active), np.int64)
        distance[order[:-1][same]] = np.diff(active[order])[same]
        starts = np.flatnonzero((distance > length // 2) & (distance <= length))
        if len(starts):
            at, period = active[starts], distance[starts]
            opens = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(period) != 0)])
            first, last = np.flatnonzero(opens), np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(at) - 1]])
            size = at[last] - at[first] + period[first] + length
            long = size >= np.maximum(least, times * period[first])
            found.append(np.column_stack([place[at[first]], size, period[first]])[long])
        # Two halves next to each other; a half that occurs once cannot be part of a factor that occurs twice.
        dense = np.full(len(sequence) + length, -1, np.int64)
        dense[active] = names
        other = dense[active + length]
        kept = other >= 0
        active, keys = active[kept], names[kept] * len(sequence) + other[kept]
        names, counts = _renamed(keys)
        length *= 2
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeated(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words stand in a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def most_repeated(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period, the first and then the shortest period of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repetition(doc_id: int | None, n: int) -> np.ndarray:
    """The test rule of the tables: some texts, by their id, repeat a stretch from some word on. The original word at each of n places."""
    places = np.arange(n)
    if doc_id is None or n == 0:
        return places
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return places
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(places >= a, a + (places - a) % p, places)


def _sequences(batch: pa.RecordBatch, planted: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    words, numbers, before = numbered(texts_of(batch))
    if planted:
        parts = [numbers[lo:hi][repetition(doc_id, hi - lo)] for doc_id, lo, hi in zip(batch.column("doc_id").to_pylist(), before[:-1].tolist(), before[1:].tolist())]
        numbers = np.concatenate(parts) if parts else numbers
    return words, numbers, before


def _of_each(runs: np.ndarray, before: np.ndarray) -> list[list[Run]]:
    """The runs of each sequence, with places counted within it."""
    cuts = np.searchsorted(runs[:, 0], before)
    relative = [(runs[lo:hi] - [start, 0, 0]).tolist() if hi > lo else [] for lo, hi, start in zip(cuts[:-1], cuts[1:], before[:-1])]
    return [[tuple(run) for run in found] for found in relative]


def runs_of(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per run of a text: doc_id, start, length, period, in words."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, numbers, before = _sequences(batch, False)
            found = _of_each(find_runs(numbers, before, least, times), before)
            rows = [(doc_id, *run) for doc_id, runs in zip(batch.column("doc_id").to_pylist(), found) for run in runs]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "period"])

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id long, start long, length long, period long")


def collapsed_texts(words: pa.Array, numbers: np.ndarray, before: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text without the words that repeat, its words joined by a space."""
    kept = ~repeated(runs, len(numbers))
    offsets = np.concatenate([[0], np.cumsum(kept)])[before]
    listed = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words.take(pa.array(numbers[kept])))
    return pc.binary_join(listed, pa.scalar(b" ", words.type))


def collapse(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id and the text with one period left of each run; words are joined by a space, null stays null."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, numbers, before = _sequences(batch, False)
            texts = collapsed_texts(words, numbers, before, find_runs(numbers, before, least, times))
            texts = pc.if_else(batch.column("text").is_valid(), texts.cast(pa.large_string()), None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts.cast(pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id long, text string")


DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the most repeated one, and digests of all runs and of the collapsed text.

    Texts are those of the tables with repetition() put in.
    """

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, numbers, before = _sequences(batch, True)
            runs = find_runs(numbers, before)
            texts = collapsed_texts(words, numbers, before, runs)
            rows = []
            for doc_id, found, text in zip(batch.column("doc_id").to_pylist(), _of_each(runs, before), texts):
                best = most_repeated(found)
                shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
                rows.append((doc_id, len(found), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.as_buffer() or b"").hexdigest()))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            columns = list(zip(*rows)) or [[] for _ in types]
            names = [part.split()[0] for part in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(each, DIGEST)
