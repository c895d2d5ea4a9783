"""Toxicity scores by a linear classifier that is penalised for scoring identity terms.

A text's features are its distinct words (lower-cased, without signs at either end) and their beginnings of PREFIXES letters, hashed to PLACES.
Logistic loss, an absolute penalty that leaves few weights other than zero, and a counterfactual penalty are minimised together
by accelerated proximal gradient descent: each labelled text that names a group (TERMS, or terms given) is copied with every such term swapped
for the next of its list, and FAIRNESS times the squared difference of the two scores is added. A text that names none is copied twice, with
one term, chosen by the text's hash, put into the first copy and the next of its list into the second: beginnings that terms share with other words are
so penalised as well. Copies that differ in no known feature are left out. A weight that only tells groups apart so
costs more than it gains, and neutral mentions are not scored for it.

The sample has at most SAMPLE learnable documents of either class, and of longer texts a passage of BYTES bytes; features in fewer than LEAST_TEXTS of
them are left out. Only weights other than zero are broadcast, so the model is bounded by the sample.

Both classes weigh the same, so a score above one half says that a text is likelier among toxic texts than among others.

Cases: an empty or null text has no feature and scores as the intercept does. If either class cannot be learned, every text scores the share of label 1 among the learnable rows, 0 without any. A word that occurs
often counts once. Repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import Cache, class_counts, held_out, labelled_sample, passage, slices, texts_of

FOLDS, FOLD_OUT = 5, 0
SAMPLE = 2500  # of either class
BYTES = 1 << 16
PLACES = 1 << 20
PREFIXES = (4, 5)
LEAST_TEXTS = 3
SPARSITY = 4e-4
FAIRNESS = 1.0
STEPS = 200
TOXIC_FROM = 0.5

#: Interchangeable names of groups; each is swapped for the next of its line.
TERMS = tuple(
    tuple(line.split())
    for line in """
women men nonbinary
woman man
female male
muslim christian jewish hindu buddhist atheist
muslims christians jews hindus buddhists atheists
black white asian latino indigenous
african european american arab
gay straight lesbian bisexual
immigrants refugees natives
immigrant refugee native
disabled deaf blind autistic
elderly young
frauen männer
muslime christen juden
ausländer flüchtlinge einheimische
femmes hommes
musulmans chrétiens juifs
immigrés réfugiés
mujeres hombres
musulmanes cristianos judíos
inmigrantes refugiados
""".strip().splitlines()
)
_SIGNS = ".,;:!?\"'()[]{}<>*#$%&-_/|~`´„“”»«¡¿…"


def _swaps(terms: Sequence[Sequence[str]]) -> dict[str, str]:
    return {a: b for line in terms for a, b in zip(line, [*line[1:], line[0]])}


def features(word: str) -> tuple[int, ...]:
    """The places of a bare word and its beginnings."""
    parts = [word, *(f"{word[:n]}\x00{n}" for n in PREFIXES if len(word) >= n)]
    return tuple(zlib.crc32(p.encode()) % PLACES for p in parts)


def bare(chunk: bytes) -> str:
    return chunk.decode("utf-8", "replace").lower().strip(_SIGNS)


_cache = Cache(lambda chunk: features(w) if (w := bare(chunk)) else ())


def places(text: bytes | None) -> set[int]:
    return set().union(*map(_cache.__getitem__, set((text or b"").split())))


def _sampler(swaps: dict[str, str]):
    names = sorted(swaps)

    def together(words: set[str]) -> np.ndarray:
        return np.array(sorted(set().union(*(features(w) for w in words if w))), np.int32)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, named, swapped = [], [], []
            for text in texts_of(batch):
                text = passage(text, BYTES)
                words = {bare(c) for c in set(text.split())}
                own.append(np.array(sorted(places(text)), np.int32))
                if names and words.isdisjoint(swaps):
                    words.add(names[zlib.crc32(text) % len(names)])
                first, second = together(words), together({swaps.get(w, w) for w in words})
                # What both copies have adds nothing to the difference of their scores.
                named.append(np.setdiff1d(first, second, assume_unique=True))
                swapped.append(np.setdiff1d(second, first, assume_unique=True))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (own, named, swapped)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *lists], names=["doc_id", "label", "own", "named", "swapped"])

    return sampled


class Matrix:
    """Rows of distinct columns, each value 1."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.shape = len(rows), width

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, x[self.column], self.shape[0])

    def back(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, y[self.row], self.shape[1])


def train(x: Matrix, label: np.ndarray, weight: np.ndarray, pairs: tuple[Matrix, Matrix], fairness: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise weighted logistic loss, the absolute penalty and the counterfactual one."""
    own, other = pairs
    n, m = weight.sum(), max(1, own.shape[0])
    # The largest curvature, by power iteration on the quadratic bound of the loss.
    v = np.random.default_rng(5).standard_normal(x.shape[1])
    curvature = 1.0
    for _ in range(12):
        v /= np.linalg.norm(v) or 1.0
        difference = own.times(v) - other.times(v)
        v = x.back(weight * x.times(v)) / (4 * n) + 2 * fairness * (own.back(difference) - other.back(difference)) / m
        curvature = np.linalg.norm(v)
    step = 1.0 / (1.1 * curvature + 0.25 + 1e-9)
    w, b = np.zeros(x.shape[1]), float(np.log(max(1e-6, (weight * label).sum()) / max(1e-6, (weight * (1 - label)).sum())))
    seen, seen_b, pace = w, b, 1.0
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-np.clip(x.times(seen) + seen_b, -40, 40))) - label) / n
        difference = own.times(seen) - other.times(seen)
        slope = x.back(error) + 2 * fairness * (own.back(difference) - other.back(difference)) / m
        new = seen - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * SPARSITY, 0)
        new_b = seen_b - step * error.sum()
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        seen, seen_b = new + (pace - 1) / faster * (new - w), new_b + (pace - 1) / faster * (new_b - b)
        w, b, pace = new, new_b, faster
    return w, b


class Model:
    def __init__(self, weights: dict[int, float], intercept: float | None, share: float):
        self.weights, self.intercept, self.share = weights, intercept, share
        self._kept = Cache(self._places)

    def __getstate__(self):
        return self.weights, self.intercept, self.share

    def __setstate__(self, state):
        self.__init__(*state)

    def _places(self, chunk: bytes) -> tuple[int, ...]:
        word = bare(chunk)
        return tuple(p for p in features(word) if p in self.weights) if word else ()

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.intercept is None:
            return np.full(len(texts), self.share)
        get, weight = self._kept.__getitem__, self.weights.__getitem__
        total = [sum(map(weight, sorted(set().union(*map(get, set((t or b"").split())))))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(total, np.float64) + self.intercept, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fairness: float = FAIRNESS, terms: Sequence[Sequence[str]] = TERMS) -> Model:
    zero, one = class_counts(labels, "toxic", FOLDS, FOLD_OUT)
    share = one / (zero + one) if zero + one else 0.0
    picked = labelled_sample(docs, labels, "toxic", FOLDS, FOLD_OUT, sample)
    table = picked.mapInArrow(_sampler(_swaps(terms)), "doc_id long, label int, own array<int>, named array<int>, swapped array<int>").toArrow().combine_chunks()
    label = table["label"].to_numpy().astype(np.float64)
    if not 0 < label.sum() < len(label):
        return Model({}, None, share)
    own, named, swapped = ([np.asarray(v.values) for v in table[c]] for c in ("own", "named", "swapped"))
    order = sorted(range(len(label)), key=lambda i: (table["doc_id"][i].as_py(), label[i], own[i].tobytes()))
    texts = np.bincount(np.concatenate(own), minlength=PLACES)
    known = np.flatnonzero(texts >= LEAST_TEXTS)
    column = np.full(PLACES, -1)
    column[known] = np.arange(len(known))

    def matrix(rows: list[np.ndarray]) -> Matrix:
        return Matrix([c[c >= 0] for c in (column[r] for r in rows)], len(known))

    label = label[order]
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    both = [i for i in order if (column[named[i]] >= 0).any() or (column[swapped[i]] >= 0).any()]
    pairs = matrix([named[i] for i in both]), matrix([swapped[i] for i in both])
    w, b = train(matrix([own[i] for i in order]), label, weight, pairs, fairness)
    return Model({int(known[i]): float(w[i]) for i in np.flatnonzero(w)}, float(b), share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with score and predicted (1 if score >= TOXIC_FROM)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = shared.value.scores(texts_of(batch))
            columns = [*(batch.column(c) for c in kept), pa.array(values, pa.float64()), pa.array((values >= TOXIC_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score", "predicted"])

    return docs.select(kept).mapInArrow(scored, docs.select(kept).schema.add("score", "double").add("predicted", "integer"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", held_out(FOLDS, FOLD_OUT).alias("held_out"), "score", "predicted")
