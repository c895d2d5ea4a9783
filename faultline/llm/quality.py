"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

A text's terms are its lower-cased words, the shapes of its words (runs of capitals, small letters, digits, and its signs), words
that repeat the one before, lines that repeat an earlier line, and the magnitude of its length, all hashed to DIMENSIONS places. Damped counts times
inverse document frequency, scaled to length one, are projected on the RANK leading singular vectors of a bounded labelled sample
(randomised power iteration). The sample's vectors are broadcast; every document is multiplied with all of them, block by block,
and its NEIGHBOURS largest cosines vote, each with its positive cosine to the power SHARPNESS times the weight that restores the classes' shares.

The sample holds at most SAMPLE learnable documents of either class, which bounds everything that is broadcast.

Cases: an empty or null text has no terms and scores 0. If either class cannot be learned, every other text scores the share of
label 1 among the learnable rows (0.5 without any). Cosines are compared to DECIMALS decimals; ties at the last neighbour go to the first places in
the sample, which is ordered by hash of id and by terms. Equal texts score equally, whatever they are batched with: blocks have one shape.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faultline.llm.common import Cache, class_counts, held_out, labelled_sample, slices, texts_of

FOLDS, FOLD_OUT = 4, 2
SAMPLE = 1500  # of either class
WORD_PLACES, SHAPE_PLACES = 1 << 13, 1 << 12
DIMENSIONS = WORD_PLACES + SHAPE_PLACES + 64
REPEATED_WORD, REPEATED_LINE, LENGTH_FROM = DIMENSIONS - 64, DIMENSIONS - 63, DIMENSIONS - 40
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 4
KEEP_FROM = 0.7
BLOCK = 512
DECIMALS = 12

_SHAPE = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x30, 0x3A)) + bytes(range(0x80, 0x100)),
    b"A" * 26 + b"a" * 26 + b"0" * 10 + b"a" * 128,
)
_RUN = re.compile(rb"(.)\1+", re.S)


def _places(word: bytes) -> int:
    """The word's place and, above 32 bits, its shape's."""
    shape = _RUN.sub(rb"\1", word.translate(_SHAPE))
    return zlib.crc32(word.lower()) % WORD_PLACES | (WORD_PLACES + zlib.crc32(shape) % SHAPE_PLACES) << 32


_cache = Cache(_places)


def terms(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text's terms, and their counts."""
    words = (text or b"").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    both = np.fromiter(map(_cache.__getitem__, words), np.int64, len(words))
    word, shape = both & 0xFFFFFFFF, both >> 32
    lines = text.split(b"\n")
    more = [REPEATED_WORD] * int((both[1:] == both[:-1]).sum()) + [REPEATED_LINE] * (len(lines) - len(set(lines)))
    more.append(LENGTH_FROM + min(30, len(words).bit_length()))
    return np.unique(np.concatenate([word, shape, np.array(more, np.int64)]), return_counts=True)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [terms(t) for t in texts_of(batch)]
        places = pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32()))
        counts = pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), places, counts], names=["doc_id", "label", "places", "counts"])


class Model:
    def __init__(self, share: float, idf=None, axes=None, vectors=None, votes=None, weights=None):
        self.share, self.idf, self.axes, self.vectors, self.votes, self.weights = share, idf, axes, vectors, votes, weights

    def project(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(found), self.axes.shape[1]))
        for i, (places, counts) in enumerate(found):
            if len(places):
                out[i] = (np.log1p(counts) * self.idf[places]) @ self.axes[places]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        found = [terms(t) for t in texts]
        empty = np.array([not len(p) for p, _ in found], bool)
        if self.vectors is None:
            return np.where(empty, 0.0, self.share)
        out = np.zeros(len(texts))
        points = self.project(found)
        near = min(NEIGHBOURS, len(self.vectors))
        block = np.zeros((BLOCK, points.shape[1]))
        for start in range(0, len(texts), BLOCK):
            part = points[start : start + BLOCK]
            block[: len(part)] = part
            cosine = np.round((block @ self.vectors.T)[: len(part)], DECIMALS)
            last = np.partition(cosine, -near, axis=1)[:, -near, None]
            above, tied = cosine > last, cosine == last
            chosen = above | (tied & (np.cumsum(tied, axis=1) <= near - above.sum(axis=1, keepdims=True)))
            top = np.nonzero(chosen)[1].reshape(len(part), near)
            weight = np.maximum(np.take_along_axis(cosine, top, axis=1), 1e-6) ** SHARPNESS * self.weights[top]
            out[start : start + BLOCK] = (weight * self.votes[top]).sum(axis=1) / weight.sum(axis=1)
        return np.where(empty, 0.0, np.clip(out, 0.0, 1.0))


def _leading_axes(rows: list[np.ndarray], values: list[np.ndarray], rank: int) -> np.ndarray:
    """The leading right singular vectors of a sparse matrix of DIMENSIONS columns, by power iteration on random vectors.

    Products are made axis by axis, which holds no more than the matrix's own values at once.
    """
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column, value = np.concatenate(rows), np.concatenate(values)
    basis = np.random.default_rng(11).standard_normal((DIMENSIONS, rank))
    for _ in range(3):
        image = np.stack([np.bincount(row, value * axis[column], len(rows)) for axis in basis.T])
        basis, _ = np.linalg.qr(np.stack([np.bincount(column, value * axis[row], DIMENSIONS) for axis in image]).T)
    return basis


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    zero, one = class_counts(labels, "quality", FOLDS, FOLD_OUT)
    share = one / (zero + one) if zero + one else 0.5
    picked = labelled_sample(docs, labels, "quality", FOLDS, FOLD_OUT, sample)
    table = picked.mapInArrow(_sampled, "doc_id long, label int, places array<int>, counts array<int>").toArrow().combine_chunks()
    places, counts = ([np.asarray(v.values) for v in table[c]] for c in ("places", "counts"))
    label = table["label"].to_pylist()
    order = sorted((i for i in range(len(label)) if len(places[i])), key=lambda i: (zlib.crc32(str(table["doc_id"][i]).encode()), places[i].tobytes()))
    votes = np.array([label[i] for i in order], np.float64)
    if not 0 < votes.sum() < len(votes):
        return Model(share)
    places = [places[i].astype(np.int64) for i in order]
    counts = [np.log1p(counts[i]) for i in order]
    frequency = np.bincount(np.concatenate(places), minlength=DIMENSIONS)
    idf = np.log((1 + len(places)) / (1 + frequency)) + 1
    values = [c * idf[p] for p, c in zip(places, counts)]
    axes = _leading_axes(places, [v / np.linalg.norm(v) for v in values], RANK)
    weights = np.where(votes == 1, share / votes.mean(), (1 - share) / (1 - votes.mean()))
    model = Model(share, idf, axes, None, votes, weights)
    model.vectors = model.project(list(zip(places, [np.expm1(c) for c in counts])))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with score and predicted (1 if score >= KEEP_FROM)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = shared.value.scores(texts_of(batch))
            columns = [*(batch.column(c) for c in kept), pa.array(values, pa.float64()), pa.array((values >= KEEP_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score", "predicted"])

    return docs.select(kept).mapInArrow(scored, docs.select(kept).schema.add("score", "double").add("predicted", "integer"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", held_out(FOLDS, FOLD_OUT).alias("held_out"), "score", "predicted")


def good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, that score KEEP_FROM or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(shared.value.scores(texts_of(batch)) >= KEEP_FROM))

    return docs.mapInArrow(kept, docs.schema)
