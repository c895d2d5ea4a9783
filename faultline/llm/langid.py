"""Language identification by prediction by partial matching.

For each language, contexts of up to ORDER bytes and the counts of what followed them form a tree. A byte costs
-log2 of its share under its longest known context; where it never followed, the context's escape (as many chances as different followers) is
paid and the next shorter context asked, down to 8 bits for an unseen byte. Counts are frozen after training, so the code length
of a text is a sum over its bytes, each a function of the byte and the ORDER before it. The language with the shortest code is predicted;
`score` is its share of 2 ^ -code length over all languages.

The trees are learned from at most DOCS documents of each language, those with the smallest hashes of id and text, repeated rows once, and from a
passage of BYTES bytes of longer texts; this bounds the model, which is broadcast. Each language with a text that may be learned from is learned. Languages are the distinct labels and few, as the model has a column for each.

Cases: a null text or one without a letter is `und` with score 0, as is every text if nothing could be learned. Equal codes go to the
first language by code point. Null ids are scored like others and never learned from. Very long texts are scored in pieces of whole bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import held_out, passage, slices, texts_of

ORDER = 4
DOCS = 250
BYTES = 1 << 16
FOLDS, FOLD_OUT = 4, 2
UNKNOWN = "und"
_PAD = b"\n" * ORDER


def windows(data: np.ndarray, order: int) -> np.ndarray:
    """At each place from ORDER on, its byte (lowest) and the `order` bytes before it, as one number."""
    key = data[ORDER:].astype(np.uint64)
    for back in range(1, order + 1):
        key |= data[ORDER - back : len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return key


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            by_lang.setdefault(lang, []).append(passage(text, BYTES).lower())
        for lang, texts in by_lang.items():
            data = np.frombuffer(_PAD + _PAD.join(texts), np.uint8)
            for order in range(ORDER + 1):
                keys, n = np.unique(windows(data, order), return_counts=True)
                columns = [pa.array([lang] * len(keys)), pa.array([order] * len(keys), pa.int32()), pa.array(keys.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "depth", "key", "n"])


class Index:
    """Places of known numbers in a sorted array, by a table of hashes with linear probing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, int(math.ceil(math.log2(4 * len(keys) + 1))))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        place = self._place(keys)
        while len(todo):
            free = self.slots[place] < 0
            self.slots[place[free]] = todo[free]
            rest = self.slots[place] != todo
            todo, place = todo[rest], (place[rest] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """For each number its place, or -1."""
        place = self._place(keys)
        found = self.slots[place]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys)) if len(self.keys) else np.empty(0, np.int64)
        while len(wrong):
            place[wrong] = (place[wrong] + 1) & ((1 << self.bits) - 1)
            found[wrong] = self.slots[place[wrong]]
            now = found[wrong]
            wrong = wrong[(now >= 0) & (self.keys[now] != keys[wrong])]
        return found


class Model:
    """Code lengths of windows and escapes for all languages, longest contexts first."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        """counts: for each order the sorted windows and how often each language has them (windows, languages)."""
        self.langs = langs
        self.orders: list[tuple[Index, np.ndarray, Index, np.ndarray]] = []
        lower_keys, lower = np.empty(0, np.uint64), np.empty((0, len(langs)))
        for order, (keys, n) in enumerate(counts):
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(contexts), len(langs)))
            kinds = np.zeros_like(total)
            np.add.at(total, of, n)
            np.add.at(kinds, of, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                own = np.log2((total[of] + kinds[of]) / n)
            if order:
                shorter = lower[np.searchsorted(lower_keys, keys & np.uint64((1 << 8 * order) - 1))]
            else:
                shorter = np.full(n.shape, 8.0)
                self.unseen = escape[0] + 8.0 if len(escape) else np.full(len(langs), 8.0)
            cost = np.where(n > 0, own, escape[of] + shorter)
            self.orders.insert(0, (Index(keys), cost.astype(np.float32), Index(contexts), escape.astype(np.float32)))
            lower_keys, lower = keys, cost

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Code lengths of each byte from ORDER on, for each language."""
        out = np.zeros((len(data) - ORDER, len(self.langs)), np.float32)
        rest = None
        key = windows(data, ORDER)
        for order, (seen, cost, contexts, escape) in zip(range(ORDER, -1, -1), self.orders):
            key = key & np.uint64((1 << 8 * (order + 1)) - 1)
            at = seen.find(key)
            hit = at >= 0
            if rest is None:
                out[hit] = cost[at[hit]]
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] += cost[at[hit]]
                rest = rest[~hit]
            key = key[~hit]
            if order:
                context = contexts.find(key >> np.uint64(8))
                known = context >= 0
                out[rest[known]] += escape[context[known]]
        out[rest] += self.unseen
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text for each language."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(_PAD + _PAD.join(texts) + _PAD, np.uint8)
        ends = np.cumsum(sizes + ORDER)
        starts = ends - ORDER - sizes
        total = np.zeros((len(texts), len(self.langs)))
        block = 1 << 18
        for low in range(0, len(data) - ORDER, block):
            bits = self.bits(data[low : low + block + ORDER])
            # Texts that this block has part of; places count from the first byte after the padding.
            first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, low + len(bits))
            if first >= last:
                continue
            edges = np.stack([starts[first:last], starts[first:last] + sizes[first:last]], axis=1)
            edges = np.clip(edges - low, 0, len(bits)).ravel()
            sums = np.concatenate([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)])[edges]
            total[first:last] += sums[1::2] - sums[0::2]
        return total


def _smallest(most: int):
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The smallest `most` hashes of each language in a task, each once."""
        least: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, hashes = batch.column("lang").dictionary_encode(), batch.column("h").to_numpy()
            of = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                least[lang] = np.unique(np.concatenate([least.get(lang, hashes[:0]), hashes[of == code]]))[:most]
        for lang, values in least.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values)], names=["lang", "h"])

    return smallest


def sample(docs: DataFrame, per_lang: int = DOCS) -> tuple[list[str], DataFrame]:
    """The languages that can be learned, and at most per_lang rows (lang, h, text) of each."""
    known = docs.where("lang is not null and text <> ''").where(~held_out(FOLDS, FOLD_OUT)).select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    least = known.select("lang", "h").mapInArrow(_smallest(per_lang), "lang string, h long").distinct()
    least = least.withColumn("nth", F.expr("row_number() over (partition by lang order by h)")).where(F.col("nth") <= per_lang)
    last = {r["lang"]: r["last"] for r in least.groupBy("lang").agg(F.max("h").alias("last")).collect()}
    bound = F.lit(None).cast("long")
    for lang, value in last.items():
        bound = F.when(F.col("lang") == lang, F.lit(value)).otherwise(bound)
    return sorted(last), known.where(F.col("h") <= bound).dropDuplicates(["lang", "h"])


def fit(docs: DataFrame, per_lang: int = DOCS) -> Model:
    """Learn from documents with text and a language that are not held out."""
    langs, picked = sample(docs, per_lang)
    if not langs:
        return Model([], [(np.empty(0, np.uint64), np.empty((0, 0)))] * (ORDER + 1))
    counts = picked.select("lang", "text").mapInArrow(_counts, "lang string, depth int, key long, n long")
    found = counts.groupBy("lang", "depth", "key").agg(F.sum("n").alias("n")).toArrow()
    depth, key, n = (found.column(c).to_numpy() for c in ("depth", "key", "n"))
    names = found.column("lang").combine_chunks().dictionary_encode()
    column = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
    by_order = []
    for order in range(ORDER + 1):
        own = depth == order
        keys, row = np.unique(key[own].view(np.uint64), return_inverse=True)
        table = np.zeros((len(keys), len(langs)))
        table[row, column[own]] = n[own]
        by_order.append((keys, table))
    return Model(langs, by_order)


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (text.upper() != text or text.lower() != text or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def predict(model: Model, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    known = [bool(model.langs) and has_letter(t) for t in texts]
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if any(known):
        bits = model.code_lengths([t.lower() for t, k in zip(texts, known) if k])
        best = bits.argmin(axis=1)
        share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        for i, j, s in zip(np.flatnonzero(known).tolist(), best.tolist(), share.tolist()):
            lang[i], score[i] = model.langs[j], s
    return lang, score


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs with lang_pred and score."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = predict(shared.value, texts_of(batch))
            columns = [*(batch.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    schema = docs.select(kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(kept).mapInArrow(scored, schema)


def known(docs: DataFrame, model: Model | None = None, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose language is predicted with a score of `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = predict(shared.value, texts_of(batch))
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
