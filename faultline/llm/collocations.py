"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words. All counts are per language.

Graph: an edge is a stretch of LONGEST words, its weight how often it occurs; it leads from the node of its first LONGEST - 1 words to that of its last ones.
Edges alone are counted over the texts, one for each word of a piece; the last words of a piece, which begin no whole edge, count as shorter ends.
Shorter phrases follow from the graph: a phrase occurs as often as its edges to longer ones flow out of it, plus the piece ends it stands at.
So counts of LONGEST - 1 words are sums of edges and ends, those of LONGEST - 2 sums of these, and so on.

Compaction: where all flow through a phrase passes one longer phrase, on the left or on the right, the phrase is an inner point of an unary path and is
absorbed by it. What remains are branching points, and those are the phrases reported. paths() follows unary paths to their ends and gives
the long phrases that always stand as a whole.

Solid graph: a phrase that occurs LEAST times is made of words, of pairs and of triples of words that do. Passes over the texts count words, pairs and
triples by hashes of KEY_BITS bits, each only where the shorter ones inside are frequent, and leave a bitmap of those that are frequent, of a fixed number of
bits whatever the input; the last pass cuts pieces where the bitmaps have no bit. A hash or bit that is shared keeps an edge
that will not be frequent, and changes no count. So the shuffles carry what may be frequent and little else, and at sizes where most
bits are set, all edges.

Words travel as 64-bit hashes that hold their language. The table of frequent words is checked for two words of one hash; if there are
such words, all is done with other hashes.

score of a cut after k words: floor(1000 * a * n / (l * r)), in decimals of 38 digits; l, r are the counts of the parts, a that of the phrase, n all words.
A phrase has the score of its worst cut.

Cases: a null text is empty; a null language is `und`. Rows of one id or none count as often as they are there. Empty tables give no rows. Other columns
are not read. Texts of any length are worked on in parts of PART bytes that end at pieces' ends.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved, slices, texts_of
from faultline.llm.words import _places, mixed, spans

LONGEST = 5
LEAST = 100
TOP = 2000
PART = 1 << 20
KEY_BITS = 40
#: Bits of each bitmap: 16 MB.
BITMAP_BITS = 27
SALTS = 16

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
ENDS = BREAK.copy()
ENDS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_W = [f"w{i}" for i in range(1, LONGEST + 1)]


class Part(NamedTuple):
    """The words of some pieces: letters and ends, hashes, the number of their piece and of their language."""

    letters: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray
    language: np.ndarray


def _cuts(text: bytes) -> list[bytes]:
    """A text in parts of about PART bytes that end where a piece ends."""
    if len(text) <= PART:
        return [text]
    ends = np.flatnonzero(BREAK[np.frombuffer(text, np.uint8)]) + 1
    chosen = np.unique(ends[np.minimum(np.searchsorted(ends, np.arange(PART, len(text), PART)), len(ends) - 1)]) if len(ends) else []
    edges = [0, *(int(e) for e in chosen if e < len(text)), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])]


def _parts(batches: Iterable[pa.RecordBatch], seed: int, names: list[str]) -> Iterator[Part]:
    """The words of all texts, part by part; languages are added to names as they come."""
    letter_hash = np.random.default_rng([7_919, seed]).integers(0, 1 << 64, size=256, dtype=np.uint64)
    numbers: dict[str, int] = {}
    salts: list[int] = []
    for batch in slices(batches):
        texts: list[bytes] = []
        owners: list[int] = []
        for text, name in zip(texts_of(batch), batch.column("lang").to_pylist()):
            name = "und" if name is None else name
            if name not in numbers:
                numbers[name] = len(numbers)
                names.append(name)
                salts.append(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))
            cuts = _cuts(text or b"")
            texts += cuts
            owners += [numbers[name]] * len(cuts)
        first = 0
        while first < len(texts):
            last, size = first + 1, len(texts[first])
            while last < len(texts) and size + len(texts[last]) <= PART:
                size += len(texts[last])
                last += 1
            data = _LOWER[np.frombuffer(b"\n".join(texts[first:last]) + b"\n", np.uint8)]
            starts, stops = spans(data, ENDS)
            if len(starts):
                sizes = stops - starts
                letters = data[~ENDS[data]]
                begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                place = np.arange(len(letters)) - np.repeat(begins, sizes)
                plain = np.add.reduceat(letter_hash[letters] * _places(int(sizes.max()))[place], begins) + sizes.astype(np.uint64)
                text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts[first:last]]), starts, side="right")
                language = np.array(owners[first:last])[text]
                hashes = mixed(mixed(plain) ^ np.array(salts, np.uint64)[language])
                yield Part(letters, sizes, np.where(hashes == 0, np.uint64(1), hashes), np.cumsum(BREAK[data])[starts], language)
            first = last


_KEY = np.uint64((1 << KEY_BITS) - 1)
_BIT = np.uint64((1 << BITMAP_BITS) - 1)


def _in_bitmap(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = key & _BIT
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _opened(bitmaps) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(b.value), np.uint8) for b in bitmaps]


def _solid(part: Part, bitmaps: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each bitmap, shortest phrases first, which words begin a phrase that may be frequent; then the words that begin one more
    word than that of which all phrases inside may be, and its keys."""
    h = part.hashes
    found: list[np.ndarray] = []
    known, key = np.ones(len(h), bool), h.copy()
    for size, bitmap in enumerate(bitmaps, 1):
        at = np.flatnonzero(known)
        known[at] = _in_bitmap(bitmap, key[at])
        found.append(known)
        longer = np.zeros(len(h), bool)
        longer[:-size] = known[:-size] & known[1 : len(h) - size + 1] & (part.piece[:-size] == part.piece[size:]) if len(h) > size else False
        at = np.flatnonzero(longer)
        key, known = key.copy(), longer
        key[at] = mixed(key[at] * np.uint64(3) + h[at + size])
    return found, np.flatnonzero(known), key[known] & _KEY


COUNTED = "lang string, word string, key long, n long"


def _counted(languages: pa.Array, words: pa.Array, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([languages, words, pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "word", "key", "n"])


def _phrase_rows(seed: int, bitmaps: Sequence, spelled: bool) -> Callable:
    """Keys of the phrases one word longer than the bitmaps know, and with no bitmap all words of each language as rows without a key.

    spelled: also the words whose bit is set, as texts.
    """

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _opened(bitmaps)
        names: list[str] = []
        for part in _parts(batches, seed, names):
            found, _, keys = _solid(part, known)
            keys, counts = np.unique(keys, return_counts=True)
            yield _counted(pa.nulls(len(keys), pa.string()), pa.nulls(len(keys), pa.string()), keys, counts)
            if not known:
                numbers, totals = np.unique(part.language, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in numbers]), pa.nulls(len(numbers), pa.string()), pa.nulls(len(numbers), pa.int64()), pa.array(totals)], names=["lang", "word", "key", "n"])
            if spelled:
                at = np.flatnonzero(found[0])
                ends = np.concatenate([[0], np.cumsum(part.sizes)]).astype(np.int64)
                words = pa.Array.from_buffers(pa.large_binary(), len(part.sizes), [None, pa.py_buffer(ends), pa.py_buffer(part.letters)]).take(pa.array(at))
                # By the words themselves, so that two words of one hash stay two rows.
                coded = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                _, first, counts = np.unique(coded * len(names) + part.language[at], return_index=True, return_counts=True)
                languages = pa.array(names, pa.string()).take(pa.array(part.language[at][first]))
                yield _counted(languages, words.take(pa.array(first)).cast(pa.large_string()).cast(pa.string()), part.hashes[at][first], counts)

    return each


def _edge_rows(seed: int, bitmaps: Sequence) -> Callable:
    """The stretch of up to LONGEST words at each word that begins a pair, as far as all triples in it may be frequent."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _opened(bitmaps)
        for part in _parts(batches, seed, []):
            h = part.hashes
            (_, pairs, triples), _, _ = _solid(part, known)
            at = np.flatnonzero(pairs)
            reach, columns = np.ones(len(at), bool), [h[at], h[at + 1]]
            for i in range(2, LONGEST):
                reach &= triples[np.minimum(at + i - 2, len(h) - 1)]
                columns.append(np.where(reach, h[np.minimum(at + i, len(h) - 1)], np.uint64(0)))
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=_W)

    return each


def _bitmap(keys: DataFrame) -> bytes:
    """The column `key` of a table as a bitmap, compressed; the driver gets that many bits, whatever the table."""
    number = F.expr(f"(key & {int(_BIT)}L) + 1")
    rows = keys.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")).collect()
    found = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        found[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    return zlib.compress(found.tobytes(), 1)


class Graph(NamedTuple):
    """words: lang, word, h of frequent words and some others. totals: lang, n. phrases: w1 ... (0 beyond the last word), words (how many), n; those
    of 1 to LONGEST words that occur `least` times."""

    words: DataFrame
    totals: DataFrame
    phrases: DataFrame


def graph(docs: DataFrame, least: int = LEAST) -> Graph:
    """Counts of all phrases of up to LONGEST words that occur at least `least` times in a language."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    for seed in range(8):
        if found := _graph(texts, least, seed):
            return found
    raise RuntimeError("words share hashes, whatever the seed")


def _graph(texts: DataFrame, least: int, seed: int) -> Graph | None:
    """The graph by the hashes of a seed, or nothing if two words share one."""
    context = texts.sparkSession.sparkContext
    bitmaps: list = []
    for size in (1, 2, 3):
        rows = texts.mapInArrow(_phrase_rows(seed, list(bitmaps), size == 2), COUNTED).groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))
        counted = saved(rows.where(F.col("lang").isNotNull() | (F.col("n") >= least)), f"keys-{size}")
        bitmaps.append(context.broadcast(_bitmap(counted.where("lang is null").select("key"))))
        if size == 1:
            totals = counted.where("lang is not null").select("lang", "n")
        if size == 2:
            words = counted.where("word is not null").select("lang", "word", F.col("key").alias("h"), "n")
            if not words.groupBy("h").count().where("count > 1").isEmpty():
                return None

    nothing = F.lit(0).cast("long")
    levels = [words.where(F.col("n") >= least).select(F.col("h").alias("w1"), *[nothing.alias(w) for w in _W[1:]], F.lit(1).alias("words"), "n")]
    rows = texts.mapInArrow(_edge_rows(seed, bitmaps), ", ".join(f"{w} long" for w in _W)).withColumn("n", F.lit(1).cast("long"))
    for size in range(LONGEST, 1, -1):
        # Flow out of each phrase: that of the edges to longer ones, and of the ends that stop here.
        rows = saved(rows.groupBy(*_W[:size]).agg(F.sum("n").alias("n")), f"flow-{size}")
        whole = rows.where((F.col(_W[size - 1]) != 0) & (F.col("n") >= least))
        levels.append(whole.select(*_W[:size], *[nothing.alias(w) for w in _W[size:]], F.lit(size).alias("words"), "n"))
    return Graph(words, totals, saved(reduce(DataFrame.unionByName, levels), "phrases"))


def _shorter(phrases: DataFrame) -> DataFrame:
    """The two phrases one word shorter within each phrase, with its count as `around`."""
    nothing = F.lit(0).cast("long")
    inner = [F.when(F.col("words") > i + 1, F.col(w)).otherwise(nothing).alias(w) for i, w in enumerate(_W)]
    first, last = F.struct(*inner), F.struct(*[F.col(w).alias(v) for v, w in zip(_W, _W[1:])], nothing.alias(_W[-1]))
    return phrases.where("words > 2").select(F.inline(F.array(first, last)), F.col("n").alias("around"))


def compact(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more that no longer one absorbs by having the same flow.

    If any longer phrase around one has its count, so has the one that is one word longer and lies between, so looking one word further is enough.
    """
    around = _shorter(phrases).groupBy(*_W).agg(F.max("around").alias("around"))
    kept = phrases.where("words > 1").join(around, _W, "left").where("around is null or around < n")
    return kept.drop("around")


def _cut_keys(left: bool) -> list[Column]:
    """The words of the part before or after cut k, zeros beyond."""
    if left:
        return [F.expr(f"if(k > {i}, {w}, 0L)").alias(f"p{i}") for i, w in enumerate(_W)]
    return [F.expr(f"coalesce(get(array({', '.join(_W)}), k + {i}), 0L)").alias(f"p{i}") for i in range(LONGEST)]


def scored(phrases: DataFrame, kept: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """kept with lang, n (all words), a, l, r, k and score of their worst cut, the smallest k of equals."""
    parts = phrases.join(words.select(F.col("h").alias("w1"), "lang"), "w1").select(
        *[F.col(w).alias(f"p{i}") for i, w in enumerate(_W)],
        F.col("n").alias("f"),
        "lang",
        # A single word may be a part of very many phrases, so it is looked up in several places.
        F.explode(F.expr(f"sequence(0, if(words = 1, {SALTS - 1}, 0))")).alias("salt"),
    )
    keys = [f"p{i}" for i in range(LONGEST)]
    salt = F.expr(f"if(p1 = 0, cast(pmod(xxhash64({', '.join(_W)}), {SALTS}) as int), 0)").alias("salt")
    cuts = kept.select(*_W, "words", "n", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    sides = []
    for left in (True, False):
        asked = cuts.select(*_W, "words", "n", "k", *_cut_keys(left)).select("*", salt)
        sides.append(asked.join(parts, [*keys, "salt"]).select(*_W, "words", "n", "lang", F.struct("k", F.lit(left).alias("left"), "f").alias("side")))
    found = reduce(DataFrame.unionByName, sides).groupBy(*_W, "words", F.col("n").alias("a"), "lang").agg(F.sort_array(F.collect_list("side")).alias("sides"))
    # Sides are in order of k, the right part of each cut before the left one.
    number = "cast({} as decimal(38, 0))"
    score = f"(1000 * {number.format('a')} * {number.format('n')}) div ({number.format('sides[2 * i + 1].f')} * {number.format('sides[2 * i].f')})"
    worst = f"array_min(transform(sequence(0, words - 2), i -> struct({score} as score, i + 1 as k, sides[2 * i + 1].f as l, sides[2 * i].f as r)))"
    return found.join(totals, "lang").select(*_W, "words", "lang", "a", "n", F.expr(worst).alias("worst")).select(*_W, "words", "lang", "a", "n", "worst.*")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language by score, count and text: lang, rank, phrase, a, l, r, n, score."""
    words, totals, phrases = graph(docs, least)
    found = scored(phrases, compact(phrases), words, totals)
    # Texts are fetched for phrases that can be among the first; equals of the last one still can.
    first = found.withColumn("place", F.expr("rank() over (partition by lang order by score desc, a desc)")).where(F.col("place") <= top).drop("place")
    spelled = first.select("*", F.posexplode(F.expr(f"slice(array({', '.join(_W)}), 1, words)")).alias("at", "h")).join(words.select("h", "word"), "h")
    columns = [*_W, "lang", "a", "l", "r", "n", "score"]
    named = spelled.groupBy(*columns).agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    ranked = named.withColumn("rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)")).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def paths(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Unary paths of the graph as long phrases that always stand as a whole: lang, phrase, words, n. Each has more than LONGEST words.

    Two edges are one path where all flow of the node between them is theirs. Paths cannot be circles, as then no piece that enters could end.
    Each edge looks for the first of its path by doubling its reach, so a path of a million words takes twenty rounds.
    """
    words, _, phrases = graph(docs, least)
    edges = phrases.where(F.col("words") == LONGEST)
    nodes = phrases.where(F.col("words") == LONGEST - 1).select(*[F.col(w).alias(f"p{i}") for i, w in enumerate(_W[:-1])], "n")
    before = edges.select(*[F.col(w).alias(f"p{i}") for i, w in enumerate(_W[1:])], "n", F.array(*_W).alias("previous"))
    after = edges.select(*[F.col(w).alias(f"p{i}") for i, w in enumerate(_W[:-1])], "n", F.array(*_W).alias("edge"))
    keys = [*[f"p{i}" for i in range(LONGEST - 1)], "n"]
    linked = nodes.join(before, keys).join(after, keys).select("edge", "previous")
    reach = edges.select(F.array(*_W).alias("edge"), "n").join(linked, "edge", "left")
    reach = saved(reach.select("edge", "n", F.coalesce("previous", "edge").alias("first"), F.expr("if(previous is null, 0, 1)").alias("at"), F.col("previous").isNull().alias("done")), "reach")
    while not reach.where("not done").isEmpty():
        further = reach.select(F.col("edge").alias("first"), F.col("first").alias("next"), F.col("at").alias("more"), F.col("done").alias("ends"))
        done, rest = reach.where("done"), reach.where("not done").join(further, "first")
        rest = rest.select("edge", "n", F.col("next").alias("first"), (F.col("at") + F.col("more")).alias("at"), F.col("ends").alias("done"))
        reach = saved(done.unionByName(rest), "reach")
    # An edge adds its last word; the first of a path adds all of its own.
    added = reach.select("first", "n", F.posexplode(F.expr(f"if(at = 0, edge, slice(edge, {LONGEST}, 1))")).alias("i", "h"), "at")
    placed = added.select("first", "n", "h", F.expr(f"if(at = 0, i, at + {LONGEST - 1})").alias("at")).join(words.select("h", "word", "lang"), "h")
    whole = placed.groupBy("first", "n").agg(F.max("lang").alias("lang"), F.count("*").alias("words"), F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    return whole.where(F.col("words") > LONGEST).select("lang", "phrase", "words", "n")


def oracle_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same in SQL for DuckDB, over the table documents."""
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), listed AS MATERIALIZED (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM listed GROUP BY lang
), grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g FROM listed, (SELECT unnest(range(1, {LONGEST + 1})) AS m) WHERE len(w) >= m
), counts AS MATERIALIZED (
    SELECT lang, m, g, count(*) AS f FROM grams GROUP BY lang, m, g HAVING count(*) >= {least}
), inner_parts AS (
    SELECT lang, f, m, g, unnest(range(2, m)) AS s FROM counts WHERE m > 2
), around AS (
    SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest(list_transform(range(1, m - s + 2), lambda i: g[i:i + s - 1])) AS part FROM inner_parts) GROUP BY lang, part
), kept AS (
    SELECT c.lang, c.m, c.g, c.f FROM counts c LEFT JOIN around a ON a.lang = c.lang AND a.part = c.g WHERE c.m > 1 AND coalesce(a.f, 0) < c.f
), cuts AS (
    SELECT lang, g, f AS a, unnest(range(1, m)) AS k FROM kept
), sides AS (
    SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:c.k] JOIN counts r ON r.lang = c.lang AND r.g = c.g[c.k + 1:] JOIN totals t ON t.lang = c.lang
), worst AS (
    SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM worst QUALIFY rank <= {top}
"""
