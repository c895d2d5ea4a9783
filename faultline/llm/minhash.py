"""Near-duplicate documents by MinHash with tensored banding.

Two collections of a few groups of hashes each are computed. A table of the index is a pair of groups, one of either
collection, and its key is made of both groups' hashes: with G groups of K hashes a side there are G * G tables for
2 * G * K hashes. A pair of documents is missed only if it agrees in no group of one side; for similarity s
that is at most 2 * (1 - s^K)^G, 5 in 10,000 at s = 0.75 and 2 in 100,000 at s = 0.85, for K = 2 and G = 10.

Candidates of the tables are verified on the full sets of shingles; nothing is linked by sketches alone.

Cases: null or empty text, or one without words, has an empty set and is linked with nothing. Documents of fewer words than a
shingle have their whole sequence as one shingle. A null doc_id takes no part: component_id is null and kept
is true. Rows that repeat a doc_id are rows of one node: with equal texts they get equal results; with different texts each keeps
the set of its own text, and where such an id stands for several texts, their groups are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved, slices, texts_of
from faultline.llm.components import components
from faultline.llm.words import mixed, word_hashes

WORDS = 5
GROUPS = 10  # of either side
HASHES = 2  # in a group
LEAST_PERCENT = 75
SEED = 20_240_917
#: Bits of the sketches that are compared before members of an open bucket are verified, and how many must agree. A bit of a
#: pair agrees with probability (1 + s) / 2: at s = 0.75 in 1792 of 2048 on average with a deviation of 15, and LEAST_AGREE is 4.5 of them below.
BITS = 2048
LEAST_AGREE = 1725

_random = np.random.default_rng(SEED)
_SPREAD = _random.integers(1, 1 << 63, size=WORDS, dtype=np.uint64) | np.uint64(1)
_FACTORS = _random.integers(1, 1 << 63, size=(2 * GROUPS * HASHES, 1), dtype=np.uint64) | np.uint64(1)
_BIT_FACTORS = _random.integers(1, 1 << 31, size=(BITS, 1), dtype=np.uint32) | np.uint32(1)


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of WORDS words; A-Z are lower-cased, words end at ASCII white space."""
    hashes, before = word_hashes([t and t.lower() for t in texts])
    total = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        total += mixed(hashes[i : i + len(total)] ^ _SPREAD[i])
    total = mixed(total)
    found = []
    for start, stop in zip(before[:-1].tolist(), before[1:].tolist()):
        if stop - start >= WORDS:
            found.append(np.unique(total[start : stop - WORDS + 1]))
        else:  # the whole sequence, told apart from a full shingle by its length
            short = hashes[start:stop]
            found.append(mixed((mixed(short ^ _SPREAD[: len(short)]).sum(keepdims=True)) + np.uint64(len(short))) if len(short) else short)
    return found


def minhashes(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of shingles, in pieces so that a very long text stays in the cache."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 1024):
        least = np.minimum(least, (_FACTORS * found[None, start : start + 1024]).min(axis=1))
    return least


def sketch(found: np.ndarray) -> bytes:
    """One bit of the least value of each of BITS hash functions."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(BITS, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(short), 64):
        least = np.minimum(least, (_BIT_FACTORS * short[None, start : start + 64]).min(axis=1))
    return np.packbits((mixed(least.astype(np.uint64)) >> np.uint64(40)).astype(np.uint8) & 1).tobytes()


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits of sketches agree, for all rows of a against all rows of b, given as 64-bit words."""
    total = np.full((len(a), len(b)), BITS, np.int16)
    for k in range(a.shape[1]):
        total -= np.bitwise_count(a[:, None, k] ^ b[None, :, k])
    return total


_SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, halves array<long>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n, digests, halves = [], [], []
        for found in shingle_sets(texts_of(batch)):
            n.append(len(found))
            if not len(found):
                digests.append((0, 0)), halves.append(None)
                continue
            whole = xxhash.xxh3_128_intdigest(found.tobytes())
            digests.append((whole >> 64, whole & ((1 << 64) - 1)))
            pair = minhashes(found).reshape(-1, HASHES)
            key = np.zeros(len(pair), np.uint64)
            for i in range(HASHES):
                key = mixed(key + pair[:, i])
            halves.append(key.view(np.int64))
        d = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
        columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(halves, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "halves"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [x.tobytes() for x in shingle_sets(texts_of(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["id", "shingles"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for a, b in zip(batch.column("left"), batch.column("right")):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
            good.append(100 * both >= LEAST_PERCENT * (len(a) + len(b) - both))
        keep = batch.filter(pa.array(good, pa.bool_()))
        yield pa.RecordBatch.from_arrays([keep.column("a"), keep.column("b")], names=["a", "b"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(_verified, "a long, b long")


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
        columns = [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "mark"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of documents in different components that agree in a group of the first side and may be similar, by size and sketch.

    The rows come sorted by key, which stands for a group's number and value; a pair is returned for the first group it
    agrees in. A key's rows are compared in blocks; ids, components, sizes and sketches are held, no pairs.
    """
    rest: list[pa.RecordBatch] = []
    held = None

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, component, n = (rows[c].to_numpy() for c in ("id", "component", "n"))
        if len(ids) < 2 or component.min() == component.max():
            return
        group = rows["i"][0].as_py()
        earlier = np.asarray(rows["x"].combine_chunks().flatten()).reshape(len(ids), -1)[:, :group]
        marks = np.frombuffer(b"".join(rows["mark"].to_pylist()), np.uint64).reshape(len(ids), -1)
        for i in range(0, len(ids), 256):
            for j in range(0, len(ids), 1024):
                x, y = slice(i, i + 256), slice(j, j + 1024)
                small, large = np.minimum(n[x, None], n[None, y]), np.maximum(n[x, None], n[None, y])
                fit = (100 * small >= LEAST_PERCENT * large) & (component[x, None] != component[None, y]) & (ids[x, None] < ids[None, y])
                for k in range(group):
                    fit &= earlier[x, None, k] != earlier[None, y, k]
                if fit.any():
                    fit &= agreeing(marks[x], marks[y]) >= LEAST_AGREE
                    a, b = np.nonzero(fit)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[x][a]), pa.array(ids[y][b])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            if rest and keys[start] != held:
                yield from pairs(pa.Table.from_batches(rest))
                rest = []
            rest.append(batch.slice(start, stop - start))
            held = keys[start]
    if rest:
        yield from pairs(pa.Table.from_batches(rest))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id).

    Links are pairs with at least LEAST_PERCENT of their united shingles in common.

    Equal sets are one class, represented by its smallest doc_id, before any table is built. Each member of a bucket is verified
    with the bucket's smallest one, a pair for each table at most. Only members of buckets that still hold several components
    are compared further: all pairs of them that agree in a group of the first side, which any table's pairs do, are compared by size and
    sketch inside the tasks, and those that may be similar are verified. So no pair that could join two components
    is left out, and what is shuffled does not grow with the pairs of a group.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = saved(docs.mapInArrow(_sketches, _SKETCH), "minhash-sketch")
    linked = sketched.where("n_shingles > 0 and doc_id is not null")
    # Written first, so that the join below has nothing but shuffles under it and a set with very many copies is split.
    classes = saved(linked.groupBy("d1", "d2").agg(F.min("doc_id").alias("id")), "minhash-classes")
    members = saved(linked.join(classes, ["d1", "d2"]).select("doc_id", "d1", "d2", "id"), "minhash-members")
    chosen = members.where("doc_id = id").select("id", "d1", "d2").distinct()
    reps = linked.withColumnRenamed("doc_id", "id").join(chosen, ["id", "d1", "d2"])

    half = GROUPS
    keyed = (
        reps.select("id", F.slice("halves", 1, half).alias("x"), F.slice("halves", half + 1, half).alias("y"))
        .select("id", "y", F.posexplode("x").alias("i", "kx"))
        .select("id", "i", "kx", F.posexplode("y").alias("j", "ky"))
        .select("id", F.xxhash64("i", "j", "kx", "ky").alias("key"))
    )
    # A window over a bucket streams from sorted rows and spills; a hot group is spread over as many buckets as there are tables.
    bucket = F.expr("min(id) over (partition by key)"), F.expr("max(id) over (partition by key)")
    shared = saved(
        keyed.select("key", "id", bucket[0].alias("lead"), bucket[1].alias("last")).where("lead < last").select("key", "id", "lead"),
        "minhash-buckets",
    )

    wanted = shared.select("id").distinct()
    sets = saved(docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").mapInArrow(_sets, "id long, shingles binary"), "minhash-sets")
    leads = shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = saved(_verify(leads, sets), "minhash-links")
    # An id that stands for several texts joins their groups.
    again = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("a", "b")
    links = links.unionByName(again)
    known = components(links)

    placed = shared.join(known.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("key")
    open_ = saved(placed.join(split, "key", "left_semi").select("id", "component").distinct(), "minhash-open")
    marks = sets.join(open_.select("id"), "id", "left_semi").mapInArrow(_marks, "id long, n long, mark binary")
    sides = reps.select("id", F.slice("halves", 1, half).alias("x")).join(open_, "id").join(marks, "id")
    sides = sides.select("*", F.posexplode("x").alias("i", "kx")).withColumn("key", F.xxhash64("i", "kx"))
    sides = sides.select("key", "i", "id", "component", "n", "x", "mark").repartition("key").sortWithinPartitions("key")
    more = saved(sides.mapInArrow(_across, "a long, b long"), "minhash-pairs").distinct()
    links = links.unionByName(saved(_verify(more, sets), "minhash-links"))
    known = components(links)

    placed = members.join(known.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("doc_id", "d1", "d2", F.coalesce("component", "id").alias("component")).groupBy("doc_id", "d1", "d2").agg(F.min("component").alias("component"))
    result = sketched.select("doc_id", "n_shingles", "d1", "d2").join(placed, ["doc_id", "d1", "d2"], "left")
    component = F.coalesce("component", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, less all but one of each group of near-duplicates.

    The smallest doc_id of a group stays; of rows that repeat it the one whose text hashes lowest. Rows with a null doc_id stay.
    """
    stays = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("stays_id")).distinct()
    own = docs.select(*(F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_text"))
    first = own.join(stays, F.col("own_id") == F.col("stays_id"), "left_semi")
    first = first.withColumn("own_nth", F.expr("row_number() over (partition by own_id order by own_text)")).where("own_nth = 1").drop("own_nth")
    both = first.unionByName(own.where("own_id is null"))
    return both.select(*(F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)))
