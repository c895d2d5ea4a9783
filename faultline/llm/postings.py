"""Nearest neighbours by largest inner product, found through balanced posting lists.

A coordinate is added to each vector that brings all to one length, so that the largest inner product is the nearest vector. A
bounded sample is halved again and again, each time evenly between two means, into as many lists as the table has LIST vectors; the
means of the halves are the lists' centroids. Every vector goes to its nearest list and, where it lies at a boundary, to others up to REPLICAS whose
distance is at most BOUNDARY times the least. Centroids are searched by best-first steps in an in-memory graph of their neighbours. A query
reads the lists whose distance is at most `ratio` times the least, LEAST_LISTS at least; the ratio is set on the sample, such that it would
have found TARGET of the true neighbours there (neighbours are nearer, so easier, in the whole table). All vectors of those lists are scored.

Neighbouring lists, in the order of the halving, share a shelf of at most SHELF entries; a longer list has several shelves to itself. A query
goes to each shelf that holds one of its lists once, in chunks of about CHUNK queries, and gets the shelf's best, so what is returned grows with
shelves and not with lists. A shelf is copied as often as the queries that ask it fill chunks, and not at all if none does. Equal vectors are one entry with their TOP + 1 smallest ids, which is all that any query's result can hold of them.

Cases: vectors that are null, empty, zero or hold null or non-finite numbers, and null ids, take no part. Shorter vectors count as followed
by zeros. Ties go to the smaller vec_id. With fewer candidates than TOP all are returned. A query id that occurs twice with different vectors
takes the vector that sorts first; a candidate id that does is found with its best score. Where squares of the largest numbers would overflow, all vectors are divided
by one power of two and scores are multiplied by its square; a score beyond the range of doubles is infinite, and the order is that of the scores before.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved
from faultline.llm.vectors import Batches, matrix, usable, width

TOP = 20
LIST = 1024
MOST_LISTS = 4096
PER_LIST = 32  # vectors of the sample for each list
REPLICAS = 4
BOUNDARY = 1.15
LEAST_LISTS = 4
TARGET = 0.97
SHELF = 16384
CHUNK = 8192
NEIGHBOURS, BEAM = 16, 16


def balanced_lists(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of `lists` parts of the sample, made by even halving between two means."""
    parts, done = [(np.arange(len(sample)), lists)], []
    while parts:
        rows, want = parts.pop()
        if want == 1 or len(rows) < 2:
            done.append(sample[rows].mean(axis=0))
            continue
        x = sample[rows]
        means = np.stack([x[0], x[((x - x[0]) ** 2).sum(axis=1).argmax()]])
        left = max(1, round(len(rows) * (want // 2) / want))
        for _ in range(8):
            side = ((x - means[0]) ** 2).sum(axis=1) - ((x - means[1]) ** 2).sum(axis=1)
            order = np.argsort(side, kind="stable")
            means = np.stack([x[order[:left]].mean(axis=0), x[order[left:]].mean(axis=0)])
        parts += [(rows[order[:left]], want // 2), (rows[order[left:]], want - want // 2)]
    return np.stack(done)


class Graph:
    """Centroids with their nearest and a few more distant ones as neighbours."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        count = len(centroids)
        self.norms = (centroids**2).sum(axis=1)
        square = self.norms[:, None] + self.norms[None] - 2 * centroids @ centroids.T
        near = np.argsort(square, axis=1, kind="stable")[:, 1 : NEIGHBOURS + 1]
        # A ring and a few jumps keep the graph in one piece.
        ring = (np.arange(count)[:, None] + np.array([1, -1, count // 2, count // 3])) % count
        self.neighbours = np.concatenate([near, ring], axis=1)

    def search(self, points: np.ndarray, ratio: float, least: int) -> np.ndarray:
        """Distances to the centroids that the search has seen, infinite for others.

        The nearest centroid not yet opened is opened until it is further than `ratio` times the least distance and
        than the `least` nearest.
        """
        rows, count = np.arange(len(points)), len(self.centroids)
        seen = np.full((len(points), count), np.inf)
        opened = np.zeros((len(points), count), bool)
        squares = (points**2).sum(axis=1)
        new = np.zeros((len(points), 1), np.int64)
        active = rows
        while len(active):
            dots = np.einsum("nd,nkd->nk", points[active], self.centroids[new])
            found = np.sqrt(np.maximum(0, squares[active, None] + self.norms[new] - 2 * dots))
            seen[active[:, None], new] = found
            closed = np.where(opened[active], np.inf, seen[active])
            best = closed.argmin(axis=1)
            distance = closed[np.arange(len(active)), best]
            limit = np.maximum(ratio * seen[active].min(axis=1), np.partition(seen[active], min(least, count) - 1, axis=1)[:, min(least, count) - 1])
            go = np.isfinite(distance) & (distance <= limit)
            active, best = active[go], best[go]
            opened[active, best] = True
            new = self.neighbours[best]
        return seen

    def lists(self, points: np.ndarray, ratio: float, least: int, most: int, beam: int = BEAM) -> list[np.ndarray]:
        """For each point its lists, nearest first: those up to the ratio, `least` at least and `most` at most."""
        out = []
        for start in range(0, len(points), 256):
            seen = self.search(points[start : start + 256], ratio, max(least, beam))
            order = np.argsort(seen, axis=1, kind="stable")
            ranked = np.take_along_axis(seen, order, axis=1)
            good = np.isfinite(ranked) & ((ranked <= ratio * ranked[:, :1]) | (np.arange(seen.shape[1]) < least)) & (np.arange(seen.shape[1]) < most)
            out += [o[g] for o, g in zip(order, good)]
        return out


def _ratio(graph: Graph, sample: np.ndarray, own: np.ndarray, top: int) -> float:
    """The ratio of distances up to which a query must read lists to find TARGET of its neighbours in the sample."""
    queries = np.arange(0, len(sample), max(1, len(sample) // 256))
    scores = own[queries] @ own.T
    scores[np.arange(len(queries)), queries] = -np.inf
    near = np.argsort(-scores, axis=1, kind="stable")[:, : min(top, len(sample) - 1)]
    homes = graph.lists(sample, BOUNDARY, 1, REPLICAS)
    asked = sample[queries].copy()
    asked[:, -1] = 0
    distance = np.sqrt(np.maximum(0, (asked**2).sum(axis=1)[:, None] + graph.norms[None] - 2 * asked @ graph.centroids.T))
    # A query that lies on a centroid has a least distance of 0.
    rounding = 1e-9 * distance.mean() + np.finfo(float).tiny
    distance = (distance + rounding) / (distance.min(axis=1, keepdims=True) + rounding)
    need = [distance[i, homes[j]].min() for i in range(len(queries)) for j in near[i]]
    return float(np.quantile(need, TARGET)) if need else 1.0


def _scale(largest: float) -> float:
    """A power of two to divide vectors by, 1 unless products of numbers as large as this could overflow."""
    return 2.0 ** math.frexp(largest)[1] if largest > 2.0**400 else 1.0


def shelves(sizes: dict[int, int], shelf: int) -> dict[int, list[int]]:
    """The shelves of each list, given the lists' sizes."""
    of_list: dict[int, list[int]] = {}
    last, room = -1, 0
    for number, size in sorted(sizes.items()):
        if size > shelf:
            parts = -(-size // shelf)
            of_list[number] = [*range(last + 1, last + 1 + parts)]
            last, room = last + parts, 0
            continue
        if size > room:
            last, room = last + 1, shelf
        of_list[number] = [last]
        room -= size
    return of_list


def search(vectors: DataFrame, every: int = 20, top: int = TOP, per_list: int = LIST, shelf: int = SHELF, chunk: int = CHUNK) -> DataFrame:
    """For each vector whose id is divisible by `every`, its `top` nearest others: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    good = usable(vectors)
    first = good.withColumn("n", F.expr("row_number() over (partition by embedding order by vec_id)")).where(f"n <= {top + 1}")
    entries = first.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    entries = saved(entries.withColumn("id", F.col("ids")[0]), "posting-entries")
    count, dims = entries.count(), width(entries)
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scale = _scale(entries.agg(F.max(F.array_max(F.transform("embedding", F.abs)))).first()[0])
    longest = entries.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale)))).first()[0]
    lists = min(-(-count // per_list), MOST_LISTS)

    def rows_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return matrix(column, dims) / scale

    def lengthened(rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, longest - (rows**2).sum(axis=1)))
        return np.concatenate([rows, rest[:, None]], axis=1)

    own = rows_of(entries.select("embedding").orderBy(F.xxhash64("id"), "id").limit(lists * PER_LIST).toArrow()["embedding"])
    sample = lengthened(own)
    graph = Graph(balanced_lists(sample, lists))
    ratio = _ratio(graph, sample, own, top)
    shared = spark.sparkContext.broadcast(graph)

    def placed(batches: Batches) -> Batches:
        for batch in batches:
            found = shared.value.lists(lengthened(rows_of(batch.column("embedding"))), BOUNDARY, 1, REPLICAS)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("embedding"), pa.array(found, pa.list_(pa.int64()))], names=["id", "embedding", "lists"])

    posted = saved(entries.select("id", "embedding").mapInArrow(placed, "id long, embedding array<double>, lists array<long>"), "postings")
    # As many rows as there are lists.
    sizes = {r["list"]: r["n"] for r in posted.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n")).collect()}
    of_list = shelves(sizes, shelf)

    def asked(batches: Batches) -> Batches:
        for batch in batches:
            rows = rows_of(batch.column("embedding"))
            found = shared.value.lists(np.concatenate([rows, np.zeros((len(rows), 1))], axis=1), ratio, LEAST_LISTS, lists)
            on = [sorted({s for number in some.tolist() for s in of_list.get(number, ())}) for some in found]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("embedding"), pa.array(on, pa.list_(pa.int64()))], names=["query_id", "embedding", "on"])

    queries = good.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    queries = saved(queries.mapInArrow(asked, "query_id long, embedding array<double>, on array<long>"), "posting-queries")
    # As many rows as there are shelves that are asked.
    asks = queries.select(F.explode("on").alias("shelf")).groupBy("shelf").agg(F.count("*").alias("n")).collect()
    chunks = {r["shelf"]: -(-r["n"] // chunk) for r in asks}

    def shelve(batches: Batches) -> Batches:
        for batch in batches:
            # Copies of an entry in lists of one shelf are one there.
            on = [sorted({of_list[n][id_ * 0x9E3779B1 % len(of_list[n])] for n in some}) for id_, some in zip(batch.column("id").to_pylist(), batch.column("lists").to_pylist())]
            on = [[s << 32 | c for s in some for c in range(chunks.get(s, 0))] for some in on]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("embedding"), pa.array(on, pa.list_(pa.int64()))], names=["id", "embedding", "on"])

    def dealt(batches: Batches) -> Batches:
        for batch in batches:
            on = [[s << 32 | (id_ * 0x9E3779B1 >> 8) % chunks[s] for s in some] for id_, some in zip(batch.column("query_id").to_pylist(), batch.column("on").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("embedding"), pa.array(on, pa.list_(pa.int64()))], names=["query_id", "embedding", "on"])

    left = posted.mapInArrow(shelve, "id long, embedding array<double>, on array<long>").select(F.explode("on").alias("part"), "id", "embedding")
    right = queries.mapInArrow(dealt, "query_id long, embedding array<double>, on array<long>").select(F.explode("on").alias("part"), "query_id", "embedding")

    def scored(have: pa.Table, want: pa.Table) -> pa.Table:
        out = []
        if have.num_rows and want.num_rows:
            x, ids = rows_of(have["embedding"]), have["id"].to_numpy()
            asked_ids = want["query_id"].to_numpy()
            for start in range(0, len(asked_ids), 256):
                rows = rows_of(want["embedding"].slice(start, 256))
                score = rows @ x.T
                keep = min(top + 1, len(ids))
                least = -np.partition(-score, keep - 1, axis=1)[:, keep - 1 : keep]
                i, j = np.nonzero(score >= least)
                order = np.lexsort((ids[j], -score[i, j], i))
                i, j = i[order], j[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[place < keep], j[place < keep]
                out.append((asked_ids[start + i], ids[j], (rows[i] * x[j]).sum(axis=1)))
        query, id_, score = (np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": query, "id": id_, "score": score})

    found = left.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(scored, "query_id long, id long, score double")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    found = found.withColumn("n", F.expr("row_number() over (partition by query_id order by score desc, id)")).where(f"n <= {top + 1}").drop("n")
    found = found.join(entries.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)")).where(f"rank <= {top}")
    # Exact, as a power of two.
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (F.col("score") * scale * scale).alias("score"))
