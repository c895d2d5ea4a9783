"""Near-duplicate vectors: all pairs with a cosine of at least COSINE, by dual traversal of cover trees.

Equal vectors are one node with a weight. Nodes go to the nearest of a few centres, a net of a bounded sample; a centre's nodes are
dealt into blocks of about BLOCK. A node also meets the blocks of every other centre that its distance, the centre's covering radius and
the threshold's chord do not rule out. Each pair of blocks is one task: both sides are built into cover trees, whose nodes hold
the points within a radius that halves from level to level, and pairs of tree nodes are traversed together. A pair of nodes is dropped when their centres
are further apart than both covering radii and the chord, and linked as a whole when even their furthest points are near enough;
other pairs are opened, down to small sets that are multiplied out. Covering radii are measured, so a node with more than FANOUT centres at half its radius gives the rest to
the nearest and stays exact.

A task returns a row per node, its number of links and the smallest node it is connected with there, never pairs, so a group of
copies costs as many rows as it has members. In data without any structure at the scale of the chord nothing can be ruled out, and the blocks
are compared pair by pair: the work is then quadratic, as for any exact method.

Cases: vectors that are null, empty, zero or hold null or non-finite numbers link with nothing: n_links 0, a component of their own.
A null vec_id takes no part: component_id null, kept true. Rows that repeat a vec_id are rows of one vector if equal; if not, each
counts its own links, and both take the smaller component. Shorter vectors count as followed by zeros.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved
from faultline.llm.components import components, forest
from faultline.llm.vectors import Batches, arrays, matrix, usable, width

COSINE = 0.95
BLOCK = 8192
SAMPLE = 2048
FANOUT = 64
LEAF = 64
DENSE = 1 << 16  # a pair of nodes of at most so many pairs of points is multiplied out
SLACK = 1e-9  # what rounding may add to a distance


def chord(cosine: float) -> float:
    return math.sqrt(2 - 2 * cosine)


class Node:
    """Points of a tree node, its centre's place, its covering radius and its parts."""

    __slots__ = ("points", "centre", "radius", "parts")

    def __init__(self, points: np.ndarray, centre: int, radius: float):
        self.points, self.centre, self.radius, self.parts = points, centre, radius, None


def distances(unit: np.ndarray, points: np.ndarray, centre: int) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (unit[points] @ unit[centre])))


def build(unit: np.ndarray, tight: float) -> Node:
    """The cover tree of unit vectors; nodes of LEAF points or a radius of `tight` are not divided."""
    everything = np.arange(len(unit))
    root = Node(everything, 0, float(distances(unit, everything, 0).max()))
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.points) <= LEAF or node.radius <= tight:
            continue
        reach = node.radius / 2
        centres, nearest, best = [], np.full(len(node.points), np.inf), np.zeros(len(node.points), np.int64)
        at = int(np.flatnonzero(node.points == node.centre)[0])
        while len(centres) < FANOUT:
            d = distances(unit, node.points, node.points[at])
            closer = d < nearest
            nearest[closer], best[closer] = d[closer], len(centres)
            centres.append(node.points[at])
            at = int(nearest.argmax())
            if nearest[at] <= reach:
                break
        if len(centres) < 2:
            continue
        node.parts = []
        for i, centre in enumerate(centres):
            own = best == i
            if own.any():
                node.parts.append(Node(node.points[own], centre, float(nearest[own].max())))
        todo.extend(node.parts)
    return root


class Links:
    """Link counts of both sides and a forest of who is connected."""

    def __init__(self, left: int, right: int):
        self.counts = np.zeros(left, np.int64), np.zeros(right, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges.append((a, b))
        self.size += len(a)
        if self.size > 1 << 20:
            self.edges = [self.joined()]
            self.size = len(self.edges[0][0])

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """Star edges over places; those of the right side are counted on from the left side's."""
        if not self.edges:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return forest(*(np.concatenate(x) for x in zip(*self.edges)))


def traverse(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, cosine: float, same: bool) -> Links:
    """All links between unit vectors a and b with weights wa and wb; `same`: both sides are one, and no point links with itself."""
    reach = chord(cosine)
    left = build(a, reach / 8)
    right = left if same else build(b, reach / 8)
    links, shift = Links(len(a), len(b)), 0 if same else len(a)
    todo = [(left, right)]
    while todo:
        p, q = todo.pop()
        apart = math.sqrt(max(0.0, 2 - 2 * float(a[p.centre] @ b[q.centre])))
        if apart > p.radius + q.radius + reach + SLACK:
            continue
        if apart + p.radius + q.radius < reach - SLACK:
            links.counts[0][p.points] += wb[q.points].sum()
            links.counts[1][q.points] += wa[p.points].sum()
            if same:
                both = np.intersect1d(p.points, q.points, assume_unique=True)
                links.counts[0][both] -= wa[both]
            ends = np.concatenate([p.points, q.points + shift])
            links.add(np.full(len(ends), ends[0]), ends)
        elif len(p.points) * len(q.points) <= DENSE or not (p.parts or q.parts):
            for start in range(0, len(p.points), 1024):
                rows = p.points[start : start + 1024]
                near = a[rows] @ b[q.points].T >= cosine
                if same:
                    near &= rows[:, None] != q.points[None, :]
                if near.any():
                    links.counts[0][rows] += near @ wb[q.points]
                    links.counts[1][q.points] += wa[rows] @ near
                    i, j = np.nonzero(near)
                    links.add(rows[i], q.points[j] + shift)
        elif p.parts and (not q.parts or p.radius >= q.radius):
            todo.extend((x, q) for x in p.parts)
        else:
            todo.extend((p, x) for x in q.parts)
    return links


def _net(sample: np.ndarray, most: int) -> np.ndarray:
    """At most `most` of the rows, each the one furthest from those before."""
    chosen, nearest = [0], np.full(len(sample), -2.0)
    while len(chosen) < min(most, len(sample)):
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
        chosen.append(int(nearest.argmin()))
    return sample[chosen]


def link(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable), kept (vec_id = component_id)."""
    spark = vectors.sparkSession
    good = usable(vectors)
    groups = good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    nodes = saved(groups, "cover-nodes")
    dims, count = width(nodes), nodes.count()
    reach = chord(cosine)

    def unit(column: pa.Array) -> np.ndarray:
        rows = matrix(column, dims)
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    if not count:
        return everyone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    sample = nodes.select("embedding").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    centres = spark.sparkContext.broadcast(_net(unit(sample["embedding"]), -(-count // block)))

    def home(batches: Batches) -> Batches:
        for batch in batches:
            rows = unit(batch.column("embedding"))
            cosines = rows @ centres.value.T
            cell = cosines.argmax(axis=1)
            far = np.sqrt(np.maximum(0, 2 - 2 * cosines.max(axis=1)))
            columns = [batch.column("id"), batch.column("weight"), arrays(rows), pa.array(cell), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "weight", "unit", "cell", "far"])

    homed = saved(nodes.mapInArrow(home, "id long, weight long, unit array<double>, cell long, far double"), "cover-homes")
    cells = {r["cell"]: (r["n"], r["radius"]) for r in homed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    # Blocks of a cell are numbered on from those of the cells before it.
    blocks = {c: -(-n // block) for c, (n, _) in cells.items()}
    firsts = dict(zip(sorted(cells), np.concatenate([[0], np.cumsum([blocks[c] for c in sorted(cells)])]).tolist()))

    def meet(batches: Batches) -> Batches:
        for batch in batches:
            rows = matrix(batch.column("unit"), dims)
            apart = np.sqrt(np.maximum(0, 2 - 2 * rows @ centres.value.T))
            own = batch.column("cell").to_pylist()
            mine, others = [], []
            for i, (id_, cell) in enumerate(zip(batch.column("id").to_pylist(), own)):
                at = firsts[cell] + (id_ * 0x9E3779B97F4A7C15 >> 20) % blocks[cell]
                mine.append(at)
                near = [c for c in cells if c == cell or (apart[i, c] <= cells[c][1] + reach + SLACK and apart[i, c] - apart[i, cell] <= 2 * reach + SLACK)]
                others.append([b for c in near for b in range(firsts[c], firsts[c] + blocks[c])])
            columns = [batch.column("id"), batch.column("weight"), batch.column("unit"), pa.array(mine), pa.array(others, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "weight", "unit", "mine", "others"])

    def compare(group: pa.Table) -> pa.Table:
        low, high, mine = (group[c].to_numpy() for c in ("low", "high", "mine"))
        group = group.select(["id", "weight", "unit"])
        left, right = group.filter(pa.array(mine == low)), group.filter(pa.array(mine == high))
        same = low[0] == high[0]
        ids = left["id"].to_numpy() if same else np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
        if not left.num_rows or not right.num_rows:
            links, n, ids = None, np.empty(0, np.int64), ids[:0]
        else:
            sides = [matrix(x["unit"], dims) for x in (left, right)]
            links = traverse(*sides, left["weight"].to_numpy(), right["weight"].to_numpy(), cosine, same)
            n = links.counts[0] if same else np.concatenate(links.counts)
        label = ids.copy()
        if links is not None:
            child, root = links.joined()
            label[child] = ids[root]
        linked = n > 0
        return pa.table({"id": ids[linked], "n": n[linked], "b": label[linked]})

    pairs = homed.mapInArrow(meet, "id long, weight long, unit array<double>, mine long, others array<long>")
    pairs = pairs.withColumn("other", F.explode("others")).select(
        "id", "weight", "unit", "mine", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    )
    found = saved(pairs.groupBy("low", "high").applyInArrow(compare, "id long, n long, b long"), "cover-links")

    n_links = found.groupBy("id").agg(F.sum("n").alias("n"))
    members = good.withColumnRenamed("vec_id", "v").join(nodes, "embedding").join(n_links, "id", "left").select("v", "embedding", "id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    members = saved(members.distinct(), "cover-members")
    again = members.groupBy("v").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("a", "b")
    known = components(found.select(F.col("id").alias("a"), "b").unionByName(again))
    members = members.join(known.withColumnRenamed("node", "id"), "id", "left").select("v", F.col("embedding").alias("e"), "links", F.coalesce("component", "id").alias("component"))
    out = everyone.join(members, (F.col("vec_id") == F.col("v")) & (F.col("embedding") == F.col("e")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    )
