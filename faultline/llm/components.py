"""Connected components of an edge table, without bringing edges or components to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import saved


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the nodes of the edges (a, b): each node but the smallest of its component, and that smallest one."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.asarray(batch.column(i)) for i in (0, 1))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component: the smallest node reachable, for each node of an edge between two different nodes.

    edges has long columns a and b. Each batch of edges is first replaced by a star per component, then large-star and
    small-star steps alternate until the edges no longer change. A node with very many edges only meets partial
    aggregates and joins that are split when skewed.
    """
    now = edges.where("a <> b").select("a", "b").mapInArrow(_local_forest, "a long, b long").distinct()
    now, before = saved(now, "edges"), None
    while before is None or before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = saved(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
