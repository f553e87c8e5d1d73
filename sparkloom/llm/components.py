"""Connected components by alternating large-star and small-star steps.

Edges stay a distributed table; every step is an aggregation with map-side
combination and a join, and the table of a step is cut before the next. A graph
of a counted, small number of edges is settled by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget

#: So many edges (16 bytes each) or fewer are settled by one task.
ONE_TASK = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v.

    Large: every larger neighbour of a node moves to the node's least neighbour.
    Small: every smaller neighbour does, and the node itself.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.where("v > u") if large else both
    moved = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the least node that each reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        # a node's label takes on what its edges reach, and so does the node that it points to
        for at in (u, v, label[u], label[v]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches]
        if some:
            node, low = least_reachable(*(np.concatenate(c) for c in zip(*some, strict=True)))
            moved = node != low
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(low[moved])], ["u", "v"])

    return edges.coalesce(1).mapInArrow(run, "u long, v long")


def components(edges: DataFrame, *, steps: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): the least node that each node of the edges (a, b) reaches, for nodes that aren't
    themselves the least; a cut table."""
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct())
    if state.count() <= one_task:
        fresh = cut(_one_task(state))
        forget(state)
    else:
        fresh = _settled(state, steps)
    out = fresh.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out._sparkloom_path = fresh._sparkloom_path
    return out


def _settled(state: DataFrame, steps: int) -> DataFrame:
    mark = None
    for _ in range(steps):
        fresh = cut(_star(_star(state, True), False))
        forget(state)
        state = fresh
        # all are stars when a step changes nothing
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return state
        mark = now
    raise RuntimeError("the components did not settle")
