"""Connected components of an edge table (large-star / small-star rounds)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node of each one's component (in memory, of one task's edges)."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, x, before[y])
        np.minimum.at(label, y, before[x])
        np.minimum.at(label, before, label.copy())  # the old root learns what its members learnt
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        if np.array_equal(before, label):
            return nodes, nodes[label]


class Linked:
    """Numbers of links (weighted by the partner's copies) and components, from pairs that are not kept."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.links, self.label = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links between ``i`` and ``j``, pair by pair."""
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        self._join(self.label[i], self.label[j])

    def add_row(self, i: int, j: np.ndarray) -> None:
        """Links of one row with different rows ``j``."""
        self.links[i] += self.copies[j].sum()
        self.links[j] += self.copies[i]
        self._join(np.broadcast_to(self.label[i], len(j)), self.label[j])

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        apart = np.flatnonzero(x != y)
        if len(apart):  # most pairs of a group are joined already
            nodes, root = components(x[apart], y[apart])
            to = np.arange(len(self.label))
            to[nodes] = root
            self.label = to[self.label]

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """A link to each component's first row."""
        a = np.flatnonzero(self.label != np.arange(len(self.label)))
        return a, self.label[a]


def _forest(batches):
    """A spanning forest of the edges of each run of batches."""
    held: list[pa.RecordBatch] = []

    def flush():
        t = pa.Table.from_batches(held)
        nodes, root = components(t["a"].to_numpy(), t["b"].to_numpy())
        keep = nodes != root
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(root[keep])], ["a", "b"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) >= 1_000_000:
            yield flush()
    if held:
        yield flush()


def connected_components(edges: DataFrame, reduced: bool = False) -> DataFrame:
    """(node, comp) for each node of ``edges`` (a, b: long); comp is its component's smallest node.

    Each task first reduces its own edges to a forest (unless they come ``reduced``); rounds of large-star and small-star then run
    over the distinct remaining edges, each round's result written to the checkpoint folder. Nulls
    and self-links are left out; repeated edges change nothing; no edges give an empty table.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = materialize((e if reduced else e.mapInArrow(_forest, "a long, b long")).distinct(), release=True)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        m = large.groupBy("a").agg(F.min("b").alias("m"))
        r = m.withColumnRenamed("a", "u")
        small = large.join(r, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = materialize(small.unionByName(m.withColumnRenamed("m", "b")).distinct(), release=True)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
