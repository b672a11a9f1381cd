"""Clusters of unit vectors: a splitting tree fitted on a sample, nearest centres over all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE = 20_000  # rows, about, that the tree is fitted on
ROUNDS = 12  # of moving two centres
APART = 0.25  # a node is cut if its halves have less than this share of the variance between them: that of an even spread
PLACES = 4  # digits of a distance; so many values at most are counted for a cluster
AT_ONCE = 512  # rows that are compared with the centres at a time


class Vectors:
    """Unit rows, given as a matrix or, if ``ptr`` is given, by the positions and values of each; zero rows stay zero."""

    def __init__(self, values: np.ndarray, positions: np.ndarray | None = None, ptr: np.ndarray | None = None, width: int = 0):
        self.positions, self.ptr = positions, ptr
        if ptr is None:
            self.values, self.count, self.width = self._unit(values, np.sqrt((values * values).sum(axis=1))[:, None]), len(values), values.shape[1]
        else:
            self.count, self.width = len(ptr) - 1, width
            norms = np.sqrt(self._sums(values * values))
            self.values = self._unit(values, np.repeat(norms, np.diff(ptr)))
        self.filled = (self.values != 0).any(axis=1) if ptr is None else self._sums(np.abs(self.values)) > 0

    @staticmethod
    def _unit(values: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return np.divide(values, norms, out=np.zeros_like(values, np.float64), where=norms > 0)

    def _sums(self, entries: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros((1, *entries.shape[1:])), np.cumsum(entries, axis=0)])
        return total[self.ptr[1:]] - total[self.ptr[:-1]]

    def dots(self, centres: np.ndarray) -> np.ndarray:
        """[row, centre] inner products."""
        if self.ptr is None:
            return self.values @ centres.T
        return self._sums(self.values[:, None] * centres.T[self.positions])

    def mean(self) -> np.ndarray:
        """The unit vector in the middle."""
        total = self.values.sum(axis=0) if self.ptr is None else np.bincount(self.positions, self.values, self.width)
        return total / (np.sqrt((total * total).sum()) or 1.0)

    def take(self, rows: np.ndarray) -> Vectors:
        out = object.__new__(Vectors)
        out.width, out.count, out.filled = self.width, len(rows), self.filled[rows]
        if self.ptr is None:
            out.values, out.positions, out.ptr = self.values[rows], None, None
        else:
            sizes = np.diff(self.ptr)[rows]
            out.ptr = np.concatenate([[0], np.cumsum(sizes)])
            source = np.repeat(self.ptr[rows] - out.ptr[:-1], sizes) + np.arange(out.ptr[-1])
            out.values, out.positions = self.values[source], self.positions[source]
        return out


def _halves(rows: Vectors, centres: np.ndarray | None = None) -> np.ndarray:
    """Two centres, moved until they stay; at first the row farthest from the middle and the one farthest from it."""
    if centres is None:
        far = int(rows.dots(rows.mean()[None])[:, 0].argmin())
        one = rows.take(np.array([far])).mean()
        other = int(rows.dots(one[None])[:, 0].argmin())
        centres = np.stack([one, rows.take(np.array([other])).mean()])
    for _ in range(ROUNDS):
        side = rows.dots(centres).argmax(axis=1)
        if side.min() == side.max():
            break
        moved = np.stack([rows.take(np.flatnonzero(side == k)).mean() for k in (0, 1)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def _stand_apart(rows: Vectors, centres: np.ndarray) -> bool:
    """Whether rows that the centres have not seen lie in two heaps along the line between them.

    Cut in halves, an even spread keeps a quarter of its variance along that line, a single heap more.
    """
    along = rows.dots((centres[0] - centres[1])[None])[:, 0]
    side = along > 0
    total = along.var() * len(along)
    if side.all() or not side.any() or total == 0:
        return False
    return sum(along[s].var() * s.sum() for s in (side, ~side)) < APART * total


def splitting_tree(rows: Vectors, least: float, seed: int) -> np.ndarray:
    """Centres of the leaves: a node is cut in two while its halves stand apart and neither has fewer than ``least`` rows.

    Halves are found on one half of a node's rows and judged on the other, so that a direction that
    only fits the rows it was found on is no reason to cut.
    """
    draw = np.random.default_rng(seed)
    waiting, leaves = [rows.take(np.flatnonzero(rows.filled))], []
    while waiting:
        node = waiting.pop()
        if not node.count:
            continue
        if node.count >= max(8, 2 * least):
            order = draw.permutation(node.count)
            centres = _halves(node.take(order[::2]))
            if _stand_apart(node.take(order[1::2]), centres):
                side = node.dots(_halves(node, centres)).argmax(axis=1)
                parts = [np.flatnonzero(side == k) for k in (0, 1)]
                if min(map(len, parts)) >= max(1, least):
                    waiting += [node.take(part) for part in parts]
                    continue
        leaves.append(node.mean())
    return np.stack(leaves) if leaves else np.zeros((0, rows.width))


def nearest(rows: Vectors, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row and the distance, rounded; ties to the first. Zero rows get -1."""
    cluster, distance = np.full(rows.count, -1, np.int32), np.zeros(rows.count)
    for at in range(0, rows.count if len(centres) else 0, AT_ONCE):
        part = np.arange(at, min(rows.count, at + AT_ONCE))
        far = np.round(np.sqrt(np.maximum(0, 2 - 2 * rows.take(part).dots(centres))), PLACES)
        cluster[part] = np.where(rows.filled[part], far.argmin(axis=1), -1)
        distance[part] = far.min(axis=1)
    return cluster, distance


def with_nearest(df: DataFrame, column: Column, vectors: Callable[[pa.Array], Vectors], centres: np.ndarray) -> DataFrame:
    """Adds ``_cluster`` and ``_distance``; rows without a vector get NULL. No shuffle."""
    centres = np.asfortranarray(centres)  # numbers of one position stand together

    @F.arrow_udf("struct<cluster:int,distance:double>")
    def find(values: pa.Array) -> pa.Array:
        cluster, distance = nearest(vectors(values), centres)
        without = pa.array(cluster < 0)
        return pa.StructArray.from_arrays([pa.array(cluster, mask=without.to_numpy(zero_copy_only=False)), pa.array(distance)], ["cluster", "distance"])

    found = df.withColumn("_found", find(column))
    return found.withColumns({"_cluster": F.col("_found.cluster"), "_distance": F.col("_found.distance")}).drop("_found")


def topic_numbers(assigned: DataFrame, quantile: float, outlier: int = -1) -> DataFrame:
    """``_cluster, topic, reach``: clusters from 0 by falling size, and the distance up to which rows belong.

    Clusters of fewer than ``max(10, rows / 100)`` rows are outliers, and so are rows farther away than
    ``reach``, the least distance within which ``quantile`` of the cluster's rows lie. Rows are counted
    by cluster and rounded distance first, so a cluster with most of the rows is a few thousand counts.
    """
    counts = assigned.groupBy("_cluster", "_distance").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per cluster
    sizes = counts.groupBy("_cluster").agg(F.sum("n").alias("n")).withColumn("total", total)
    large = sizes.where(F.col("_cluster").isNotNull() & (F.col("n") >= F.greatest(F.lit(10), F.floor(F.col("total") / 100))))
    order = Window.orderBy(F.desc("n"), "_cluster")  # at most a hundred rows
    ranked = large.select("_cluster", F.col("n").alias("size"), (F.row_number().over(order) - 1).alias("topic"))
    by = Window.partitionBy("_cluster").orderBy("_distance")
    reached = (counts.join(F.broadcast(ranked), "_cluster").withColumn("within", F.sum("n").over(by))
               .where(F.col("within") >= F.ceil(F.col("size") * quantile)))
    return reached.groupBy("_cluster", "topic").agg(F.min("_distance").alias("reach"))


def with_topics(assigned: DataFrame, numbers: DataFrame, outlier: int = -1) -> DataFrame:
    """``dominant_topic`` from the nearest cluster's number, ``outlier`` where it is too small or too far."""
    near = F.col("_distance") <= F.col("reach")
    joined = assigned.join(F.broadcast(numbers), "_cluster", "left")  # at most a hundred topics
    topic = F.when(near, F.col("topic")).otherwise(F.lit(outlier)).cast("int")
    return joined.withColumn("dominant_topic", topic).drop("_cluster", "_distance", "topic", "reach")
