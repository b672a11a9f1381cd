"""Approximate nearest neighbours: lists of rotated vectors scanned dimension block by block."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.llm.common import folder, stage, table
from textpulse.llm.vectors import distinct_items, query_blocks, ranked, usable

SAMPLE = 20_000  # vectors that the list centres are fitted on, about
LISTS = 256  # lists, fewer if the sample is small
PROBED = 0.6  # share of the lists that a query looks into; vectors without fine clusters need so many
BLOCK = 16  # dimensions of a column block
DOUBT = 2.1  # how sure the test must be before it gives a candidate up
CHUNK = 2048  # vectors of a chunk of a list
ROUNDS = 10
SEED = 11


@dataclass
class Index:
    rotation: np.ndarray
    centres: np.ndarray

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.rotation

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        """Squared distance of each vector to each centre."""
        return (rotated ** 2).sum(axis=1)[:, None] - 2 * rotated @ self.centres.T + (self.centres ** 2).sum(axis=1)


def fit(items: DataFrame, sample: int = SAMPLE, lists: int = LISTS) -> Index | None:
    """A random rotation and k-means centres of a bounded sample, chosen by a hash of the item."""
    total = items.count()
    drawn = items.filter(F.pmod(F.xxhash64("item"), F.lit(1 << 30)) < min(1.0, sample / max(1, total)) * (1 << 30))
    rows = sorted((r.item, r.v) for r in drawn.select("item", "v").limit(2 * sample).collect())
    if not rows:  # a small table may miss the sample
        rows = [(r.item, r.v) for r in items.select("item", "v").limit(1).collect()]
    if not rows:
        return None
    vectors = np.array([v for _, v in rows])
    random = np.random.default_rng(SEED)
    rotation, upper = np.linalg.qr(random.standard_normal((vectors.shape[1],) * 2))
    index = Index(rotation * np.sign(np.diag(upper)), np.zeros((0, vectors.shape[1])))
    rotated = index.rotated(vectors)
    index.centres = rotated[random.choice(len(rotated), max(1, min(lists, len(rotated) // 16)), replace=False)]
    for _ in range(ROUNDS):
        nearest = index.distances(rotated).argmin(axis=1)
        sums = np.zeros_like(index.centres)
        np.add.at(sums, nearest, rotated)
        sizes = np.bincount(nearest, minlength=len(sums))[:, None]
        index.centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), index.centres)
    return index


def indexed(items: DataFrame, index: Index) -> DataFrame:
    """(list, ids, matrix, rotated) rows: every item in the list of its nearest centre, in chunks.

    Lists are range-partitioned with the item as second key, so a list of a third of all vectors
    is spread over tasks, and cut into chunks of bounded size.
    """
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.array(batch.column(2).to_pylist())
                nearest = index.distances(index.rotated(vectors)).argmin(axis=1).astype(np.int32)
                yield pa.record_batch([pa.array(nearest), *batch.columns], ["list", "item", "ids", "v"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(lists)) + 1
            for start, end in zip([0, *edges], [*edges, len(lists)]):
                for at in range(start, end, CHUNK):
                    part = batch.slice(at, min(CHUNK, end - at))
                    vectors = np.array(part.column(3).to_pylist(), "<f8")
                    yield pa.record_batch([pa.array([int(lists[at])], pa.int32()), pa.array([part.column(2).to_pylist()], pa.list_(pa.list_(pa.int64()))),
                                           pa.array([vectors.tobytes()]), pa.array([index.rotated(vectors).astype("<f8").tobytes()])],
                                          ["list", "ids", "matrix", "rotated"])

    assigned = items.mapInArrow(assign, "list int, item long, ids array<long>, v array<double>")
    dealt = assigned.repartitionByRange("list", "item").sortWithinPartitions("list", "item")
    return dealt.mapInArrow(pack, "list int, ids array<array<long>>, matrix binary, rotated binary")


def scan(rotated: np.ndarray, queries: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vector and query numbers of the pairs that no test abandoned.

    After each column block the partial squared distance, scaled to all dimensions, estimates the
    whole one. The hypothesis that the distance is within the query's limit is given up when the
    estimate passes the limit by more than sampling d of D dimensions of a random rotation explains.
    """
    dimensions = rotated.shape[1]
    first = min(BLOCK, dimensions)
    x, q = rotated[:, :first], queries[:, :first]
    partial = np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ q.T + (q ** 2).sum(axis=1), 0)

    def allowed(d: int) -> np.ndarray:
        slack = 1 + DOUBT / np.sqrt(d) if d < dimensions else 1 + 1e-9
        return limits * (d / dimensions if d < dimensions else 1) * slack ** 2

    vector, query = np.nonzero(partial <= allowed(first) + 1e-12)
    known = partial[vector, query]
    for at in range(first, dimensions, BLOCK):
        end = min(at + BLOCK, dimensions)
        known = known + ((rotated[vector, at:end] - queries[query, at:end]) ** 2).sum(axis=1)
        stay = known <= allowed(end)[query] + 1e-12
        vector, query, known = vector[stay], query[stay], known[stay]
    return vector, query


def search(vectors: DataFrame, queries: DataFrame, k: int, probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every query, ties to smaller ids.

    ``vectors`` and ``queries`` have vec_id and v, doubles of one length. score is the Euclidean
    distance of the original vectors. A query's own id is no candidate; fewer rows give all.

    Every vector is in the list of its nearest centre. A query probes the share ``probed`` of the
    lists, the nearest first. Its limit comes from its nearest list's chunks, the distance of the
    K-th there. Then all probed chunks are scanned with early abandoning (``scan``); distances of
    those that stay are computed exactly. A query whose probed lists hold fewer than k vectors has a
    limit without bound and, if rows are missing then, is answered from all lists.
    """
    spark = vectors.sparkSession
    few = k + 1
    items = stage(distinct_items(vectors, few))
    index = fit(items)
    out, schema = folder(spark, "neighbours"), "query_id long, vec_id long, score double"
    spark.createDataFrame([], schema).write.parquet(out)
    if index is None:
        return ranked(spark.read.schema(schema).parquet(out), k, F.asc("score"))
    stored = stage(indexed(items, index))
    sizes = np.zeros(len(index.centres), np.int64)
    for r in stored.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).collect():  # a row per list
        sizes[r["list"]] = r.n
    for ids, matrix in query_blocks(queries):
        rotated = index.rotated(matrix)
        order = np.argsort(index.distances(rotated), axis=1, kind="stable")
        # As many lists as asked for, and more as long as they hold too few items.
        enough = np.cumsum(sizes[order], axis=1) >= few
        needed = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, order.shape[1])
        count = np.maximum(needed, int(np.ceil(probed * order.shape[1])))
        probes = np.zeros(order.shape, bool)
        np.put_along_axis(probes, order, np.arange(order.shape[1]) < count[:, None], axis=1)
        asked = spark.sparkContext.broadcast((matrix, rotated, order[:, 0], probes))

        def exact(row: dict, own: np.ndarray) -> np.ndarray:
            return np.frombuffer(row["matrix"], "<f8").reshape(-1, own.shape[1])

        def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, _, nearest, _ = asked.value
            for batch in batches:
                for row in batch.to_pylist():
                    mine = np.flatnonzero(nearest == row["list"])
                    x = exact(row, own)
                    if len(mine) and len(x) >= few:
                        q = own[mine]
                        far = np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ q.T + (q ** 2).sum(axis=1), 0)
                        yield pa.record_batch([pa.array(mine.astype(np.int32)), pa.array(np.partition(far, few - 1, axis=0)[few - 1])], ["query", "far"])

        limits = np.full(len(ids), np.inf)
        for r in stored.mapInArrow(limit, "query int, far double").groupBy("query").agg(F.min("far").alias("far")).collect():
            limits[r["query"]] = r.far * (1 + 1e-9) + 1e-12
        bound = spark.sparkContext.broadcast(limits)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, turned, _, looked = asked.value
            for batch in batches:
                for row in batch.to_pylist():
                    mine = np.flatnonzero(looked[:, row["list"]])
                    if not len(mine):
                        continue
                    x, rot = exact(row, own), np.frombuffer(row["rotated"], "<f8").reshape(-1, own.shape[1])
                    vector, query = scan(rot, turned[mine], bound.value[mine])
                    far = np.sqrt(((x[vector] - own[mine][query]) ** 2).sum(axis=1))
                    place = np.lexsort((vector, far, query))  # items of a chunk are in order
                    vector, query, far = vector[place], query[place], far[place]
                    rank = np.arange(len(query)) - np.searchsorted(query, query)
                    rows = [(int(mine[q]), i, float(s)) for v, q, s in zip(vector[rank < few], query[rank < few], far[rank < few]) for i in row["ids"][v]]
                    if rows:
                        q, i, s = zip(*rows)
                        yield pa.record_batch([pa.array(ids[list(q)]), pa.array(i, pa.int64()), pa.array(s)], ["query_id", "vec_id", "score"])

        ranked(stored.mapInArrow(near, schema), k, F.asc("score")).select("query_id", "vec_id", "score").write.mode("append").parquet(out)
        asked.unpersist()
        bound.unpersist()
    return ranked(spark.read.schema(schema).parquet(out), k, F.asc("score"))


def op5_adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stage(usable(table(spark, sf_dir, "embeddings"), nonzero=True))
    return search(whole, whole.filter("vec_id % 100 = 0"), 10)
