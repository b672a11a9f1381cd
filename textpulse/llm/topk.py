"""Exact top-k search by inner product with a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import folder, stage, table
from textpulse.llm.vectors import distinct_items, query_blocks, ranked, usable

CHUNK = 2048  # vectors of a chunk
LISTS = 2  # lists that a score is the sum of


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exact: in doubles where no sum can pass 2^53."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def chunks(items: DataFrame) -> DataFrame:
    """(items, ids, matrix) rows of up to CHUNK vectors each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                matrix = part.column(2).flatten().to_numpy().astype("<f8")
                yield pa.record_batch([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                                       pa.array([part.column(1).to_pylist()], pa.list_(pa.list_(pa.int64()))),
                                       pa.array([matrix.tobytes()])], ["items", "ids", "matrix"])

    return items.mapInArrow(run, "items array<long>, ids array<array<long>>, matrix binary")


def _lists(row: dict, queries: np.ndarray, lists: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A chunk's vectors and its score lists: [vector, query] partial scores over a part of the dimensions."""
    matrix = np.frombuffer(row["matrix"], "<f8").reshape(-1, queries.shape[1])
    parts = np.array_split(np.arange(queries.shape[1]), min(lists, queries.shape[1]))
    return matrix, [_product(matrix[:, p], queries[:, p]) for p in parts]


def _best(values: np.ndarray, count: int) -> np.ndarray:
    """Row numbers of the ``count`` greatest values of each column."""
    count = min(count, len(values))
    return np.argpartition(-values, count - 1, axis=0)[:count] if count < len(values) else np.tile(np.arange(count)[:, None], values.shape[1])


def search(vectors: DataFrame, queries: DataFrame, k: int, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of every query, ties to smaller ids.

    ``vectors`` and ``queries`` have vec_id and v, whole numbers of one length as doubles; a
    query's own id is no candidate; fewer rows than k give all of them.

    The score of a vector is a sum over lists, each the partial scores over a part of the
    dimensions. Phase 1 gathers, for each query, the best entries of every list of each chunk,
    looks their scores up, and takes the least partial score of each list. The K-th greatest score
    gathered is a safe cutoff, as K vectors reach it: a vector that does has in some list at least
    the cutoff's share, counted from the list's least value. Phase 2 broadcasts cutoff and least
    values and collects from each list all entries with that share. Phase 3 adds the missing
    partial scores of the entries whose known ones leave the cutoff in reach, exactly. A chunk's lists
    lie together, so the entries are resolved where they are and only K per query and task are moved.

    Queries come in blocks of bounded size, each a pass over the chunks; its rows are appended to
    a table in the shared folder, so a lost executor repeats single tasks.
    """
    spark = vectors.sparkSession
    few = k + 1  # the query's own row may be among the best
    stored = stage(chunks(distinct_items(vectors, few).repartition(spark.sparkContext.defaultParallelism)))
    out, schema = folder(spark, "topk"), "query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for ids, matrix in query_blocks(queries):
        asked = spark.sparkContext.broadcast(matrix)

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = asked.value
            least, best = None, np.zeros((0, len(own)), np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    _, partial = _lists(row, own, lists)
                    low = np.stack([p.min(axis=0) for p in partial])
                    least = low if least is None else np.minimum(least, low)
                    total = sum(partial)
                    # Each list's best entries; one that two lists name counts once.
                    named = np.zeros(total.shape, bool)
                    for p in partial:
                        np.put_along_axis(named, _best(p, few), True, axis=0)
                    scores = np.where(named, total, np.iinfo(np.int64).min)
                    best = np.concatenate([best, scores])
                    best = np.take_along_axis(best, _best(best, few), axis=0)
            if least is not None:
                yield pa.record_batch([pa.array(np.arange(len(own), dtype=np.int32)), pa.array(least.T.tolist(), pa.list_(pa.int64())),
                                       pa.array(best.T.tolist(), pa.list_(pa.int64()))], ["query", "least", "best"])

        gathered = stored.mapInArrow(gather, "query int, least array<long>, best array<long>")
        width = min(lists, matrix.shape[1])
        lows = gathered.groupBy("query").agg(*[F.min(F.col("least")[i]).alias(f"l{i}") for i in range(width)])
        scores = gathered.select("query", F.explode("best").alias("score")).filter(F.col("score") > np.iinfo(np.int64).min)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
        cuts = scores.withColumn("place", place).filter(F.col("place") == few).select("query", F.col("score").alias("cut"))
        least = np.zeros((width, len(ids)), np.int64)
        cutoff, known = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        for r in lows.join(cuts, "query", "left").collect():  # a row per query of the block
            least[:, r["query"]] = [r[f"l{i}"] for i in range(width)]
            if r.cut is not None:
                cutoff[r["query"]], known[r["query"]] = r.cut, True
        safe = spark.sparkContext.broadcast((least, cutoff, known))

        def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = asked.value
            least, cutoff, known = safe.value
            lift = cutoff - least.sum(axis=0)  # what all lists together must reach above their least values
            for batch in batches:
                for row in batch.to_pylist():
                    vectors_, partial = _lists(row, own, lists)
                    held = np.stack([len(partial) * (p - low) >= lift for p, low in zip(partial, least)]) | ~known
                    vector, query = np.nonzero(held.any(axis=0))
                    # Upper bound: what is held, and just under the share for what is not.
                    bound = np.zeros(len(vector))
                    for i, p in enumerate(partial):
                        mine = held[i, vector, query]
                        bound += np.where(mine, p[vector, query], least[i, query] + lift[query] / len(partial))
                    near = (bound >= cutoff[query] - 1e-6 * np.abs(bound) - 1) | ~known[query]
                    vector, query = vector[near], query[near]
                    total = np.zeros(len(vector), np.int64)
                    for i, p in enumerate(partial):
                        total += p[vector, query]
                    # The best of the chunk for each query, ties to the smaller item.
                    items = np.array(row["items"], np.int64)
                    order = np.lexsort((items[vector], -total, query))
                    vector, query, total = vector[order], query[order], total[order]
                    rank = np.arange(len(query)) - np.searchsorted(query, query)
                    rows = [(int(q), i, int(s)) for v, q, s in zip(vector[rank < few], query[rank < few], total[rank < few]) for i in row["ids"][v]]
                    if rows:
                        q, i, s = zip(*rows)
                        yield pa.record_batch([pa.array(ids[list(q)]), pa.array(i, pa.int64()), pa.array(s, pa.int64())], ["query_id", "vec_id", "score"])

        ranked(stored.mapInArrow(resolve, schema), k, F.desc("score")).select("query_id", "vec_id", "score").write.mode("append").parquet(out)
        asked.unpersist()
        safe.unpersist()
    return ranked(spark.read.schema(schema).parquet(out), k, F.desc("score"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    whole = stage(rows.select("vec_id", F.transform("v", lambda x: F.floor(256 * x).cast("double")).alias("v")))
    return search(whole, whole.filter("vec_id % 50 = 0"), 5)


OP1_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
