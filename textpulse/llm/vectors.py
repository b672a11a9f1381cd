"""Vector tables: what takes part in a search, equal vectors as one item, blocks of queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

QUERY_BLOCK = 2048  # queries that are broadcast at a time, about


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", nonzero: bool = False) -> DataFrame:
    """(vec_id, v): rows that take part, v as doubles.

    Out are rows with a null id, a null or empty vector, a null or non-finite component, with
    ``nonzero`` also zero vectors, and vectors of another length than most rows have (ties: the
    longer). Repeated ids count once, with the least of their vectors.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # also false for NaN, which is above infinity
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(finite)
    if nonzero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    rows = rows.filter(F.size("v") == (length[0].d if length else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_items(rows: DataFrame, keep: int) -> DataFrame:
    """(item, ids, v): equal vectors as one item with their ``keep`` smallest ids; item is the smallest.

    A search for the k best rows but the query's own needs no more than k + 1 ids of one vector.
    The limit holds before the shuffle, so a vector in a third of all rows sends few rows per task.
    """
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("rank", first).filter(F.col("rank") <= keep)
    return few.groupBy("v").agg(F.min("vec_id").alias("item"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("item", "ids", "v")


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of about ``size`` queries at a time: the stated query set in blocks of bounded size."""
    blocks = -(-queries.count() // size)
    for block in range(blocks):
        rows = sorted(queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect(), key=lambda r: r.vec_id)
        if rows:
            yield np.array([r.vec_id for r in rows], np.int64), np.array([r.v for r in rows], np.float64)


def ranked(found: DataFrame, k: int, best) -> DataFrame:
    """The ``k`` first rows of each query by ``best`` and vec_id, the query itself left out."""
    order = Window.partitionBy("query_id").orderBy(best, "vec_id")
    return (found.filter("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
