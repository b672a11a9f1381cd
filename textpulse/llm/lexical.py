"""Ranked lexical search: exact inner products over sparse ball trees."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import discard, map_batches, raw, stage, table

KEPT = 50  # documents reported for an item
TERMS_AT_ONCE = 8_192  # query terms of a block of items, about: the width of a tree's centroids
TREE_DOCS = 4_096  # documents of a tree
TREE_ENTRIES = 2_000_000  # term entries of a tree, about
LEAF_DOCS, FAN = 4, 4
BLOCKS = 1024  # groups of terms that have a radius of their own
DIRECTIONS = 48  # random directions on which vectors are clustered
MEANS_ROUNDS = 8  # of moving the centres of a node's clusters
FIRST_OF = 32  # one of so many documents is searched first, for a threshold
SLACK = 1e-9  # more than the rounding of any sum of doubles made here, relatively
#: Term characters stay, A-Z become a-z, all else parts terms.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in order; a null text has none."""
    return (text or b"").translate(TABLE).split()


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): distinct terms of every item; rows that share an id are one item."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = map_batches(items.select(F.col("item_id").cast("long"), raw("text")), run, "item_id long, terms array<binary>")
    return rows.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))


def query_blocks(items: DataFrame) -> Iterator[list]:
    """The stated query set in blocks of about ``TERMS_AT_ONCE`` terms, an item never parted."""
    found = stage(query_terms(items).filter(F.size("terms") > 0))
    blocks = max(1, math.ceil((found.agg(F.sum(F.size("terms"))).first()[0] or 0) / TERMS_AT_ONCE))
    for block in range(blocks):
        rows = found.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if rows:
            yield sorted(rows, key=lambda r: (r.item_id is not None, r.item_id))
    discard(found)


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with a term: length, and the counts of query terms."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, lengths, sizes, codes, counts = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = terms_of(text)
            if not words:
                continue
            met = sorted((code, n) for word, n in Counter(words).items() if (code := vocabulary.get(word)) is not None)
            keep.append(i)
            lengths.append(len(words))
            sizes.append(len(met))
            codes += [code for code, _ in met]
            counts += [n for _, n in met]
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(v, kind)) for v, kind in ((codes, pa.int32()), (counts, pa.int64()))]
        return pa.record_batch([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()), *lists],
                               ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long"), raw("text"))
    return map_batches(rows, run, "doc_id long, n long, terms array<int>, tfs array<long>")


@dataclass
class Model:
    """What scores depend on besides a document: corpus counts, and the items of a block as sparse vectors."""

    n_docs: int
    n_terms: int
    weights: np.ndarray  # by term
    block_starts: np.ndarray  # terms are numbered so that a block's stand together
    items: list[tuple[int | None, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # id, terms, weights, blocks, norm in each block

    def values(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """A document's component for a term, an integer."""
        m = 50 + 50 * n * self.n_docs // self.n_terms
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def block_starts(df: np.ndarray) -> np.ndarray:
    """First terms of at most ``BLOCKS`` groups with about the same document counts; frequent terms stand alone."""
    before = np.cumsum(df) - df
    return np.flatnonzero(np.diff(before * BLOCKS // max(1, int(df.sum())), prepend=-1))


class BallTree:
    """A tree over sparse vectors: each node is a run of them within a radius of their centroid.

    Vectors are given as ``ptr`` (ends), ``terms`` and ``values``. The radius is kept for each block
    of terms: a vector of the node differs from the centroid, within the block, by no more. Nodes are
    cut along the random direction in which they spread most. Any rounding of the centroids is
    harmless, as radii are taken from them as stored; radii are rounded up.
    """

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, starts: np.ndarray, weights: np.ndarray):
        n, width = len(ptr) - 1, len(weights)
        row = np.repeat(np.arange(n), np.diff(ptr))
        spread = np.random.default_rng(5).standard_normal((DIRECTIONS, width), np.float32)
        pulled = (values * weights[terms]).astype(np.float64)
        places = np.stack([np.bincount(row, pulled * along[terms], n) for along in spread], 1)
        self.order, levels = self._split(places)
        # The vectors in the order of the leaves.
        sizes = np.diff(ptr)[self.order]
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(ptr[self.order] - self.ptr[:-1], sizes) + np.arange(self.ptr[-1])
        self.terms, self.values = terms[source], values[source]
        self.low, self.high = (np.concatenate([getattr(level, end) for level in levels]) for end in ("low", "high"))
        sizes = [len(level.low) for level in levels]
        bases = np.cumsum(sizes) - sizes
        self.first = np.concatenate([base + size + level.first for base, size, level in zip(bases, sizes, levels)])
        self.children = np.concatenate([level.children for level in levels])
        balls = [self._balls(level.low, level.high, starts, width) for level in levels]
        self.centroids, self.radii = (np.concatenate(parts) for parts in zip(*balls))

    @dataclass
    class Level:
        low: np.ndarray
        high: np.ndarray
        first: np.ndarray  # number of the first child in the next level
        children: np.ndarray

    @staticmethod
    def _parts(places: np.ndarray) -> list[np.ndarray]:
        """A node's vectors in at most ``FAN`` clusters; in equal parts if nothing tells them apart."""
        along = places[:, places.var(axis=0).argmax()]
        ranked = np.argsort(along, kind="stable")
        parts = np.array_split(ranked, FAN)
        for _ in range(MEANS_ROUNDS):
            centres = np.stack([places[part].mean(axis=0) for part in parts])
            near = (places @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
            found = [part for k in range(len(centres)) if len(part := np.flatnonzero(near == k))]
            if len(found) < 2:
                break
            parts = found
        return parts

    @staticmethod
    def _split(places: np.ndarray) -> tuple[np.ndarray, list]:
        order, levels, nodes = np.arange(len(places)), [], [(0, len(places))]
        while nodes:
            following, first, children = [], [], []
            for low, high in nodes:
                first.append(len(following))
                if high - low > LEAF_DOCS:
                    own = order[low:high]
                    parts = BallTree._parts(places[own])
                    order[low:high] = own[np.concatenate(parts)]
                    ends = low + np.cumsum([0, *map(len, parts)])
                    following += zip(ends[:-1].tolist(), ends[1:].tolist())
                children.append(len(following) - first[-1])
            ends = np.array(nodes, np.int64)
            levels.append(BallTree.Level(ends[:, 0], ends[:, 1], np.array(first), np.array(children)))
            nodes = following
        return order, levels

    def _balls(self, low: np.ndarray, high: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        # Only the vectors of this level's nodes, which stand one behind the other.
        docs = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
        label = np.repeat(np.arange(len(low)), high - low)
        sizes = np.diff(self.ptr)[docs]
        row = np.repeat(np.arange(len(docs)), sizes)
        entry = np.repeat(self.ptr[docs] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(row))
        terms, values = self.terms[entry], self.values[entry]
        centre = np.bincount(label[row] * width + terms, values, len(low) * width).reshape(len(low), width)
        centre = (centre / (high - low)[:, None]).astype(np.float32)
        exact = centre.astype(np.float64)
        squares = np.add.reduceat(exact * exact, starts, axis=1)
        block = np.searchsorted(starts, terms, "right") - 1
        own = exact[label[row], terms]
        # (x - c)^2 in place of c^2 where the vector has an entry.
        moved = np.bincount(row * len(starts) + block, (values - own) ** 2 - own * own, len(docs) * len(starts))
        apart = np.maximum(squares[label] + moved.reshape(len(docs), -1), 0)
        # The differences cancel to within a share of what was added and taken away.
        size = np.bincount(row * len(starts) + block, (values - own) ** 2 + own * own, len(docs) * len(starts)).reshape(len(docs), -1)
        apart += SLACK * (squares[label] + size)
        furthest = np.maximum.reduceat(apart, np.concatenate([[0], np.cumsum(high - low)[:-1]]), axis=0)
        return centre, np.nextafter((np.sqrt(furthest) * (1 + SLACK)).astype(np.float32), np.float32(np.inf))

    def bounds(self, low: int, high: int, terms, weights, blocks, norms) -> np.ndarray:
        """No vector below one of these nodes has a greater inner product with the item."""
        middle = self.centroids[low:high, terms].astype(np.float64) @ weights
        return (middle + self.radii[low:high, blocks].astype(np.float64) @ norms) * (1 + SLACK) + 1

    def scores(self, node: int, dense: np.ndarray) -> np.ndarray:
        """Exact inner products of a leaf's vectors, in integers."""
        ends = self.ptr[self.low[node]:self.high[node] + 1]
        sums = np.concatenate([[0], np.cumsum(dense[self.terms[ends[0]:ends[-1]]] * self.values[ends[0]:ends[-1]])])
        return np.diff(sums[ends - ends[0]])


class Best:
    """The best documents of an item so far; ``least`` is the score that a further one must reach."""

    def __init__(self, least: int, k: int):
        self.least, self.k, self.rows = max(1, least), k, []

    def add(self, scores: np.ndarray, ids: list) -> None:
        met = np.flatnonzero(scores >= self.least)
        if len(met):
            self.rows += [(-int(scores[i]), ids[i] is None, ids[i] or 0, ids[i]) for i in met]
            if len(self.rows) > self.k:
                self.rows = heapq.nsmallest(self.k, self.rows)
            if len(self.rows) == self.k:
                self.least = max(self.least, -max(self.rows)[0])


def descend(tree: BallTree, ids: list, item: tuple, dense: np.ndarray, best: Best) -> int:
    """Best-first search of one tree for one item; returns the number of leaves scored."""
    _, *vector = item
    # The nodes of the first level: the root alone.
    waiting, scored = [(-tree.bounds(0, 1, *vector)[0], 0)], 0
    while waiting:
        bound, node = heapq.heappop(waiting)
        if -bound < best.least:
            break  # and so is every other bound
        first, count = int(tree.first[node]), int(tree.children[node])
        if count:
            for child, reach in enumerate(tree.bounds(first, first + count, *vector).tolist(), first):
                if reach >= best.least:
                    heapq.heappush(waiting, (-reach, child))
        else:
            scored += 1
            best.add(tree.scores(node, dense), ids[tree.low[node]:tree.high[node]])
    return scored


def forest(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[BallTree, list]]:
    """Trees of at most ``TREE_DOCS`` documents, one at a time, with the ids in leaf order."""
    def built(parts: list[pa.RecordBatch]):
        ids = [i for part in parts for i in part.column(0).to_pylist()]
        size = np.concatenate([part.column(2).value_lengths().to_numpy() for part in parts]).astype(np.int64)
        length = np.concatenate([part.column(1).to_numpy() for part in parts])
        terms = np.concatenate([part.column(2).flatten().to_numpy() for part in parts]).astype(np.int64)
        tf = np.concatenate([part.column(3).flatten().to_numpy() for part in parts])
        tree = BallTree(np.concatenate([[0], np.cumsum(size)]), terms, model.values(np.repeat(length, size), tf), model.block_starts, model.weights)
        return tree, [ids[i] for i in tree.order]

    waiting, docs, entries = [], 0, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(batch.column(2).slice(at).value_lengths().to_numpy())
            take = min(TREE_DOCS - docs, max(1, int(np.searchsorted(ends, TREE_ENTRIES - entries, "right"))), batch.num_rows - at)
            waiting.append(batch.slice(at, take))
            at, docs, entries = at + take, docs + take, entries + int(ends[take - 1])
            if docs >= TREE_DOCS or entries >= TREE_ENTRIES:
                yield built(waiting)
                waiting, docs, entries = [], 0, 0
    if docs:
        yield built(waiting)


def searched(rows: DataFrame, model: Model, least: dict[int | None, int], k: int = KEPT) -> DataFrame:
    """(item_id, doc_id, score): the ``k`` best of each task for every item, none below its ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(least.get(item[0], 1), k) for item in model.items]
        dense = np.zeros(len(model.weights), np.int64)
        for tree, ids in forest(batches, model):
            for item, own in zip(model.items, best):
                dense[item[1]] = item[2]
                descend(tree, ids, item, dense, own)
                dense[item[1]] = 0
        for item, own in zip(model.items, best):
            if own.rows:
                scores, _, _, docs = zip(*own.rows)
                yield pa.record_batch([pa.array([item[0]] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array([-s for s in scores], pa.int64())],
                                      ["item_id", "doc_id", "score"])

    return rows.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item_id long, doc_id long, score long")


def top(found: DataFrame, k: int = KEPT) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def fitted(rows: DataFrame, items: list, vocabulary: list[bytes]) -> tuple[Model, dict[int, int]]:
    """The model of a block of items, and the new number of each term of ``vocabulary``."""
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    met = {r.term: r.df for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    df = np.array([met.get(i, 0) for i in range(len(vocabulary))], np.int64)
    by_count = np.argsort(-df, kind="stable")
    number = {int(old): new for new, old in enumerate(by_count)}
    code = {term: number[i] for i, term in enumerate(vocabulary)}
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df[by_count]], np.int64)
    starts = block_starts(df[by_count])
    vectors = []
    for item in items:
        terms = np.array(sorted(code[bytes(t)] for t in item.terms), np.int64)
        own = weights[terms]
        block, place = np.unique(np.searchsorted(starts, terms, "right") - 1, return_inverse=True)
        vectors.append((item.item_id, terms, own, block, np.sqrt(np.bincount(place, own.astype(np.float64) ** 2)) * (1 + SLACK)))
    return Model(n_docs, max(1, n_terms), weights, starts, vectors), number


def search(docs: DataFrame, items: DataFrame, k: int = KEPT) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0.

    A document is a sparse vector of saturated term counts, an item one of term weights; the score
    is their inner product in integers. Terms are runs of ASCII letters and digits and of all other
    characters beyond ASCII, A-Z lower-cased. Ties go to the smaller doc_id.

    Null and empty texts hold no term: such documents count nowhere and such items find nothing. Rows
    of one item_id are one item; a null id is an id. Rows of one doc_id are documents of their own,
    null ids come last among ties. No documents or no items give no rows.

    Texts are read once a block of items. What stays of one, its length and the counts of query
    terms, is staged; corpus counts are combined in the map tasks. Each task builds trees of bounded
    size over its documents and searches them best-first. A first search of a part of the documents
    gives for every item a score that its ``k``-th best reaches at least: trees are pruned by it from
    the start, and what tasks send to the ranking does not grow with the number of tasks.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in query_blocks(items):
        vocabulary = sorted({bytes(t) for item in block for t in item.terms})
        rows = stage(counted(docs, {term: i for i, term in enumerate(vocabulary)}))
        model, number = fitted(rows, block, vocabulary)
        numbered = _renumbered(rows, number)
        part = numbered.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST_OF)) == 0)
        least = {r.item_id: r.score for r in top(searched(part, model, {}, k), k).filter(F.col("rank") == k).collect()}
        out = out.union(stage(top(searched(numbered, model, least, k), k)))
        discard(rows)
    return out


def _renumbered(rows: DataFrame, number: dict[int, int]) -> DataFrame:
    """``rows`` with terms by their new numbers."""
    to = np.array([number[i] for i in range(len(number))], np.int32)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(2)
        ends = np.concatenate([[0], np.cumsum(old.value_lengths().to_numpy())])
        terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(to[old.flatten().to_numpy()], pa.int32()))
        return pa.record_batch([batch.column(0), batch.column(1), terms, batch.column(3)], ["doc_id", "n", "terms", "tfs"])

    return map_batches(rows, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
used AS (SELECT r, doc_id, w, len(w) AS n FROM docs WHERE len(w) > 0),
corpus AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM used),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM used)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, corpus GROUP BY term),
scored AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * nd) // nt)))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weighed USING (term), corpus GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
