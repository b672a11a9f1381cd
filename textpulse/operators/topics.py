"""Topics: assignment by clustering, class-based TF-IDF words, names and summary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.plan import keep_columns
from textpulse.functions.text import title_case
from textpulse.operators import clusters
from textpulse.operators.tfidf import term_tokens

OUTLIER = -1
HASHED_TERMS = 1 << 16  # positions of a text vector; a hundred centres of so many numbers are held at once
TOPIC_QUANTILE = 0.95  # share of a topic's rows, the nearest ones, that belong to it


def _dense(values: pa.Array) -> clusters.Vectors:
    """Rows of a column of embeddings; NULL, empty and not finite ones count as zero."""
    rows = [r if r is not None and None not in r else [] for r in values.to_pylist()]
    matrix = np.zeros((len(rows), max(map(len, rows), default=0)))
    for own, row in zip(matrix, rows):
        if len(row) == matrix.shape[1]:
            own[:] = row
    matrix[~np.isfinite(matrix).all(axis=1)] = 0
    return clusters.Vectors(matrix)


def _term_positions(settings: Settings) -> Column:
    """Terms of ``clean_text`` as positions. All terms count, whatever their number: they are hashed, so no vocabulary is gathered."""
    tokens = term_tokens(F.col("clean_text"), settings.stop_words)
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(HASHED_TERMS)).cast("int"))


def _weighted(idf: np.ndarray):
    """TF-IDF vectors of lists of positions."""
    def vectors(values: pa.Array) -> clusters.Vectors:
        lists = values.fill_null([])
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        position = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        key, count = np.unique(row * HASHED_TERMS + position, return_counts=True)
        row, position = key // HASHED_TERMS, key % HASHED_TERMS
        ptr = np.searchsorted(row, np.arange(len(lists) + 1))
        return clusters.Vectors(count * idf[position], position, ptr, HASHED_TERMS)

    return vectors


def topic_from_centres(df: DataFrame, centres: np.ndarray, embedding: str = "embedding", quantile: float = TOPIC_QUANTILE) -> DataFrame:
    """Adds ``dominant_topic`` by the nearest of some centres, which are made unit vectors.

    Topics are numbered from 0 by falling size; -1 marks rows without a vector, of small clusters, and
    farther from their centre than ``quantile`` of the cluster's rows.
    """
    unit = centres / np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-300)
    return _assigned(df, F.col(embedding).cast("array<double>"), _dense, unit, quantile)


def _assigned(df: DataFrame, column: Column, vectors, centres: np.ndarray, quantile: float) -> DataFrame:
    found = clusters.with_nearest(df, column, vectors, centres)
    return clusters.with_topics(found, clusters.topic_numbers(found.select("_cluster", "_distance"), quantile), OUTLIER)


def assign_topics(df: DataFrame, settings: Settings = DEFAULT, embedding: str | None = None,
                  quantile: float = TOPIC_QUANTILE, sample: int = clusters.SAMPLE) -> DataFrame:
    """Adds ``dominant_topic``, numbered from 0 by falling size; -1 marks outliers.

    Vectors are TF-IDF of ``clean_text`` or a column of precomputed embeddings. There are as many
    topics as the data have: a tree fitted on about ``sample`` rows cuts a group in two while its
    halves stand apart and neither has fewer than ``max(10, rows / 100)`` messages. All rows go
    to the nearest leaf; small leaves and the rows beyond ``quantile`` of a leaf's distances are
    outliers, and so are rows without a term. Fewer than ``topic_min_rows`` messages, no text with a
    term, or topics switched off give NULL. Runs Spark jobs.
    """
    unassigned = df.withColumn("dominant_topic", F.lit(None).cast("int"))
    enough = settings.enable_topics and (
        df.limit(settings.topic_min_rows).count() >= settings.topic_min_rows)
    if not enough:
        return unassigned
    if embedding:
        column, vectors = F.col(embedding).cast("array<double>"), _dense
        total = df.count()
    else:
        column = _term_positions(settings)
        # A row per position, and one, -1, that counts the texts.
        seen = (df.select(F.explode(F.concat(F.array(F.lit(-1)), F.array_distinct(column))).alias("position"))
                .groupBy("position").agg(F.count(F.lit(1)).alias("n")).collect())
        found = {r.position: r.n for r in seen}
        total = found.pop(-1, 0)
        idf = np.zeros(HASHED_TERMS)
        for position, n in found.items():
            idf[position] = np.log((total + 1) / (n + 1)) if n > 1 else 0.0
        if not idf.any():
            return unassigned
        vectors = _weighted(idf)
    # Vectors of the sample and a hundred centres at most are held here.
    share = min(1.0, sample / max(1, total))
    some = df.select(column.alias("_vector")).sample(share, settings.topic_seed).toArrow().column("_vector").combine_chunks()
    rows = vectors(some)
    least = max(10 * share, rows.count / 100)
    centres = clusters.splitting_tree(rows, least, settings.topic_seed)
    if not len(centres):
        return unassigned
    return _assigned(df, column, vectors, centres, quantile)


def topic_top_words(df: DataFrame, settings: Settings = DEFAULT, min_topics: int = 2) -> DataFrame:
    """``topic_id, term, weight, rank``: the words that set a topic apart.

    weight = tf(t, c) / words(c) * ln(1 + A / f(t)), with A the whole-numbered mean of words
    per topic and f the frequency over all topics. Words of fewer than ``min_topics`` topics
    are left out, outliers count as a topic.
    """
    counts = (df.where(F.col("dominant_topic").isNotNull())
              .select(F.col("dominant_topic").alias("topic_id"),
                      F.explode(term_tokens(F.col("clean_text"), settings.stop_words)).alias("term"))
              .groupBy("topic_id", "term").agg(F.count(F.lit(1)).alias("tf")))
    by_term = Window.partitionBy("term")  # at most one row per topic
    counts = keep_columns(
        counts.withColumns({"f": F.sum("tf").over(by_term), "topics": F.count(F.lit(1)).over(by_term)})
        .where(F.col("topics") >= min_topics))
    words_per_topic = counts.groupBy("topic_id").agg(F.sum("tf").alias("words"))
    mean_words = words_per_topic.agg(F.floor(F.avg("words"))).scalar()
    weighted = counts.join(F.broadcast(words_per_topic), "topic_id").withColumn(
        "weight", F.col("tf") / F.col("words") * F.log(1 + mean_words / F.col("f")))
    best = Window.partitionBy("topic_id").orderBy(F.desc("weight"), "term")
    return (weighted.withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= settings.topic_top_words)
            .select("topic_id", "term", "weight", "rank"))


def topic_words(top_words: DataFrame) -> DataFrame:
    """``topic_id, words``: the ranked words of each topic as an array (bounded by the rank)."""
    return top_words.groupBy("topic_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda w: w["term"]).alias("words"))


def with_topic_keywords(df: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``topic_keywords``: the words of the topic, ``outlier``, or ``''`` without words."""
    lookup = F.broadcast(words.select(F.col("topic_id").alias("dominant_topic"),
                                      F.array_join("words", ", ").alias("_words_joined")))
    topic = F.col("dominant_topic")
    return df.join(lookup, "dominant_topic", "left").withColumn("topic_keywords", F.when(
        topic == OUTLIER, "outlier").when(topic.isNotNull(), F.coalesce("_words_joined", F.lit("")))
    ).select(*df.columns, "topic_keywords")


def topic_names(words: DataFrame) -> DataFrame:
    """``topic_id, top_words``: the first four words in title case."""
    return words.select("topic_id", title_case(
        F.array_join(F.slice("words", 1, 4), ", ")).alias("top_words"))


def topic_summary(df: DataFrame, words: DataFrame) -> DataFrame:
    """Size, mean score and name per topic, ordered by topic."""
    sizes = df.where(F.col("dominant_topic").isNotNull()).groupBy(
        F.col("dominant_topic").alias("topic_id")).agg(
            F.count("id").alias("post_count"), F.avg("sentiment_score").alias("avg_sentiment"))
    named = sizes.join(F.broadcast(topic_names(words)), "topic_id", "left")
    return named.select(
        "topic_id",
        F.when(F.col("topic_id") == OUTLIER, "Miscellaneous / Outliers")
        .otherwise(F.col("top_words")).alias("topic_name"),
        "top_words", "post_count", "avg_sentiment").orderBy("topic_id")


def topic_count(df: DataFrame) -> DataFrame:
    """Number of topics without outliers."""
    return df.agg(F.count_distinct(F.when(
        F.col("dominant_topic") != OUTLIER, F.col("dominant_topic"))).alias("topics"))
