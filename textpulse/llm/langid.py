"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textpulse.llm.common import discard, map_batches, raw, stage, table

DIMENSIONS = 1 << 13  # hashed n-gram features
CENTROIDS = 4  # clusters per language
SAMPLE = 2_000  # training documents per language, at most
LANGUAGES = 1_000  # languages, at most
ROUNDS = 12  # k-means rounds
AT_ONCE = 64  # texts whose features are weighted together in training
EDGES = 2.0 ** np.arange(3, 13)  # length classes of the rejection distance, in bytes
SLACK = 0.6  # a document is rejected below so much of the least similarity seen in training
LETTER = regex.compile(r"\p{L}")
#: ASCII letters lower-cased, other ASCII characters to blanks: digits and signs tell no language.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
UNDETERMINED = "und"


def features(text: bytes, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed byte 2- and 3-grams of the words of the whole lower-cased text."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    data = np.frombuffer(b" " + b" ".join(text.translate(LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(dimensions, np.float32)
    pairs = data[:-1] << 8 | data[1:]
    triples = pairs[:-1] << 8 | data[2:] | 1 << 24
    shift = np.uint32(32 - dimensions.bit_length() + 1)
    out = np.zeros(dimensions, np.float32)
    for grams in (pairs, triples):
        out += np.bincount(grams * np.uint32(2654435761) >> shift, minlength=dimensions)
    return out


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one; term frequency enters as its logarithm."""
    weighted = np.log1p(counts)
    weighted *= idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    return weighted


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    floor: np.ndarray  # least similarity that is not rejected, per length class

    def similarity(self, texts: list[bytes]) -> np.ndarray:
        return normalised(np.stack([features(t) for t in texts]), self.idf) @ self.centroids.T


def _vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """A row of length one for each text, made few at a time: the result is the only large array."""
    out = np.empty((len(texts), len(idf)), np.float32)
    for at in range(0, len(texts), AT_ONCE):
        out[at:at + AT_ONCE] = normalised(np.stack([features(t, len(idf)) for t in texts[at:at + AT_ONCE]]), idf)
    return out


def _sum(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of some rows, in order, without a copy of them."""
    total = np.zeros(vectors.shape[1], vectors.dtype)
    for row in rows:
        total += vectors[row]
    return total


def _centroids(vectors: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means; starts from the vector next to the mean and then the farthest ones."""
    mean = vectors.mean(axis=0)
    chosen = [int(np.argmax(vectors @ mean))]
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(np.argmin((vectors @ vectors[chosen].T).max(axis=1))))
    centres = vectors[chosen]
    for _ in range(ROUNDS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([_sum(vectors, np.flatnonzero(nearest == k)) if (nearest == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def length_class(size: int) -> int:
    return int(np.searchsorted(EDGES, size, "right"))


def _snippets(text: bytes) -> list[bytes]:
    """The text and its beginnings in every shorter length class."""
    return [text, *(text[:int(edge)] for edge in EDGES if edge < len(text))]


def _clustered(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of a language, and the least similarity of its training texts per length class."""
    centres = _centroids(_vectors(texts, idf), CENTROIDS)
    floor = np.ones(len(EDGES) + 1)
    for text in texts:
        parts = _snippets(text)
        near = (normalised(np.stack([features(p) for p in parts]), idf) @ centres.T).max(axis=1)
        for part, value in zip(parts, near):
            at = length_class(len(part))
            floor[at] = min(floor[at], value)
    return centres, floor


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on columns text and lang; rows with a null in either take no part.

    The model is fitted on a bounded sample of about ``sample`` documents per language, chosen by
    a hash, the same on each run over the same files. Document frequencies come from the sample
    of all languages. Every language has up to ``CENTROIDS`` centroids, clustered in a task of
    its own.
    """
    counts = labelled.filter("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(len(EDGES) + 1))
    # A hash bound per language that leaves about the sample, so no language is ranked as a whole.
    # The hash is one of the row's place: many copies of one text are drawn like different texts.
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row.lang, F.lit(min(1.0, sample / row.n))).otherwise(share)
    known = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.col("text").cast("string").alias("text"))
    drawn = stage(known.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < share * (1 << 30)))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = sum((features(t) > 0).astype(np.int64) for t in batch.column(0).to_pylist())
        at = np.flatnonzero(seen)
        return pa.record_batch([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["dimension", "df"])

    frequency = map_batches(drawn.select(raw("text")), counted, "dimension int, df long").groupBy("dimension").agg(F.sum("df").alias("df"))
    found = np.zeros(DIMENSIONS)
    for row in frequency.collect():  # at most DIMENSIONS rows
        found[row.dimension] = row.df
    total = sum(min(sample, row.n) for row in counts)
    idf = (np.log((1 + max(total, found.max())) / (1 + found)) + 1).astype(np.float32)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        centres, floor = _clustered([t.encode() for t in group["text"]], idf)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": [c.tolist() for c in centres], "floor": [floor.tolist()] * len(centres)})

    rows = drawn.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, floor array<double>").collect()
    discard(drawn)
    if not rows:
        return Model(idf, np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(len(EDGES) + 1))
    rows.sort(key=lambda r: r.lang)
    floor = np.minimum.reduce([np.array(r.floor) for r in rows])
    floor = np.minimum.accumulate(floor[::-1])[::-1] * SLACK  # a shorter text may always be as far as a longer one
    return Model(idf, np.array([r.centroid for r in rows], np.float32), [r.lang for r in rows], floor)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row of ``docs``.

    lang_pred is the language of the nearest centroid by cosine, ties to the first in order of
    name; score is that cosine. Null texts and texts without a letter get ``und`` and score 0;
    so does every text if the model knows no language. A text is rejected if it is ``und`` or
    farther from every centroid than training documents of its length came, with slack.
    Repeated rows and null ids keep a row each.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # LANGUAGES x CENTROIDS x DIMENSIONS floats at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        learned = shared.value
        n = batch.num_rows
        langs, scores, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
        texts = batch.column(1).to_pylist()
        usable = [i for i, t in enumerate(texts) if t and LETTER.search(t.decode("utf-8", "replace"))] if learned.languages else []
        for at in range(0, len(usable), 256):
            own = usable[at:at + 256]
            near = learned.similarity([texts[i] for i in own])
            best = near.argmax(axis=1)
            for i, k, value in zip(own, best, near[np.arange(len(own)), best]):
                langs[i], scores[i] = learned.languages[k], min(1.0, max(0.0, float(value)))
                rejected[i] = value < learned.floor[length_class(len(texts[i]))]
        return pa.record_batch([batch.column(0), pa.array(langs), pa.array(scores), pa.array(rejected)],
                               ["doc_id", "lang_pred", "score", "rejected"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), raw("text")), run,
                       "doc_id long, lang_pred string, score double, rejected boolean")


def fold(column: str, parts: int) -> Column:
    """Remainder of the checksum of the id as text."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


def trained(docs: DataFrame) -> Model:
    """The model of the documents outside the held-out fold; rows without an id are held out."""
    return fit(docs.filter(fold("doc_id", 3) != 1))


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        learned = shared.value
        out = []
        for text in texts:
            text = bytes(text) if text is not None else b""
            usable = bool(learned.languages) and bool(LETTER.search(text.decode("utf-8", "replace")))
            out.append(usable and float(learned.similarity([text]).max()) >= learned.floor[length_class(len(text))])
        return pd.Series(out, dtype=bool)

    return docs.filter(kept(raw("text")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, trained(docs))
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score", "rejected")
