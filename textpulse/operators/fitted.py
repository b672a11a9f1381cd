"""A sentiment scorer fitted on labelled texts: TF-IDF and multinomial logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, IDF, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.operators.sentiment import PROBABILITIES, Scorer
from textpulse.operators.tfidf import term_tokens

LABELS = ("Negative", "Neutral", "Positive")
SAMPLE = 20_000  # labelled rows, about, that a fit uses
TERMS = 20_000  # terms of a model, at most
PENALTY = 0.0005


@dataclass
class Model:
    """Weight of every term for each label, and what a text without a known term gets."""

    terms: list[str]
    idf: np.ndarray  # by term
    weights: np.ndarray  # [term, label]
    intercept: np.ndarray  # by label

    def scorer(self, settings: Settings = DEFAULT) -> Scorer:
        """As a scorer of ``analyze_sentiment``. Known terms are weighted by their counts and idf, at length one."""
        known, idf, weights, intercept = pa.array(self.terms, pa.string()), self.idf, self.weights, self.intercept

        @F.arrow_udf(PROBABILITIES)
        def score(tokens: pa.Array) -> pa.Array:
            lists = tokens.fill_null([])
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            code = pc.index_in(lists.flatten(), known).fill_null(-1).to_numpy()
            met = code >= 0
            key, count = np.unique(row[met] * len(idf) + code[met], return_counts=True)
            row, code = (key // len(idf), key % len(idf)) if len(idf) else (key, key)
            value = count * idf[code]
            norm = np.sqrt(np.bincount(row, value * value, len(lists)))
            value = value / np.where(norm > 0, norm, 1)[row]
            total = np.stack([np.bincount(row, value * weights[code, k], len(lists)) for k in range(3)], 1) + intercept
            shares = np.exp(total - total.max(axis=1, keepdims=True))
            shares /= shares.sum(axis=1, keepdims=True)
            return pa.StructArray.from_arrays([pa.array(shares[:, k]) for k in range(3)], ["neg", "neu", "pos"])

        return lambda text: score(term_tokens(text, settings.stop_words))

    def table(self, spark: SparkSession) -> DataFrame:
        """``term, idf, neg, neu, pos``; the row without a term has the intercepts."""
        rows = [(None, None, *map(float, self.intercept))]
        rows += [(t, float(i), *map(float, w)) for t, i, w in zip(self.terms, self.idf, self.weights)]
        return spark.createDataFrame(rows, "term string, idf double, neg double, neu double, pos double")

    @classmethod
    def of(cls, table: DataFrame) -> Model:
        """The model in a table of at most ``TERMS`` terms."""
        found = table.limit(TERMS + 2).collect()
        if len(found) > TERMS + 1:
            raise ValueError(f"more than {TERMS} terms")
        rows = sorted((r for r in found if r.term is not None), key=lambda r: r.term)
        last = next((r for r in found if r.term is None), None)
        weights = np.array([(r.neg, r.neu, r.pos) for r in rows], float).reshape(len(rows), 3)
        return cls([r.term for r in rows], np.array([r.idf for r in rows], float), weights,
                   np.array([last.neg, last.neu, last.pos] if last else [0.0] * 3))

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        return cls.of(spark.read.parquet(path))


def fit(df: DataFrame, settings: Settings = DEFAULT, sample: int = SAMPLE, label: str = "label") -> Model:
    """A model of the texts in ``clean_text`` whose ``label`` is one of ``LABELS``; other rows are left out.

    Fitted on about ``sample`` rows and the ``TERMS`` terms that most of them hold; a label that no row
    has is never given. Rows without any label raise ValueError.
    """
    number = F.coalesce(*[F.when(F.col(label) == name, float(i)) for i, name in enumerate(LABELS)])
    rows = df.select(number.alias("label"), term_tokens(F.col("clean_text"), settings.stop_words).alias("tokens")).where("label IS NOT NULL")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if not sizes:
        raise ValueError("no labelled rows")
    some = rows.sample(min(1.0, sample / sum(sizes.values())), settings.topic_seed).cache()
    try:
        counted = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=TERMS, minDF=2).fit(some)
        weighted = IDF(inputCol="counts", outputCol="weighted").fit(counted.transform(some))
        features = Normalizer(inputCol="weighted", outputCol="features").transform(weighted.transform(counted.transform(some)))
        model = LogisticRegression(family="multinomial", regParam=PENALTY, maxIter=60).fit(features.select("label", "features"))
    finally:
        some.unpersist()
    weights, intercept = np.zeros((len(counted.vocabulary), 3)), np.full(3, -1e3)
    for k in range(model.numClasses):
        if k in {int(s) for s in sizes}:
            weights[:, k] = model.coefficientMatrix.toArray()[k]
            intercept[k] = model.interceptVector[k]
    return Model(list(counted.vocabulary), np.asarray(weighted.idf.toArray()), weights, intercept)
