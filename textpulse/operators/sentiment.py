"""Three-class sentiment with a replaceable scorer.

A scorer is a function ``Column -> Column`` from clean text to
``struct<neg double, neu double, pos double>``. The default counts lexicon words in
JVM expressions; :func:`model_scorer` wraps a Python model.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.plan import compute_once
from textpulse.functions.text import SPACE_CHARS, count_in, sentiment_tokens

Scorer = Callable[[Column], Column]
PROBABILITIES = "struct<neg:double,neu:double,pos:double>"
_SMOOTHING = 0.5


def lexicon_scorer(settings: Settings = DEFAULT) -> Scorer:
    """Shares of positive and negative words, smoothed by half a neutral word."""
    def score(text: Column) -> Column:
        # One-element transforms bind the tokens and the counts to names.
        counts = F.transform(F.array(sentiment_tokens(text)), lambda t: F.struct(
            count_in(t, settings.negative_words).cast("double").alias("n"),
            count_in(t, settings.positive_words).cast("double").alias("p")))

        def shares(c):
            total = c["p"] + c["n"] + F.lit(_SMOOTHING)
            return F.struct((c["n"] / total).alias("neg"), (F.lit(_SMOOTHING) / total).alias("neu"),
                            (c["p"] / total).alias("pos"))

        return F.element_at(F.transform(counts, shares), 1)

    return score


def model_scorer(load: Callable[[], Callable[[list[str]], list]], batch_size: int = 32) -> Scorer:
    """Scorer around a Python model.

    ``load()`` runs once per Python worker and returns ``predict(texts)``, which gives one
    (neg, neu, pos) per text. Texts arrive in Arrow batches and are scored ``batch_size`` at
    a time; a failing batch yields NULL, which becomes the neutral default.
    """
    @F.pandas_udf(PROBABILITIES)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load()
        for texts in batches:
            rows = [(None, None, None)] * len(texts)
            used = [i for i, t in enumerate(texts) if t and t.strip()]
            for at in range(0, len(used), batch_size):
                chosen = used[at:at + batch_size]
                try:
                    scores = predict([texts.iloc[i] for i in chosen])
                except Exception:
                    continue
                for i, row in zip(chosen, scores):
                    rows[i] = tuple(float(v) for v in row)
            yield pd.DataFrame(rows, columns=["neg", "neu", "pos"], dtype="float64")

    return lambda text: score(text)


def sentiment_label(neg: Column, neu: Column, pos: Column) -> Column:
    """Class of the largest value; a tie goes to Negative, then Neutral."""
    return (F.when((neg >= neu) & (neg >= pos), "Negative")
            .when(neu >= pos, "Neutral").otherwise("Positive"))


def compound_score(label: Column, confidence: Column) -> Column:
    """Signed confidence; 0 for Neutral."""
    return (F.when(label == "Positive", confidence).when(label == "Negative", -confidence)
            .otherwise(F.lit(0.0)))


def analyze_sentiment(df: DataFrame, settings: Settings = DEFAULT,
                      scorer: Scorer | None = None) -> DataFrame:
    """Adds score, label, confidence and uncertainty. Blank text is Neutral with confidence 0."""
    text = F.coalesce(F.col("clean_text"), F.lit(""))
    blank = F.btrim(text, F.lit(SPACE_CHARS)) == ""
    probabilities = (scorer or lexicon_scorer(settings))(text)
    df = compute_once(df, _probs=F.when(~blank, probabilities))
    neg, neu, pos = (F.col("_probs")[c] for c in ("neg", "neu", "pos"))
    scored = neg.isNotNull() & neu.isNotNull() & pos.isNotNull()
    df = df.withColumns({
        "sentiment_label": F.when(scored, sentiment_label(neg, neu, pos)).otherwise("Neutral"),
        "sentiment_confidence": F.when(scored, F.greatest(neg, neu, pos)).otherwise(F.lit(0.0)),
    }).drop("_probs")
    kept = [c for c in df.columns if c not in (
        "sentiment_score", "sentiment_label", "sentiment_confidence", "sentiment_uncertain")]
    return df.select(
        *kept,
        compound_score(F.col("sentiment_label"), F.col("sentiment_confidence")).alias("sentiment_score"),
        "sentiment_label", "sentiment_confidence",
        (F.col("sentiment_confidence") < settings.confidence_threshold).alias("sentiment_uncertain"))
