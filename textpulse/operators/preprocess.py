"""Cleaning and filtering of message text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.language import detect_language
from textpulse.functions.plan import compute_once
from textpulse.functions.terms import has_term
from textpulse.functions.text import clean_text, remove_stop_words, truncate_text, words

# Filters in the order they apply.
STAGES = ("deleted", "short", "language", "irrelevant")


def with_original_text(df: DataFrame) -> DataFrame:
    return df.withColumn("original_text", F.coalesce(F.col("text"), F.lit("")))


def filter_deleted(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return df.where(~F.col("original_text").isin(*settings.deleted_markers))


def with_clean_text(df: DataFrame) -> DataFrame:
    return compute_once(df, clean_text=clean_text(F.col("original_text")))


def with_text_length(df: DataFrame) -> DataFrame:
    return df.withColumn("text_length", F.length("original_text"))


def filter_short(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Length is that of the original text, not of the cleaned one."""
    return df.where(F.col("text_length") >= settings.min_text_length)


def with_words(df: DataFrame) -> DataFrame:
    """Word array of ``clean_text``, shared by language, relevance and keyword operators."""
    return compute_once(df, _words=words(F.col("clean_text")))


def _tokens(df: DataFrame):
    return F.col("_words") if "_words" in df.columns else words(F.col("clean_text"))


def with_language(df: DataFrame, settings: Settings = DEFAULT, detector=None) -> DataFrame:
    """``detector``: optional ``Column -> Column`` on clean text, for instance a pandas UDF."""
    text = F.col("clean_text")
    found = detector(text) if detector else detect_language(text, _tokens(df), settings.language_words)
    return compute_once(df, language=found)


def filter_language(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return df.where(F.col("language").isin(*settings.supported_languages))


def with_relevance(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    found = has_term(F.col("clean_text"), _tokens(df), settings.relevance_terms)
    return compute_once(df, is_relevant=found)


def filter_relevance(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_relevant"))


def with_truncated_text(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    limit = settings.max_char_length
    columns = {"clean_text": truncate_text(F.col("clean_text"), limit)}
    out = compute_once(df, **columns, **(
        {"_long": F.length("clean_text") > limit} if "_words" in df.columns else {}))
    if "_words" in df.columns:
        # The words of a text that was not cut are still right.
        out = out.withColumn("_words", F.when(
            F.col("_long"), words(F.col("clean_text"))).otherwise(F.col("_words"))).drop("_long")
    return out


def annotate_stages(df: DataFrame, settings: Settings = DEFAULT, detector=None) -> DataFrame:
    """Every row with its cleaning columns and ``_dropped``, the filter that removes it.

    NULL means kept. Later steps are skipped for rows an earlier one drops.
    """
    df = with_text_length(with_original_text(df))
    df = df.withColumn("_dropped", F.when(
        F.col("original_text").isin(*settings.deleted_markers), "deleted").when(
        F.col("text_length") < settings.min_text_length, "short"))
    kept = F.col("_dropped").isNull()
    df = compute_once(df, clean_text=F.when(kept, clean_text(F.col("original_text"))))
    df = compute_once(df, _words=F.when(kept, words(F.col("clean_text"))))
    text, tokens = F.col("clean_text"), F.col("_words")
    found = detector(text) if detector else detect_language(text, tokens, settings.language_words)
    df = compute_once(df, language=F.when(kept, found))
    kept = kept & F.col("language").isin(*settings.supported_languages)
    df = compute_once(df, is_relevant=F.when(
        kept, has_term(text, tokens, settings.relevance_terms)))
    return df.withColumn("_dropped", F.coalesce(
        F.col("_dropped"),
        F.when(~F.col("language").isin(*settings.supported_languages), "language"),
        F.when(~F.col("is_relevant"), "irrelevant")))


def _stage_columns():
    counts = [F.count_if(F.col("_dropped") == s).alias(f"dropped_{s}") for s in STAGES]
    return [F.count(F.lit(1)).alias("rows_in"), *counts,
            F.count_if(F.col("_dropped").isNull()).alias("rows_kept")]


def stage_counts(df: DataFrame, settings: Settings = DEFAULT, detector=None) -> DataFrame:
    """One row: rows read, rows each filter drops, rows kept. One pass over the input."""
    return annotate_stages(df, settings, detector).agg(*_stage_columns())


def preprocess(df: DataFrame, settings: Settings = DEFAULT, detector=None,
               observation: Observation | None = None, keep_words: bool = False) -> DataFrame:
    """Clean, filter and truncate, in this order:

    deleted markers, length of the original text, language and relevance of the whole
    cleaned text, then truncation. An ``observation`` receives the stage counts from the
    job that runs the plan.
    """
    if observation is not None:
        df = annotate_stages(df, settings, detector)
        df = df.observe(observation, *_stage_columns())
        df = df.where(F.col("_dropped").isNull()).drop("_dropped")
    else:
        df = filter_deleted(with_original_text(df), settings)
        df = filter_short(with_text_length(df), settings)
        df = with_words(with_clean_text(df))
        df = filter_language(with_language(df, settings, detector), settings)
        df = filter_relevance(with_relevance(df, settings))
    df = with_truncated_text(df, settings)
    return df if keep_words else df.drop("_words")


def without_stop_words(df: DataFrame, settings: Settings = DEFAULT,
                       column: str = "clean_text", out: str = "text_without_stop_words") -> DataFrame:
    stops = settings.stop_words + settings.custom_stop_words
    return df.withColumn(out, remove_stop_words(F.col(column), stops))
