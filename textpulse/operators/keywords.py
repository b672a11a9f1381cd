"""Keyword flags, categories and lifecycle stage of a message."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.phrases import Phrases
from textpulse.functions.plan import compute_once
from textpulse.functions.terms import (
    has_term, matched_terms, normalize_terms, relevant_words)
from textpulse.functions.text import runs, words

TERMS, CHARACTERS = 200_000, 8 << 20  # of a table of terms that goes to every worker


def _terms(settings: Settings, *lists):
    terms = tuple(t for terms in lists for t in terms)
    return normalize_terms(terms) if settings.normalize_keywords else terms


def _tokens(df: DataFrame, text: str) -> Column:
    return F.col("_words") if "_words" in df.columns else words(F.col(text))


def match_keywords(df: DataFrame, terms, text: str = "clean_text",
                   found: str = "found", matches: str = "matches") -> DataFrame:
    """Whether any term occurs as whole words, and the terms that do, in list order."""
    columns = {matches: matched_terms(F.col(text), _tokens(df, text), terms)}
    return compute_once(df, **columns).withColumn(found, F.size(matches) > 0)


def match_term_table(df: DataFrame, terms: DataFrame, text: str = "clean_text", key: str = "id",
                     found: str = "found", matches: str = "matches") -> DataFrame:
    """As ``match_keywords`` for a table of any number of terms; ``matches`` are in order of the terms.

    Up to ``TERMS`` terms go to every worker, and a text is cut into words once to look up what stands
    in it: no shuffle, whatever the texts share with the terms. More terms meet the texts in joins. No
    term enters the plan; one without a word character, an empty and a NULL one are never found.
    """
    given = terms.select("term").where("term IS NOT NULL").distinct().withColumn("_words", words(F.col("term"))).where(F.size("_words") > 0)
    size = given.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("term")), F.lit(0)).alias("characters")).first()
    if size.n > TERMS or size.characters > CHARACTERS:
        return _joined_terms(df, given, text, key, matches).withColumn(found, F.size(matches) > 0)
    phrases = df.sparkSession.sparkContext.broadcast(Phrases(r.runs for r in given.select(runs(F.col("term")).alias("runs")).collect()))

    @F.arrow_udf("array<string>")
    def held(parts: pa.Array, word_first: pa.Array) -> pa.Array:
        find, values, ends = phrases.value.find, parts.values, parts.offsets.to_pylist()
        return pa.array([find(values.slice(low, high - low).to_numpy(zero_copy_only=False).tolist(), first.as_py())
                         for low, high, first in zip(ends, ends[1:], word_first)], pa.list_(pa.string()))

    value = F.coalesce(F.col(text), F.lit(""))
    rows = compute_once(df, _runs=runs(value), _word_first=F.rlike(value, F.lit(r"(?U)\A\w")))
    return rows.withColumn(matches, held("_runs", "_word_first")).drop("_runs", "_word_first").withColumn(found, F.size(matches) > 0)


def _joined_terms(df: DataFrame, given: DataFrame, text: str, key: str, matches: str) -> DataFrame:
    """``matches`` of terms that are too many for a worker.

    A term is looked for only in texts that hold its rarest word: words of texts and terms meet in
    joins, and a text gets the few candidates that it may hold back by its key, to be verified on the
    text at word borders. Rows of one key are verified one by one.
    """
    parts = given.select("term", F.explode(F.array_distinct("_words")).alias("word"))
    held = df.select(F.col(key).alias("_key"), F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
    # How many rows hold a word, for the words of terms alone.
    common = held.join(parts.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # A term with a word that no text holds is in no text.
    rarest = (parts.join(common, "word", "left").groupBy("term")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("rare"))
              .where("rare.n > 0").select("term", F.col("rare.word").alias("word")))
    candidates = held.join(rarest, "word").groupBy("_key").agg(F.collect_set("term").alias("_terms"))  # bounded by the text's words
    rows = df.join(candidates, F.col(key).eqNullSafe(F.col("_key")), "left")

    def stands(term: Column) -> Column:
        escaped = F.regexp_replace(term, r"([^\w\s])", r"\\$1")
        pattern = F.concat(F.lit(r"(?U)\b"), escaped, F.lit(r"\b"))
        return F.contains(F.col(text), term) & F.rlike(F.col(text), pattern)

    verified = F.array_sort(F.coalesce(F.filter("_terms", stands), F.array().cast("array<string>")))
    return compute_once(rows, **{matches: verified}).drop("_key", "_terms")


def category_column(text: Column, tokens: Column, settings: Settings) -> Column:
    """Names of all categories with a matching term, comma-joined; ``other`` without any."""
    names = F.concat_ws(",", *[
        F.when(has_term(text, tokens, _terms(settings, terms)), F.lit(name))
        for name, terms in settings.search_terms.items()])
    return names


def classify_category(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    names = category_column(F.col("clean_text"), _tokens(df, "clean_text"), settings)
    df = compute_once(df, search_category=names)
    return df.withColumn("search_category", F.when(
        F.col("search_category") == "", "other").otherwise(F.col("search_category")))


def flag_terms(df: DataFrame, out: str, terms, text: str = "clean_text") -> DataFrame:
    return compute_once(df, **{out: has_term(F.col(text), _tokens(df, text), terms)})


def lifecycle_stage(df: DataFrame) -> DataFrame:
    """Recruitment and retention follow the categories, alumni follows plain substrings."""
    text, category = F.col("clean_text"), F.col("search_category")
    return df.withColumns({
        "is_recruitment": category.contains("recruitment"),
        "is_retention": (category.contains("retention") | category.contains("compensation")
                         | F.col("mentions_attrition")),
        "is_alumni": (text.contains("moved back")
                      | (text.contains("after") & text.contains("years"))
                      | (text.contains("left") & text.contains("rural"))),
    })


def flag_keywords(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """All keyword columns, computed from one word array per row."""
    keep_words = "_words" in df.columns
    if not keep_words:
        df = compute_once(df, _words=words(F.col("clean_text")))
    partner = _terms(settings, settings.partner_terms, settings.partner_extra_terms)
    faculty = _terms(settings, settings.faculty_terms, settings.faculty_extra_terms)
    region = _terms(settings, settings.region_terms)
    attrition = _terms(settings, settings.attrition_terms)
    everything = (
        _terms(settings, settings.region_terms, settings.partner_terms, settings.faculty_terms,
               settings.attrition_terms)
        + _terms(settings, settings.partner_extra_terms, settings.faculty_extra_terms))
    categories = tuple(t for terms in settings.search_terms.values() for t in _terms(settings, terms))
    df = df.withColumn("_hits", relevant_words(F.col("_words"), everything + categories))
    text, tokens = F.col("clean_text"), F.col("_hits")
    # A plain projection: flags nobody reads are pruned.
    df = df.withColumns({
        "mentions_oregon": has_term(text, tokens, region),
        "mentions_partner": has_term(text, tokens, partner),
        "mentions_faculty": has_term(text, tokens, faculty),
        "mentions_attrition": has_term(text, tokens, attrition),
        "search_category": category_column(text, tokens, settings),
        "keyword_matches": F.array_join(matched_terms(text, tokens, everything), ",")})
    df = df.withColumn("search_category", F.when(
        F.col("search_category") == "", "other").otherwise(F.col("search_category")))
    df = lifecycle_stage(df)
    ordered = [c for c in df.columns if c not in ("keyword_matches", "_words", "_hits")]
    return df.select(*ordered, "keyword_matches", *(["_words"] if keep_words else []))


def keyword_counts(df: DataFrame) -> DataFrame:
    """Messages that mention the region and a partner."""
    return df.agg(F.count_if("mentions_oregon").alias("oregon_count"),
                  F.count_if("mentions_partner").alias("partner_count"))
