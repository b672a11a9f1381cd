"""TF-IDF keywords of negative messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.plan import compute_once, drop_listed


def term_tokens(text: Column, stop_words) -> Column:
    """Runs of two or more word characters, lower-cased, without stop words."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w\w+"), F.lit(0))
    return drop_listed(runs, list(stop_words))


def _occurrences(tokens: Column) -> Column:
    """Every token with a mark on its first occurrence in the row."""
    ordered = F.sort_array(tokens)  # array_sort would run a comparator per pair
    return F.element_at(F.transform(F.array(ordered), lambda sorted_: F.transform(
        sorted_, lambda t, i: F.struct(
            t.alias("term"), F.coalesce(F.get(sorted_, i - 1) != t, F.lit(True)).alias("first")))), 1)


def term_statistics(texts: DataFrame, stop_words) -> DataFrame:
    """``term, total, docs`` per term; the term ``''`` counts rows and non-NULL texts.

    One aggregation with partial sums in the map tasks: memory and shuffle follow the
    vocabulary, not the text.
    """
    text = F.col("clean_text")
    row = F.struct(F.lit("").alias("term"), text.isNotNull().alias("first"))
    occurrences = _occurrences(term_tokens(text, stop_words))
    return (texts.select(F.inline(F.concat(F.array(row), occurrences)))
            .groupBy("term").agg(F.count(F.lit(1)).alias("total"), F.count_if("first").alias("docs")))


def _vocabulary(texts: DataFrame, settings: Settings) -> DataFrame:
    """One row: array of (term, idf), empty for too few texts. Reads the texts once."""
    top = (term_statistics(texts, settings.stop_words)
           # The row that counts the texts comes first, then the most frequent terms.
           .orderBy(F.col("term") != "", F.desc("total"), "term")
           .limit(settings.negative_max_terms + 1)
           .agg(F.collect_list(F.struct("term", "total", "docs")).alias("terms")))
    counted = top.select(
        F.filter("terms", lambda t: t["term"] != "").alias("terms"),
        F.get(F.filter("terms", lambda t: t["term"] == ""), F.lit(0)).alias("texts"))
    idf = F.transform("terms", lambda t: F.struct(
        t["term"].alias("term"),
        (F.log((1 + F.col("texts")["docs"]) / (1 + t["docs"])) + 1).alias("idf")))
    enough = F.coalesce(F.col("texts")["total"] >= settings.negative_min_rows, F.lit(False))
    return counted.select(F.array_sort(F.when(enough, idf).otherwise(F.filter(
        idf, lambda _: F.lit(False)))).alias("vocabulary"))


def negative_keywords(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Top terms of Negative messages by summed, length-normalised TF-IDF.

    The vocabulary is the ``negative_max_terms`` most frequent terms, chosen before idf and
    normalisation. ``frequency`` counts texts that contain the term as a substring. Fewer than
    ``negative_min_rows`` negative messages give no rows.

    The vocabulary enters the second pass as a scalar subquery of bounded size, so term
    counts and norms are worked out inside each row, without a join or a shuffle of texts.
    """
    texts = df.where(F.col("sentiment_label") == "Negative").select("clean_text")
    vocabulary = _vocabulary(texts, settings).scalar()
    rows = texts.where(F.col("clean_text").isNotNull()).select(
        "clean_text", vocabulary.alias("_vocabulary"), vocabulary["term"].alias("_terms"))
    known = F.filter(term_tokens(F.col("clean_text"), settings.stop_words),
                     lambda t: F.array_contains(F.col("_terms"), t))
    rows = compute_once(rows, _known=known)
    weights = F.transform(F.col("_vocabulary"), lambda v: F.struct(
        v["term"].alias("term"),
        (F.size(F.filter(F.col("_known"), lambda t: t == v["term"])) * v["idf"]).alias("weight"),
        F.contains(F.col("clean_text"), v["term"]).alias("found")))
    rows = compute_once(rows, _weights=weights)
    norm = F.sqrt(F.aggregate(F.col("_weights"), F.lit(0.0),
                              lambda acc, w: acc + w["weight"] * w["weight"]))
    rows = compute_once(rows, _norm=norm)
    scored = rows.select("_norm", F.inline("_weights")).select(
        "term", "found", F.when(F.col("_norm") > 0, F.col("weight") / F.col("_norm"))
        .otherwise(F.lit(0.0)).alias("share"))
    return (scored.groupBy("term").agg(F.sum("share").alias("tfidf_score"),
                                       F.count_if("found").alias("frequency"))
            .select(F.col("term").alias("keyword"), "tfidf_score", "frequency",
                    F.lit("negative_tfidf").alias("category"))
            .orderBy(F.desc("tfidf_score"), "keyword"))


def keyword_containment(df: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, term) for every message that contains one of the terms as a substring.

    The terms are a stated query list of any length, not a table that grows with the messages:
    they reach the tasks as one array. Rows fan out only for actual matches.
    """
    listed = terms.agg(F.array_sort(F.collect_set("term")).alias("t")).scalar()
    found = F.filter("_terms", lambda t: F.contains(F.col("clean_text"), t))
    return (df.select("id", "clean_text", listed.alias("_terms"))
            .select("id", F.explode(found).alias("term")))
