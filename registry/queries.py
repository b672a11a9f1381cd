"""One Spark query per operator, each over whole tables.

Doubles are rounded and times written as text so that engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from registry import data
from registry.data import RUN_TS, SETTINGS
from textpulse.functions import text
from textpulse.functions.spans import is_whitelisted
from textpulse.operators import (
    fitted, insights, joins, keywords, monthly, pii, preprocess, sentiment, stats, tfidf, threads, topics)
from textpulse.schemas import PROCESSED
from textpulse.session import new_folder, stage
from textpulse.sources import items as item_source, keyed, ledger, runs, sinks
from textpulse.streaming import incremental as stream, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TIME = "yyyy-MM-dd HH:mm:ss"


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(column: str | Column, places: int = 6) -> Column:
    # Adding zero turns -0.0 into 0.0.
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, places) + F.lit(0.0)


def as_text(column: str) -> Column:
    return F.date_format(column, TIME)


_folder = new_folder


# --- sources ------------------------------------------------------------------------------

@query
def src_items(spark, sf):
    path = _folder(spark, "landing")
    data.item_lines(data.items(spark, sf)).select("value").write.text(path)
    read = item_source.read_items(spark, path)
    return read.select(
        "id", "title", "body", F.try_variant_get("createdAt", "$", "bigint").alias("created_at"), F.col("upVotes").alias("up_votes"),
        F.col("downVotes").alias("down_votes"), F.col("subredditName").alias("subreddit"), "url", "author",
        (F.length("comments") > 2).alias("has_comments"))


@query
def landing_threads(spark, sf):
    """Landing files to messages: lines read raw, comments flattened."""
    path = _folder(spark, "landing")
    data.item_lines(data.items(spark, sf)).select("value").write.text(path)
    flat = threads.flatten_threads(item_source.read_items(spark, path), item_source.ORDER)
    order = Window.partitionBy(*item_source.ORDER).orderBy("place")
    return flat.select(F.row_number().over(order).cast("long").alias("position"), "id", "parent_id", "text", "score", "subreddit", "type",
                       F.try_variant_get("timestamp", "$", "bigint").alias("created_at"))


@query
def landing_arrays(spark, sf):
    """As ``landing_threads`` from files that hold an array of items each, read in splits."""
    def arrays(batches):
        gap = "["
        for batch in batches:
            lines = batch.column("value").to_pylist()
            yield pa.record_batch([pa.array([(gap if i == 0 else ",") + line for i, line in enumerate(lines)], pa.string())], ["value"])
            gap = "," if lines else gap
        yield pa.record_batch([pa.array(["[]" if gap == "[" else "]"], pa.string())], ["value"])

    path = _folder(spark, "landing")
    data.item_lines(data.items(spark, sf)).select("value").mapInArrow(arrays, "value string").write.text(path)
    flat = threads.flatten_threads(item_source.read_items(spark, path, multi_line=True), item_source.ORDER)
    order = Window.partitionBy(*item_source.ORDER).orderBy("place")
    return flat.select(F.row_number().over(order).cast("long").alias("position"), "id", "parent_id", "text", "score", "subreddit", "type",
                       F.try_variant_get("timestamp", "$", "bigint").alias("created_at"))


@query
def src_processed(spark, sf):
    df = pii.redact_pii(data.flagged(spark, sf), SETTINGS)
    path = _folder(spark, "processed")
    public = sinks.public_columns(df)
    sinks.write_csv(public, path)
    return item_source.read_processed_csv(spark, path).select(
        "id", "clean_text", rounded("sentiment_score").alias("sentiment_score"), "sentiment_label",
        "search_category", "year_month", as_text("timestamp").alias("ts"))


@query
def file_md5(spark, sf):
    return runs.file_md5(spark, sf, "*.parquet").select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length", "md5")


# Every writer, read back from its files.

@query
def sink_main(spark, sf):
    out = _folder(spark, "out")
    sinks.write_main(pii.redact_pii(data.flagged(spark, sf), SETTINGS), out)
    table = spark.read.schema(PROCESSED).parquet(f"{out}/{sinks.MAIN}.parquet")
    again = item_source.read_processed_csv(spark, f"{out}/{sinks.MAIN}.csv").select("id", F.col("sentiment_label").alias("csv_label"))
    return table.join(again, "id").select("id", "year_month", "sentiment_label", "csv_label", rounded("sentiment_score").alias("sentiment_score"))


@query
def sink_monthly(spark, sf):
    out = _folder(spark, "out")
    sinks.write_monthly(_monthly(spark, sf), out)
    back = spark.read.csv(f"{out}/{sinks.MONTHLY}.csv", header=True)
    return back.select("year_month", *[F.col(c).cast("long").alias(c) for c in ("year", "month", "total_posts")],
                       *[rounded(F.col(f"{s}_sentiment").cast("double")).alias(f"{s}_sentiment") for s in ("avg", "median", "std")],
                       *[F.col(c).cast("long").alias(c) for c in ("oregon_mentions", "partner_mentions")])


@query
def sink_negative_keywords(spark, sf):
    out = _folder(spark, "out")
    df = stage(data.scored(spark, sf).select("clean_text", "sentiment_label"))
    sinks.write_negative_keywords(tfidf.negative_keywords(df, SETTINGS), out)
    back = spark.read.csv(f"{out}/{sinks.NEGATIVE}.csv", header=True)
    return back.select("keyword", rounded(F.col("tfidf_score").cast("double"), 4).alias("tfidf_score"),
                       F.col("frequency").cast("long").alias("frequency"), "category")


@query
def sink_audit(spark, sf):
    out = _folder(spark, "out")
    sinks.write_audit(pii.pii_audit(data.protected(spark, sf), RUN_TS), out)
    back = spark.read.csv(f"{out}/{sinks.AUDIT}.csv", header=True)
    return back.select("post_id", "entity_type", F.col("start_position").cast("long").alias("start_position"),
                       F.col("end_position").cast("long").alias("end_position"), F.col("confidence").cast("double").alias("confidence"),
                       as_text("timestamp").alias("detected_at"))


@query
def sink_topics(spark, sf):
    out = _folder(spark, "out")
    df = stage(data.with_topics(data.scored(spark, sf)).select("id", "clean_text", "dominant_topic", "sentiment_score"))
    sinks.write_topic_summary(topics.topic_summary(df, _topic_words(df)), out)
    back = spark.read.csv(f"{out}/{sinks.TOPICS}.csv", header=True)
    return back.select(F.col("topic_id").cast("long").alias("topic_id"), "topic_name", "top_words", F.col("post_count").cast("long").alias("post_count"),
                       rounded(F.col("avg_sentiment").cast("double")).alias("avg_sentiment"))


@query
def sink_history(spark, sf):
    """A line for each language, with its number of documents."""
    out = _folder(spark, "out")
    sizes = data.table(spark, sf, "documents").groupBy("lang").count().orderBy("lang").collect()
    for r in sizes:
        sinks.append_run(spark, out, f"run {r.lang}", r["count"] >= 100, r["count"], None if r["count"] >= 100 else "too few")
    return runs.run_history(spark, out).select("timestamp", "success", "records_processed", "error")


@query
def sink_insights(spark, sf):
    out = _folder(spark, "out")
    sinks.write_insights(insights.parse_insights(_responses(spark, sf)), out)
    back = spark.read.csv(f"{out}/{sinks.INSIGHTS}.csv", header=True)
    return back.select("post_id", "primary_complaint", "quotable_line", *[F.col(c).cast("boolean").alias(c) for c in (
        "mentions_leaving", "mentions_rural", "mentions_partner")], F.col("severity").cast("long").alias("severity"))


# --- threads and timestamps ---------------------------------------------------------------

@query
def flatten_threads(spark, sf):
    flat = threads.flatten_threads(data.items(spark, sf), ("doc_id",))
    position = F.row_number().over(Window.partitionBy("doc_id").orderBy("place")).cast("long")
    return flat.select(
        "doc_id", position.alias("position"), "id", "parent_id", "text", "score", "subreddit", "type",
        F.try_variant_get("timestamp", "$", "bigint").alias("created_at"))


@query
def dedupe_first(spark, sf):
    rows = data.messages(spark, sf).select(
        F.md5("text").alias("id"), F.col("id").cast("long").alias("doc_id"), "subreddit", "text")
    return threads.dedupe_first(
        rows.withColumn("_order", F.col("doc_id")), ("_order",)).select("id", "doc_id", "subreddit")


def _raw_times(spark, sf):
    ts = F.col("ts").cast("timestamp")
    raw = (F.when(F.col("event_type") == "click", F.unix_seconds(ts).cast("string"))
           .when(F.col("event_type") == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(F.col("event_type") == "purchase", F.date_format(ts, "yyyyMMdd"))
           .when(F.col("event_type") == "signup", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
           .otherwise(F.col("props")))
    return data.table(spark, sf, "events").select("event_id", "event_type", raw.alias("timestamp"))


@query
def parse_ts(spark, sf):
    return threads.parse_timestamps(_raw_times(spark, sf)).select("event_id", as_text("timestamp").alias("ts"))


@query
def parse_ts_shapes(spark, sf):
    return threads.parse_timestamps(data.time_texts(spark, sf)).select("event_id", as_text("timestamp").alias("ts"))


@query
def unreadable_ts(spark, sf):
    return threads.unreadable_timestamps(data.time_texts(spark, sf))


@query
def impute_ts(spark, sf):
    df = threads.impute_timestamps(threads.parse_timestamps(_raw_times(spark, sf)), RUN_TS)
    return df.select("event_id", as_text("timestamp").alias("ts"), "timestamp_imputed")


@query
def since_filter(spark, sf):
    events = data.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return threads.since_filter(events, datetime(2024, 1, 15, 12), "ts").select("event_id", "user_id", "event_type")


@query
def volume_gate(spark, sf):
    df = threads.require_rows(data.messages(spark, sf), SETTINGS.min_results)
    return df.agg(F.count(F.lit(1)).alias("rows"))


# --- text ---------------------------------------------------------------------------------

@query
def filter_deleted(spark, sf):
    """Every seventh document is a marker of deleted text, every eleventh has none."""
    marked = data.messages(spark, sf).withColumn("text", F.when(F.col("id").cast("long") % 14 == 0, "[deleted]").when(
        F.col("id").cast("long") % 7 == 0, "[removed]").when(F.col("id").cast("long") % 11 != 0, F.col("text")))
    df = preprocess.with_original_text(marked)
    return preprocess.filter_deleted(df, SETTINGS).select("id", F.length("original_text").cast("long").alias("chars"))


@query
def clean_text(spark, sf):
    return data.cleaned(spark, sf).select("id", "clean_text")


@query
def clean_html(spark, sf):
    pages = data.table(spark, sf, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("text"))
    return preprocess.with_clean_text(preprocess.with_original_text(pages)).select("page_id", "clean_text")


@query
def filter_short(spark, sf):
    df = preprocess.with_text_length(preprocess.with_original_text(data.messages(spark, sf)))
    return preprocess.filter_short(df, SETTINGS).select("id", F.col("text_length").cast("long").alias("text_length"))


@query
def detect_language(spark, sf):
    return preprocess.with_language(data.cleaned(spark, sf), SETTINGS).select("id", "language")


@query
def filter_language(spark, sf):
    df = preprocess.with_language(data.cleaned(spark, sf), SETTINGS)
    return preprocess.filter_language(df, SETTINGS).select("id", "language")


@query
def filter_relevance(spark, sf):
    df = preprocess.with_relevance(data.cleaned(spark, sf), SETTINGS)
    return preprocess.filter_relevance(df).select("id", "is_relevant")


@query
def truncate_text(spark, sf):
    return preprocess.with_truncated_text(data.cleaned(spark, sf), SETTINGS).select("id", "clean_text")


@query
def preprocess_messages(spark, sf):
    return data.preprocessed(spark, sf).select(
        "id", F.col("text_length").cast("long").alias("text_length"), "language", "is_relevant", "clean_text")


@query
def stage_counts(spark, sf):
    return preprocess.stage_counts(data.messages(spark, sf), SETTINGS)


@query
def remove_stopwords(spark, sf):
    return preprocess.without_stop_words(data.cleaned(spark, sf), SETTINGS).select(
        "id", F.col("text_without_stop_words").alias("kept"))


# --- keywords -----------------------------------------------------------------------------

@query
def keyword_match(spark, sf):
    terms = ("the", "on", "on the", "of the", "the of", "With", "from", "to be")
    df = keywords.match_keywords(data.cleaned(spark, sf), terms)
    return df.select("id", "found", F.array_join("matches", "|").alias("matches"))


@query
def keyword_table(spark, sf):
    """All words and neighbouring pairs of words of the benchmark as terms."""
    parts = text.words(F.col("clean_text"))
    items = data.table(spark, sf, "benchmark").select(text.clean_text(F.col("text")).alias("clean_text"))
    pairs = F.zip_with(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 2, F.size(parts)), lambda a, b: F.concat_ws(" ", a, b))
    terms = items.select(F.explode(F.concat(parts, pairs)).alias("term"))
    df = keywords.match_term_table(data.cleaned(spark, sf), terms)
    return df.select("id", "found", F.size("matches").cast("long").alias("n"), F.md5(F.array_join("matches", "|")).alias("matches"))


def _flag(name):
    return lambda spark, sf: keywords.flag_keywords(data.cleaned(spark, sf), SETTINGS).select("id", name)


QUERIES["flag_region"] = _flag("mentions_oregon")
QUERIES["flag_partner"] = _flag("mentions_partner")
QUERIES["flag_faculty"] = _flag("mentions_faculty")
QUERIES["flag_attrition"] = _flag("mentions_attrition")
QUERIES["classify_category"] = _flag("search_category")
QUERIES["keyword_matches"] = _flag("keyword_matches")


@query
def lifecycle_stage(spark, sf):
    """Every fifth text ends in a phrase of former members; some hold only half of one."""
    phrases = F.array(*[F.lit(p) for p in data.ALUMNI_PHRASES])
    number = F.col("id").cast("long")
    df = data.cleaned(spark, sf).withColumn("clean_text", F.when(number % 5 == 0, F.concat_ws(
        " ", "clean_text", F.get(phrases, (number / 5 % len(data.ALUMNI_PHRASES)).cast("int")))).otherwise(F.col("clean_text")))
    return keywords.flag_keywords(df, SETTINGS).select("id", "is_recruitment", "is_retention", "is_alumni")


@query
def keyword_counts(spark, sf):
    return keywords.keyword_counts(keywords.flag_keywords(data.cleaned(spark, sf), SETTINGS))


# --- sentiment ----------------------------------------------------------------------------

@query
def sentiment_score(spark, sf):
    p = sentiment.lexicon_scorer(SETTINGS)(F.col("clean_text"))
    df = data.cleaned(spark, sf).select("id", p.alias("p"))
    return df.select("id", *[rounded(F.col("p")[c]).alias(c) for c in ("neg", "neu", "pos")])


@query
def sentiment_batched(spark, sf):
    """Scores of a model that gets texts in batches, and fails on a batch with a very long text."""
    def load():
        def predict(texts):
            if any(len(t) > 15_000 for t in texts):
                raise MemoryError("too long")
            counts = [(t.count("e"), t.count("a") + 1, t.count("o")) for t in texts]
            return [tuple(v / sum(c) for v in c) for c in counts]
        return predict

    df = data.cleaned(spark, sf)
    out = sentiment.analyze_sentiment(df, SETTINGS, sentiment.model_scorer(load, batch_size=1))
    return out.select("id", rounded("sentiment_score").alias("sentiment_score"), "sentiment_label")


@query
def sentiment_label(spark, sf):
    return data.scored(spark, sf).select("id", "sentiment_label")


@query
def compound_score(spark, sf):
    return data.scored(spark, sf).select("id", rounded("sentiment_score").alias("sentiment_score"))


@query
def sentiment_uncertain(spark, sf):
    return data.scored(spark, sf).select(
        "id", rounded("sentiment_confidence").alias("sentiment_confidence"), "sentiment_uncertain")


@query
def sentiment_blank(spark, sf):
    """Every third text keeps its line breaks and spaces alone: blank input is Neutral, the rest is scored."""
    df = data.cleaned(spark, sf).withColumn("clean_text", F.when(
        F.col("id").cast("long") % 3 == 0, F.regexp_replace("text", r"[^ \n]", "")).otherwise(F.col("clean_text")))
    return sentiment.analyze_sentiment(df, SETTINGS).select(
        "id", rounded("sentiment_score").alias("sentiment_score"), "sentiment_label",
        rounded("sentiment_confidence").alias("sentiment_confidence"), "sentiment_uncertain")


# --- personal data ------------------------------------------------------------------------

@query
def pii_spans(spark, sf):
    df = preprocess.with_original_text(data.messages(spark, sf))
    df = pii.with_spans(df, replace(SETTINGS, pii_whitelist=()))
    return df.select("id", F.inline("pii_spans")).select(
        "id", "entity_type", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "confidence")


@query
def pii_gazetteer(spark, sf):
    """Spans of all five types: patterns, and names of the tables themselves."""
    plain = replace(SETTINGS, pii_whitelist=(), given_names=(), place_names=())
    both = pii.several(pii.pattern_detector(plain), pii.gazetteer_detector(data.gazetteer(spark, sf)))
    return pii.with_spans(data.letters(spark, sf), plain, both).select("id", F.inline("pii_spans")).select(
        "id", "entity_type", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "confidence")


@query
def pii_whitelist(spark, sf):
    df = pii.with_spans(preprocess.with_original_text(data.messages(spark, sf)), SETTINGS)
    return df.select("id", F.inline("pii_spans")).select(
        "id", "entity_type", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query
def pii_whitelisted_words(spark, sf):
    """The whitelist test on every line of a document, as substrings and as whole words."""
    lines = data.table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.select("doc_id", F.col("n").cast("long").alias("line_no"), *[
        is_whitelisted(F.col("line"), ("er", "the resident", "dr. house"), m).alias(m) for m in ("substring", "word")])


@query
def sentiment_fitted(spark, sf):
    """Scores of a fitted model's form: weights by a rule for the most frequent terms, saved and loaded."""
    df = stage(data.preprocessed(spark, sf).select("id", "clean_text"))
    top = (tfidf.term_statistics(df, SETTINGS.stop_words).where(F.col("term") != "").orderBy(F.desc("total"), "term").limit(300)
           .select("term", (F.lit(1.0) + 1 / F.col("docs")).alias("idf"), (F.length("term") % 3 - 1).cast("double").alias("neg"),
                   (F.ascii("term") % 5 / 4.0).alias("neu"), (F.length("term") % 4 - 1.5).cast("double").alias("pos")))
    end = spark.range(1).select(F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"),
                                F.lit(0.1).alias("neg"), F.lit(-0.2).alias("neu"), F.lit(0.0).alias("pos"))
    path = _folder(spark, "model")
    fitted.Model.of(top.union(end)).save(spark, path)
    out = sentiment.analyze_sentiment(df, SETTINGS, fitted.Model.load(spark, path).scorer(SETTINGS))
    return out.select("id", rounded("sentiment_score").alias("sentiment_score"), "sentiment_label",
                      rounded("sentiment_confidence").alias("sentiment_confidence"))


@query
def redact_text(spark, sf):
    return data.protected(spark, sf).select("id", "redacted_text")


@query
def pii_summary(spark, sf):
    return data.protected(spark, sf).select(
        "id", "pii_detected", "pii_types", F.col("pii_count").cast("long").alias("pii_count"))


@query
def pii_audit(spark, sf):
    return pii.pii_audit(data.protected(spark, sf), RUN_TS).select(
        "post_id", "entity_type", F.col("start_position").cast("long").alias("start_position"),
        F.col("end_position").cast("long").alias("end_position"), "confidence",
        as_text("timestamp").alias("detected_at"))


@query
def pii_posts(spark, sf):
    return pii.pii_posts(pii.pii_audit(data.protected(spark, sf), RUN_TS))


# --- topics -------------------------------------------------------------------------------

def _embedded(spark, sf):
    return data.table(spark, sf, "embeddings")


@query
def topic_assign(spark, sf):
    df = topics.assign_topics(_embedded(spark, sf), SETTINGS, embedding="embedding")
    return df.select("vec_id", "label", "dominant_topic")


def _by_centres(spark, sf):
    """Vectors with the topic of the nearest of five of them."""
    df = _embedded(spark, sf)
    centres = np.array([r.embedding for r in df.where("vec_id < 5").orderBy("vec_id").collect()], float)
    return topics.topic_from_centres(df, centres)


@query
def topic_from_centres(spark, sf):
    return _by_centres(spark, sf).select("vec_id", "label", "dominant_topic")


@query
def topic_chain(spark, sf):
    """Topics of vectors, then words, names and sizes of these topics from the documents that share their ids."""
    assigned = stage(_by_centres(spark, sf).select(F.col("vec_id").cast("string").alias("id"), "dominant_topic"))
    df = stage(data.scored(spark, sf).select("id", "clean_text", "sentiment_score").join(assigned, "id"))
    return topics.topic_summary(df, _topic_words(df)).select(
        F.col("topic_id").cast("long").alias("topic_id"), "topic_name", "top_words", "post_count",
        rounded("avg_sentiment").alias("avg_sentiment"))


@query
def topic_assign_text(spark, sf):
    df = stage(data.preprocessed(spark, sf).select("id", "clean_text"))
    return topics.assign_topics(df, SETTINGS).select("id", "dominant_topic")


@query
def topic_count(spark, sf):
    return topics.topic_count(data.with_topics(data.preprocessed(spark, sf)))


@query
def topic_top_words(spark, sf):
    best = topics.topic_top_words(data.with_topics(data.preprocessed(spark, sf)), SETTINGS)
    return best.select(F.col("topic_id").cast("long").alias("topic_id"), "term",
                       rounded("weight").alias("weight"), F.col("rank").cast("long").alias("rank"))


def _topic_words(df):
    return topics.topic_words(topics.topic_top_words(df, SETTINGS))


@query
def topic_keywords(spark, sf):
    df = stage(data.with_topics(data.preprocessed(spark, sf)).select("id", "clean_text", "dominant_topic"))
    return topics.with_topic_keywords(df, _topic_words(df)).select("id", "topic_keywords")


@query
def topic_names(spark, sf):
    df = stage(data.with_topics(data.preprocessed(spark, sf)).select("id", "clean_text", "dominant_topic"))
    return topics.topic_names(_topic_words(df)).select(
        F.col("topic_id").cast("long").alias("topic_id"), "top_words")


@query
def topic_summary(spark, sf):
    df = stage(data.with_topics(data.scored(spark, sf)).select(
        "id", "clean_text", "dominant_topic", "sentiment_score"))
    return topics.topic_summary(df, _topic_words(df)).select(
        F.col("topic_id").cast("long").alias("topic_id"), "topic_name", "top_words", "post_count",
        rounded("avg_sentiment").alias("avg_sentiment"))


# --- calendar, aggregates, windows --------------------------------------------------------

@query
def calendar_cols(spark, sf):
    return monthly.with_calendar(data.messages(spark, sf), SETTINGS).select(
        "id", as_text("timestamp_pacific").alias("local_time"), "year_month",
        F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "day_of_week")


def _monthly(spark, sf):
    return monthly.monthly_sentiment(data.flagged(spark, sf), SETTINGS)


@query
def monthly_sentiment(spark, sf):
    return _monthly(spark, sf).select(
        "year_month", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"),
        "total_posts", *[rounded(f"{s}_sentiment").alias(f"{s}_sentiment") for s in ("avg", "median", "std")],
        "oregon_mentions", "partner_mentions")


@query
def monthly_label_counts(spark, sf):
    return _monthly(spark, sf).select("year_month", "positive_count", "negative_count", "neutral_count")


@query
def monthly_pct_negative(spark, sf):
    return _monthly(spark, sf).select("year_month", rounded("pct_negative").alias("pct_negative"))


def _order_messages(spark, sf):
    """Orders as scored messages: a large table with many months."""
    score = (F.col("o_totalprice") % 2000) / 1000 - 1
    return data.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        score.alias("sentiment_score"),
        F.when(score < 0, "Negative").otherwise("Positive").alias("sentiment_label"),
        (F.col("o_orderstatus") == "P").alias("mentions_oregon"),
        F.col("o_orderpriority").startswith("1").alias("mentions_partner"))


@query
def monthly_orders(spark, sf):
    return monthly.monthly_sentiment(_order_messages(spark, sf), SETTINGS).select(
        "year_month", "total_posts",
        *[rounded(f"{s}_sentiment").alias(f"{s}_sentiment") for s in ("avg", "median", "std")],
        "oregon_mentions", "partner_mentions", "positive_count", "negative_count")


@query
def monthly_state(spark, sf):
    """The series of three batches that were added to a stored state, one of them twice."""
    path, rows = _folder(spark, "state"), _order_messages(spark, sf)
    for batch in (0, 1, 1, 2):
        state.add_batch(spark, rows.where(F.pmod(F.col("id").cast("long"), F.lit(3)) == batch), path, batch)
    return state.monthly_series(spark, path, SETTINGS).select(
        "year_month", "total_posts",
        # The scores have five digits, so means may lie halfway between two of six: both engines round them up.
        *[rounded(F.col(f"{s}_sentiment") + 1e-9).alias(f"{s}_sentiment") for s in ("avg", "median", "std", "rolling_3mo")],
        "oregon_mentions", "partner_mentions", "positive_count", "negative_count")


def _rolling(months):
    column = f"rolling_{months}mo_sentiment"
    return lambda spark, sf: monthly.monthly_sentiment(_order_messages(spark, sf), SETTINGS).select(
        "year_month", rounded(column).alias(column))


for _months in monthly.ROLLING:
    QUERIES[f"rolling_{_months}mo"] = _rolling(_months)


@query
def complete_months(spark, sf):
    """Only months whose orders exceed the mean volume stay; the gaps come back as rows."""
    full = monthly.monthly_sentiment(_order_messages(spark, sf), SETTINGS)
    busy = full.withColumn("_mean", F.avg("total_posts").over(Window.partitionBy())).where(
        F.col("total_posts") > F.col("_mean")).drop("_mean")
    return monthly.complete_months(busy).select(
        "year_month", "total_posts", rounded("rolling_3mo_sentiment").alias("rolling_3mo_sentiment"))


@query
def negative_keywords(spark, sf):
    df = stage(data.scored(spark, sf).select("clean_text", "sentiment_label"))
    return tfidf.negative_keywords(df, SETTINGS).select(
        "keyword", rounded("tfidf_score", 4).alias("tfidf_score"), "frequency", "category")


@query
def vocabulary(spark, sf):
    """The most frequent terms of all cleaned texts."""
    stats_ = tfidf.term_statistics(data.cleaned(spark, sf), SETTINGS.stop_words)
    return (stats_.where(F.col("term") != "").orderBy(F.desc("total"), "term")
            .limit(SETTINGS.negative_max_terms))


@query
def run_stats(spark, sf):
    return stats.run_stats(pii.redact_pii(data.flagged(spark, sf), SETTINGS))


@query
def run_metadata(spark, sf):
    df = pii.redact_pii(data.flagged(spark, sf), SETTINGS)
    meta = stats.run_metadata(df, datetime(2024, 7, 1, 3, 4, 5), SETTINGS)
    return meta.select("run_timestamp", "run_timestamp_pacific", "records_final", "version",
                       F.col("statistics.positive_pct").alias("positive_pct"),
                       F.col("statistics.pii_redacted_count").alias("pii_redacted_count"))


# --- top-k and deep analysis --------------------------------------------------------------

@query
def top_negative(spark, sf):
    top = insights.top_negative(data.scored(spark, sf), 100, settings=SETTINGS)
    return top.select("id", rounded("sentiment_score").alias("sentiment_score"))


@query
def batch_numbers(spark, sf):
    top = insights.number_batches(insights.top_negative(data.scored(spark, sf), 100, settings=SETTINGS))
    return top.select("id", F.col("rank").cast("long").alias("rank"), F.col("batch").cast("long").alias("batch"))


@query
def prompt_batches(spark, sf):
    top = insights.number_batches(insights.top_negative(data.scored(spark, sf), 100, settings=SETTINGS))
    return insights.prompt_batches(top, SETTINGS, head="HEAD", tail="TAIL").select(
        F.col("batch").cast("long").alias("batch"), "posts", "prompt")


@query
def model_calls(spark, sf):
    def connect():
        """A stand-in for a model: one object per post of the prompt."""
        import json
        import re

        def answer(prompt):
            ids = re.findall(r"POST_ID: (\S+)", prompt)
            return json.dumps([{"post_id": i, "primary_complaint": "other", "severity": 1 + int(i) % 5} for i in ids])
        return answer

    top = insights.number_batches(insights.top_negative(data.scored(spark, sf), 100, settings=SETTINGS))
    answers = insights.call_model(insights.prompt_batches(top, SETTINGS), connect, 2)
    return insights.parse_insights(answers).select(
        "post_id", "primary_complaint", F.col("severity").cast("long").alias("severity"))


def _responses(spark, sf):
    """One response per document: fenced, bare, a lone object, or prose."""
    kinds = F.array(*[F.lit(c) for c in insights.COMPLAINTS])
    doc = F.struct(
        F.col("doc_id").cast("string").alias("post_id"),
        F.element_at(kinds, (F.length("text") % 8 + 1).cast("int")).alias("primary_complaint"),
        F.col("source").alias("quotable_line"),
        (F.length("text") % 2 == 0).alias("mentions_leaving"),
        (F.col("lang") == "en").alias("mentions_rural"),
        (F.length("text") % 5 + 1).alias("severity"))
    body = F.to_json(F.array(doc))
    response = (F.when(F.col("lang") == "en", F.concat(F.lit("```json\n"), body, F.lit("\n```\n")))
                .when(F.col("lang") == "de", F.concat(F.lit("  "), body))
                .when(F.col("lang") == "es", F.to_json(doc))
                .otherwise(F.col("text")))
    return data.table(spark, sf, "documents").select("doc_id", response.alias("response"))


@query
def parse_insights(spark, sf):
    rows = insights.parse_insights(_responses(spark, sf))
    return rows.select("post_id", "primary_complaint", "quotable_line", "mentions_leaving",
                       "mentions_rural", "mentions_partner", F.col("severity").cast("long").alias("severity"))


@query
def complaint_counts(spark, sf):
    return insights.complaint_counts(insights.parse_insights(_responses(spark, sf))).withColumnRenamed("count", "n")


@query
def insight_summary(spark, sf):
    rows = stage(insights.parse_insights(_responses(spark, sf), "response", "doc_id"))
    return insights.insight_summary(rows, ("doc_id",)).withColumn(
        "avg_severity", rounded("avg_severity")).withColumn("top_quotes", F.array_join("top_quotes", "|"))


# --- relations ----------------------------------------------------------------------------

@query
def join_audit(spark, sf):
    df = stage(data.protected(spark, sf).select("id", "pii_spans", "pii_count"))
    joined = joins.join_audit(df, pii.pii_audit(df, RUN_TS))
    return joined.select("id", "entity_type", F.col("start_position").cast("long").alias("start_position"))


@query
def join_audit_without(spark, sf):
    df = stage(data.protected(spark, sf).select("id", "pii_spans"))
    return joins.messages_with_audit(df, pii.pii_audit(df, RUN_TS), found=False).select("id")


@query
def join_monthly(spark, sf):
    df = stage(data.flagged(spark, sf).select(
        "id", "year_month", "sentiment_score", "sentiment_label", "mentions_oregon", "mentions_partner"))
    joined = joins.join_monthly(df, stage(monthly.monthly_sentiment(df, SETTINGS)))
    return joined.select("id", "year_month", rounded("difference").alias("difference"))


@query
def join_topic(spark, sf):
    df = stage(data.with_topics(data.scored(spark, sf)).select(
        "id", "clean_text", "dominant_topic", "sentiment_score"))
    summary = stage(topics.topic_summary(df, _topic_words(df)))
    return joins.join_topic(df, summary).select("id", "topic_name", "post_count")


@query
def keyword_containment(spark, sf):
    """Documents that contain one of the most frequent words of the benchmark as a substring."""
    words = data.table(spark, sf, "benchmark").select(text.clean_text(F.col("text")).alias("clean_text"))
    top = (tfidf.term_statistics(words, ()).where(F.col("term") != "")
           .orderBy(F.desc("total"), "term").limit(50).select("term"))
    return tfidf.keyword_containment(data.cleaned(spark, sf), top).select("id", "term")


# --- incremental and streaming ------------------------------------------------------------

@query
def incremental(spark, sf):
    """Writes a mark, reads it back and keeps what came after it."""
    out = _folder(spark, "marked")
    mark = data.table(spark, sf, "events").agg(
        F.concat(F.date_format(F.timestamp_seconds(F.avg(F.unix_seconds(F.col("ts").cast("timestamp"))).cast("long")),
                               "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("run_timestamp"))
    sinks.write_metadata(mark, out)
    events = data.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return threads.since_filter(events, runs.last_run_timestamp(spark, out), "ts").select("event_id", "event_type")


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return events.withColumn("timestamp", F.col("ts").cast("timestamp"))


def _finish(spark, writer, out):
    (writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{out}/table")


@query
def stream_monthly_counts(spark, sf):
    events = _event_stream(spark, sf)
    day = events.select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("year_month"), F.col("value").alias("sentiment_score"),
        F.when(F.col("event_type") == "error", "Negative").when(F.col("event_type") == "purchase", "Positive")
        .otherwise("Neutral").alias("sentiment_label"))
    out = _folder(spark, "stream")
    write = lambda batch, _id: batch.write.mode("overwrite").parquet(f"{out}/table")
    table = _finish(spark, stream.monthly_counts(day).writeStream.outputMode("complete").foreachBatch(write), out)
    return table.select("year_month", "total_posts", "positive_count", "negative_count", "neutral_count",
                        rounded("avg_sentiment").alias("avg_sentiment"))


@query
def stream_dedupe(spark, sf):
    events = _event_stream(spark, sf).select(F.col("user_id").alias("id"), "timestamp")
    out = _folder(spark, "stream")
    writer = stream.drop_seen(events).select("id").writeStream.format("parquet").option("path", f"{out}/table")
    return _finish(spark, writer, out)


@query
def stream_merge(spark, sf):
    """Two versions of overlapping sets merged by id: the newer one stays, an older one changes nothing."""
    messages = monthly.with_calendar(data.messages(spark, sf), SETTINGS).select(
        "id", "timestamp", "year_month", F.length("text").cast("long").alias("chars"))
    out = _folder(spark, "merge")
    keyed.merge(spark, messages.withColumn("_version", F.lit(1)), out, buckets=2)
    longer = messages.where(F.col("chars") > 1000).withColumns({"chars": F.col("chars") * 2, "_version": F.lit(2)})
    keyed.merge(spark, longer, out)
    keyed.merge(spark, longer.withColumns({"chars": F.lit(0).cast("long"), "_version": F.lit(0)}), out)
    return keyed.read(spark, out).select("id", "year_month", "chars", F.col("_version").cast("long").alias("version"))


@query
def landing_ledger(spark, sf):
    """Messages of a second run: files that landed since the first, and those of one folder that were rewritten."""
    landing, out = _folder(spark, "landing"), _folder(spark, "ledger")
    lines = data.item_lines(data.items(spark, sf))

    def land(rows, name):
        rows.select("value").write.mode("overwrite").text(f"{landing}/{name}")

    for part in range(3):
        land(lines.where(F.col("doc_id") % 4 == part), f"part={part}")
    ledger.record(ledger.pending(spark, landing, out), out, RUN_TS)
    land(lines.where(F.col("doc_id") % 4 == 3), "part=3")
    land(lines.where((F.col("doc_id") % 4 == 1) & (F.col("doc_id") % 3 == 0)), "part=1")
    files = [r.path for r in ledger.pending(spark, landing, out).collect()]
    flat = threads.flatten_threads(item_source.read_items(spark, files), item_source.ORDER)
    return flat.select("id", "parent_id", "text", "score", "type")


@query
def monthly_trend(spark, sf):
    """Flagship: text to monthly mean sentiment with a rolling mean of three months."""
    return _monthly(spark, sf).select(
        "year_month", "total_posts", rounded("avg_sentiment").alias("avg_sentiment"),
        rounded("pct_negative").alias("pct_negative"),
        rounded("rolling_3mo_sentiment").alias("rolling_3mo_sentiment"))
