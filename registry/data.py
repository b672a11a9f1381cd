"""The test tables as inputs of the operators, and settings whose terms occur in them."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textpulse.config import DEFAULT
from textpulse.operators import keywords, monthly, pii, preprocess, sentiment
from textpulse.sources.items import read_table

RUN_TS = datetime(2025, 1, 1, tzinfo=timezone.utc)

# The invented prose of the test tables holds none of the default terms.
SETTINGS = replace(
    DEFAULT,
    relevance_terms=("this", "of the", "from"),
    region_terms=("from", "on the"),
    partner_terms=("in the", "with the", "an"),
    partner_extra_terms=("or",),
    faculty_terms=("as", "to be"),
    faculty_extra_terms=("all", "no"),
    attrition_terms=("the", "on", "on the", "of the", "never-seen"),
    search_terms={
        "recruitment": ("from the", "this"),
        "retention": ("of the", "to be"),
        "isolation": ("in the",),
        "compensation": ("with the", "for the"),
        "career": ("Capital Term", "by-pass"),
    },
    positive_words=("for", "with", "by", "on"),
    negative_words=("was", "that", "are", "or"),
    custom_stop_words=("er", "es", "th", "nd"),
)

ALUMNI_PHRASES = ("moved back", "after years", "left a rural town", "after", "years", "left", "rural", "moved")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages, with times spread over five years."""
    seconds = F.lit(1577836800) + (F.col("doc_id") * 104729) % 157680000
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text",
        F.timestamp_seconds(seconds).alias("timestamp"), F.col("source").alias("subreddit"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.with_clean_text(preprocess.with_original_text(messages(spark, sf_dir)))


def preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.preprocess(messages(spark, sf_dir), SETTINGS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.analyze_sentiment(preprocessed(spark, sf_dir), SETTINGS)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = preprocess.preprocess(messages(spark, sf_dir), SETTINGS, keep_words=True)
    df = sentiment.analyze_sentiment(df, SETTINGS)
    df = keywords.flag_keywords(df, SETTINGS).drop("_words")
    return monthly.with_calendar(df, SETTINGS)


def protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with spans and redacted text, unfiltered."""
    return pii.redact_pii(preprocess.with_original_text(messages(spark, sf_dir)), SETTINGS)


def with_topics(df: DataFrame) -> DataFrame:
    """A topic per message from its source, with one group as outliers."""
    number = F.regexp_extract("subreddit", "([0-9]+)", 1).cast("int")
    return df.withColumn("dominant_topic", (F.pmod(number, F.lit(5)) - 1).cast("int"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as nested items: first line = title, other lines = comments, each sentence of
    a line = a reply to the one before, in chains of eight."""
    def node(key: Column, body: Column, votes: Column, replies: Column) -> Column:
        own = F.to_json(F.struct(
            key.alias("id"), body.alias("body"),
            (F.lit(1577836800) + votes * 86400).alias("createdAt"),
            votes.alias("upVotes"), F.lit(1).alias("downVotes")))
        return F.concat(F.left(own, F.length(own) - 1), F.lit(',"replies":['), replies, F.lit("]}"))

    def chains(line: Column, i: Column) -> Column:
        key = F.concat(F.col("doc_id").cast("string"), F.lit("_"), i.cast("string"))
        sentences = F.transform(F.split(line, r"\. "), lambda s, j: F.struct(s.alias("s"), j.alias("j")))
        starts = F.sequence(F.lit(1), F.size(sentences), F.lit(8))
        return F.transform(starts, lambda at: F.aggregate(
            F.reverse(F.slice(sentences, at, F.lit(8))), F.lit(""), lambda acc, x: node(
                F.concat(key, F.lit("_"), x["j"].cast("string")), x["s"], x["j"], acc)))

    lines = F.split("text", "\n")
    comments = F.flatten(F.transform(F.slice(lines, F.lit(2), F.size(lines)), chains))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.get(lines, F.lit(0)).alias("title"),
        F.lit(None).cast("string").alias("body"), F.parse_json(F.col("doc_id").cast("string")).alias("createdAt"),
        F.col("n_chars").alias("upVotes"), F.lit(2).cast("long").alias("downVotes"),
        F.col("source").alias("subredditName"), F.concat(F.lit("u/"), "doc_id").alias("url"),
        F.col("lang").alias("author"),
        F.concat(F.lit("["), F.array_join(comments, ","), F.lit("]")).alias("comments"), "doc_id")


#: Shapes of text dates: how a time is written, and what of it is left.
TIME_SHAPES = (
    ("yyyy/MM/dd", "day"), ("d MMMM yyyy", "day"), ("MMM d, yyyy h:mm a", "minute"), ("MMMM d, yyyy 'at' h:mm a", "minute"),
    ("dd-MMM-yyyy HH:mm:ss", "second"), ("M/d/yy", "day"), ("M-d-yyyy H:mm", "minute"), ("yyyy.MM.dd HH:mm", "minute"),
    ("yyyyMMdd'T'HHmmss", "second"), ("yyyyMMdd'T'HHmmss'Z'", "second"), ("EEEE, d MMMM yyyy h:mm a", "minute"),
    ("'never on' EEEE", None), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "second"), ("yyyy MMM d HH:mm", "minute"),
    ("MMM yyyy", "month"), ("yyyy/M/d H:mm:ss", "second"), ("d. MMMM yyyy", "day"), ("MMM. d, yyyy", "day"), ("d'th' MMM yyyy", "day"),
    ("yyyy-M-d", "day"), ("yyyy-MM-dd'T'HH:mm:ss'+00:00'", "second"), ("d MMM yy ha", "hour"), ("MM.dd.yyyy, HH:mm", "minute"),
    ("yyyy/MM/dd'T'HH:mm:ss'Z'", "second"), ("'week' w 'of' yyyy", None),
)


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in as many shapes."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_id") % len(TIME_SHAPES)
    written = F.coalesce(*[F.when(kind == i, F.date_format(ts, pattern) if "w" not in pattern else F.concat(
        F.lit("week "), F.weekofyear(ts), F.lit(" of "), F.year(ts))) for i, (pattern, _) in enumerate(TIME_SHAPES)])
    return table(spark, sf_dir, "events").select("event_id", written.alias("timestamp"))


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per customer that names them, their nation, a phone number, an address and a day."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    digits = lambda count: F.lpad((F.col("c_custkey") % 10 ** count).cast("string"), count, "0")
    phone = F.concat(F.lit("206-"), digits(3), F.lit("-"), digits(4))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 366).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"), F.concat(
            F.lit("Dear all, "), "c_name", F.lit(" from "), "n_name", F.lit(" can be called at "), phone, F.lit(" or written to under u"),
            "c_custkey", F.lit("@example.org since "), day, F.lit(".")).alias("original_text"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as persons, nations as places."""
    names = lambda name, column, kind: table(spark, sf_dir, name).select(F.lit(kind).alias("entity_type"), F.col(column).alias("name"))
    return names("customer", "c_name", "PERSON").union(names("nation", "n_name", "LOCATION"))


def item_lines(items: DataFrame) -> DataFrame:
    """``doc_id, value``: each item as one JSON text with its comments nested, as a landing file has it."""
    own = F.to_json(F.struct("id", "title", "body", F.col("doc_id").alias("createdAt"), "upVotes", "downVotes", "subredditName", "url", "author"))
    return items.select("doc_id", F.concat(F.left(own, F.length(own) - 1), F.lit(',"comments":'), "comments", F.lit("}")).alias("value"))
