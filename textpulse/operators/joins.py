"""Documented relations between the output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textpulse.functions.plan import broadcast_if_small

_AUDIT = ("entity_type", "start_position", "end_position", "confidence")


def join_audit(messages: DataFrame, audit: DataFrame) -> DataFrame:
    """Every message with its audit rows (left join on ``id = post_id``).

    The audit table alone decides who has partners, whatever ``pii_count`` says; adaptive
    execution splits hot keys on the message side.
    """
    return messages.join(audit.select(F.col("post_id").alias("id"), *_AUDIT), "id", "left")


def messages_with_audit(messages: DataFrame, audit: DataFrame, found: bool = True) -> DataFrame:
    """Messages that have (or have no) audit rows."""
    posts = audit.select(F.col("post_id").alias("id"))
    return messages.join(posts, "id", "left_semi" if found else "left_anti")


def join_monthly(messages: DataFrame, monthly: DataFrame) -> DataFrame:
    """Messages with the mean of their month and the difference to it.

    The monthly table is broadcast if it is found small, as it is with one row per calendar month.
    """
    means = broadcast_if_small(monthly.select("year_month", F.col("avg_sentiment").alias("month_avg_sentiment")))
    return messages.join(means, "year_month").withColumn(
        "difference", F.col("sentiment_score") - F.col("month_avg_sentiment"))


def join_topic(messages: DataFrame, summary: DataFrame) -> DataFrame:
    """Messages with the name and size of their topic; the topics are broadcast if they are found few."""
    topics = broadcast_if_small(summary.select(F.col("topic_id").alias("dominant_topic"), "topic_name", "post_count"))
    return messages.join(topics, "dominant_topic", "left")
