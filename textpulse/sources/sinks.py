"""Output tables. Every writer replaces its folder unless it says otherwise."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from textpulse import schemas
from textpulse.session import delete, replace_folder

MAIN = "reddit_sentiment"
STREAMED = "reddit_sentiment_keyed"  # read with sources.keyed
MONTHLY = "sentiment_by_month"
NEGATIVE = "negative_keywords"
AUDIT = "pii_audit_log"
TOPICS = "topic_summary"
METADATA = "run_metadata"
HISTORY = "run_history"
INSIGHTS = "deep_insights"
FAILURES = "deep_failures"

_RAW_TEXT = ("text", "original_text", "author")


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header. ``single`` is for tables of bounded size: one file, and a header even
    without rows."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").csv(path, header=True, escape='"')


def public_columns(df: DataFrame, drop_raw: bool = False) -> DataFrame:
    """Main dataset without internal columns; ``drop_raw`` also removes unredacted text."""
    hidden = ("pii_spans", "_words") + (_RAW_TEXT + ("clean_text",) if drop_raw else ())
    return df.drop(*hidden)


def write_main(df: DataFrame, out: str, csv: bool = True, drop_raw: bool = False) -> None:
    """Main dataset as Parquet by month, and as CSV.

    The rebalance hint gives each month files of even size; adaptive execution splits a
    month that holds much of the data over several tasks. Both are written beside the old ones and
    take their places when they are whole, so a run that dies leaves what was there.
    """
    spark, public = df.sparkSession, public_columns(df, drop_raw)
    fresh = f"{out}/_{MAIN}-{uuid.uuid4().hex}"
    try:
        (public.hint("rebalance", "year_month").write
         .partitionBy("year_month").parquet(f"{fresh}/{MAIN}.parquet"))
        if csv:
            written = spark.read.schema(public.schema).parquet(f"{fresh}/{MAIN}.parquet")
            write_csv(written.select(*public.columns), f"{fresh}/{MAIN}.csv")
        for name in (f"{MAIN}.parquet", *([f"{MAIN}.csv"] if csv else [])):
            replace_folder(spark, f"{fresh}/{name}", f"{out}/{name}")
    finally:
        delete(spark, fresh)


def write_monthly(monthly: DataFrame, out: str) -> None:
    write_csv(monthly.orderBy("year_month"), f"{out}/{MONTHLY}.csv", single=True)


def write_negative_keywords(keywords: DataFrame, out: str) -> None:
    write_csv(keywords, f"{out}/{NEGATIVE}.csv", single=True)


def write_audit(audit: DataFrame, out: str) -> None:
    """Audit rows grow with the data, so they keep their partitions; an empty table is one
    file with a header."""
    audit = audit.select(*schemas.AUDIT.fieldNames())
    write_csv(audit, f"{out}/{AUDIT}.csv", single=audit.isEmpty())


def write_topic_summary(summary: DataFrame, out: str) -> None:
    write_csv(summary.select(*schemas.TOPIC_SUMMARY.fieldNames()), f"{out}/{TOPICS}.csv", single=True)


def write_metadata(metadata: DataFrame, out: str) -> None:
    metadata.coalesce(1).write.mode("overwrite").json(f"{out}/{METADATA}.json")


def append_run(spark, out: str, timestamp: str, success: bool, records: int,
               error: str | None = None) -> None:
    """Adds one line to the run history."""
    row = spark.createDataFrame([(timestamp, success, records, error)], schemas.RUN)
    row.coalesce(1).write.mode("append").option("ignoreNullFields", False).json(f"{out}/{HISTORY}.json")


def write_insights(insights: DataFrame, out: str) -> bool:
    """Writes the insight table only if it has rows; tells whether it did."""
    if insights.isEmpty():
        return False
    write_csv(insights.select(*schemas.INSIGHT.fieldNames()), f"{out}/{INSIGHTS}.csv")
    return True


def write_failures(failed: DataFrame, out: str) -> bool:
    """Requests that a model did not answer, if any; tells whether there were."""
    if failed.isEmpty():
        return False
    write_csv(failed, f"{out}/{FAILURES}.csv")
    return True


def with_month_partition(df: DataFrame) -> DataFrame:
    """Rows without a month go to one named partition instead of being lost."""
    return df.withColumn("year_month", F.coalesce("year_month", F.lit("unknown")))
