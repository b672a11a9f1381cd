"""Run statistics and the run metadata document."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from textpulse.config import DEFAULT, Settings


def round_one_place(value: Column) -> Column:
    """Half-even rounding of the binary value: ``round`` and ``bround`` round its decimal text."""
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit("")).cast("double")


def run_stats(df: DataFrame) -> DataFrame:
    """One row of label and mention percentages, row count and messages with personal data.

    Zeros for empty input. ``pii_count`` holds the spans of a message, so no second table
    is needed for the number of affected messages.
    """
    total = F.count(F.lit(1))
    label = lambda name: F.count_if(F.col("sentiment_label") == name)
    percent = lambda part: F.coalesce(round_one_place(F.try_divide(part, total) * 100), F.lit(0.0))
    return df.agg(
        percent(label("Positive")).alias("positive_pct"),
        percent(label("Negative")).alias("negative_pct"),
        percent(label("Neutral")).alias("neutral_pct"),
        percent(F.count_if("mentions_oregon")).alias("oregon_mention_pct"),
        percent(F.count_if("mentions_partner")).alias("partner_mention_pct"),
        F.count_if(F.col("pii_count") > 0).alias("pii_redacted_count"),
        total.alias("records_final"))


def run_metadata(df: DataFrame, run_ts: datetime, settings: Settings = DEFAULT) -> DataFrame:
    """The run document: one row with nested feature flags and statistics."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    at = F.lit(run_ts)
    local = F.convert_timezone(None, F.lit(settings.output_timezone), at)
    # Offset of the output zone at that moment, as +hh:mm.
    minutes = F.expr("0") + (F.unix_timestamp(local.cast("timestamp")) - F.unix_timestamp(at)) / 60
    offset = F.format_string(
        "%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"),
        F.floor(F.abs(minutes) / 60), F.pmod(F.abs(minutes), F.lit(60)).cast("long"))
    stats = run_stats(df)
    fields = [c for c in stats.columns if c != "records_final"]
    return stats.select(
        F.concat(F.date_format(at, iso), F.lit("+00:00")).alias("run_timestamp"),
        F.concat(F.date_format(local, iso), offset).alias("run_timestamp_pacific"),
        F.col("records_final").alias("records_processed"), "records_final",
        F.lit(settings.sentiment_model).alias("sentiment_model"),
        F.lit(settings.backfill_months).alias("backfill_months"),
        F.lit(settings.version).alias("version"),
        F.struct(F.lit(settings.enable_topics).alias("topics"),
                 F.lit(settings.enable_rolling).alias("rolling_averages")).alias("features_enabled"),
        F.struct(*fields).alias("statistics"))
