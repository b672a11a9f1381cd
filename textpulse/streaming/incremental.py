"""Streams over the landing folder: new files, duplicates, maintained output, counts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from textpulse.config import DEFAULT, Settings
from textpulse.operators import stats
from textpulse.plans.batch import enrich, messages
from textpulse.sources import keyed
from textpulse.sources.items import parse_lines
from textpulse.sources.sinks import append_run, public_columns, write_metadata


def read_item_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Items of new landing files (JSON lines). The checkpoint replaces the run-time mark, so
    a message that arrives late is not lost."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # Negative, so that the newest file comes first in ascending order.
    age = -F.unix_micros(F.col("_metadata.file_modification_time"))
    return parse_lines(reader.text(path).select("value", age.alias("_age")))


def drop_seen(stream: DataFrame, delay: str = "7 days", key: str = "id") -> DataFrame:
    """First message of every key, across micro-batches.

    The delay runs on the time at which a micro-batch starts, which never goes back, so no first
    message is lost, however old its own timestamp. State is bounded by what arrives within the
    delay; a repeat that comes later passes again, for ``merge_by_id`` to resolve.
    """
    return (stream.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", delay)
            .dropDuplicatesWithinWatermark([key]).drop("_seen"))


def monthly_counts(stream: DataFrame) -> DataFrame:
    """Running counts per month and label for ``update`` or ``complete`` output."""
    label = lambda name: F.count_if(F.col("sentiment_label") == name)
    return stream.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("total_posts"), label("Positive").alias("positive_count"),
        label("Negative").alias("negative_count"), label("Neutral").alias("neutral_count"),
        F.avg("sentiment_score").alias("avg_sentiment"))


def start_incremental(spark: SparkSession, landing: str, target: str, checkpoint: str,
                      settings: Settings = DEFAULT, scorer=None, detector=None,
                      files_per_trigger: int | None = None, drop_raw: bool = False,
                      out: str | None = None) -> StreamingQuery:
    """Processes all new landing files and merges them into the keyed table at ``target``, then stops.

    The version of a row is the modification time of its file in microseconds, which outlives a
    checkpoint: an edit wins over older files in the same micro-batch, in an earlier one, and
    after a restart with a new checkpoint. With ``out`` every micro-batch adds a line to the run
    history there, and the metadata, which is the mark, follows a micro-batch of at least
    ``settings.min_results`` rows; a smaller one is merged, too, as its files are not read again.
    """
    stream = read_item_stream(spark, landing, files_per_trigger)

    def process(batch: DataFrame, batch_id: int) -> None:
        session, run_ts = batch.sparkSession, datetime.now(timezone.utc)
        stamp = run_ts.isoformat()
        rows = messages(with_batch_order(batch), run_ts, order=("_age", "_row"), kept=("_age",))
        observed = Observation("stages")
        rows = enrich(rows, settings, scorer, detector, observation=observed).withColumn("_version", -F.col("_age"))
        try:
            keyed.merge(session, public_columns(rows, drop_raw).drop("_age"), target)
        except Exception as error:
            if out:
                append_run(session, out, stamp, False, 0, str(error))
            raise
        if out:
            counts = observed.get
            if counts["rows_in"] >= settings.min_results:
                write_metadata(stats.run_metadata(keyed.read(session, target), run_ts, settings), out)
            append_run(session, out, stamp, True, counts["rows_kept"])

    return (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def with_batch_order(batch: DataFrame) -> DataFrame:
    return batch.withColumn("_row", F.monotonically_increasing_id())
