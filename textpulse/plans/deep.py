"""Deep analysis run: processed table to insights."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from textpulse.config import DEFAULT, Settings
from textpulse.operators import insights as ops
from textpulse.schemas import INSIGHT
from textpulse.session import delete, new_folder, stage
from textpulse.sources import sinks


def run_deep(spark: SparkSession, processed: DataFrame, out: str,
             connect: Callable[[], Callable[[str], str]], n: int | None = None,
             threshold: float | None = None, settings: Settings = DEFAULT,
             concurrency: int = 4) -> DataFrame:
    """Insights of the most negative messages, written when there are any.

    Responses are stored before they are parsed: no request is repeated when a later
    step reads the insights again. Requests that failed are written with their errors.
    """
    text = [c for c in ops.TEXTS if c in processed.columns]
    narrow = processed.select("id", "sentiment_score", *text)
    top = ops.number_batches(ops.top_negative(narrow, n, threshold, settings), settings.deep_batch_size)
    responses = ops.call_model(ops.prompt_batches(top, settings), connect, concurrency)
    stored = new_folder(spark, "responses")
    responses.write.parquet(stored)
    responses = spark.read.parquet(stored)
    insights = stage(ops.parse_insights(responses).select(*INSIGHT.fieldNames()))
    sinks.write_insights(insights, out)
    sinks.write_failures(responses.where("error IS NOT NULL").select("batch", "error"), out)
    delete(spark, stored)
    return insights
