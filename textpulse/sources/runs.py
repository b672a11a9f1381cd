"""State of earlier runs: high-water mark, history, file integrity."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.functions.digest import resumable
from textpulse.schemas import RUN
from textpulse.session import exactly, packed
from textpulse.sources.chains import chained_md5
from textpulse.sources.sinks import HISTORY, METADATA

WHOLE = 256 << 20  # bytes of a file that one task hashes at once


def last_run_timestamp(spark: SparkSession, out: str) -> datetime | None:
    """Run time of the last successful run; None when missing or unreadable."""
    try:
        found = (spark.read.schema("run_timestamp string").json(f"{out}/{METADATA}.json")
                 .agg(F.max(F.col("run_timestamp").try_cast("timestamp")).cast("double").alias("s")))
        seconds = found.first()["s"]
    except AnalysisException:  # no metadata yet
        return None
    return None if seconds is None else datetime.fromtimestamp(seconds, timezone.utc)


def run_history(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(RUN).json(f"{out}/{HISTORY}.json")


def file_md5(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, length, md5`` of every file of a folder (or of one file).

    Files are hashed in parallel. One of more than ``WHOLE`` bytes is hashed split by split, each in a task that goes on
    from the state that the one before it returned; that work is done when this is called. Files that readers unpack by
    their names (``.gz``) are hashed as wholes. A missing path gives one row with an empty hash.
    """
    reader = spark.read.format("binaryFile")
    try:
        files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    except AnalysisException:
        return spark.range(1).select(F.lit(path).alias("path"), F.lit(0).cast("long").alias("length"),
                                     F.lit("").alias("md5"))
    hashed = [F.col("path"), F.col("length"), F.md5("content").alias("md5")]
    large = [tuple(file) for file in files.filter(F.col("length") > WHOLE).select("path", "length").collect()]
    if not large or not resumable():
        return files.select(hashed)
    result = files.filter(F.col("length") <= WHOLE).select(hashed)
    wholes = [file for file, _ in large if packed(spark, file)]
    if wholes:
        result = result.union(spark.read.format("binaryFile").load([exactly(file) for file in wholes]).select(hashed))
    chained = chained_md5(spark, [file for file in large if file[0] not in wholes])
    return result.union(spark.createDataFrame(chained, "path string, length long, md5 string"))
