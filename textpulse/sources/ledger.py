"""Which landing files earlier runs took in."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

LEDGER = "landing_ledger"
_FILE = "path string, length long, modified timestamp"


def listing(spark: SparkSession, landing: str) -> DataFrame:
    """``path, length, modified`` of every file below a folder. No content is read; a missing folder has no files."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    except AnalysisException:
        return spark.createDataFrame([], _FILE)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def taken(spark: SparkSession, out: str) -> DataFrame:
    """The ledger: a row for each file that a run took in. It only grows."""
    try:
        return spark.read.schema(f"{_FILE}, run_timestamp string").parquet(f"{out}/{LEDGER}.parquet")
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], f"{_FILE}, run_timestamp string")


def pending(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """Files of the landing folder that no run took in as they are now: one that was rewritten is new."""
    return listing(spark, landing).join(taken(spark, out).select("path", "length", "modified").distinct(),
                                        ["path", "length", "modified"], "left_anti")


def record(files: DataFrame, out: str, run_ts: datetime) -> None:
    """Adds files to the ledger. The last step of a run: one that fails before takes them in again."""
    (files.select("path", "length", "modified", F.lit(run_ts.isoformat()).alias("run_timestamp"))
     .write.mode("append").parquet(f"{out}/{LEDGER}.parquet"))
