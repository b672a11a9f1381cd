"""Stored state of the monthly series: batches add to it, the whole series is read from it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from textpulse.config import DEFAULT, Settings
from textpulse.operators.monthly import added, monthly_from_state, monthly_state
from textpulse.session import delete, file_names, read_text, write_text

_SCHEMA = "year_month string, sentiment_score double, sentiment_label string, _n long, _ids long, _region long, _partner long"


def _marks(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in file_names(spark, path) if n.endswith(".json"))


def _now(spark: SparkSession, path: str) -> dict:
    """Number of the last batch, and the folder of the state that holds it."""
    marks = _marks(spark, path)
    return json.loads(read_text(spark, f"{path}/{marks[-1]}")) if marks else {"batch": -1, "folder": None}


def read_state(spark: SparkSession, path: str) -> DataFrame:
    folder = _now(spark, path)["folder"]
    return spark.read.schema(_SCHEMA).parquet(f"{path}/{folder}") if folder else spark.createDataFrame([], _SCHEMA)


def add_batch(spark: SparkSession, df: DataFrame, path: str, batch: int) -> bool:
    """Adds the rows of batch number ``batch`` to the state; tells whether it did.

    Numbers grow; a batch that is repeated is counted once. The sum of old state and batch is written
    beside the old one, then a small file names it: a batch that fails leaves the state as it was. The
    state has a row per month, score and label, so it follows the months and not the rows.
    """
    now = _now(spark, path)
    if batch <= now["batch"]:
        return False
    folder = f"state-{uuid.uuid4().hex}"
    added(read_state(spark, path).unionByName(monthly_state(df))).write.parquet(f"{path}/{folder}")
    write_text(spark, f"{path}/{batch:012d}.json", json.dumps({"batch": batch, "folder": folder}))
    # Readers that began with the state before this one still find it.
    marks = _marks(spark, path)
    kept = {json.loads(read_text(spark, f"{path}/{m}"))["folder"] for m in marks[-2:]}
    for name in file_names(spark, path):
        if name in marks[:-2] or name.startswith("state-") and name not in kept:
            delete(spark, f"{path}/{name}")
    return True


def monthly_series(spark: SparkSession, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Counts, mean, median, deviation and rolling means per month of all batches so far."""
    return monthly_from_state(read_state(spark, path), settings)
