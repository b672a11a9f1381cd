"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textpulse.session import new_folder as folder, stage, unstage as discard

__all__ = ["discard", "folder", "map_batches", "numbered", "raw", "stage", "table"]
ROWS_OF_A_FILE = 40  # bits of a row number that count within a file
SLICE_ROWS, SLICE_BYTES = 1 << 10, 4 << 20  # of a batch, where a function makes Python objects of it


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(column: str) -> Column:
    """UTF-8 bytes of a text column: tasks then skip decoding what they only hash."""
    return F.col(column).cast("binary")


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with a column row, and safe names for its own columns, by their names.

    row tells the file, in order of names, and the place in it. It does not depend on how a scan is
    split, so several jobs may read the table and meet by it; later rows of a file have greater numbers.
    What is no Parquet table is written as one first. The files' names are broadcast: the driver has
    listed them to plan the scan.
    """
    where = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no name can clash with others

    def placed(df: DataFrame) -> DataFrame:
        return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"),
                         *[F.col(f"`{c}`").alias(n) for c, n in where.items()])

    try:
        rows = placed(docs)
    except AnalysisException:
        rows = placed(stage(docs))
    files = rows.select("file").distinct()
    known = stage(files.select("file", F.row_number().over(Window.orderBy("file")).cast("long").alias("number")))
    number = F.call_function("shiftleft", F.col("number"), F.lit(ROWS_OF_A_FILE))
    return rows.join(F.broadcast(known), "file").select((number + F.col("place")).alias("row"), *where.values()), where


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """All rows of a batch, in order, halved until a part has few rows and bytes, or one row."""
    if batch.num_rows > 1 and (batch.num_rows > SLICE_ROWS or batch.nbytes > SLICE_BYTES):
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half))
        yield from slices(batch.slice(half))
    else:
        yield batch


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str, sliced: bool = False) -> DataFrame:
    """``function`` over each Arrow batch of ``df``; only one batch is in memory at a time.

    With ``sliced`` it gets a batch in small parts: for functions that take rows one by one and
    make many Python objects of each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch) if sliced else (batch,):
                if part.num_rows and (out := function(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)
