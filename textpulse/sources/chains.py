"""MD5 of large files, as a chain of tasks that read a split each."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.functions.digest import Md5
from textpulse.session import exactly, read_bytes

_SAMPLE, _APART, _FEWEST, _MOST = 1 << 14, 1 << 24, 64, 1024  # bytes of a sample, bytes between two, and how many choose a separator
_ROW, _LONG = 256, 1 << 26  # bytes between two separators, about, and those that need no thought
_BOM = b"\xef\xbb\xbf"
_STATE = "state binary, fed long, block long"


def chained_md5(spark: SparkSession, files: list[tuple[str, int]]) -> list[tuple[str, int, str]]:
    """``path, length, md5`` of each of ``files`` (paths and lengths), which must not be ``packed``.

    All that goes from a task to the next, through the driver, is the state of a hash. Several files advance at a time.
    """
    with ThreadPool(max(1, min(len(files), spark.sparkContext.defaultParallelism))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda file: (*file, _md5(spark, *file))), files, 1)


def _md5(spark: SparkSession, path: str, length: int) -> str:
    separator = _separator(spark, path, length)
    rows = _rows(spark, path, separator)
    left_out = _BOM if read_bytes(spark, path, 0, len(_BOM)) == _BOM else b""  # by a reader of lines
    first = Md5()
    first.update(left_out)
    state, fed, block = first.state, len(left_out), -1
    for split in range(rows.rdd.getNumPartitions()):
        step = rows.mapInArrow(_go_on(state, fed, block, separator), _STATE)
        for row in spark.sparkContext.runJob(step.rdd, list, [split]):
            state, fed, block = bytes(row.state), row.fed, row.block
    last = Md5(state)
    if fed == length - 1:  # rows do not tell whether the last one was ended
        last.update(separator)
    elif fed != length:
        raise OSError(f"{path} has {length} bytes, {fed} were read")
    return last.hexdigest()


def _rows(spark: SparkSession, path: str, separator: bytes) -> DataFrame:
    """``value, block``: the bytes between separators, split by Spark at any of them."""
    return spark.read.option("lineSep", separator.decode()).text(exactly(path)).select(
        F.col("value").cast("binary"), F.col("_metadata.file_block_start").alias("block"))


def _separator(spark: SparkSession, path: str, length: int) -> bytes:
    """The ASCII byte that cuts samples of a file into rows of about ``_ROW`` bytes, if it is nowhere missing for long."""
    stride = -(-length // min(max(length // _APART, _FEWEST), _MOST))
    counts = np.array([np.bincount(np.frombuffer(read_bytes(spark, path, at, _SAMPLE), np.uint8), minlength=256)
                       for at in range(0, length, stride)])
    missing = np.zeros(128, np.int64)  # samples in a row, at most
    run = missing.copy()
    for seen in counts[:, :128] > 0:
        run = np.where(seen, 0, run + 1)
        missing = np.maximum(missing, run)
    share = counts[:, :128].sum(axis=0) / counts.sum()
    distance = np.abs(np.log2(share * _ROW + 1e-6))
    return bytes([int(np.lexsort((distance, np.maximum(missing * stride, _LONG)))[0])])


def _go_on(state: bytes, fed: int, block: int, separator: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A hash as it is after the rows of one more split; ``block`` is where the last split with rows began (-1: none yet)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        md5, count, at = Md5(state), fed, block
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            if blocks[0] < at or (np.diff(blocks) < 0).any():
                raise OSError("splits of a file are out of order")
            data = separator.join(([b""] if at >= 0 else []) + batch.column("value").to_pylist())
            md5.update(data)
            count, at = count + len(data), int(blocks[-1])
        yield pa.RecordBatch.from_pylist([{"state": md5.state, "fed": count, "block": at}])

    return run
