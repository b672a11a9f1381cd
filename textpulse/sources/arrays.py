"""Files of one JSON array each, read in as many tasks as their bytes ask for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.session import stage

WHOLE, TAIL, MIDDLE, HEAD = range(4)  # an item, or the part of one that begins, goes on, ends in a block
_BLOCK = "_file string, _block long"
_CHANGE = np.zeros(256, np.int64)  # of depth, by a byte
_CHANGE[list(b"[{")], _CHANGE[list(b"]}")] = 1, -1


def _segments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, _file, _block``: the text between closing braces, split by Spark at any brace."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, pa.RecordBatch]]:
    """Block, bytes with the braces back in place, and rows of each run of segments."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("_file").to_pylist(), batch.column("_block").to_pylist()))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            rows = batch.slice(low, high - low)
            yield keys[low], np.frombuffer("}".join([*rows.column("value").to_pylist(), ""]).encode(), np.uint8), rows


def _structure(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: quotes before it that open or close a string, and the change of depth it would make outside one.

    A backslash stands in strings alone, so whether a quote counts does not depend on where one is.
    """
    quote, slash = text == 0x22, text == 0x5C
    if slash.any():
        at = np.arange(len(text))
        other = np.maximum.accumulate(np.where(slash, -1, at))  # the last byte that is no backslash
        before = np.concatenate([[-1], other[:-1]])
        quote &= (at - 1 - before) % 2 == 0
    return np.cumsum(quote) - quote, _CHANGE[text]


def _starts(segments: DataFrame) -> DataFrame:
    """``_file, _block, inside, depth``: whether a block begins within a string, and how deep."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, quotes, change = None, 0, [0, 0]

        def sent():
            return pa.RecordBatch.from_pylist([{"_file": now[0], "_block": now[1], "odd": quotes % 2, "outside": change[0], "within": change[1]}])

        for key, text, _ in _parts(batches):
            if now is not None and key != now:
                yield sent()
            if key != now:
                now, quotes, change = key, 0, [0, 0]
            passed, step = _structure(text)
            odd = (quotes + passed) % 2 == 1
            change[0] += int(step[~odd].sum())  # if the block begins outside a string
            change[1] += int(step[odd].sum())
            quotes += int(passed[-1]) + int(text[-1] == 0x22)
        if now is not None:
            yield sent()

    blocks = segments.mapInArrow(run, f"{_BLOCK}, odd long, outside long, within long")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    placed = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    own = F.when(F.col("inside") == 1, F.col("within")).otherwise(F.col("outside"))
    return placed.withColumn("own", own).select("_file", "_block", "inside", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("depth"))


def read_array_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value, _file, _block, _row``: the objects of array files as raw JSON, with their order.

    Files are split anywhere. One pass counts quotes and brackets of each block; running sums over the
    blocks of a file, one row each, tell every block whether it begins in a string and how deep. A
    second pass cuts the objects out; those that blocks share are put together by a shuffle of
    their parts alone. Values of an array that are no objects are left out.
    """
    segments = _segments(spark, path)
    starts = stage(_starts(segments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, depth, number, open_, held = None, 0, 0, 0, False, []
        out: list[tuple] = []

        def sent():
            rows = list(zip(*out))
            out.clear()
            return pa.record_batch([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()),
                                    pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.binary())], ["_file", "_block", "_row", "kind", "part"])

        def add(kind: int, part: bytes):
            nonlocal number
            out.append((*now, number, kind, part))
            number += 1

        def finish():
            # What the block leaves unfinished.
            if held:
                add(TAIL if open_ else MIDDLE, b"".join(held))
                held.clear()

        for key, text, rows in _parts(batches):
            if key != now:
                if now is not None:
                    finish()
                now, number = key, 0
                inside, depth = (rows.column(c)[0].as_py() for c in ("inside", "depth"))
                # Depth 1 is the array: an item began before this block.
                open_, going = False, depth > 1
            passed, step = _structure(text)
            outside = (inside + passed) % 2 == 0
            after = depth + np.cumsum(np.where(outside, step, 0))
            begins = np.flatnonzero(outside & (text == 0x7B) & (after == 2))
            ends = np.flatnonzero(outside & (text == 0x7D) & (after == 1)) + 1
            raw, at = text.tobytes(), 0
            marks = sorted([(p, 1) for p in begins.tolist()] + [(p, 0) for p in ends.tolist()])
            for place, begin in marks:
                if begin:
                    at, open_, going = place, True, True
                else:
                    add(WHOLE if open_ else HEAD, b"".join(held) + raw[at:place])
                    held.clear()
                    open_ = going = False
            if going:
                held.append(raw[at:])
            inside = (inside + int(passed[-1]) + int(text[-1] == 0x22)) % 2
            depth = int(after[-1])
            if out:
                yield sent()
        if now is not None:
            finish()
            if out:
                yield sent()

    placed = segments.join(F.broadcast(starts), ["_file", "_block"])  # a row per split, which the driver has planned
    parts = stage(placed.select("value", "_file", "_block", "inside", "depth").mapInArrow(run, f"{_BLOCK}, _row long, kind int, part binary"))
    text = F.col("part").cast("string").alias("value")
    whole = parts.where(F.col("kind") == WHOLE).select(text, "_file", "_block", "_row")
    order = Window.partitionBy("_file").orderBy("_block", "_row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.where(F.col("kind") != WHOLE).withColumn("item", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_row", F.col("part").cast("string").alias("part"))))
    shared = (numbered.groupBy("_file", "item").agg(pieces.alias("pieces"))  # the parts of one item
              .select(F.array_join(F.transform("pieces", lambda p: p["part"]), "").alias("value"), "_file",
                      F.col("pieces")[0]["_block"].alias("_block"), F.col("pieces")[0]["_row"].alias("_row")))
    return whole.union(shared)
