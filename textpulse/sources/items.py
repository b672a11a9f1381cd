"""Landing files of nested items, and tables between own stages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from textpulse.functions.brackets import NONE, scan
from textpulse.functions.plan import compute_once
from textpulse.schemas import ITEM, JSON_OPTIONS, PROCESSED
from textpulse.sources.arrays import read_array_lines

# Input order: file, split within the file, row within the split. A split is read by one
# task in file order, so the growing row number is right within it.
ORDER = ("_file", "_block", "_row")
ROWS, CHARACTERS = 4_096, 4 << 20  # items, and their text, that are sent on at a time


def parse_lines(lines: DataFrame) -> DataFrame:
    """Items of raw JSON: ``value`` holds one item, or an array of them; other columns are carried.

    Comments stay the JSON text that the file has, cut out by the positions of its brackets, so that
    neither their depth nor their number meets a limit of a JSON parser. Lines that are no JSON give
    an item of NULLs.
    """
    carried = [c for c in lines.columns if c != "value"]
    schema = T.StructType([*(lines.schema[c] for c in carried), T.StructField("_own", T.StringType()), T.StructField("_comments", T.StringType())])

    def parts(text: str) -> Iterator[tuple[str, str | None]]:
        array = text.lstrip().startswith("[")
        tree = scan(text, "comments", deep=False) if array else scan(text, root="comments", deep=False)
        if tree is None:
            yield text, None
            return
        for node in range(len(tree.start)) if array else (0,):
            if tree.parent[node] == NONE:
                yield tree.own(text, node), None if tree.low[node] == NONE else text[tree.low[node]:tree.high[node]]

    def sent(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        line, own, comments = zip(*rows)
        line = pa.array(line, pa.int64())
        return pa.record_batch([*(batch.column(c).take(line) for c in carried), pa.array(own, pa.string()), pa.array(comments, pa.string())],
                               schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, values = [], 0, batch.column("value")
            for i in range(batch.num_rows):
                for own, comments in parts(values[i].as_py() or ""):
                    rows.append((i, own, comments))
                    size += len(own) + len(comments or "")
                    if len(rows) >= ROWS or size >= CHARACTERS:
                        yield sent(batch, rows)
                        rows, size = [], 0
            if rows:
                yield sent(batch, rows)

    found = lines.where(F.trim("value") != "").mapInArrow(run, schema)
    found = compute_once(found, _item=F.from_json("_own", ITEM, JSON_OPTIONS))
    return found.select(*[F.coalesce("_comments", "_item.comments").alias(c) if c == "comments" else F.col(f"_item.{c}").alias(c)
                          for c in ITEM.fieldNames()], *carried)


def read_items(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Items of a landing folder, or of a list of files, with their input order.

    JSON lines are read in parallel splits. ``multi_line`` reads files that hold one JSON
    array each, in parallel splits, too, by two passes. Comments stay JSON text until they are flattened.
    """
    if multi_line:
        return parse_lines(read_array_lines(spark, path))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    return parse_lines(lines).withColumn("_row", F.monotonically_increasing_id())


def read_processed_csv(spark: SparkSession, path: str) -> DataFrame:
    """The main dataset from CSV: columns found by header name, cast to their fixed types."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return raw.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in PROCESSED.fields])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as its scan splits it."""
    return spark.read.parquet(path)
