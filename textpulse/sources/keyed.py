"""A table of one row per id, kept in cells of a month and a bucket of ids, with snapshots.

    target/data/<merge>/_m=<month>/_b=<bucket>/   rows of a cell
    target/index/<merge>/_b=<bucket>/             month of every id of a bucket
    target/manifest/<number>.json                 which folders make up the table

A merge writes new folders and then one manifest, which is the switch: before it, readers see the
old table, after it the new one. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from textpulse.session import delete, exists, file_names, read_text, work_dir, write_text
from textpulse.sources.sinks import with_month_partition

BUCKETS = 64  # of a new table; a merge reads the index of those that receive rows
_ID = "id string, year_month string"


@dataclass(frozen=True)
class Snapshot:
    """What makes up the table: folders below the target, as many as there are months times buckets."""

    number: int = 0
    buckets: int = BUCKETS
    schema: dict | None = None
    cells: dict[tuple[str, int], str] = field(default_factory=dict)
    index: dict[int, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "buckets": self.buckets, "schema": self.schema,
                           "cells": [[*cell, folder] for cell, folder in sorted(self.cells.items())],
                           "index": sorted(self.index.items())})

    @classmethod
    def of(cls, text: str) -> Snapshot:
        found = json.loads(text)
        return cls(found["number"], found["buckets"], found["schema"],
                   {(month, bucket): folder for month, bucket, folder in found["cells"]}, dict(found["index"]))

    def folders(self) -> set[str]:
        return {*self.cells.values(), *self.index.values()}


@dataclass(frozen=True)
class Merged:
    """What a merge touched: cells and index buckets read, cells written."""

    read: set[tuple[str, int]]
    buckets: set[int]
    written: set[tuple[str, int]]


def snapshots(spark: SparkSession, target: str) -> list[str]:
    """Manifests, oldest first."""
    return sorted(n for n in file_names(spark, f"{target}/manifest") if n.endswith(".json"))


def snapshot(spark: SparkSession, target: str, buckets: int = BUCKETS) -> Snapshot:
    """The table as it is now; an empty one if there is none."""
    names = snapshots(spark, target)
    return Snapshot.of(read_text(spark, f"{target}/manifest/{names[-1]}")) if names else Snapshot(buckets=buckets)


def _cells(spark: SparkSession, target: str, now: Snapshot, wanted) -> DataFrame:
    schema = T.StructType.fromJson(now.schema)
    folders = [f"{target}/{now.cells[cell]}" for cell in sorted(wanted) if cell in now.cells]
    # Cells are leaf folders, so month and bucket are read as the columns they are.
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, target: str, months: set[str] | None = None) -> DataFrame:
    """The current table, or the cells of some months."""
    now = snapshot(spark, target)
    if now.schema is None:
        raise ValueError(f"no table at {target}")
    return _cells(spark, target, now, [cell for cell in now.cells if months is None or cell[0] in months])


def merge(spark: SparkSession, batch: DataFrame, target: str, version: str = "_version", buckets: int = BUCKETS) -> Merged:
    """Upsert: per id the newest row stays.

    ``batch`` has id, timestamp, year_month and the column ``version``. Newest is the largest version,
    then the latest timestamp; rows that agree in both are told apart by their content, so the outcome
    does not depend on the order of rows, and repeating a batch changes nothing. Rows without a month
    go to one named month. New columns are NULL in older rows.

    Read are the index of the buckets that receive rows, and the cells that receive rows or hold an
    older row of an id in the batch; nothing else of the table is read or written.
    """
    now = snapshot(spark, target, buckets)
    staged = f"{work_dir(spark)}/merge-{uuid.uuid4().hex}"
    try:
        return _merge(spark, batch, target, version, now, staged)
    finally:
        delete(spark, staged)


def _merge(spark: SparkSession, batch: DataFrame, target: str, version: str, now: Snapshot, staged: str) -> Merged:
    def placed(df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64("id"), F.lit(now.buckets)).cast("int")
        return df.withColumns({"_m": F.col("year_month"), "_b": bucket})

    def distinct(df: DataFrame) -> set[tuple[str, int]]:  # months times buckets
        return {(r["_m"], r["_b"]) for r in df.select("_m", "_b").distinct().collect()}

    batch = with_month_partition(batch)
    batch.write.parquet(f"{staged}/batch")
    batch = spark.read.schema(batch.schema).parquet(f"{staged}/batch")
    touched = distinct(placed(batch))
    hit = {bucket for _, bucket in touched}
    folders = [f"{target}/{now.index[b]}" for b in sorted(hit) if b in now.index]
    index = spark.read.schema(_ID).parquet(*folders) if folders else spark.createDataFrame([], _ID)
    touched |= distinct(placed(index.join(batch.select("id").distinct(), "id", "left_semi")))

    merged = batch
    if now.schema is not None:
        merged = _cells(spark, target, now, touched).unionByName(batch, allowMissingColumns=True)
    newest = Window.partitionBy("id").orderBy(F.desc(version), F.desc("timestamp"), F.xxhash64(*sorted(batch.columns)))
    merged = merged.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    name = uuid.uuid4().hex
    (placed(merged).hint("rebalance", "_m", "_b").write.partitionBy("_m", "_b").parquet(f"{target}/data/{name}"))
    written = spark.read.schema(T.StructType([*merged.schema, T.StructField("_m", T.StringType()), T.StructField("_b", T.IntegerType())])
                                ).parquet(f"{target}/data/{name}")
    cells = distinct(written)
    moved = written.select("id", "year_month")
    placed(index.join(moved.select("id"), "id", "left_anti").unionByName(moved)).drop("_m").hint("rebalance", "_b").write.partitionBy(
        "_b").parquet(f"{target}/index/{name}")

    following = Snapshot(
        now.number + 1, now.buckets, json.loads(merged.schema.json()),
        {**{c: f for c, f in now.cells.items() if c not in touched}, **{(m, b): f"data/{name}/_m={m}/_b={b}" for m, b in cells}},
        {**now.index, **{b: f"index/{name}/_b={b}" for b in hit}})
    switch(spark, target, following)
    vacuum(spark, target)
    return Merged(touched & set(now.cells), hit, cells)


def switch(spark: SparkSession, target: str, to: Snapshot) -> None:
    """Makes a snapshot the table, in one step."""
    write_text(spark, f"{target}/manifest/{to.number:012d}.json", to.to_json())


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Deletes manifests but the last ``keep``, and merges of which no kept one names a folder.

    Readers that began with the table before the last merge still find their files.
    """
    names = snapshots(spark, target)
    used: set[str] = set()
    for name in names[-keep:]:
        used |= {"/".join(folder.split("/")[:2]) for folder in Snapshot.of(read_text(spark, f"{target}/manifest/{name}")).folders()}
    for kind in ("data", "index"):
        for name in file_names(spark, f"{target}/{kind}"):
            if f"{kind}/{name}" not in used:
                delete(spark, f"{target}/{kind}/{name}")
    for name in names[:-keep]:
        delete(spark, f"{target}/manifest/{name}")
