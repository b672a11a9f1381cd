"""Token ids in Arrow files of fixed-size-list batches, with zero-copy random access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import folder, stage, table
from textpulse.llm.encode import encoded

LENGTH = 2048  # ids of a sequence
SEQUENCES = 32  # sequences of a batch; every batch but a file's last has so many
UNKNOWN = 1 << 60  # a table that is no file counts as endless in Spark's estimates
FILE_BYTES = 256 << 20  # bytes of the documents table that go into a file, at most about


class TokenWriter:
    """Cuts a stream of ids into equal sequences and writes them as batches of one Arrow file.

    A file has the columns ids, fixed-size list of ``length`` unsigned integers, and mask, fixed-size
    list of ``length`` bits (true: an id, false: padding). Only the last sequence is padded. A second
    Arrow file beside it has a row per document: doc_id, start in the file, n_tokens. Both get their
    final names when complete, so a task that dies leaves no half file under a name that is read.
    """

    def __init__(self, uri: str, name: str, dtype: np.dtype, length: int = LENGTH):
        self.fs, self.root = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.root, recursive=True)
        self.name, self.dtype, self.length = name, dtype, length
        self.attempt = f"{self.root}/.{name}-{uuid.uuid4().hex}"
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))],
                                {"length": str(length), "sequences": str(SEQUENCES)})
        self.sink = self.fs.open_output_stream(f"{self.attempt}.arrow")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.index_sink = self.fs.open_output_stream(f"{self.attempt}.index")
        self.index = pa.ipc.new_file(self.index_sink, self.index_schema)
        self.waiting, self.held, self.tokens, self.docs = [], 0, 0, 0

    def add(self, doc_ids: pa.Array, ids: list[bytes]) -> None:
        n = np.array([len(x) // self.dtype.itemsize for x in ids], np.int64)
        starts = self.tokens + np.cumsum(n) - n
        self.index.write_batch(pa.record_batch([doc_ids, pa.array(starts), pa.array(n)], schema=self.index_schema))
        self.tokens, self.docs = self.tokens + int(n.sum()), self.docs + len(ids)
        self.waiting += ids
        self.held += int(n.sum())
        full = self.length * SEQUENCES
        if self.held >= full:
            stream = np.frombuffer(b"".join(self.waiting), self.dtype)
            whole = len(stream) // full * full
            for at in range(0, whole, full):
                self._write(stream[at:at + full])
            self.waiting, self.held = [stream[whole:].tobytes()], len(stream) - whole

    def _write(self, ids: np.ndarray) -> None:
        count = -(-len(ids) // self.length)
        padded = np.zeros(count * self.length, self.dtype)
        padded[:len(ids)] = ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length)
                 for v in (padded, np.arange(len(padded)) < len(ids))]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> dict:
        if self.held:
            self._write(np.frombuffer(b"".join(self.waiting), self.dtype))
        for writer, sink in ((self.writer, self.sink), (self.index, self.index_sink)):
            writer.close()
            sink.close()
        for end in ("index", "arrow"):
            self.fs.move(f"{self.attempt}.{end}", f"{self.root}/{self.name}.{end}")
        return {"file": self.name, "docs": self.docs, "tokens": self.tokens}


class TokenFile:
    """Random access to a written file.

    On a local or mounted path the file is memory-mapped: ``sequence`` and ``mask`` are views of
    it, ``document`` is one where the document lies within a batch.
    """

    def __init__(self, uri: str, name: str):
        fs, root = pafs.FileSystem.from_uri(uri)
        path = f"{root}/{name}"
        local = isinstance(fs, pafs.LocalFileSystem)
        opened = [pa.memory_map(f"{path}.{end}") if local else fs.open_input_file(f"{path}.{end}") for end in ("arrow", "index")]
        self.reader, self.index = pa.ipc.open_file(opened[0]), pa.ipc.open_file(opened[1])
        self.length = int(self.reader.schema.metadata[b"length"])
        self.per_batch = int(self.reader.schema.metadata[b"sequences"])
        self._batch: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, k: int) -> pa.RecordBatch:
        if self._batch[0] != k:
            self._batch = (k, self.reader.get_batch(k))
        return self._batch[1]

    def sequence(self, k: int) -> np.ndarray:
        at = k % self.per_batch
        return self._ids(k // self.per_batch)[at * self.length:(at + 1) * self.length]

    def mask(self, k: int) -> pa.Array:
        return self.batch(k // self.per_batch).column(1).slice(k % self.per_batch, 1).flatten()

    def _ids(self, k: int) -> np.ndarray:
        return self.batch(k).column(0).flatten().to_numpy(zero_copy_only=True)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on in the file."""
        size = self.length * self.per_batch
        parts = []
        while n:
            at = start % size
            take = min(n, size - at)
            parts.append(self._ids(start // size)[at:at + take])
            start, n = start + take, n - take
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.index.num_record_batches):
            yield self.index.get_batch(k)


def write_tokens(docs: DataFrame, tokenizer: str, uri: str, end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the manifest (file, docs, tokens, base).

    Files are numbered in order, ``base`` is the number of ids in those before. Null ids come
    first, a null text is an empty document of the end id alone, rows with equal ids are ordered
    by text; no rows give no files. Rows of one id may be spread over several files.

    Texts are range-partitioned, then encoded and written where they arrive, so each text is moved
    once and encoded once. A repeated task writes the same file again.
    """
    row = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The hash and the row number part rows of equal ids, which would else share one file.
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.monotonically_increasing_id().asc()]
    # No fewer files than the session has partitions, and more as the table grows: a file is one task.
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    needed = -(-size // FILE_BYTES) if size < UNKNOWN else 1
    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), needed)
    ranged = row.repartitionByRange(count, *keys).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if batch.num_rows:
                ids, dtype = encoded(batch.column(1), tokenizer, end_id)
                if writer is None:
                    writer = TokenWriter(uri, f"part-{TaskContext.get().partitionId():06d}", dtype, length)
                writer.add(batch.column(0), ids)
        if writer:
            yield pa.RecordBatch.from_pylist([writer.close()])

    files = stage(ranged.mapInArrow(run, "file string, docs long, tokens long"))
    # One row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files; ids as in the file, start over all files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                file = TokenFile(uri, entry["file"])
                for index in file.documents():
                    start, n = index.column(1).to_numpy(), index.column(2).to_numpy()
                    ids = [file.tokens(s, k).astype("<u4").tobytes() for s, k in zip(start.tolist(), n.tolist())]
                    yield pa.record_batch([index.column(0), pa.array(start + entry["base"]), index.column(2), pa.array(ids, pa.binary())],
                                          ["doc_id", "start", "n_tokens", "ids"])

    files = manifest.select("file", "base")
    # As many tasks as the session has partitions, and no more than about four files in each.
    count = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count() // 4)
    spread = files.repartition(count)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op4_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = folder(spark, "tokens")
    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), uri)
    return read_tokens(manifest, uri).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
