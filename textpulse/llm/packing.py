"""Mixture-controlled packing: deficit round-robin over source queues."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import map_batches, stage, table
from textpulse.llm.encode import encoded

SCALE = 1 << 24  # queue weights are integers of about this sum
MAX_QUEUES = 10_000  # distinct sources; the schedule holds a few numbers for each


@dataclass
class Schedule:
    """How many tokens of each queue come before each window, in closed form.

    Every window grants each queue with tokens left its quantum, weight / sum of weights of the
    window. A fraction of a token that a queue could not use stays in its deficit for the next
    window. As quanta are constant until some queue runs dry, the tokens that queue s has sent
    before window j are a floor of a linear function of j within each of at most 2 x queues
    phases. Any task can evaluate it for any window, so the deficits carry over windows and over
    partitions without a running state.
    """

    totals: np.ndarray  # tokens per queue
    first: np.ndarray  # first window of each phase
    sent: np.ndarray  # [phase, queue] tokens sent before the phase
    whole: np.ndarray  # [phase, queue] whole tokens of the quantum
    part: np.ndarray  # [phase, queue] remainder of the quantum, over `over`
    over: np.ndarray  # [phase]
    windows: int

    @classmethod
    def of(cls, totals: list[int], weights: list[float], window: int) -> Schedule:
        left = [int(n) for n in totals]
        scale = SCALE / (sum(weights) or 1)
        shares = [max(1, round(w * scale)) for w in weights]
        first, sent, whole, part, over, at = [], [], [], [], [], 0
        while any(left):
            live = [s if n else 0 for s, n in zip(shares, left)]
            total = sum(live)
            quanta = [window * s for s in live]
            # Whole windows until a queue would have to send more than it has.
            length = min(((n + 1) * total - 1) // q for n, q in zip(left, quanta) if q)
            for span in ((length, 1) if length else (1,)):
                first.append(at)
                sent.append([n - m for n, m in zip(totals, left)])
                over.append(total)
                if span == length and length:
                    whole.append([q // total for q in quanta])
                    part.append([q % total for q in quanta])
                    left = [n - q * span // total for n, q in zip(left, quanta)]
                else:
                    # The window in which a queue sends its last tokens.
                    now = [min(n, -(-q // total)) for n, q in zip(left, quanta)]
                    whole.append(now)
                    part.append([0] * len(now))
                    left = [n - m for n, m in zip(left, now)]
                at += span
        first.append(at)
        sent.append(list(totals))
        zero = [0] * len(totals)
        table_of = lambda rows: np.array(rows, np.int64).reshape(len(rows), len(totals))
        return cls(np.array(totals, np.int64), np.array(first, np.int64), table_of(sent), table_of([*whole, zero]),
                   table_of([*part, zero]), np.array([*over, 1], np.int64), at)

    def before(self, window: np.ndarray, queue: np.ndarray | slice) -> np.ndarray:
        """Tokens that ``queue`` has sent before ``window``; a slice gives a column per queue."""
        phase = np.searchsorted(self.first, window, "right") - 1
        steps = window - self.first[phase]
        over = self.over[phase]
        if isinstance(queue, slice):
            steps, over = steps[:, None], over[:, None]
        return self.sent[phase, queue] + steps * self.whole[phase, queue] + steps * self.part[phase, queue] // over

    def window_of(self, token: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """The window in which the queue's ``token`` is sent."""
        low, high = np.zeros_like(token), np.full_like(token, self.windows)
        while (high - low > 1).any():
            middle = (low + high) // 2
            reached = self.before(middle, queue) <= token
            low, high = np.where(reached, middle, low), np.where(reached, high, middle)
        return low


def sequence_starts(total: int, length: int) -> np.ndarray:
    """Starts of the sequences behind the last full one, and the end.

    What is left over is cut into powers of two, which need no padding.
    """
    at, starts = total - total % length, []
    rest = total % length
    while rest:
        starts.append(at)
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
    return np.array([*starts, total], np.int64)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value for every value from first to last of each row."""
    count = last - first + 1
    row = np.repeat(np.arange(len(first)), count)
    return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def pieces(start: np.ndarray, tokens: np.ndarray, queue: np.ndarray, schedule: Schedule, length: int) -> dict[str, np.ndarray]:
    """Pieces of documents that begin at ``start`` in the stream of their ``queue``."""
    total = int(schedule.totals.sum())
    tail = sequence_starts(total, length)
    full = total // length
    row, window = _spread(schedule.window_of(start, queue), schedule.window_of(start + tokens - 1, queue))
    low = np.maximum(start[row], schedule.before(window, queue[row]))
    high = np.minimum(start[row] + tokens[row], schedule.before(window + 1, queue[row]))
    some = high > low
    row, window, low, high = row[some], window[some], low[some], high[some]
    # Within a window the queues take turns in order; windows follow each other gapless.
    distinct, place = np.unique(window, return_inverse=True)
    begun, done = schedule.before(distinct, slice(None)), schedule.before(distinct + 1, slice(None))
    turn = begun.sum(axis=1, keepdims=True) + np.cumsum(done - begun, axis=1) - (done - begun)
    at = turn[place, queue[row]] + low - begun[place, queue[row]]

    def sequence(position):
        return np.where(position < full * length, position // length, full + np.searchsorted(tail, position, "right") - 1)

    def begin(number):
        return np.where(number < full, number * length, tail[np.clip(number - full, 0, len(tail) - 1)])

    part, number = _spread(sequence(at), sequence(at + high - low - 1))
    begins = np.maximum(at[part], begin(number))
    ends = np.minimum((at + high - low)[part], begin(number + 1))
    return {"row": row[part], "start": (low - start[row])[part] + begins - at[part], "length": ends - begins,
            "sequence_id": number, "offset": begins - begin(number), "window": window[part]}


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(part, queue, doc_id, start, n_tokens, ids): ``start`` counts the queue's tokens in the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids, dtype = encoded(batch.column(2), tokenizer, end_id)
            starts = []
            for source, own in zip(batch.column(1).to_pylist(), ids):
                starts.append(sent.get(source, 0))
                sent[source] = starts[-1] + len(own) // dtype.itemsize
            n = [len(own) // dtype.itemsize for own in ids]
            yield pa.record_batch([pa.array([part] * len(ids), pa.int64()), batch.column(1), batch.column(0),
                                   pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                                  ["part", "queue", "doc_id", "start", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "part long, queue string, doc_id long, start long, n_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer: str, weights: dict[str | None, float] | None = None, length: int = 2048,
         window: int = 16 * 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, ids, doc_tokens, sequence_id, offset, window.

    Every source is a queue. A window is a run of ``window`` tokens; each holds the sources in
    proportion to ``weights`` (default: their share of all tokens) as long as they last, then the
    others in proportion. Sequences of ``length`` are cut from the gapless row of windows; the
    tokens behind the last full sequence form sequences of powers of two, so nothing is padded.
    ``ids`` are a piece's ids as little-endian 32-bit integers.

    A null text is an empty document of the end id alone; a null source is a queue of its own;
    repeated rows and null ids are packed like others; a source without a weight gets the smallest;
    no rows give no pieces. More than ``MAX_QUEUES`` sources raise ValueError.

    Documents are encoded once into a staged table. Each task counts the tokens of each source it
    has written; running sums of these counts, one row per task and source, place every document.
    """
    staged = stage(tokenized(docs, tokenizer, end_id))
    counts = staged.groupBy("part", "queue").agg(F.sum("n_tokens").alias("n"))
    order = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(counts.select("part", "queue", "n", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")))
    totals = bases.groupBy("queue").agg(F.sum("n").alias("n")).limit(MAX_QUEUES + 1).collect()
    if len(totals) > MAX_QUEUES:
        raise ValueError(f"more than {MAX_QUEUES} sources: group them before packing")
    totals = sorted((r.queue is not None, r.queue or "", r.n) for r in totals)
    names = [name if given else None for given, name, _ in totals]
    sizes = [n for *_, n in totals]
    share = sizes if weights is None else [float(weights.get(name, 0)) for name in names]
    schedule = Schedule.of(sizes, share, window)
    number = {name: i for i, name in enumerate(names)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        start, n = (columns[c].to_numpy() for c in ("start", "n_tokens"))
        queue = np.array([number[q] for q in columns["queue"].to_pylist()], np.int64)
        cut = pieces(start, n, queue, schedule, length)
        ids = columns["ids"].to_pylist()
        width = len(ids[0]) // int(n[0])
        own, last, out = b"", -1, []
        for row, at, size in zip(cut["row"].tolist(), cut["start"].tolist(), cut["length"].tolist()):
            if row != last:
                own, last = np.frombuffer(ids[row], f"<u{width}").astype("<u4").tobytes(), row
            out.append(own[4 * at:4 * (at + size)])
        rows = pa.array(cut["row"])
        return pa.record_batch(
            [columns["doc_id"].take(rows), columns["queue"].take(rows), pa.array(cut["start"]), pa.array(cut["length"]),
             pa.array(out, pa.binary()), pa.array(n[cut["row"]]), pa.array(cut["sequence_id"]), pa.array(cut["offset"]),
             pa.array(cut["window"])],
            ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window"])

    joined = (staged.alias("s").join(bases.alias("b"), (F.col("s.part") == F.col("b.part")) & F.col("s.queue").eqNullSafe(F.col("b.queue")))
              .select("s.doc_id", "s.queue", (F.col("s.start") + F.col("b.base")).alias("start"), "s.n_tokens", "s.ids"))
    return map_batches(joined, run, "doc_id long, source string, start long, length long, ids binary, doc_tokens long, "
                                    "sequence_id long, offset long, window long")


def digests(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "source", "window")


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
