"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.llm.common import map_batches, numbered, raw, stage, table

TOPICS = 8
MARGINS = ("source", "lang", "topic")
MAX_CELLS = 200_000  # combinations of source, language and topic
ROUNDS = 200  # raking rounds, at most
TOLERANCE = 0.01  # a margin that is off by more, relatively, is told
CLOSE = 1e-9  # greatest relative error of a margin at which raking ends
#: Share of all tokens raised to this power and normalised is the default target of a value.
TEMPER = 0.9
SEED = 17
LONG = re.compile(rb"[a-z\x80-\xff]{4,}")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def topic(text: bytes | None) -> tuple[int, int]:
    """Number of words of the text and its topic.

    The topic is a hash class of the most frequent word of at least four letters, ties to the
    first in order; class 0 if there is none.
    """
    words = (text or b"").translate(LOWER).split()
    counts = Counter(LONG.findall(b" ".join(words)))
    if not counts:
        return len(words), 0
    most = max(counts.values())
    word = min(w for w, n in counts.items() if n == most)
    return len(words), int.from_bytes(word, "big") % 1_000_003 % TOPICS


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, lang, topic, tokens) per row; tokens are words and one for the end."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, topics = zip(*map(topic, batch.column(4).to_pylist()))
        return pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(topics, pa.int32()), pa.array([n + 1 for n in sizes], pa.int64())],
                               ["row", "doc_id", "source", "lang", "topic", "tokens"])

    rows = docs.select("row", F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), raw("text"))
    return map_batches(rows, run, "row long, doc_id long, source string, lang string, topic int, tokens long")


def shares(values: list, tokens: np.ndarray, target: Mapping | float) -> np.ndarray:
    """Target share of each distinct value: given ones, or the tempered share of its tokens."""
    if isinstance(target, Mapping):
        wanted = np.array([float(target.get(v, 0.0)) for v in values])
    else:
        wanted = (tokens / tokens.sum()) ** target
    if not wanted.sum() > 0:
        raise ValueError("a margin needs a positive target for some value that occurs")
    return wanted / wanted.sum()


def rake(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Weight of each cell so that weighted tokens have the target share in every margin, and the
    greatest relative error of a margin that is left.

    Each step scales the cells of one margin's values to their targets, in turn, until all
    margins hold at once. Cells of a value with target 0 get weight 0. Margins that contradict
    each other through empty cells leave the last scaled one exact, and an error that tells so.
    """
    weights, worst = np.ones(len(tokens)), 0.0
    total = tokens.sum()
    for _ in range(ROUNDS):
        worst = 0.0
        for code, target in zip(codes, targets):
            now = np.bincount(code, weights * tokens, len(target))
            scale = np.divide(target * total, now, out=np.zeros(len(target)), where=now > 0)
            worst = max(worst, np.abs(scale[(now > 0) & (target > 0)] - 1).max(initial=0))
            weights *= scale[code]
        if worst < CLOSE:
            break
    return weights, worst


def calibrated(docs: DataFrame, targets: Mapping[str, Mapping | float] | None = None, seed: int = SEED) -> DataFrame:
    """(row, doc_id, source, lang, topic, tokens, weight, probability, kept) per row of ``docs``.

    ``docs`` has a column row, the same whenever it is read. ``targets`` gives for source, lang and
    topic either shares of tokens by value or a power that tempers the present shares (default
    ``TEMPER`` for each). weight is the raked weight of the row's cell. Probabilities are the weights
    over the greatest one: no more rows are lost than the targets ask, and the expected tokens have
    the target shares exactly. kept is drawn from a hash of row number, id and ``seed``.

    A null source or language is a value of its own, a null or empty text counts one token and
    topic 0; repeated rows are drawn one by one; an empty table gives an empty one. More than
    ``MAX_CELLS`` cells raise ValueError: margins must be coarsened then.

    Cell counts are combined in the map tasks over all rows. The cells, bounded as said, are
    raked on the driver and joined back by broadcast.
    """
    spark = docs.sparkSession
    rows = stage(measured(docs))
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")).limit(MAX_CELLS + 1).collect()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells: coarsen the margins")
    cells.sort(key=lambda r: [(r[m] is not None, r[m] if r[m] is not None else 0) for m in MARGINS])
    tokens = np.array([float(r.tokens) for r in cells])
    codes, wanted = [], []
    for margin in MARGINS if cells else ():
        values = sorted({r[margin] for r in cells}, key=lambda v: (v is not None, v if v is not None else 0))
        number = {v: i for i, v in enumerate(values)}
        code = np.array([number[r[margin]] for r in cells])
        codes.append(code)
        wanted.append(shares(values, np.bincount(code, tokens), (targets or {}).get(margin, TEMPER)))
    weights, residual = rake(tokens, codes, wanted) if cells else (np.zeros(0), 0.0)
    if residual > TOLERANCE:
        warnings.warn(f"margins contradict each other: one is off by {residual:.3g} of its target", stacklevel=2)
    top = weights.max(initial=0) or 1.0
    factors = spark.createDataFrame([(r.source, r.lang, r.topic, float(w), float(w / top)) for r, w in zip(cells, weights)],
                                    "s string, l string, t int, weight double, probability double")
    met = F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l")) & (F.col("topic") == F.col("t"))
    # 53 bits of a hash as a number from 0 to 1.
    draw = F.call_function("shiftrightunsigned", F.xxhash64(F.lit(seed), "row", "doc_id"), F.lit(11)) / float(1 << 53)
    return (rows.join(F.broadcast(factors), met).drop("s", "l", "t").withColumn("kept", draw < F.col("probability")))


def sample(docs: DataFrame, targets: Mapping[str, Mapping | float] | None = None) -> DataFrame:
    """The drawn rows of ``docs``, a stored table, with all their columns."""
    whole, where = numbered(docs)
    needed = whole.select("row", *[F.col(where[c]).alias(c) for c in ("doc_id", "source", "lang", "text")])
    kept = stage(calibrated(needed, targets).filter("kept").select("row"))
    # The same plan at every size: whether one side is small must not decide what is moved.
    return whole.join(kept.hint("merge"), "row", "left_semi").select(*[F.col(n).alias(c) for c, n in where.items()])


def op6_mixture_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, where = numbered(table(spark, sf_dir, "documents"))
    return calibrated(whole.select("row", *[F.col(where[c]).alias(c) for c in ("doc_id", "source", "lang", "text")])).select("doc_id", "source", "lang", "topic", "tokens", F.round("weight", 9).alias("weight"),
                                   F.round("probability", 9).alias("probability"), "kept")
