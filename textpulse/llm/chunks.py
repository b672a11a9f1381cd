"""Substring dedup by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import discard, map_batches, numbered, raw, stage, table

LOOK_BACK = 16  # bytes that the gear hash remembers
ONE_CUT_IN = 4  # every so many word ends, on average, could end a chunk
FEWEST_WORDS, MOST_WORDS = 3, 24  # words of a chunk
LEAST_WORDS = 50  # repeated runs of fewer words stay
LEAST_RUN = 2 * FEWEST_WORDS  # words of repeated chunks in a row that are looked at
EDGE_WORDS = 2 * MOST_WORDS  # words compared on either side of a piece; what lies farther is settled by hashes
BESIDE = 2  # chunks beside a region whose words are hashed with it
PRIME = 0x9E3779B97F4A7C15  # odd
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: One pseudo-random number for each byte value, from a rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


def normal_words(text: bytes | None) -> list[bytes]:
    """Words without ASCII white space, A-Z lower-cased: what is compared."""
    return (text or b"").translate(LOWER).split()


def gear(data: bytes) -> np.ndarray:
    """The gear hash after each byte: sum over the last LOOK_BACK bytes of GEAR[byte] << age.

    Doubling the span of the sums evaluates all positions in log2(LOOK_BACK) vector steps.
    """
    sums = GEAR[np.frombuffer(data, np.uint8)]
    span = 1
    while span < LOOK_BACK:
        older = np.zeros_like(sums)
        older[span:] = sums[:-span] << np.uint32(span)
        sums = sums + older
        span *= 2
    return sums


def chunk_ends(words: list[bytes]) -> np.ndarray:
    """Word numbers behind which a chunk ends; the last is the number of words."""
    if not words:
        return np.zeros(0, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(lengths + 1) - 1  # of each word: the blank behind it
    # Bits that all remembered bytes reach lie from LOOK_BACK - 1 upwards.
    hashes = gear(b" ".join(words) + b" ")[last] >> np.uint32(LOOK_BACK - 1)
    ends, before = [], 0
    for end in (*(np.flatnonzero(hashes % ONE_CUT_IN == 0) + 1).tolist(), len(words)):
        while end - before > MOST_WORDS:  # counted from the cut before, so equal runs are cut alike
            before += MOST_WORDS
            ends.append(before)
        if end - before >= FEWEST_WORDS or end == len(words) > before:
            ends.append(end)
            before = end
    return np.array(ends, np.int64)


def chunked(docs: DataFrame) -> DataFrame:
    """(digest, row, first, words, again) of every chunk.

    ``first`` is the number of its first word, ``again`` that of an equal chunk's earlier in the
    same row, -1 if there is none: repetitions within a text never meet in a shuffle.
    """
    digest = xxhash.xxh64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sizes, firsts, counts, again = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            words = normal_words(text)
            ends = chunk_ends(words).tolist()
            starts, seen = [0, *ends[:-1]] if ends else [], {}
            for a, b in zip(starts, ends):
                own = digest(b" ".join(words[a:b]))
                earlier = seen.setdefault(own, a)
                digests.append(own)
                again.append(earlier if earlier < a else -1)
                counts.append(b - a)
            sizes.append(len(ends))
            firsts += starts
        rows = np.repeat(batch.column(0).to_numpy(), sizes)
        return pa.record_batch([pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(rows), pa.array(firsts, pa.int32()),
                                pa.array(counts, pa.int32()), pa.array(again, pa.int32())], ["digest", "row", "first", "words", "again"])

    return map_batches(docs.select("row", raw("text")), run, "digest long, row long, first int, words int, again int", sliced=True)


def _adjoining(found: DataFrame, *same: str) -> DataFrame:
    """``found`` with run: chunks of a row that follow each other without a gap, and agree in ``same``, share one."""
    inside = Window.partitionBy("row").orderBy("first")
    follows = F.col("first") == F.lag(F.col("first") + F.col("words")).over(inside)
    for column in same:
        follows &= F.col(column) == F.lag(column).over(inside)
    opens = F.when(follows, 0).otherwise(1)
    return found.withColumn("opens", opens).withColumn("run", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))


def _pieces(links: DataFrame, least_run: int) -> DataFrame:
    """(row, first, last, kept_row, shift): repeated chunks in a row that stand in a row at their kept place, too.

    Word w of the piece is word w + shift of kept_row. A piece ends where the kept row or the shift
    changes, so it never joins texts that stand apart where they come from.
    """
    placed = links.withColumn("shift", F.col("kept_first") - F.col("first"))
    return (_adjoining(placed, "kept_row", "shift").groupBy("row", "run", "kept_row", "shift")
            .agg(F.min("first").alias("first"), F.max(F.col("first") + F.col("words")).alias("last"))
            .filter(F.col("last") - F.col("first") >= least_run).select("row", "first", "last", "kept_row", "shift"))


def _contexts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(row, at, after, words): hashes of up to EDGE_WORDS words before or after a place, nearest first."""
    place = lambda row, at, after: runs.select(F.col(row).alias("row"), F.struct(at.alias("at"), F.lit(after).alias("after")).alias("place"))
    places = (place("row", F.col("first"), False).union(place("kept_row", F.col("first") + F.col("shift"), False))
              .union(place("row", F.col("last"), True)).union(place("kept_row", F.col("last") + F.col("shift"), True)))
    # Distinct first: the kept place of a common passage is asked for by every document that repeats it.
    wanted = places.distinct().groupBy("row").agg(F.collect_list("place").alias("places"))  # bounded by the row's text

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
            words = normal_words(text)
            for p in asked:
                at = max(0, p["at"])
                near = words[at:at + EDGE_WORDS] if p["after"] else words[max(0, at - EDGE_WORDS):at][::-1]
                out.append((row, p["at"], p["after"], [xxhash.xxh32_intdigest(w) for w in near]))
        rows, at, after, words = zip(*out)
        return pa.record_batch([pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(after), pa.array(words, pa.list_(pa.int64()))],
                               ["row", "at", "after", "words"])

    # The same plan at every size: whether one side is small must not decide what is moved.
    joined = docs.select("row", raw("text").alias("text")).join(wanted.hint("merge"), "row").select("row", "text", "places")
    return map_batches(joined, run, "row long, at int, after boolean, words array<long>", sliced=True)


def _equal_prefix(a: str, b: str):
    """Number of leading elements that two arrays share; -1 of no position means all of the shorter."""
    size = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, 1, size), F.slice(b, 1, size), lambda x, y: x == y), False)
    return F.when(size == 0, 0).when(differ > 0, (differ - 1).cast("int")).otherwise(size)


def _merged(spans: DataFrame, *same: str) -> DataFrame:
    """``spans`` numbered by run: those of a row, equal in ``same``, that overlap share one."""
    inside = Window.partitionBy("row", *same).orderBy("first", "last")
    reach = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    # Equal places may also touch; texts from different places that only touch stay apart.
    together = F.col("first") <= reach if same else F.col("first") < reach
    opens = F.when(together, 0).otherwise(1)
    return spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))


def _verified(docs: DataFrame, links: DataFrame, least_words: int) -> DataFrame:
    """(row, first, last, kept_row, shift): spans of ``least_words`` or more that equal a run of words at their kept place."""
    pieces = stage(_pieces(links, min(LEAST_RUN, least_words)))
    beside = stage(_contexts(docs, pieces))
    out = pieces
    for after, edge in ((False, "first"), (True, "last")):
        near = beside.filter(F.col("after") == after)
        own = near.select("row", F.col("at").alias("own_at"), F.col("words").alias("own_words"))
        kept = near.select(F.col("row").alias("kept_row"), F.col("at").alias("kept_at"), F.col("words").alias("kept_words"))
        placed = out.withColumn("own_at", F.col(edge)).withColumn("kept_at", F.col(edge) + F.col("shift"))
        grown = placed.join(own, ["row", "own_at"]).join(kept, ["kept_row", "kept_at"])
        more = _equal_prefix("own_words", "kept_words")
        out = grown.withColumn(edge, F.col(edge) + more if after else F.col(edge) - more).select("row", "first", "last", "kept_row", "shift")
    spans = stage(_merged(out, "kept_row", "shift").groupBy("row", "kept_row", "shift", "run")
                  .agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")
                  .filter(F.col("last") - F.col("first") >= least_words))
    discard(pieces)
    discard(beside)
    return spans


def _unsettled(links: DataFrame, spans: DataFrame, least_words: int) -> DataFrame:
    """Digests of repeated chunks that no verified span explains.

    A run of repeated chunks inside one span is settled, and so is a chunk so deep in a span that
    ``least_words`` words around it are, too. What is left may repeat another place than the chunks'
    first ones, or be made of parts that do not stand together anywhere.
    """
    whole = Window.partitionBy("row", "run")
    runs = _adjoining(links).select("digest", "row", "first", F.col("first").alias("low"), (F.col("first") + F.col("words")).alias("high"),
                                    F.min("first").over(whole).alias("run_low"), F.max(F.col("first") + F.col("words")).over(whole).alias("run_high"))
    long = runs.filter(F.col("run_high") - F.col("run_low") >= min(LEAST_RUN, least_words))
    known = spans.select("row", F.col("first").alias("f"), F.col("last").alias("l"))
    covered = ((F.col("f") <= F.col("run_low")) & (F.col("l") >= F.col("run_high"))) | (
        (F.col("f") <= F.col("low") - least_words) & (F.col("l") >= F.col("high") + least_words))
    return (long.alias("a").join(known.alias("b"), (F.col("a.row") == F.col("b.row")) & covered, "left_anti")
            .select("digest").distinct())


def _windows(docs: DataFrame, regions: DataFrame, spans: DataFrame, least_words: int) -> DataFrame:
    """(high, low, row, at): 128-bit hashes of all runs of ``least_words`` words in or beside ``regions``, but not in a span."""
    def listed(df: DataFrame, name: str) -> DataFrame:  # disjoint, bounded by the row's text
        return df.groupBy("row").agg(F.collect_list(F.struct(F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"))).alias(name))

    asked = listed(regions, "regions").join(listed(spans, "spans"), "row", "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for row, text, own, known in zip(*(c.to_pylist() for c in batch.columns)):
            words = normal_words(text)
            ends = np.concatenate([[0], chunk_ends(words)])
            wanted = np.zeros(max(0, len(words) - least_words + 1), bool)
            for r in own:
                # Chunks beside the region may hold words of the passage, cut elsewhere.
                low = ends[max(0, np.searchsorted(ends, r["first"]) - BESIDE)]
                high = ends[min(len(ends) - 1, np.searchsorted(ends, r["last"]) + BESIDE)]
                wanted[low:max(low, high - least_words + 1)] = True
            for s in known or ():
                wanted[s["first"]:s["last"] - least_words + 1] = False
            at = np.flatnonzero(wanted)
            if len(at):
                out.append((np.full(len(at), row), at, *(window_hashes(words, least_words, seed)[at] for seed in (1, 2))))
        if not out:
            return None
        row, at, high, low = map(np.concatenate, zip(*out))
        return pa.record_batch([pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(row, pa.int64()), pa.array(at, pa.int32())],
                               ["high", "low", "row", "at"])

    # The same plan at every size: whether one side is small must not decide what is moved.
    joined = docs.select("row", raw("text").alias("text")).join(asked.hint("merge"), "row").select("row", "text", "regions", "spans")
    return map_batches(joined, run, "high long, low long, row long, at int", sliced=True)


def window_hashes(words: list[bytes], size: int, seed: int) -> np.ndarray:
    """A polynomial hash, modulo 2^64, of every run of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, seed) for w in set(words)}
    values = np.fromiter((known[w] for w in words), np.uint64, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(PRIME) + values[k:k + len(out)]
    return out


def _elsewhere(docs: DataFrame, chunks: DataFrame, links: DataFrame, spans: DataFrame, least_words: int) -> DataFrame:
    """(row, first, last, kept_row, shift): repeats that the first places of the chunks do not show.

    All runs of ``least_words`` words around unsettled chunks, wherever these stand, are compared by
    hash. The first of equal runs lies in no verified span, as a span repeats something before it.
    """
    digests = stage(_unsettled(links, spans, least_words))
    met = _adjoining(chunks.join(digests, "digest", "left_semi").select("row", "first", "words"))
    regions = (met.groupBy("row", "run").agg(F.min("first").alias("first"), F.max(F.col("first") + F.col("words")).alias("last"))
               .filter(F.col("last") - F.col("first") >= min(LEAST_RUN, least_words)))
    windows = stage(_windows(docs, regions, spans, least_words))
    # A table of its own: a join of two plain shuffles is one that adaptive execution splits at a hot hash.
    kept = stage(windows.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(F.struct("row", "at")).alias("kept"))
                 .filter("n > 1").select("high", "low", F.col("kept.row").alias("kept_row"), F.col("kept.at").alias("kept_at")))
    again = (windows.join(kept, ["high", "low"]).filter((F.col("row") != F.col("kept_row")) | (F.col("at") != F.col("kept_at")))
             .select("row", F.col("at").alias("first"), (F.col("at") + least_words).alias("last"), "kept_row", (F.col("kept_at") - F.col("at")).alias("shift")))
    out = stage(_merged(again, "kept_row", "shift").groupBy("row", "kept_row", "shift", "run")
                .agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run"))
    for table_of in (digests, windows, kept):
        discard(table_of)
    return out


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(row, first, last, kept_row): runs of at least ``least_words`` words seen before, disjoint within a row.

    ``docs`` has text and row, a number of its own for every row that is the same whenever the
    table is read; rows are in the order of these numbers. Words are compared with A-Z lower-cased
    and white space as one blank. ``last`` is behind the last word. Spans that overlap are one, with
    the kept row of the longest.

    Of every repeated chunk the occurrence in the first row is kept. Neighbouring later ones whose
    kept places adjoin, too, form a piece; a piece is extended on both sides word by word as long as
    the text equals the text beside its kept place. Repeated chunks that are left over, as where a
    passage is made of others or its chunks were first met in different rows, are settled by hashes
    of all runs of ``least_words`` words around them.

    A chunk is moved as a digest and a place, never as text. First occurrences are minima that are
    combined in the map tasks, so a passage in a third of all documents is one row per task there, and
    the joins back are ones that adaptive execution splits.
    """
    chunks = stage(chunked(docs))
    heads = chunks.filter("again < 0").select("digest", "row", "first", "words")
    firsts = (heads.groupBy("digest").agg(F.count("*").alias("n"), F.min("row").alias("kept_row"), F.min_by("first", "row").alias("kept_first"))
              .filter("n > 1").drop("n"))
    found = heads.join(firsts, "digest").filter("kept_row <> row").select("digest", "row", "first", "words", "kept_row", "kept_first")
    inner = chunks.filter("again >= 0").select("digest", "row", "first", "words", F.col("row").alias("kept_row"), F.col("again").alias("kept_first"))
    links = stage(found.union(inner))
    spans = _verified(docs, links, least_words)
    others = _elsewhere(docs, chunks, links, spans, least_words)
    longest = F.max_by("kept_row", F.struct(F.col("last") - F.col("first"), -F.col("kept_row")))
    out = stage(_merged(spans.union(others.select(spans.columns))).groupBy("row", "run")
                .agg(F.min("first").alias("first"), F.max("last").alias("last"), longest.alias("kept_row")).drop("run"))
    for table_of in (chunks, links, spans, others):
        discard(table_of)
    return out


def find_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, first_word, last_word, n_words, kept_doc_id) of every repeated span.

    ``docs`` is a stored table. Documents without a repeated span have no row. Null and empty
    texts have no span; repeated rows are copies of the first; null ids stay null; an empty table
    gives no spans.
    """
    whole, where = numbered(docs)
    rows = whole.select("row", F.col(where["doc_id"]).cast("long").alias("doc_id"), F.col(where["text"]).cast("string").alias("text"))
    spans = repeated_spans(rows, least_words)
    ids = rows.select("row", "doc_id")
    kept = ids.select(F.col("row").alias("kept_row"), F.col("doc_id").alias("kept_doc_id"))
    return (spans.join(ids, "row").join(kept, "kept_row")
            .select("doc_id", F.col("first").cast("long").alias("first_word"), (F.col("last") - 1).cast("long").alias("last_word"),
                    (F.col("last") - F.col("first")).cast("long").alias("n_words"), "kept_doc_id"))


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; the white space before a span's first word stays."""
    ends = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, at = [], 0
    for first, last in sorted(spans):
        out.append(text[at:ends[first][0]])
        at = ends[last - 1][1]
        while at < len(text) and text[at:at + 1] in b" \t\n\x0b\x0c\r":
            at += 1
    out.append(text[at:])
    return b"".join(out)


def cut_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs``, a stored table, with repeated spans cut from text, all columns kept; n_chars, if there, follows.

    Every row stays, also one that is left without a word; nulls stay nulls.
    """
    whole, where = numbered(docs)
    text = where["text"]
    spans = (repeated_spans(whole.select("row", F.col(text).cast("string").alias("text")), least_words)
             .groupBy("row").agg(F.collect_list(F.struct(F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"))).alias("spans")))  # disjoint, bounded by the text

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if own is None or t is None else without_spans(t.encode(), [(s["first"], s["last"]) for s in own]).decode()
                          for t, own in zip(texts, spans)])

    changed = whole.join(stage(spans).hint("merge"), "row", "left").withColumn(text, cut(text, "spans"))
    if "n_chars" in where:
        changed = changed.withColumn(where["n_chars"], F.when(F.col("spans").isNull(), F.col(where["n_chars"]))
                                     .otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(n).alias(c) for c, n in where.items()])


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents"))
