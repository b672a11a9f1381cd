"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from textpulse.llm.common import discard, map_batches, numbered, raw, stage, table
from textpulse.llm.components import components

BITS = 64
HASHES_AT_ONCE = 1 << 16  # bit counts of a long text are summed in slices of so many hashes
HOT_BUCKET = 64  # buckets of more fingerprints are cut by the bits outside the segment


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the shingle hashes.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than ``shingle`` are
    one shingle; no word, or null, gives 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64, count).astype(">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, HASHES_AT_ONCE):
        part = hashes[at:at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the fingerprint as a signed long."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), raw("text")), run, "doc_id long, fp long", sliced=True)


def _variants(df: DataFrame, value: Column, width: int, segments: int, name: str) -> DataFrame:
    """One row per segment of ``value`` and wildcard position, and one with no wildcard.

    ``name`` numbers segment, position and remaining bits in one long; ``wild`` is the
    position (-1: none) and ``bit`` the bit that the wildcard hides.
    """
    each = width + 1
    df = df.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(segments * each - 1))))
    seg, wild = F.floor(F.col("v") / each).cast("int"), F.col("v") % each - 1
    part = F.call_function("shiftrightunsigned", value, seg * width).bitwiseAND(F.lit((1 << width) - 1))
    hidden = F.when(wild >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), wild)).otherwise(F.lit(0).cast("long"))
    kept = part.bitwiseAND(F.bitwise_not(hidden))
    number = F.call_function("shiftleft", F.col("v").cast("long"), F.lit(width))
    return df.select(*[c for c in df.columns if c != "v"], number.bitwiseOR(kept).alias(name), wild.alias("wild"),
                     F.when(part.bitwiseAND(hidden) != 0, 1).otherwise(0).alias("bit"))


def _pairs(members: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links among rows with equal keys: the join, then the check of all 64 bits.

    A wildcard bucket pairs only fingerprints that differ in the hidden bit, so two with equal
    segments meet once per segment and not at every position.
    """
    left = members.select(*keys, "wild", F.col("fp").alias("a"), F.col("bit").alias("bit_a"))
    right = members.select(*keys, F.col("fp").alias("b"), F.col("bit").alias("bit_b"))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (left.join(right, keys)
            .filter(F.when(F.col("wild") >= 0, F.col("bit_a") < F.col("bit_b")).otherwise(F.col("a") < F.col("b")))
            .filter(far <= distance).select("a", "b"))


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints at most ``distance`` bits apart.

    ``prints`` has a column fp of distinct values. The 64 bits are cut into just so many
    segments that one of them differs by at most one bit (two for a distance of 2 or 3). Every
    segment is indexed exactly and with each of its bits as a wildcard; fingerprints that share a
    key are checked on all bits. A key of more than ``HOT_BUCKET`` fingerprints, as in a large
    group of near copies, is cut again in the same way by the rest of the bits.
    """
    segments = max(2, distance // 2 + 1)
    width = -(-BITS // segments)
    keyed = _variants(prints.select("fp"), F.col("fp"), width, segments, "key")
    # Most keys belong to one fingerprint and end here; the partitioning serves the count alone.
    shared = stage(keyed.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1"))
    found = _pairs(shared.filter(F.col("n") <= HOT_BUCKET), ["key"], distance)
    hot = shared.filter(F.col("n") > HOT_BUCKET)
    # Within a key the segment differs by one known bit at most, so the rest of the bits holds a
    # difference of at most ``distance``: rotated to the low end it is cut like the whole was.
    seg = F.call_function("shiftrightunsigned", F.col("key"), F.lit(width)) / (width + 1)
    shift = F.floor(seg).cast("int") * width
    low = F.when(shift > 0, F.col("fp").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1)).otherwise(F.lit(0).cast("long"))
    high = F.when(shift + width < BITS, F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("fp"), shift + width), shift)).otherwise(F.lit(0).cast("long"))
    rest = BITS - width
    inner_segments = distance // 2 + 1
    inner_width = -(-rest // inner_segments)
    inner = _variants(hot.select("key", F.col("wild").alias("outer_wild"), F.col("bit").alias("outer_bit"), "fp", low.bitwiseOR(high).alias("rest")),
                      F.col("rest"), inner_width, inner_segments, "sub")
    a = inner.select("key", "sub", "outer_wild", "wild", F.col("fp").alias("a"), F.col("bit").alias("bit_a"), F.col("outer_bit").alias("outer_a"))
    b = inner.select("key", "sub", F.col("fp").alias("b"), F.col("bit").alias("bit_b"), F.col("outer_bit").alias("outer_b"))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    deep = (a.join(b, ["key", "sub"])
            .filter(F.when(F.col("outer_wild") >= 0, F.col("outer_a") < F.col("outer_b")).otherwise(F.col("a") != F.col("b")))
            .filter((F.col("wild") < 0) | (F.col("bit_a") != F.col("bit_b")))
            .filter(far <= distance).select("a", "b"))
    return found.union(deep).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``distance`` differing
    bits. Null and empty texts have fingerprint 0 and are linked like any other. Rows with equal
    doc_id keep a row each. A null doc_id never is a component's id unless it has no other.

    Copies collapse to one fingerprint before any link is sought, so a group of exact copies costs
    one node; links and components are tables in the shared folder and never reach the driver.
    """
    prints = stage(fingerprints(docs, shingle))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = stage(components(links(nodes, distance)))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(first, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of ``docs``, a stored table, for each group of near copies, with all its columns.

    It has the group's smallest id; of rows that share that id the first stays; in a group without
    ids, the first row.
    """
    whole, where = numbered(docs)
    keyed = whole.select("row", F.coalesce(F.col(where["doc_id"]).cast("long"), F.lit(2 ** 63 - 1)).alias("id"))
    # The row number takes the id's place, so that every group has exactly one first row.
    found = near_duplicates(whole.select(F.col("row").alias("doc_id"), F.col(where["text"]).alias("text")), shingle, distance)
    grouped = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")).join(keyed, "row")
    # The least id, then the first row, in one minimum that is combined in the map tasks.
    kept = stage(grouped.groupBy("group").agg(F.min(F.struct("id", "row")).alias("least")).select("least.row"))
    # The same plan at every size: whether one side is small must not decide what is moved.
    return whole.join(kept.hint("merge"), "row", "left_semi").select(*[F.col(n).alias(c) for c, n in where.items()])


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
