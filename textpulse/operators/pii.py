"""Personal data: detection, redaction, row summary and the value-free audit table.

A detector is a function ``Column -> Column`` from text to an array of spans. The
default uses patterns and name lists in JVM expressions; :func:`model_detector`
wraps a Python recogniser.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.gazetteer import Filter, Trie, spot, tokens_of
from textpulse.functions.plan import compute_once
from textpulse.functions.spans import default_patterns, detect_spans, drop_whitelisted, in_order, redact
from textpulse.schemas import SPANS
from textpulse.session import stage

Detector = Callable[[Column], Column]
MAX_NAMES = 100_000  # of a gazetteer that goes to every worker, some seventy megabytes of it
_ARROW_SPANS = pa.list_(pa.struct([("entity_type", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64())]))


def pattern_detector(settings: Settings = DEFAULT) -> Detector:
    patterns = default_patterns(settings)
    return lambda text: detect_spans(text, patterns)


def model_detector(load: Callable[[], Callable[[str], list]]) -> Detector:
    """Detector around a Python recogniser.

    ``load()`` runs once per Python worker and returns ``recognise(text)``, which gives
    (entity_type, start, end, confidence) tuples.
    """
    @F.pandas_udf(SPANS)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        recognise = load()
        names = ("entity_type", "start", "end", "confidence")
        for texts in batches:
            yield pd.Series([[dict(zip(names, span)) for span in recognise(t)] if t else []
                             for t in texts])

    return lambda text: detect(text)


def gazetteer_detector(names: DataFrame, confidence: float = 0.85, limit: int | None = None) -> Detector:
    """Detector of the names in a table ``entity_type, name``, case-sensitive, at token borders.

    Of names that begin at one place the longest counts. Up to ``MAX_NAMES`` names go to every worker
    as a trie, and a text is read in one pass. More names meet the texts in a join: such a detector is
    for ``with_spans`` and ``redact_pii``, and is no function of a column. More than ``limit`` names
    raise ValueError.
    """
    given = names.where("entity_type IS NOT NULL AND trim(name) <> ''").select("entity_type", "name").distinct()
    rows = given.limit((MAX_NAMES if limit is None else min(limit, MAX_NAMES)) + 1).collect()
    if limit is not None and (len(rows) > limit or limit > MAX_NAMES < len(rows) and given.limit(limit + 1).count() > limit):
        raise ValueError(f"more than {limit} names")
    if len(rows) > MAX_NAMES:
        return JoinedGazetteer(given, confidence)
    trie = names.sparkSession.sparkContext.broadcast(Trie((r.entity_type, r.name) for r in rows))

    @F.arrow_udf(SPANS)
    def detect(texts: pa.Array) -> pa.Array:
        find = trie.value.find
        return pa.array([_spans(find(t or ""), confidence) for t in texts.to_pylist()], _ARROW_SPANS)

    return lambda text: detect(text)


def _spans(found: Iterable[tuple[str, int, int]], confidence: float) -> list[dict]:
    return [{"entity_type": kind, "start": start, "end": end, "confidence": confidence} for kind, start, end in found]


class JoinedGazetteer:
    """Names of a gazetteer that are too many for a worker.

    A filter of fixed size, made of all names, leaves of a text's phrases little else than names. These
    meet the names in a join, and a text gets the few that it holds back by its hash. They are looked for
    in the text like those of a small gazetteer, so texts of one hash do not disturb each other.
    """

    def __init__(self, names: DataFrame, confidence: float):
        @F.arrow_udf("array<string>")
        def tokens(values: pa.Array) -> pa.Array:
            return pa.array([tokens_of(v.strip()) for v in values.to_pylist()], pa.list_(pa.string()))

        @F.arrow_udf("array<long>")
        def spots(values: pa.Array) -> pa.Array:
            return pa.array([[spot("".join(v)), spot(v[0], first=True)] for v in values.to_pylist()], pa.list_(pa.int64()))

        self.confidence = confidence
        parts = stage(names.select("entity_type", tokens("name").alias("tokens")).where(F.size("tokens") > 0))
        self.names = parts.groupBy(F.array_join("tokens", "").alias("phrase")).agg(F.collect_set("entity_type").alias("types"))
        # Buckets of the bitmap functions begin at one.
        at = parts.select(F.explode(spots("tokens")).alias("at")).select((F.col("at") + 1).alias("at"))
        bits = at.groupBy(F.bitmap_bucket_number("at").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        sizes = [r.n for r in parts.select(F.size("tokens").alias("n")).distinct().collect()]
        self.filter = names.sparkSession.sparkContext.broadcast(Filter(((r.n - 1, bytes(r.bits)) for r in bits.collect()), sizes))

    def __call__(self, text: Column) -> Column:
        raise TypeError("names of a large gazetteer meet the texts in a join: use with_spans or redact_pii")

    def join(self, df: DataFrame, text: Column) -> tuple[DataFrame, Column]:
        """``df`` with the names of each text in a column of its own, and the spans made of it."""
        confidence, names, column = self.confidence, self.filter, f"_names_{uuid.uuid4().hex}"

        @F.arrow_udf("array<string>")
        def phrases(texts: pa.Array) -> pa.Array:
            return pa.array([names.value.phrases(t or "") for t in texts.to_pylist()], pa.list_(pa.string()))

        @F.arrow_udf(SPANS)
        def detect(texts: pa.Array, found: pa.Array) -> pa.Array:
            tries = (Trie((kind, name["phrase"]) for name in held.as_py() or () for kind in name["types"]) for held in found)
            return pa.array([_spans(trie.find(t or ""), confidence) for t, trie in zip(texts.to_pylist(), tries)], _ARROW_SPANS)

        key = f"{column}_key"
        held = (df.select(F.xxhash64(text).alias(key), F.explode(phrases(text)).alias("phrase")).distinct().join(self.names, "phrase")
                .groupBy(key).agg(F.collect_list(F.struct("phrase", "types")).alias(column)))
        return df.withColumn(key, F.xxhash64(text)).join(held, key, "left").drop(key), detect(text, F.col(column))


class _Several:
    def __init__(self, detectors: tuple[Detector, ...]):
        self.detectors = detectors

    def __call__(self, text: Column) -> Column:
        return in_order(F.concat(*[d(text) for d in self.detectors]))

    def join(self, df: DataFrame, text: Column) -> tuple[DataFrame, Column]:
        spans = []
        for detector in self.detectors:
            df, found = _found(df, detector, text)
            spans.append(found)
        return df, in_order(F.concat(*spans))


def several(*detectors: Detector) -> Detector:
    """All that any of some detectors finds, in order."""
    return _Several(detectors)


def _found(df: DataFrame, detector: Detector, text: Column) -> tuple[DataFrame, Column]:
    """Spans of any detector, with the table that they are columns of."""
    return detector.join(df, text) if hasattr(detector, "join") else (df, detector(text))


def with_spans(df: DataFrame, settings: Settings = DEFAULT, detector: Detector | None = None,
               text: str = "original_text") -> DataFrame:
    """Adds ``pii_spans``: detected entities that no whitelist item protects."""
    value = F.coalesce(F.col(text), F.lit(""))
    columns = [c for c in df.columns if c != "pii_spans"]
    df, found = _found(df, detector or pattern_detector(settings), value)
    df = compute_once(df, pii_spans=found).select(*[F.col(f"`{c}`") for c in columns], "pii_spans")
    return compute_once(df, pii_spans=drop_whitelisted(
        value, F.col("pii_spans"), settings.pii_whitelist, settings.pii_whitelist_match))


def pii_summary(df: DataFrame) -> DataFrame:
    """``pii_detected``, ``pii_types`` and ``pii_count`` from ``pii_spans``."""
    spans = F.col("pii_spans")
    types = F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["entity_type"])))
    return df.withColumns({"pii_detected": F.size(spans) > 0, "pii_types": F.array_join(types, ","),
                           "pii_count": F.size(spans)})


def redact_pii(df: DataFrame, settings: Settings = DEFAULT, detector: Detector | None = None,
               text: str = "original_text") -> DataFrame:
    """Adds the redacted text, the summary columns and ``pii_spans``.

    Action ``flag`` keeps the text as it is; ``none`` detects nothing.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    if settings.pii_action == "none":
        df = df.withColumn("pii_spans", F.array().cast(SPANS))
    else:
        df = with_spans(df, settings, detector, text)
    redacting = settings.pii_action == "redact"
    df = df.withColumn("redacted_text", redact(value, F.col("pii_spans")) if redacting else value)
    spans_last = [c for c in pii_summary(df).columns if c != "pii_spans"]
    return pii_summary(df).select(*spans_last, "pii_spans")


def pii_audit(df: DataFrame, run_ts: datetime | Column, key: str = "id") -> DataFrame:
    """One row per span of ``pii_spans``; carries positions, never the value."""
    at = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return (df.where(F.size("pii_spans") > 0)
            .select(F.col(key).cast("string").alias("post_id"), F.inline("pii_spans"))
            .select("post_id", "entity_type", F.col("start").alias("start_position"),
                    F.col("end").alias("end_position"), "confidence", at.alias("timestamp")))


def pii_posts(audit: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct messages in an audit table."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return audit.agg(count("post_id").alias("pii_redacted_count"))
