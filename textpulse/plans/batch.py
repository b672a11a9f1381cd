"""Full and incremental batch runs: landing files to output tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.operators import (
    keywords, monthly, pii, preprocess, sentiment, stats, tfidf, threads, topics)
from textpulse.session import delete, stage, unstage, work_dir
from textpulse.sources import items as item_source, keyed, ledger, runs, sinks


@dataclass(frozen=True)
class RunResult:
    success: bool
    records: int
    stage_counts: dict
    error: str | None = None


def messages(items: DataFrame, run_ts: datetime, since: datetime | None = None,
             order: tuple[str, ...] = item_source.ORDER, kept: tuple[str, ...] = ()) -> DataFrame:
    """Items to flat, de-duplicated messages with UTC timestamps; ``kept`` names order columns that stay."""
    flat = threads.dedupe_first(threads.flatten_threads(items, order), order + ("place",), kept=kept)
    return threads.since_filter(
        threads.impute_timestamps(threads.parse_timestamps(flat), run_ts), since)


def enrich(df: DataFrame, settings: Settings = DEFAULT, scorer=None, detector=None,
           language=None, observation: Observation | None = None) -> DataFrame:
    """Messages to the enriched table, without topics. One pass, no shuffle."""
    df = preprocess.preprocess(df, settings, language, observation, keep_words=True)
    df = sentiment.analyze_sentiment(df, settings, scorer)
    df = pii.redact_pii(df, settings, detector)
    df = keywords.flag_keywords(df, settings).drop("_words")
    return monthly.with_calendar(df, settings)


def run(spark: SparkSession, items: DataFrame, out: str, settings: Settings = DEFAULT,
        incremental: bool = False, run_ts: datetime | None = None, csv: bool = True,
        drop_raw: bool = False, backfill: bool = False, scorer=None, detector=None,
        language=None, merge: bool = False) -> RunResult:
    """One run. Too little input fails the run and leaves existing outputs as they are.

    The enriched table is written once to the shared work folder; every output reads it
    from there, column-pruned, so the text work runs once and a lost executor costs only
    its own tasks. ``incremental`` keeps messages after the last run; ``backfill`` cuts at
    ``backfill_months`` before the run. With ``merge`` the messages are merged by id into the
    keyed table, an edit replacing what earlier runs had, and the outputs are those of the whole table.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    stamp = run_ts.isoformat()
    work = f"{work_dir(spark)}/run-{uuid.uuid4().hex}"
    try:
        since = runs.last_run_timestamp(spark, out) if incremental else None
        source = messages(items, run_ts, since)
        if backfill:
            source = source.where(F.col("timestamp") > F.add_months(
                F.lit(run_ts), -settings.backfill_months))
        observed = Observation("stages")
        enrich(source, settings, scorer, detector, language, observed).write.parquet(f"{work}/enriched")
        counts = observed.get
        if counts["rows_in"] < settings.min_results:
            raise threads.InsufficientData(
                f"{counts['rows_in']} rows, at least {settings.min_results} needed")
        enriched = spark.read.parquet(f"{work}/enriched")
        if merge:
            version = F.lit(int(run_ts.timestamp() * 1e6))
            keyed.merge(spark, enriched.withColumn("_version", version), f"{out}/{sinks.STREAMED}")
            enriched = keyed.read(spark, f"{out}/{sinks.STREAMED}").drop("_version")
        export(spark, enriched, work, out, settings, run_ts, csv, drop_raw)
    except Exception as error:
        sinks.append_run(spark, out, stamp, False, 0, str(error))
        if isinstance(error, threads.InsufficientData):
            return RunResult(False, 0, {}, str(error))
        raise
    finally:
        delete(spark, work)
    sinks.append_run(spark, out, stamp, True, counts["rows_kept"])
    return RunResult(True, counts["rows_kept"], dict(counts))


def run_landing(spark: SparkSession, landing: str, out: str, settings: Settings = DEFAULT,
                incremental: bool = False, late: bool = False, multi_line: bool = False,
                run_ts: datetime | None = None, **options) -> RunResult:
    """A run over a landing folder that notes the files it took in.

    ``incremental`` reads only files that no earlier run took in; of their messages those after the
    last run are kept, or all with ``late``, as a message may land after a run though it is older.
    A run that fails notes nothing, so its files are read again with those that land until then.
    """
    files = ledger.pending(spark, landing, out) if incremental else ledger.listing(spark, landing)
    found = stage(files)  # what is noted is what was read
    paths = [r.path for r in found.select("path").collect()]  # the reader lists them here, too
    run_ts = run_ts or datetime.now(timezone.utc)
    try:
        if not paths:
            sinks.append_run(spark, out, run_ts.isoformat(), False, 0, "no new files")
            return RunResult(False, 0, {}, "no new files")
        items = item_source.read_items(spark, paths, multi_line)
        result = run(spark, items, out, settings, incremental and not late, run_ts, **options)
        if result.success:
            new = found if incremental else found.join(ledger.taken(spark, out).select(*found.columns), found.columns, "left_anti")
            ledger.record(new, out, run_ts)
        return result
    finally:
        unstage(found)


def export(spark: SparkSession, enriched: DataFrame, work: str, out: str, settings: Settings,
           run_ts: datetime, csv: bool = True, drop_raw: bool = False) -> None:
    """All output tables of an enriched table. The metadata, which is the mark, comes last."""
    assigned = topics.assign_topics(enriched, settings)
    # The assignment is written once: summary and words must see the same topics.
    assigned.select("id", "clean_text", "sentiment_score", "dominant_topic").write.parquet(f"{work}/topics")
    by_topic = spark.read.parquet(f"{work}/topics")
    words = topics.topic_words(topics.topic_top_words(by_topic, settings))
    words.write.parquet(f"{work}/words")
    words = spark.read.schema("topic_id int, words array<string>").parquet(f"{work}/words")
    sinks.write_main(topics.with_topic_keywords(assigned, words), out, csv, drop_raw)
    sinks.write_monthly(monthly.monthly_sentiment(enriched, settings), out)
    sinks.write_negative_keywords(tfidf.negative_keywords(enriched, settings), out)
    sinks.write_audit(pii.pii_audit(enriched, run_ts), out)
    sinks.write_topic_summary(topics.topic_summary(by_topic, words), out)
    sinks.write_metadata(stats.run_metadata(enriched, run_ts, settings), out)
