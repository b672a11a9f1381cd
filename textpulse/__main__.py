"""Job entry: ``spark-submit`` or ``python -m textpulse``."""

from __future__ import annotations

import argparse
import importlib
import sys
from dataclasses import fields

from textpulse.config import DEFAULT
from textpulse.operators.insights import complaint_counts, insight_summary
from textpulse.plans.batch import run_landing
from textpulse.plans.deep import run_deep
from textpulse.session import get_session, release
from textpulse.sources.sinks import MAIN, STREAMED
from textpulse.streaming.incremental import start_incremental


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="textpulse")
    parser.add_argument("--items", help="landing folder of nested items")
    parser.add_argument("--out", help="output folder")
    parser.add_argument("--multi-line", action="store_true", help="one JSON array per file")
    parser.add_argument("--incremental", action="store_true", help="only new landing files, messages after the last run")
    parser.add_argument("--late", action="store_true", help="with --incremental: older messages of new files, too")
    parser.add_argument("--merge", action="store_true", help="merge by id into the keyed table; outputs cover the whole table")
    parser.add_argument("--backfill-only", action="store_true", help="full run over the backfill months")
    parser.add_argument("--stream", action="store_true", help="merge new landing files into the keyed table")
    parser.add_argument("--drop-raw", action="store_true", help="leave unredacted text out of the main dataset")
    parser.add_argument("--dry-run", action="store_true", help="check the settings and stop")
    parser.add_argument("--deep-analysis", action="store_true", help="analyse the main dataset")
    parser.add_argument("--deep-n-posts", type=int, default=100)
    parser.add_argument("--client", help="module:function that returns the model client")
    args = parser.parse_args(argv)
    if args.dry_run:
        print("settings valid", {f.name: v for f in fields(DEFAULT) if not isinstance(v := getattr(DEFAULT, f.name), (tuple, dict))})
        return 0
    if not args.out:
        parser.error("--out is required")
    spark = get_session()
    try:
        return _run(spark, parser, args)
    finally:
        release(spark)


def _run(spark, parser: argparse.ArgumentParser, args: argparse.Namespace) -> int:
    if args.deep_analysis:
        if not args.client:
            parser.error("--client is required for --deep-analysis")
        module, name = args.client.split(":")
        connect = getattr(importlib.import_module(module), name)
        insights = run_deep(spark, spark.read.parquet(f"{args.out}/{MAIN}.parquet"), args.out, connect,
                            args.deep_n_posts)
        if insights.isEmpty():
            return 1
        complaint_counts(insights).show()
        insight_summary(insights).show(truncate=False)
        return 0
    if not args.items:
        parser.error("--items is required")
    if args.stream:
        start_incremental(spark, args.items, f"{args.out}/{STREAMED}", f"{args.out}/{STREAMED}.checkpoint",
                          drop_raw=args.drop_raw, out=args.out).awaitTermination()
        return 0
    return 0 if run_landing(spark, args.items, args.out, incremental=args.incremental, late=args.late, merge=args.merge,
                            multi_line=args.multi_line, drop_raw=args.drop_raw, backfill=args.backfill_only).success else 1


if __name__ == "__main__":
    sys.exit(main())
