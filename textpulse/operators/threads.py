"""Threads to flat messages: flattening, de-duplication, timestamps, volume gate."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from textpulse.functions.brackets import walk
from textpulse.functions.plan import compute_once
from textpulse.functions.text import strip
from textpulse.functions.timestamps import parse_text, parse_variant, shape
from textpulse.schemas import COMMENT, JSON_OPTIONS

ROWS, CHARACTERS = 4_096, 4 << 20  # comments, and their text, that are sent on at a time
_POST = ("title", "body", "createdAt", "upVotes", "downVotes", "url", "author")


class InsufficientData(RuntimeError):
    """A run has too few rows to replace existing results."""


def _comment_rows(items: DataFrame, carried: list[str]) -> DataFrame:
    """A row per post and per comment below it: ``carried`` columns, place, parent, own.

    The bracket positions of a thread are found in one pass; its comments leave one by one, each as
    the JSON object it is without its replies. Columns of the post itself are NULL beside a comment.
    """
    own_columns = [*carried, *_POST]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, size = batch.column(batch.num_columns - 1), [], 0
            for i in range(batch.num_rows):
                rows.append((i, i, 0, None, None))
                text = texts[i].as_py()
                for place, parent, own in walk(text) if text and text.lstrip().startswith("[") else ():
                    rows.append((i, None, place, parent, own))
                    size += len(own)
                    if len(rows) >= ROWS or size >= CHARACTERS:
                        yield sent(batch, rows)
                        rows, size = [], 0
            if rows:
                yield sent(batch, rows)

    def sent(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        item, post, place, parent, own = zip(*rows)
        item, post = pa.array(item, pa.int64()), pa.array(post, pa.int64())
        columns = [batch.column(i).take(item if i < len(carried) else post) for i in range(len(own_columns))]
        return pa.record_batch([*columns, pa.array(place, pa.int64()), pa.array(parent, pa.string()), pa.array(own, pa.string())],
                               [*own_columns, "place", "parent", "own"])

    narrow = items.select(*carried, *[F.to_json(c).alias(c) if c == "createdAt" else c for c in _POST], "comments")
    schema = T.StructType([*(T.StructField(c, narrow.schema[c].dataType) for c in own_columns), T.StructField("place", T.LongType()),
                           T.StructField("parent", T.StringType()), T.StructField("own", T.StringType())])
    return narrow.mapInArrow(run, schema)


def flatten_threads(items: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per post and comment.

    Posts and comments without an id are skipped with everything below them.
    ``order`` names columns that give the input order of the items; they are kept,
    with ``place``, so that (order..., place) is depth-first order of the whole input.
    Missing and NULL fields count alike. ``timestamp`` stays raw (VARIANT). ``comments`` is JSON
    text: an array of objects with ``replies`` nested in the same way, to any depth. Text that is no
    array or whose brackets do not match has no comments.

    No shuffle, and time linear in the text whatever its depth. A thread never is one array: a few
    thousand comments are sent on at a time, and positions take sixty-four bytes a comment.
    """
    def votes(up: str, down: str) -> Column:
        return F.coalesce(up, F.lit(0)).cast("long") - F.coalesce(down, F.lit(0)).cast("long")

    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    rows = _comment_rows(items.where(F.col("id") != ""), [*order, "id", "subredditName"])
    above = F.from_json(F.concat(F.lit('{"id":'), "parent", F.lit("}")), "id string")["id"]
    rows = compute_once(rows, _c=F.from_json("own", COMMENT, JSON_OPTIONS), _above=above)
    comment = F.col("place") > 0
    either = lambda c: F.when(comment, F.col(f"_c.{c}")).otherwise(F.col(c))
    fields = rows.select(
        *order, "place", either("id").alias("id"),
        F.when(comment, F.coalesce("_above", "id")).alias("parent_id"),
        F.when(comment, text("_c.body")).otherwise(F.concat(text("title"), F.lit("\n"), text("body"))).alias("text"),
        F.when(comment, F.col("_c.createdAt")).otherwise(F.try_parse_json("createdAt")).alias("timestamp"),
        F.when(comment, votes("_c.upVotes", "_c.downVotes")).otherwise(votes("upVotes", "downVotes")).alias("score"),
        F.col("subredditName").alias("subreddit"), F.when(comment, "Comment").otherwise("Post").alias("type"),
        either("url").alias("reddit_url"), either("author").alias("author"))
    return (fields.where(F.col("id") != "")
            .select(*order, "place", "id", "parent_id", strip(F.col("text")).alias("text"),
                    "timestamp", "score", "subreddit", "type", "reddit_url", "author"))


def dedupe_first(df: DataFrame, order: tuple[str, ...], key: str = "id", kept: tuple[str, ...] = ()) -> DataFrame:
    """First row of every key in the given order; order columns are dropped, but for those ``kept``.

    ``row_number() = 1`` lets Spark keep one candidate per key in each map task before
    the shuffle, so a key that holds much of the input costs no more than a rare one.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank", *[c for c in order if c not in kept])


def parse_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Raw timestamps (VARIANT or text) to UTC timestamps, unreadable ones to NULL."""
    raw = F.col(column)
    variant = df.schema[column].dataType.typeName() == "variant"
    return compute_once(df, **{column: parse_variant(raw) if variant else parse_text(raw)})


def unreadable_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """``shape, rows, example``: raw timestamps that are there but cannot be read, counted by what they look like.

    For a look at what imputation would hide. One aggregation with partial sums; the example is the
    least of the texts.
    """
    raw = F.col(column)
    variant = df.schema[column].dataType.typeName() == "variant"
    text = F.coalesce(F.try_variant_get(raw, "$", "string"), F.to_json(raw)) if variant else raw
    rows = compute_once(df.select(raw), _parsed=parse_variant(raw) if variant else parse_text(raw), _text=text)
    return (rows.where(F.col("_text").isNotNull() & (F.col("_text") != "null") & F.col("_parsed").isNull())
            .groupBy(F.left(shape(F.col("_text")), F.lit(40)).alias("shape"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min("_text").alias("example")))


def impute_timestamps(df: DataFrame, run_ts: datetime, column: str = "timestamp") -> DataFrame:
    """NULL timestamps become the run time and are flagged in ``timestamp_imputed``."""
    ts = F.col(column)
    return df.withColumns({
        "timestamp_imputed": ts.isNull(), column: F.coalesce(ts, F.lit(_utc(run_ts)))})


def since_filter(df: DataFrame, since: datetime | None, column: str = "timestamp") -> DataFrame:
    """Rows strictly after ``since`` (a time without zone is UTC); all rows for None."""
    return df if since is None else df.where(F.col(column) > F.lit(_utc(since)))


def require_rows(df: DataFrame, minimum: int) -> DataFrame:
    """``df`` if it has at least ``minimum`` rows, else :class:`InsufficientData`.

    Reads no more than ``minimum`` rows.
    """
    found = df.limit(minimum).count()
    if found < minimum:
        raise InsufficientData(f"{found} rows, at least {minimum} needed")
    return df


def _utc(ts: datetime) -> datetime:
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts
