"""Calendar columns and the monthly sentiment series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textpulse.config import DEFAULT, Settings
from textpulse.functions.plan import keep_columns

# Score bins for the median: scores lie in [-1, 1], other values fall into the end bins. So many that
# the bins of a month are few enough for one task, and the scores of a bin, too.
_BINS = 200_000
PLACES = 6  # digits of a score in a stored state
STATE = ("year_month", "sentiment_score", "sentiment_label")
ROLLING = (3, 6, 12)


def with_calendar(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Local time of the output zone and its month, year and weekday."""
    local = F.col("timestamp_pacific")
    return df.withColumn("timestamp_pacific", F.convert_timezone(
        None, F.lit(settings.output_timezone), F.col("timestamp"))).withColumns({
            "year_month": F.date_format(local, "yyyy-MM"),
            "year": F.year(local), "month": F.month(local),
            "day_of_week": F.date_format(local, "EEEE")})


def _score_counts(df: DataFrame) -> DataFrame:
    """(month, score, label) with row counts; ``_bin`` is -1 for rows without a score."""
    counts = (df.where("year_month is not null")
              .groupBy("year_month", "sentiment_score", "sentiment_label").agg(
                  F.expr("count(1) as _n"), F.expr("count(id) as _ids"),
                  F.expr("count_if(mentions_oregon) as _region"),
                  F.expr("count_if(mentions_partner) as _partner")))
    return _binned(counts)


def _binned(counts: DataFrame) -> DataFrame:
    position = f"least({_BINS - 1}, greatest(0, cast(floor((sentiment_score + 1) * {_BINS / 2}) as int)))"
    # Both readers of the counts must ask for the same columns to share one shuffle.
    return keep_columns(counts).withColumn("_bin", F.expr(
        f"if(sentiment_score is null, -1, {position})"))


def _month_stats(counts: DataFrame) -> DataFrame:
    """One row per month: sums, mean, squared deviation and where the middle ranks lie.

    Deviations are summed around the bin centres and then moved to the mean, which keeps
    them exact to rounding. Scores of rank ``_low`` and ``_high`` are the middle ones;
    ``_low_bin`` and ``_low_rank`` say in which bin, and where in it, the first one is.
    """
    centre = f"((_bin + 0.5D) / {_BINS / 2} - 1)"
    offset = f"(sentiment_score - {centre})"
    label = lambda name: f"sum(if(sentiment_label = '{name}', _n, 0))"
    bins = counts.groupBy("year_month", "_bin").agg(*map(F.expr, (
        "sum(_ids) as _ids", "sum(_region) as _region", "sum(_partner) as _partner",
        f"{label('Positive')} as _pos", f"{label('Negative')} as _neg", f"{label('Neutral')} as _neu",
        "sum(if(_bin < 0, 0, _n)) as _count", f"sum(_n * {offset}) as _sum",
        f"sum(_n * {offset} * {offset}) as _square")))
    month = "over (partition by year_month)"
    bins = bins.selectExpr(
        "*", f"{centre} as _centre", f"sum(_count) {month} as _total",
        f"sum(_count * {centre} + _sum) {month} / nullif(sum(_count) {month}, 0) as _mean",
        "sum(_count) over (partition by year_month order by _bin) - _count as _before")
    holds = lambda rank: f"{rank} > _before and {rank} <= _before + _count"
    low, high = "((_total + 1) div 2)", "(_total div 2 + 1)"
    return bins.groupBy("year_month").agg(*map(F.expr, (
        "sum(_ids) as total_posts", "first(_mean) as avg_sentiment", "first(_total) as _total",
        "sum(_square + 2 * (_centre - _mean) * _sum + _count * pow(_centre - _mean, 2)) as _deviation",
        f"coalesce(max(if({holds(low)}, _bin, null)), -1) as _low_bin",
        f"max(if({holds(low)}, {low} - _before, null)) as _low_rank",
        f"coalesce(max(if({holds(high)}, _bin, null)), -1) as _high_bin",
        f"max(if({holds(high)}, {high} - _before, null)) as _high_rank",
        "sum(_region) as oregon_mentions", "sum(_partner) as partner_mentions",
        "sum(_pos) as positive_count", "sum(_neg) as negative_count", "sum(_neu) as neutral_count")))


def monthly_sentiment(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Counts, mean, median and sample deviation of the score per local month.

    The input is read once and reduced in the map tasks to one row per (month, score,
    label); everything else works on that. A month that holds most of the data is spread
    over all tasks, and no task holds the values of a month: the median is found by
    counting, exactly, among the scores of the one or two bins with the middle ranks. The
    result has one row per calendar month, at most some thousand given the range of
    timestamps, so its rows may be broadcast.
    """
    return _series(_score_counts(df), settings)


def monthly_state(df: DataFrame) -> DataFrame:
    """What a batch adds to the monthly series: row counts per month, score and label.

    Scores keep ``PLACES`` digits, so a month has two million scores at most, however many rows it
    has. States of batches are added up by ``added``; the series of the sum is that of all rows.
    """
    rounded = F.round("sentiment_score", PLACES) + F.lit(0.0)  # no negative zero
    return _score_counts(df.withColumn("sentiment_score", rounded)).drop("_bin")


def added(states: DataFrame) -> DataFrame:
    """One state from those of several batches."""
    return states.groupBy(*STATE).agg(*[F.sum(c).alias(c) for c in ("_n", "_ids", "_region", "_partner")])


def monthly_from_state(state: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The monthly series, median and rolling means included, from an added-up state."""
    return _series(_binned(state), settings)


def _series(counts: DataFrame, settings: Settings) -> DataFrame:
    stats = _month_stats(counts)
    middle = (counts.select("year_month", "_bin", "sentiment_score", "_n")
              .join(F.broadcast(stats), "year_month").where("_bin in (_low_bin, _high_bin)")
              .repartition("year_month")
              .withColumn("_upto", F.expr(
                  "sum(_n) over (partition by year_month, _bin order by sentiment_score)")))
    score_at = lambda end: (
        f"min(if(_bin = _{end}_bin and _upto >= _{end}_rank, sentiment_score, null))")
    keep = [c for c in stats.columns if c not in (
        "year_month", "_low_bin", "_low_rank", "_high_bin", "_high_rank")]
    monthly = middle.groupBy("year_month").agg(
        F.expr(f"({score_at('low')} + {score_at('high')}) / 2 as median_sentiment"),
        *[F.first(c).alias(c) for c in keep])
    monthly = monthly.selectExpr(
        "year_month", "cast(substr(year_month, 1, 4) as int) as year",
        "cast(substr(year_month, 6, 2) as int) as month", "total_posts", "avg_sentiment",
        "median_sentiment",
        "if(_total > 1, sqrt(greatest(_deviation, 0.0D) / (_total - 1)), null) as std_sentiment",
        "oregon_mentions", "partner_mentions", "positive_count", "negative_count",
        "neutral_count", "try_divide(negative_count, total_posts) * 100 as pct_negative")
    return with_rolling(monthly, settings.enable_rolling)


def with_rolling(monthly: DataFrame, enabled: bool = True) -> DataFrame:
    """Means of the last 3, 6 and 12 rows in month order; NULL until a frame is full.

    The window is unpartitioned: its input is one row per month.
    """
    mean = F.col("avg_sentiment")
    columns = {}
    for months in ROLLING:
        frame = Window.orderBy("year_month").rowsBetween(1 - months, Window.currentRow)
        full = F.when(F.count(mean).over(frame) == months, F.avg(mean).over(frame))
        columns[f"rolling_{months}mo_sentiment"] = (
            full if enabled else F.lit(None).cast("double"))
    return monthly.withColumns(columns)


def complete_months(monthly: DataFrame) -> DataFrame:
    """Adds a row for every month missing between the first and the last one."""
    first_day = lambda c: F.to_date(F.concat(c, F.lit("-01")))
    span = monthly.agg(F.min("year_month").alias("a"), F.max("year_month").alias("b")).where("a is not null")
    months = span.select(F.explode(F.sequence(
        first_day(F.col("a")), first_day(F.col("b")), F.expr("interval 1 month"))).alias("day"))
    months = months.select(F.date_format("day", "yyyy-MM").alias("year_month"),
                           F.year("day").alias("_year"), F.month("day").alias("_month"))
    rolling = [f"rolling_{m}mo_sentiment" for m in ROLLING]
    filled = (months.join(F.broadcast(monthly.drop(*rolling)), "year_month", "left")
              .withColumns({"year": F.col("_year"), "month": F.col("_month"),
                            "total_posts": F.coalesce("total_posts", F.lit(0))})
              .drop("_year", "_month"))
    return with_rolling(filled.select(*[c for c in monthly.columns if c not in rolling]))
