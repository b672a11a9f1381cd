import math
import random
from collections import Counter
from dataclasses import replace
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textpulse.config import DEFAULT
from textpulse.operators import insights, joins, monthly, stats, tfidf, topics


def _scored(spark, rows):
    """(id, month, score, label) with flags."""
    return spark.createDataFrame(
        [(str(i), m, s, l, i % 3 == 0, i % 2 == 0) for i, (m, s, l) in enumerate(rows)],
        "id string, year_month string, sentiment_score double, sentiment_label string, "
        "mentions_oregon boolean, mentions_partner boolean")


def _random_rows(seed=3):
    rng = random.Random(seed)
    rows = []
    for month, size in {"2023-01": 400, "2023-02": 1, "2023-03": 2, "2023-05": 31, "2023-06": 7}.items():
        for _ in range(size):
            score = rng.choice([0.0, 1.0, -1.0, 0.5, None, rng.uniform(-1, 1), rng.uniform(0.5, 0.5004)])
            rows.append((month, score, rng.choice(["Positive", "Negative", "Neutral"])))
    return rows + [(None, 0.5, "Positive"), ("2023-07", None, "Neutral")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_monthly_matches_pandas(spark, seed):
    df = _scored(spark, _random_rows(seed))
    got = monthly.monthly_sentiment(df).toPandas().sort_values("year_month").reset_index(drop=True)
    pdf = df.toPandas().dropna(subset=["year_month"])
    want = pdf.groupby("year_month").agg(
        total=("id", "count"), mean=("sentiment_score", "mean"), median=("sentiment_score", "median"),
        std=("sentiment_score", "std"), region=("mentions_oregon", "sum")).reset_index()
    assert list(got.year_month) == list(want.year_month)
    assert list(got.total_posts) == list(want.total) and list(got.oregon_mentions) == list(want.region)
    for a, b in (("avg_sentiment", "mean"), ("median_sentiment", "median"), ("std_sentiment", "std")):
        pd.testing.assert_series_equal(got[a], want[b], check_names=False, atol=1e-12, rtol=1e-12)
    for k in (3, 6, 12):
        pd.testing.assert_series_equal(got[f"rolling_{k}mo_sentiment"], want["mean"].rolling(k).mean(),
                                       check_names=False, atol=1e-12)
    negative = pdf.groupby("year_month").apply(lambda g: (g.sentiment_label == "Negative").mean() * 100,
                                               include_groups=False)
    assert list(got.pct_negative) == pytest.approx(list(negative))


def test_equal_scores_have_no_deviation_and_a_hot_month_is_reduced_early(spark):
    df = _scored(spark, [("2023-01", 0.8, "Positive")] * 5000 + [("2023-02", -0.2, "Negative")])
    rows = {r.year_month: r for r in monthly.monthly_sentiment(df).collect()}
    assert rows["2023-01"].std_sentiment == pytest.approx(0, abs=1e-9)
    assert rows["2023-01"].median_sentiment == 0.8
    assert rows["2023-02"].std_sentiment is None and rows["2023-01"].rolling_3mo_sentiment is None


def test_monthly_reads_its_input_once(spark, tmp_path):
    _scored(spark, _random_rows()).write.parquet(str(tmp_path / "t"))
    out = monthly.monthly_sentiment(spark.read.parquet(str(tmp_path / "t"))).select("year_month", "median_sentiment")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_rolling_off_and_complete_months(spark):
    df = _scored(spark, _random_rows())
    off = monthly.monthly_sentiment(df, replace(DEFAULT, enable_rolling=False))
    assert off.where("rolling_3mo_sentiment is not null").isEmpty()
    filled = monthly.complete_months(monthly.monthly_sentiment(df)).orderBy("year_month").collect()
    assert [r.year_month for r in filled] == [f"2023-0{m}" for m in range(1, 8)]
    assert filled[3].total_posts == 0 and filled[3].avg_sentiment is None and filled[3].year == 2023


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-01 03:00:00",), ("2024-07-01 03:00:00",)], "t string")
    rows = monthly.with_calendar(df.select(F.col("t").cast("timestamp").alias("timestamp"))).orderBy("timestamp").collect()
    assert (rows[0].year_month, rows[0].year, rows[0].month, rows[0].day_of_week) == ("2023-12", 2023, 12, "Sunday")
    assert rows[0].timestamp_pacific == datetime(2023, 12, 31, 19) and rows[1].timestamp_pacific == datetime(2024, 6, 30, 20)


TEXTS = ["the pain of pain grows", "pain and bad days, bad nights", "don't grow bad habits", "bad", "painful nights grow",
         "xx yy zz", None, ""]


def _tfidf_in_python(texts, stops, size):
    docs = [[w for w in __import__("re").findall(r"\w\w+", (t or "").lower()) if w not in stops]
            for t in texts if t is not None]
    total, df = Counter(w for d in docs for w in d), Counter(w for d in docs for w in set(d))
    vocabulary = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]
    idf = {w: math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in vocabulary}
    scores = Counter()
    for d in docs:
        weights = {w: d.count(w) * idf[w] for w in vocabulary}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        for w, v in weights.items():
            scores[w] += v / norm if norm else 0
    return {w: (scores[w], sum(w in t for t in texts if t is not None)) for w in vocabulary}


@pytest.mark.parametrize("size", [3, 50])
def test_negative_keywords_match_brute_force(spark, size):
    df = spark.createDataFrame([(t, "Negative") for t in TEXTS] + [("good", "Positive")] * 9,
                               "clean_text string, sentiment_label string")
    config = replace(DEFAULT, negative_max_terms=size)
    got = tfidf.negative_keywords(df, config).collect()
    want = _tfidf_in_python(TEXTS, DEFAULT.stop_words, size)
    assert {r.keyword: r.frequency for r in got} == {w: f for w, (_, f) in want.items()}
    assert {r.keyword: r.tfidf_score for r in got} == pytest.approx({w: s for w, (s, _) in want.items()})
    assert [r.tfidf_score for r in got] == sorted((r.tfidf_score for r in got), reverse=True)


def test_negative_keywords_need_five_rows(spark):
    df = spark.createDataFrame([("some words here", "Negative")] * 4, "clean_text string, sentiment_label string")
    out = tfidf.negative_keywords(df)
    assert out.columns == ["keyword", "tfidf_score", "frequency", "category"] and out.isEmpty()
    assert tfidf.negative_keywords(df.limit(0)).isEmpty()
    assert tfidf.negative_keywords(df.select(F.lit("a i").alias("clean_text"), "sentiment_label").union(df.limit(0))
                                   .union(df.select(F.lit("the of"), "sentiment_label"))).isEmpty()


def test_containment_takes_any_number_of_terms(spark):
    df = spark.createDataFrame([("1", "pain and rain"), ("2", "w7 w150"), ("3", None)], "id string, clean_text string")
    terms = spark.createDataFrame([("ain",), ("rain",), ("ain",), (None,)] + [(f"w{i}",) for i in range(200)], "term string")
    found = sorted((r.id, r.term) for r in tfidf.keyword_containment(df, terms).collect())
    assert found == [("1", "ain"), ("1", "rain"), ("2", "w1"), ("2", "w15"), ("2", "w150"), ("2", "w7")]
    assert tfidf.keyword_containment(df, terms.limit(0)).isEmpty()


def test_topics(spark):
    words = {0: "spouse job partner move", 1: "salary loan debt money", 2: "call night backup shift"}
    rng = random.Random(5)
    rows = [(str(i), " ".join(rng.choices(words[i % 3].split(), k=8)), 0.1 * (i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, clean_text string, sentiment_score double")
    out = topics.assign_topics(df)
    again = {r.id: r.dominant_topic for r in topics.assign_topics(df).collect()}
    got = {r.id: r.dominant_topic for r in out.collect()}
    assert got == again and len(got) == 120
    sizes = Counter(got.values())
    assert all(n >= 10 for t, n in sizes.items() if t != topics.OUTLIER)
    found = topics.topic_words(topics.topic_top_words(out, min_topics=1))
    assert len({t for t in got.values() if t >= 0}) == 3 and sizes[topics.OUTLIER] <= 6
    for row in found.where(F.col("topic_id") != topics.OUTLIER).collect():
        assert any(set(row["words"]) <= set(w.split()) for w in words.values())
    summary = topics.topic_summary(out, found).collect()
    assert sum(r.post_count for r in summary) == 120
    named = topics.with_topic_keywords(out, found)
    assert named.columns[-1] == "topic_keywords" and named.where("topic_keywords is null").isEmpty()
    few = topics.assign_topics(df.limit(49))
    assert few.where("dominant_topic is not null").isEmpty()
    assert topics.topic_summary(few, found).isEmpty()
    blank = topics.assign_topics(df.withColumn("clean_text", F.lit("")))
    assert blank.count() == 120 and blank.where("dominant_topic is not null").isEmpty()


def test_as_many_topics_as_the_data_have(spark):
    draw = np.random.default_rng(4)

    def found(groups, each=150, strays=0):
        middles = draw.standard_normal((groups, 16)) * 4
        rows = np.concatenate([middles.repeat(each, axis=0) + draw.standard_normal((groups * each, 16)), 30 * draw.standard_normal((strays, 16))])
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, embedding array<double>")
        out = {r.id: r.dominant_topic for r in topics.assign_topics(df, embedding="embedding").collect()}
        return [Counter(out[i] for i in range(g * each, (g + 1) * each)) for g in range(groups)]

    for groups in (1, 2, 7):
        parts = found(groups)
        main = [part.most_common(1)[0] for part in parts]
        assert len({topic for topic, _ in main}) == groups and all(topic >= 0 and n >= 0.85 * 150 for topic, n in main)
        assert all(set(part) <= {topic, topics.OUTLIER} for part, (topic, _) in zip(parts, main))


def test_topics_from_centres(spark):
    rows = [(i, [1.0, 0.01 * i]) for i in range(20)] + [(100 + i, [0.01 * i, 2.0]) for i in range(40)] + [
        (200, None), (201, [0.0, 0.0]), (202, [float("nan"), 1.0]), (203, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    got = {r.id: r.dominant_topic for r in topics.topic_from_centres(df, np.array([[5.0, 0.0], [0.0, 1.0], [-1.0, 0.0]])).collect()}
    # By size: the second centre's rows are topic 0. The farthest twentieth, the small cluster and rows without a vector are outliers.
    assert [got[i] for i in range(20)] == [1] * 19 + [-1] and [got[100 + i] for i in range(40)] == [0] * 38 + [-1] * 2
    assert {got[i] for i in (200, 201, 202, 203)} == {-1}
    assert topics.topic_from_centres(df.limit(0), np.eye(2)).count() == 0


def test_run_stats_round_half_even_and_empty(spark):
    schema = "sentiment_label string, mentions_oregon boolean, mentions_partner boolean, pii_count int"
    df = spark.createDataFrame([("Positive" if i < 49 else "Negative", i < 3, False, i % 2) for i in range(400)], schema)
    row = stats.run_stats(df).first()
    assert row.positive_pct == 12.2 == round(12.25, 1) and row.oregon_mention_pct == round(0.75, 1)
    assert row.pii_redacted_count == 200 and row.records_final == 400
    assert stats.run_stats(df.limit(0)).first().asDict() == {
        "positive_pct": 0.0, "negative_pct": 0.0, "neutral_pct": 0.0, "oregon_mention_pct": 0.0,
        "partner_mention_pct": 0.0, "pii_redacted_count": 0, "records_final": 0}


@pytest.mark.parametrize("part", [1, 3, 7, 11, 23, 69, 131])
def test_rounding_is_that_of_python(spark, part):
    got = spark.range(1).select(stats.round_one_place(F.lit(part) / F.lit(2000) * 100)).first()[0]
    assert got == round(part / 2000 * 100, 1)


def test_top_negative_and_prompts(spark):
    rows = [(f"{i:03d}", -0.3 - i / 100, "t" * 2000) for i in range(24)] + [("x", None, "a"), ("y", 0.5, "b")]
    df = spark.createDataFrame(rows, "id string, sentiment_score double, clean_text string")
    top = insights.top_negative(df, 500)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 23  # a score of exactly -0.3 stays out
    prompts = insights.prompt_batches(insights.number_batches(top)).orderBy("batch").collect()
    assert [p.posts for p in prompts] == [10, 10, 3]
    assert "POST_ID: 023\nTEXT: " + "t" * 1500 + "\n\n---\nPOST_ID: 022" in prompts[0].prompt


def test_parse_insights(spark):
    good = '[{"post_id":"1","severity":4,"mentions_leaving":true},{"post_id":"2","severity":"x"}]'
    df = spark.createDataFrame([(r,) for r in (
        f"```json\n{good}\n```", f"  {good}", f"```\n{good}\n```", '{"post_id":"9"}', "sorry", None, "[broken")],
        "response string")
    rows = insights.parse_insights(df).collect()
    ids = Counter(r.post_id for r in rows if r.post_id)
    assert ids == {"1": 3, "2": 3}
    assert {r.severity for r in rows if r.post_id == "2"} == {None}
    summary = insights.insight_summary(insights.parse_insights(df).where("post_id is not null")).first()
    assert summary.total_analyzed == 6 and summary.posts_mentioning_leaving == 3 and summary.avg_severity == 4.0
    assert summary.posts_mentioning_rural == 0


def test_relations(spark):
    messages = spark.createDataFrame([("a", 2, "2023-01", 0.5), ("b", 0, "2023-01", -0.5)],
                                     "id string, pii_count int, year_month string, sentiment_score double")
    audit = spark.createDataFrame([("a", "PERSON", 0, 3, 0.8), ("a", "LOCATION", 5, 9, 0.8)],
                                  "post_id string, entity_type string, start_position int, end_position int, confidence double")
    rows = joins.join_audit(messages, audit).collect()
    assert sorted((r.id, r.entity_type) for r in rows if r.id == "a") == [("a", "LOCATION"), ("a", "PERSON")]
    assert [(r.id, r.entity_type) for r in rows if r.id == "b"] == [("b", None)]
    assert [r.id for r in joins.messages_with_audit(messages, audit, found=False).collect()] == ["b"]
    months = spark.createDataFrame([("2023-01", 0.1)], "year_month string, avg_sentiment double")
    joined = joins.join_monthly(messages, months)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert {r.id: round(r.difference, 3) for r in joined.collect()} == {"a": 0.4, "b": -0.6}
