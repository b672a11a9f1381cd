import random
from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from textpulse.config import DEFAULT
from textpulse.functions import spans
from textpulse.operators import pii, sentiment


def _analyze(spark, texts, **kwargs):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, clean_text string")
    return sentiment.analyze_sentiment(df, **kwargs).orderBy("id").collect()


def test_polarity(spark):
    good, bad, plain, blank, none = _analyze(spark, [
        "i loved this program, best choice and i recommend it", "terrible, i hated it, worst place",
        "residency is three years long", "  ", None])
    assert good.sentiment_label == "Positive" and good.sentiment_score > 0.5
    assert bad.sentiment_label == "Negative" and bad.sentiment_score < -0.5
    assert plain.sentiment_label == "Neutral" and plain.sentiment_score == 0.0
    for row in (blank, none):
        assert (row.sentiment_label, row.sentiment_score, row.sentiment_confidence) == ("Neutral", 0.0, 0.0)
        assert row.sentiment_uncertain


def test_scores_stay_in_range(spark):
    rows = _analyze(spark, ["good " * n + "bad " * m for n in range(7) for m in range(7)])
    assert all(-1 <= r.sentiment_score <= 1 and 0 <= r.sentiment_confidence <= 1 for r in rows)
    assert all(r.sentiment_uncertain == (r.sentiment_confidence < 0.7) for r in rows)


def test_ties_go_to_the_first_class(spark):
    fixed = lambda *p: lambda _text: F.struct(*[F.lit(v).alias(n) for n, v in zip(("neg", "neu", "pos"), p)])
    row = _analyze(spark, ["x"], scorer=fixed(0.4, 0.4, 0.2))[0]
    assert (row.sentiment_label, row.sentiment_score, row.sentiment_uncertain) == ("Negative", -0.4, True)
    row = _analyze(spark, ["x"], scorer=fixed(0.1, 0.2, 0.7))[0]
    assert (row.sentiment_label, row.sentiment_uncertain) == ("Positive", False)


def test_model_scorer_falls_back_per_batch(spark):
    def load():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise ValueError("boom")
            return [(0.1, 0.1, 0.8) for _ in texts]
        return predict

    rows = _analyze(spark, ["a", "", "boom", "b"], scorer=sentiment.model_scorer(load, batch_size=1))
    assert [r.sentiment_label for r in rows] == ["Positive", "Neutral", "Neutral", "Positive"]
    assert [r.sentiment_confidence for r in rows] == [0.8, 0.0, 0.0, 0.8]


def _redact(spark, texts, settings=DEFAULT, detector=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, original_text string")
    return pii.redact_pii(df, settings, detector).orderBy("id").collect()


def test_documented_cases(spark):
    rows = _redact(spark, [
        "The clinic line is 555-867-5309, ask for the night desk.",
        "Write to front.desk@valleyclinic.org before Friday noon",
        "Dr. Maria Lopez at Riverside Hospital taught our class.",
        "We train in family medicine and in internal medicine.",
        "My ward looks nothing like Grey's Anatomy, and Dr. House would quit.",
        "Seen on r/Residency and again on r/medicalschool.",
        "After New York City the quiet of rural Oregon was a shock.",
        "Small towns ask a lot of you and give a lot back.",
        "", None, "Ring John Smith on 555-9876 or write to js@mail.net"])
    text = [r.redacted_text for r in rows]
    assert text[0] == "The clinic line is [REDACTED], ask for the night desk."
    assert "valleyclinic" not in text[1] and "EMAIL_ADDRESS" in rows[1].pii_types
    assert "Maria Lopez" not in text[2] and "PERSON" in rows[2].pii_types
    assert "family medicine" in text[3] and "Grey's Anatomy" in text[4] and "Dr. House" in text[4]
    assert "r/Residency" in text[5]
    assert rows[6].pii_types == "LOCATION" and rows[6].pii_count == 2
    assert not rows[7].pii_detected and text[7].startswith("Small")
    assert text[8] == text[9] == "" and rows[8].pii_count == rows[9].pii_count == 0
    assert rows[10].pii_count == 3 and rows[10].pii_types == "EMAIL_ADDRESS,PERSON,PHONE_NUMBER"


def test_whitelist(column):
    protected = lambda match: lambda c: spans.is_whitelisted(c, DEFAULT.pii_whitelist, match)
    values = ["Dr. House", "Denver", "September 2023", "Sarah Johnson", "Dr. John Smith", "ER"]
    assert column(protected("substring"), values) == [True, True, True, False, False, True]
    assert column(protected("word"), values) == [True, False, False, False, False, True]


def test_actions(spark):
    text = "mail a@b.org"
    flagged = _redact(spark, [text], replace(DEFAULT, pii_action="flag"))[0]
    assert flagged.redacted_text == text and flagged.pii_count == 1
    ignored = _redact(spark, [text], replace(DEFAULT, pii_action="none"))[0]
    assert ignored.redacted_text == text and ignored.pii_count == 0


def test_overlapping_spans_give_one_replacement(spark):
    def load():
        return lambda _t: [("A", 2, 6, 0.5), ("B", 4, 8, 0.5), ("C", 8, 9, 0.5), ("D", 0, 1, 0.5)]

    row = _redact(spark, ["0123456789"], detector=pii.model_detector(load))[0]
    assert row.redacted_text == "[REDACTED]1[REDACTED][REDACTED]9"
    assert row.pii_count == 4


def test_offsets_count_characters(spark):
    text = "\U0001f600é a@b.org \U0001f600 c@d.org"
    row = _redact(spark, [text])[0]
    assert [text[s["start"]:s["end"]] for s in row.pii_spans] == ["a@b.org", "c@d.org"]
    assert row.redacted_text == "\U0001f600é [REDACTED] \U0001f600 [REDACTED]"


def test_audit_has_positions_and_no_values(spark):
    df = spark.createDataFrame([("p7", "Ask for Maria Roe, m.roe@post.net, phone 555-2468")],
                               "id string, original_text string")
    audit = pii.pii_audit(pii.redact_pii(df), datetime(2025, 1, 1))
    assert audit.columns == ["post_id", "entity_type", "start_position", "end_position", "confidence", "timestamp"]
    rows = audit.collect()
    assert len(rows) == 3 and {r.post_id for r in rows} == {"p7"}
    assert pii.pii_posts(audit).first()[0] == 1


def test_patterns_accept_what_their_signs_reject_nowhere(spark):
    """A text with a match always shows the cheaper sign."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for p in spans.default_patterns(DEFAULT):
        if p.sign:
            assert docs.where(F.col("text").rlike(p.regex) & ~F.col("text").rlike(p.sign)).isEmpty()


@pytest.mark.parametrize("sample", ["(555) 123-4567", "+1 555 123 4567", "555.123.4567", "March 3rd, 2024", "May 2021",
                                    "3/4/21", "2024-01-31", "tomorrow", "Mr. Brown"])
def test_pattern_samples(spark, sample):
    assert _redact(spark, [f"see {sample} ok"], replace(DEFAULT, pii_whitelist=()))[0].redacted_text == "see [REDACTED] ok"


def test_fitted_scorer(spark, tmp_path):
    from textpulse.operators import fitted
    draw = random.Random(4)
    words = {"Negative": "awful pain lost unfair rude".split(), "Neutral": "table window seven street paper".split(),
             "Positive": "great kind happy bright thanks".split()}
    common = "clinic doctor week people town".split()

    def rows(n, labels=fitted.LABELS):
        out = []
        for i in range(n):
            label = labels[i % len(labels)]
            text = " ".join(draw.choices(words[label], k=draw.randint(2, 3)) + draw.choices(common, k=6) + draw.choices(sum(words.values(), []), k=1))
            out.append((i, text, label))
        return spark.createDataFrame(out + [(-1, "odd label", "Other"), (-2, None, "Neutral")], "id long, clean_text string, label string")

    model = fitted.fit(rows(600))
    held = sentiment.analyze_sentiment(rows(300).where("id >= 0"), scorer=model.scorer())
    assert held.where("label = sentiment_label").count() >= 270
    model.save(spark, str(tmp_path / "model"))
    again = sentiment.analyze_sentiment(held.drop("sentiment_score"), scorer=fitted.Model.load(spark, str(tmp_path / "model")).scorer())
    first, second = ({r.id: (r.sentiment_label, round(r.sentiment_score, 9)) for r in df.collect()} for df in (held, again))
    assert first == second
    # Blank texts stay neutral without confidence; texts of unknown words get what the intercepts say.
    odd = sentiment.analyze_sentiment(spark.createDataFrame([(1, ""), (2, "zzz qqq")], "id long, clean_text string"), scorer=model.scorer())
    blank, unknown = odd.orderBy("id").collect()
    shares = np.exp(model.intercept) / np.exp(model.intercept).sum()
    assert (blank.sentiment_label, blank.sentiment_confidence) == ("Neutral", 0.0)
    assert unknown.sentiment_confidence == pytest.approx(shares.max()) and unknown.sentiment_label == fitted.LABELS[shares.argmax()]
    two = sentiment.analyze_sentiment(rows(60), scorer=fitted.fit(rows(200, ("Negative", "Positive")).where("id >= 0")).scorer())
    assert {r.sentiment_label for r in two.where("clean_text IS NOT NULL").collect()} == {"Negative", "Positive"}
    assert sentiment.analyze_sentiment(rows(0).where("id > 0"), scorer=model.scorer()).count() == 0
    with pytest.raises(ValueError, match="no labelled"):
        fitted.fit(rows(30).where("label = 'Other'"))
    assert fitted.Model.of(spark.createDataFrame([], model.table(spark).schema)).terms == []


def test_gazetteer_takes_the_longest_name(spark):
    names = spark.createDataFrame([
        ("LOCATION", "New York"), ("LOCATION", "New York City"), ("PERSON", "Ann"), ("PERSON", "Ann O'Neil-Smith"), ("LOCATION", "Paris"),
        ("PERSON", "Paris"), ("PERSON", " "), (None, "x"), ("PERSON", None), ("PERSON", "Łukasz"), *((("PERSON", f"Name{i} Of {i}") for i in range(5000)))],
        "entity_type string, name string")
    texts = ["Ann met Ann O'Neil-Smith and Anna in New  York City, not New York.", "Paris", "Name77 Of 77 and Name77 Of 78", None, "", "Łukasz ann"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, original_text string")
    found = pii.with_spans(df, replace(DEFAULT, pii_whitelist=()), pii.gazetteer_detector(names))
    got = {r.id: [(texts[r.id][s.start:s.end], s.entity_type) for s in r.pii_spans] for r in found.collect()}
    assert got == {0: [("Ann", "PERSON"), ("Ann O'Neil-Smith", "PERSON"), ("New  York City", "LOCATION"), ("New York", "LOCATION")],
                   1: [("Paris", "LOCATION"), ("Paris", "PERSON")], 2: [("Name77 Of 77", "PERSON")], 3: [], 4: [], 5: [("Łukasz", "PERSON")]}
    with pytest.raises(ValueError, match="more than 100 names"):
        pii.gazetteer_detector(names, limit=100)
    both = pii.several(pii.pattern_detector(DEFAULT), pii.gazetteer_detector(names.limit(4)))
    row = pii.redact_pii(df.limit(1), replace(DEFAULT, pii_whitelist=()), both).first()
    assert "New" not in row.redacted_text and row.pii_types == "LOCATION,PERSON"


def test_names_beyond_a_worker_meet_the_texts_in_a_join(spark, monkeypatch):
    """The same spans as of a trie, for texts and ids that repeat, NULL and blank ones, and names of several types."""
    draw = random.Random(6)
    words = ["Ann", "New", "York", "City", "O'Neil", "-", "Łukasz", "Paris", "\U0001f600", "of", "Mc\u00a0Coy"]
    names = [(draw.choice(["PERSON", "LOCATION"]), draw.choice([" ", "  ", "-"]).join(draw.choices(words, k=draw.randint(1, 4)))) for _ in range(60)]
    names += [("PERSON", "\t"), (None, "Ann"), ("PERSON", None), ("PERSON", "Paris"), ("LOCATION", "Paris"), ("PERSON", " Ann ")]
    texts = [draw.choice([" ", "\n", "  "]).join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(80)]
    texts += [None, "", " ", *texts[:20], *["Ann of Paris"] * 5]
    df = spark.createDataFrame([(i % 50 if i % 9 else None, t) for i, t in enumerate(texts)], "id int, original_text string").repartition(3)
    table = spark.createDataFrame(names, "entity_type string, name string")
    plain = replace(DEFAULT, pii_whitelist=())

    def found():
        both = pii.several(pii.pattern_detector(plain), pii.gazetteer_detector(table))
        out = pii.with_spans(df, plain, both)
        assert out.columns == ["id", "original_text", "pii_spans"]
        return sorted((r.id or 0, r.original_text or "", [tuple(s) for s in r.pii_spans]) for r in out.collect())

    listed = found()
    monkeypatch.setattr(pii, "MAX_NAMES", 5)
    assert found() == listed and sum(len(spans) for *_, spans in listed) > 100
    monkeypatch.setattr(pii, "gazetteer_detector", lambda names: pii.JoinedGazetteer(names.dropna(), 0.85))
    assert found() == listed
    with pytest.raises(TypeError, match="with_spans"):
        pii.gazetteer_detector(table)(F.col("original_text"))
