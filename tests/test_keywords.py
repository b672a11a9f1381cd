import random
import re
from dataclasses import replace

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from textpulse.config import DEFAULT, SEARCH_TERMS
from textpulse.functions import terms, text
from textpulse.operators import keywords

LIST = ("quit", "quitting", "left", "left after nhsc", "don't go", "c++", "non-compete", "Big", "3 years", "so")


def _found_in_python(value, words):
    return [w for w in words if re.search(r"\b" + re.escape(w) + r"\b", value)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["quit", "quitting", "left", "after", "nhsc", "don't", "go", "won't", "also", "so", "3", "years", ".", ",x",
     "non-compete", "c++", "_so", "big", "Big", "éso"]), max_size=9).map(" ".join), min_size=60, max_size=60))
def test_terms_match_like_word_boundaries(column, texts):
    assert column(lambda c: terms.matched_terms(c, text.words(c), LIST), texts) == [
        _found_in_python(t, LIST) for t in texts]
    assert column(lambda c: terms.has_term(c, text.words(c), LIST), texts) == [
        bool(_found_in_python(t, LIST)) for t in texts]
    short = lambda c: terms.relevant_words(text.words(c), LIST)
    assert column(lambda c: terms.matched_terms(c, short(c), LIST), texts) == [
        _found_in_python(t, LIST) for t in texts]


def _flags(spark, texts, settings=DEFAULT):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, clean_text string")
    return keywords.flag_keywords(df, settings).orderBy("id").collect()


def test_flags_and_categories(spark):
    rows = _flags(spark, [
        "so it goes", "also", "quit rural and two body problem rural", "the ohsu rural track",
        "cleft palate in rural area", "moved back", "my apd said", "", "he has a buyout clause", "noncompete"])
    assert [r.mentions_partner for r in rows] == [True] + [False] * 9
    assert rows[2].search_category == "partner_family,retention"
    assert rows[3].search_category == "recruitment" and rows[3].mentions_oregon
    assert rows[4].is_alumni and rows[5].is_alumni and not rows[0].is_alumni
    assert rows[6].mentions_faculty and rows[6].keyword_matches == "apd"
    assert rows[7].search_category == "other" and rows[7].keyword_matches == ""
    assert rows[8].search_category == "compensation" and rows[8].is_retention
    assert not rows[9].mentions_attrition
    assert rows[2].keyword_matches == "quit"


def test_capitals_and_hyphens_never_match_unless_normalised(spark):
    texts = [text.lower().replace("-", "") for text in SEARCH_TERMS["oregon_ohsu"]]
    assert not any("oregon_ohsu" in r.search_category for r in _flags(spark, texts))
    rows = _flags(spark, texts, replace(DEFAULT, normalize_keywords=True))
    assert all("oregon_ohsu" in r.search_category for r in rows)


def test_every_category_agrees_with_python(spark):
    texts = [t for words in SEARCH_TERMS.values() for t in words]
    for row, value in zip(_flags(spark, texts), texts):
        want = [c for c, words in SEARCH_TERMS.items() if _found_in_python(value, words)]
        assert row.search_category == (",".join(want) or "other"), value


def test_counts(spark):
    df = spark.createDataFrame([(1, "so portland"), (2, "x")], "id int, clean_text string")
    assert keywords.keyword_counts(keywords.flag_keywords(df)).first() == (1, 1)


def test_a_table_of_terms_matches_like_a_list(spark):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["c++", "don't", "u.s", "é", "a-b"]
    texts = [draw.choice([" ", ", ", "-", "  "]).join(draw.choices(vocabulary, k=draw.randint(0, 12))) for _ in range(80)] + [None, "", "w1w2 w1 w2", "...!"]
    listed = vocabulary + [" ".join(draw.choices(vocabulary, k=2)) for _ in range(200)] + ["w1 w2", "w1, w2", "w1-w2", "W1", "w1.", "unheard of", "w5 unheard"]
    rows = [(str(i) if i % 7 else None, t) for i, t in enumerate(texts)] + [("1", "w3 w4"), ("1", "w3 w4")]
    df = spark.createDataFrame(rows, "id string, clean_text string").repartition(3)
    terms = spark.createDataFrame([(t,) for t in [*listed, *listed[:5], None, "", "!"]], "term string")
    order = lambda out: sorted((r.id or "", r.clean_text or "", r.found, sorted(r.matches)) for r in out.collect())
    assert order(keywords.match_term_table(df, terms)) == order(keywords.match_keywords(df, tuple(dict.fromkeys(listed))))
    assert {(r.found, tuple(r.matches)) for r in keywords.match_term_table(df, terms.limit(0)).collect()} == {(False, ())}
    assert keywords.match_term_table(df.limit(0), terms).count() == 0


def test_a_hundred_thousand_terms(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("term"), F.col("id"), F.when(F.col("id") % 2 == 0, " of").otherwise("")).alias("term"))
    df = spark.createDataFrame([(str(i), f"the term{i} of term{i + 1} off") for i in range(300)], "id string, clean_text string")
    out = keywords.match_term_table(df, terms)
    assert "term99999" not in out._jdf.queryExecution().toString()
    for r in out.collect():
        i = int(r.id)
        assert r.matches == sorted([f"term{i} of"] if i % 2 == 0 else [f"term{i}"]) + ([f"term{i + 1}"] if i % 2 == 0 else [])


def test_terms_of_a_table_are_found_without_a_shuffle(spark, monkeypatch):
    """One pass over the texts, with the same terms as the joins of a larger table find."""
    long = "w1 w2 w3 w4 w5 w6, w7"
    texts = ["w1 w2-w3", "-w1 w2", "w1 w2-", f"so {long} w8", f"so {long}x", "+c++x c+", "c++", "  ", "", None, "e\u0301t\u00e9 \u00bd x", "a\nb\x00c", "\U0001f600 a", "a" * 9000]
    listed = ["w1", "w1 w2", "-w1", "w2-", "w2-w3", long, "c++", "+c", "++", "e\u0301t\u00e9", "t\u00e9", "\u00bd x", "b\x00c", "a", "a\nb", "x", "never", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, clean_text string")
    terms = spark.createDataFrame([(t,) for t in listed], "term string")
    found = lambda: {r.id: (r.found, r.matches) for r in keywords.match_term_table(df, terms).collect()}
    out, passed = keywords.match_term_table(df, terms), found()
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert passed[0] == (True, ["w1", "w1 w2", "w2-", "w2-w3"]) and passed[3] == (True, ["w1", "w1 w2", long]) and passed[5] == (True, ["c++", "x"]), passed
    monkeypatch.setattr(keywords, "TERMS", 1)
    assert found() == passed
