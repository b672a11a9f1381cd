import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from textpulse.config import DEFAULT
from textpulse.functions import text, timestamps
from textpulse.functions.language import detect_language
from textpulse.operators import preprocess


def test_clean_text_golden(column):
    raw = "a b see https://x.y/z). &AMP; x200B &amp; [deleted] self-care couldn’t"
    assert column(text.clean_text, [raw, None, "  A  b\x1cc  "]) == [
        "a b see amp x200b selfcare couldnt", "", "a b c"]


def _clean_in_python(value):
    value = re.sub(r"https?://\S+|www\.\S+", "", value)
    value = re.sub(r"&[a-z]+;|x200b|\[deleted\]|\[removed\]", "", value)
    value = re.sub(r"[^a-zA-Z0-9\s.,!?']", "", value)
    return re.sub(r"\s+", " ", value.lower()).strip()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9.,!?'&;x200[]delt:/wh   \x1c\x85é\U0001f600\n", max_size=60),
                min_size=60, max_size=60))
def test_clean_text_matches_python(column, texts):
    assert column(text.clean_text, texts) == [_clean_in_python(t) for t in texts]


def test_strip_removes_all_unicode_space(column):
    assert column(text.strip, ["　\x1f a b \n", ""]) == ["a b", ""]


def _truncate_in_python(value, limit=2000):
    if len(value) <= limit:
        return value
    head, tail = value[:int(1600 * limit / 2000)], value[-int(400 * limit / 2000):]
    if " " in head:
        head = head[:head.rindex(" ")]
    if " " in tail:
        tail = tail[tail.index(" ") + 1:]
    return head + " ... " + tail


def test_truncate(column):
    texts = ["x" * 2000, "x" * 2001, "word " * 500, "x" * 1700 + " " + "y" * 900, " " * 3000]
    got = column(text.truncate_text, texts)
    assert got == [_truncate_in_python(t) for t in texts]
    assert len(got[1]) == 2005
    assert column(lambda c: text.truncate_text(c, 100), ["word " * 30]) == [
        _truncate_in_python("word " * 30, 100)]


def test_title_case(column):
    assert column(text.title_case, ["rural, 3rd, can't"]) == ["rural, 3rd, can't".title()]


def test_stop_words(column):
    assert column(lambda c: text.remove_stop_words(c, ("the", "don't")), [" the cat  don't sit ", None]) == [
        "cat sit", ""]


def test_language(column):
    find = lambda c: detect_language(c, text.words(c), DEFAULT.language_words)
    assert column(find, ["the cat is on the mat", "der hund und die katze", "el perro de los vecinos",
                         "le chat est dans les bois", "xyzzy qwerty", "th", ""]) == [
        "en", "de", "es", "fr", "unknown", "unknown", "unknown"]


def test_parse_text(column):
    got = column(lambda c: F.date_format(timestamps.parse_text(c), "yyyy-MM-dd HH:mm:ss"), [
        "1641852316", "20240315", "1.2.3", "abc", None, "2024-03-15T10:00:00Z", "2024-03-15 10:00:00+05:30",
        "2024-03-15", "March 5, 2024", "03/05/2024", "Fri, 15 Mar 2024 10:00:00 GMT", "9999-12-31", "-5", ""])
    assert got == ["2022-01-10 22:05:16", "1970-08-23 06:18:35", None, None, None, "2024-03-15 10:00:00",
                   "2024-03-15 04:30:00", "2024-03-15 00:00:00", "2024-03-05 00:00:00", "2024-03-05 00:00:00",
                   "2024-03-15 10:00:00", None, None, None]


SHAPES = [
    ("2024/03/15", "2024-03-15 00:00:00"), ("15 March 2024", "2024-03-15 00:00:00"), ("Mar 15, 2024 10:30 PM", "2024-03-15 22:30:00"),
    ("March 15th, 2024 at 9:05 am", "2024-03-15 09:05:00"), ("15-Mar-2024 23:59:59", "2024-03-15 23:59:59"),
    ("15/03/2024", "2024-03-15 00:00:00"), ("3/5/24", "2024-03-05 00:00:00"), ("3-5-1999 7:08", "1999-03-05 07:08:00"),
    ("2024.03.15 10:30", "2024-03-15 10:30:00"), ("20240315T103045", "2024-03-15 10:30:45"), ("20240315T103045Z", "2024-03-15 10:30:45"),
    ("Friday, 15 March 2024 12:00 AM", "2024-03-15 00:00:00"), ("Fri Mar 15 2024 12:30 p.m.", "2024-03-15 12:30:00"),
    ("Fri, 15 Mar 2024 10:00:00 +0530", "2024-03-15 04:30:00"), ("2024 Mar 15 10:00 -03", "2024-03-15 13:00:00"),
    ("Mar 2024", "2024-03-01 00:00:00"), ("2024/3/5 1:02:03.456", "2024-03-05 01:02:03"), ("15. September 2024", "2024-09-15 00:00:00"),
    ("Sept. 5, 2024", "2024-09-05 00:00:00"), ("1st Jan 2024 10:00 UTC", "2024-01-01 10:00:00"), ("2024-3-5", "2024-03-05 00:00:00"),
    ("2024-03-15T10:00:00.123456789+00:00", "2024-03-15 10:00:00"), ("15 mar 24 6pm", "2024-03-15 18:00:00"),
    ("03.15.2024, 10:30", "2024-03-15 10:30:00"), ("2024/03/15T10:30:00+02:00", "2024-03-15 08:30:00"),
    ("2024/02/30", None), ("2024/13/13", None), ("15 Foo 2024", None), ("2024/03/15 25:00", None), ("13/13/2024", None),
    ("Mar 15", None), ("Mar 15, 2024 13:00 PM", None), ("1|2|3", None), ("|" * 30, None), ("yesterday", None), ("10:30", None)]


def test_dates_of_many_shapes(column):
    got = column(lambda c: F.date_format(timestamps.parse_text(c), "yyyy-MM-dd HH:mm:ss"), [text for text, _ in SHAPES])
    assert dict(zip([text for text, _ in SHAPES], got)) == dict(SHAPES)


def test_unreadable_times_are_counted(spark):
    from textpulse.operators.threads import unreadable_timestamps
    rows = [("soon",), ("later",), ("99/99/2024",), ("2024-01-01",), (None,), ("12",)]
    found = {r.shape: (r.rows, r.example) for r in unreadable_timestamps(spark.createDataFrame(rows, "timestamp string")).collect()}
    assert found == {"a": (2, "later"), "99/99/9999": (1, "99/99/2024")}
    variants = spark.createDataFrame([('"soon"',), ("true",), ("null",), ("5",)], "j string").select(F.parse_json("j").alias("timestamp"))
    assert sorted((r.shape, r.rows) for r in unreadable_timestamps(variants).collect()) == [("a", 2)]


def test_parse_variant(column):
    got = column(lambda c: F.date_format(timestamps.parse_variant(F.parse_json(c)), "yyyy-MM-dd HH:mm:ss"), [
        "1641852316", '"1641852316"', "-5", "1.641852316e9", "true", "null", "{}", '"2024-03-15"', "1641852316000"])
    assert got == ["2022-01-10 22:05:16", "2022-01-10 22:05:16", "1969-12-31 23:59:55", "2022-01-10 22:05:16",
                   None, None, None, "2024-03-15 00:00:00", None]


def test_filters_use_original_text(spark):
    df = spark.createDataFrame(
        [("a", "[deleted]"), ("b", "[deleted] x"), ("c", "x" * 14), ("d", "the do " + "-" * 8), ("e", None)],
        "id string, text string")
    kept = preprocess.filter_deleted(preprocess.with_original_text(df))
    assert {r.id for r in kept.collect()} == {"b", "c", "d"}
    short = preprocess.filter_short(preprocess.with_text_length(kept))
    assert {r.id for r in short.collect()} == {"d"}
    assert [r.clean_text for r in preprocess.preprocess(df).collect()] == ["the do"]


def test_preprocess_counts_agree_with_rows(spark):
    from pyspark.sql import Observation
    rows = [(str(i), t) for i, t in enumerate(
        ["[removed]", "short", "der hund und die katze sind im haus", "the cat is on the mat today",
         "the doctor is in the clinic today", "the match was a long one for all"])]
    df = spark.createDataFrame(rows, "id string, text string")
    counts = preprocess.stage_counts(df).first().asDict()
    assert counts == {"rows_in": 6, "dropped_deleted": 1, "dropped_short": 1, "dropped_language": 1,
                      "dropped_irrelevant": 1, "rows_kept": 2}
    seen = Observation("c")
    kept = preprocess.preprocess(df, observation=seen).collect()
    assert sorted(r.id for r in kept) == sorted(r.id for r in preprocess.preprocess(df).collect()) == ["4", "5"]
    assert seen.get == counts


def test_cleaning_runs_once_per_row(spark):
    """The cleaning patterns stand once in the plan, however many filters follow."""
    df = spark.createDataFrame([("1", "x")], "id string, text string")
    plan = preprocess.preprocess(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("x200b") == 1
