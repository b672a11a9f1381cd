"""Fixed schemas of every table that crosses a file or process boundary."""

from pyspark.sql import types as T

# The JSON reader turns text nested deeper than 1000 levels into NULL unless told otherwise.
JSON_OPTIONS = {"maxNestingDepth": "1000000"}

# ``createdAt`` stays VARIANT: a JSON number means epoch seconds, a JSON string is parsed.
ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("createdAt", T.VariantType()),
    T.StructField("upVotes", T.LongType()),
    T.StructField("downVotes", T.LongType()),
    T.StructField("subredditName", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("comments", T.StringType()),
])

# One comment without the replies below it.
COMMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("createdAt", T.VariantType()),
    T.StructField("upVotes", T.LongType()),
    T.StructField("downVotes", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("score", T.LongType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("reddit_url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("timestamp_imputed", T.BooleanType()),
])

PROCESSED = T.StructType(MESSAGE.fields + [
    T.StructField("original_text", T.StringType()),
    T.StructField("clean_text", T.StringType()),
    T.StructField("text_length", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("is_relevant", T.BooleanType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("sentiment_confidence", T.DoubleType()),
    T.StructField("sentiment_uncertain", T.BooleanType()),
    T.StructField("redacted_text", T.StringType()),
    T.StructField("pii_detected", T.BooleanType()),
    T.StructField("pii_types", T.StringType()),
    T.StructField("pii_count", T.IntegerType()),
    T.StructField("mentions_oregon", T.BooleanType()),
    T.StructField("mentions_partner", T.BooleanType()),
    T.StructField("mentions_faculty", T.BooleanType()),
    T.StructField("mentions_attrition", T.BooleanType()),
    T.StructField("search_category", T.StringType()),
    T.StructField("is_recruitment", T.BooleanType()),
    T.StructField("is_retention", T.BooleanType()),
    T.StructField("is_alumni", T.BooleanType()),
    T.StructField("keyword_matches", T.StringType()),
    T.StructField("dominant_topic", T.IntegerType()),
    T.StructField("topic_keywords", T.StringType()),
    T.StructField("timestamp_pacific", T.TimestampNTZType()),
    T.StructField("year_month", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
])

SPAN = T.StructType([
    T.StructField("entity_type", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()),
])
SPANS = T.ArrayType(SPAN)

AUDIT = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("start_position", T.IntegerType()),
    T.StructField("end_position", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])

NEGATIVE_KEYWORDS = T.StructType([
    T.StructField("keyword", T.StringType()),
    T.StructField("tfidf_score", T.DoubleType()),
    T.StructField("frequency", T.LongType()),
    T.StructField("category", T.StringType()),
])

TOPIC_SUMMARY = T.StructType([
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("topic_name", T.StringType()),
    T.StructField("top_words", T.StringType()),
    T.StructField("post_count", T.LongType()),
    T.StructField("avg_sentiment", T.DoubleType()),
])

INSIGHT = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("primary_complaint", T.StringType()),
    T.StructField("specific_factor", T.StringType()),
    T.StructField("quotable_line", T.StringType()),
    T.StructField("mentions_leaving", T.BooleanType()),
    T.StructField("mentions_rural", T.BooleanType()),
    T.StructField("mentions_partner", T.BooleanType()),
    T.StructField("severity", T.IntegerType()),
    T.StructField("actionable_insight", T.StringType()),
])

RUN = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("error", T.StringType()),
])
