"""SQL that must give the same rows as the registered queries.

Written from the definitions of the operators, for an engine with RE2 patterns; shared
steps are common table expressions that each statement lists first.
"""

from __future__ import annotations

from registry.data import ALUMNI_PHRASES, SETTINGS, TIME_SHAPES
from textpulse.functions.spans import END, START, default_patterns
from textpulse.operators.insights import COMPLAINTS

ORACLE_SQL: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]::VARCHAR[]"


def escape(term: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)


def any_term(column: str, terms) -> str:
    pattern = "\\b(?:" + "|".join(escape(t) for t in terms) + ")\\b"
    return f"regexp_matches({column}, {text(pattern)})"


def rounded(expression: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0"


# Unicode white space as RE2 needs it spelled out, and the same as characters.
SPACE = (r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
         r"\x{3000}")
SPACE_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233,
               8239, 8287, 12288]
SPACE_TEXT = " || ".join(f"chr({c})" for c in SPACE_CODES)


def clean(column: str) -> str:
    out = column
    for pattern in (f"https?://[^{SPACE}]+|www\\.[^{SPACE}]+",
                    r"&[a-z]+;|x200b|\[deleted\]|\[removed\]", f"[^a-zA-Z0-9{SPACE}.,!?']"):
        out = f"regexp_replace({out}, {text(pattern)}, '', 'g')"
    return f"trim(regexp_replace(lower({out}), {text('[' + SPACE + ']+')}, ' ', 'g'))"


MESSAGES = """
messages AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, text AS original_text, lang, source AS subreddit,
         TIMESTAMP '2020-01-01 00:00:00' + to_seconds((doc_id * 104729) % 157680000) AS ts
  FROM documents)"""

CLEANED = MESSAGES + f""",
cleaned AS (SELECT *, {clean("coalesce(original_text, '')")} AS whole_text FROM messages)"""


def hits(name: str) -> str:
    return (f"len(list_filter(regexp_extract_all(whole_text, '[a-z0-9_]+'), "
            f"lambda w: list_contains({array(SETTINGS.language_words[name])}, w)))")


LANGUAGES = CLEANED + f""",
hits AS (SELECT *, {', '.join(f'{hits(n)} AS {n}' for n in SETTINGS.language_words)} FROM cleaned),
languages AS (
  SELECT *, CASE WHEN length(whole_text) < 3 OR greatest(en, de, es, fr) = 0 THEN 'unknown'
                 WHEN en = greatest(en, de, es, fr) THEN 'en'
                 WHEN de = greatest(en, de, es, fr) THEN 'de'
                 WHEN es = greatest(en, de, es, fr) THEN 'es' ELSE 'fr' END AS language
  FROM hits)"""


def truncated(column: str) -> str:
    head = f"substring({column}, 1, 1600)"
    tail = f"right({column}, 400)"
    return f"""CASE WHEN length({column}) <= 2000 THEN {column} ELSE
      (CASE WHEN contains({head}, ' ') THEN regexp_replace({head}, ' [^ ]*$', '') ELSE {head} END)
      || ' ... ' ||
      (CASE WHEN contains({tail}, ' ') THEN substring({tail}, instr({tail}, ' ') + 1) ELSE {tail} END) END"""


PREPROCESSED = LANGUAGES + f""",
preprocessed AS (
  SELECT *, {truncated('whole_text')} AS clean_text FROM languages
  WHERE original_text NOT IN ('[deleted]', '[removed]', '') AND length(original_text) >= 15
    AND language = 'en' AND {any_term('whole_text', SETTINGS.relevance_terms)})"""


def word_count(words, column: str = "clean_text") -> str:
    return (f"len(list_filter(regexp_extract_all({column}, '[a-z'']+'), "
            f"lambda w: list_contains({array(words)}, w)))")


def scores(source: str, column: str = "clean_text") -> str:
    return f""",
counts AS (SELECT *, CAST({word_count(SETTINGS.positive_words, column)} AS DOUBLE) AS p,
                  CAST({word_count(SETTINGS.negative_words, column)} AS DOUBLE) AS n FROM {source}),
shares AS (SELECT *, n / (p + n + 0.5) AS neg, 0.5 / (p + n + 0.5) AS neu, p / (p + n + 0.5) AS pos FROM counts),
labels_ AS (SELECT *, CASE WHEN neg >= neu AND neg >= pos THEN 'Negative' WHEN neu >= pos THEN 'Neutral'
                          ELSE 'Positive' END AS sentiment_label,
                  greatest(neg, neu, pos) AS sentiment_confidence FROM shares),
scored AS (SELECT *, CASE sentiment_label WHEN 'Positive' THEN sentiment_confidence
                         WHEN 'Negative' THEN -sentiment_confidence ELSE 0.0 END AS sentiment_score FROM labels_)"""


SCORED = PREPROCESSED + scores("preprocessed")

S = SETTINGS
_ALL_TERMS = (S.region_terms + S.partner_terms + S.faculty_terms + S.attrition_terms
              + S.partner_extra_terms + S.faculty_extra_terms)


def matched(column: str, terms) -> str:
    terms = list(dict.fromkeys(terms))
    return ("list_filter([" + ", ".join(
        f"CASE WHEN {any_term(column, [t])} THEN {text(t)} END" for t in terms)
        + "], lambda t: t IS NOT NULL)")


def categories(column: str) -> str:
    parts = ", ".join(f"CASE WHEN {any_term(column, terms)} THEN {text(name)} END"
                      for name, terms in S.search_terms.items())
    return f"coalesce(nullif(concat_ws(',', {parts}), ''), 'other')"


def flags(source: str, column: str) -> str:
    return f""",
flags AS (SELECT *, {any_term(column, S.region_terms)} AS mentions_oregon,
    {any_term(column, S.partner_terms + S.partner_extra_terms)} AS mentions_partner,
    {any_term(column, S.faculty_terms + S.faculty_extra_terms)} AS mentions_faculty,
    {any_term(column, S.attrition_terms)} AS mentions_attrition,
    {categories(column)} AS search_category,
    array_to_string({matched(column, _ALL_TERMS)}, ',') AS keyword_matches FROM {source}),
flagged AS (SELECT *, contains(search_category, 'recruitment') AS is_recruitment,
    contains(search_category, 'retention') OR contains(search_category, 'compensation')
      OR mentions_attrition AS is_retention,
    contains({column}, 'moved back') OR (contains({column}, 'after') AND contains({column}, 'years'))
      OR (contains({column}, 'left') AND contains({column}, 'rural')) AS is_alumni FROM flags)"""


CLEAN_FLAGS = CLEANED + flags("cleaned", "whole_text")

CALENDAR = """,
calendar AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', ts)) AS local_time FROM {source}),
dated AS (SELECT *, strftime(local_time, '%Y-%m') AS year_month FROM calendar)"""

DATED = SCORED + flags("scored", "clean_text") + CALENDAR.format(source="flagged")


def monthly(source: str) -> str:
    return f""",
months AS (
  SELECT year_month, count(id) AS total_posts, avg(sentiment_score) AS avg_sentiment,
         median(sentiment_score) AS median_sentiment, stddev_samp(sentiment_score) AS std_sentiment,
         count(*) FILTER (mentions_oregon) AS oregon_mentions,
         count(*) FILTER (mentions_partner) AS partner_mentions,
         count(*) FILTER (sentiment_label = 'Positive') AS positive_count,
         count(*) FILTER (sentiment_label = 'Negative') AS negative_count,
         count(*) FILTER (sentiment_label = 'Neutral') AS neutral_count
  FROM {source} GROUP BY year_month)"""


def rolling(months: int, source: str = "months") -> str:
    frame = f"OVER (ORDER BY year_month ROWS BETWEEN {months - 1} PRECEDING AND CURRENT ROW)"
    value = f"CASE WHEN count(avg_sentiment) {frame} = {months} THEN avg(avg_sentiment) {frame} END"
    return rounded(value)


MONTHS = DATED + monthly("dated")

# --- personal data: gaps and matches give the offsets ----------------------------------------


def _spans() -> str:
    parts = []
    for p in default_patterns(SETTINGS):
        regex = text(p.regex.replace("(?=[A-Z])", "").replace(START, r"\b").replace(END, r"\b"))
        parts.append(
            f"SELECT doc_id, id, original_text, {text(p.entity_type)} AS entity_type, "
            f"CAST({p.confidence} AS DOUBLE) AS confidence, "
            f"regexp_split_to_array(original_text, {regex}) AS gaps, "
            f"regexp_extract_all(original_text, {regex}) AS hits FROM messages")
    return " UNION ALL ".join(parts)


SPANS = MESSAGES + f""",
found AS ({_spans()}),
numbered AS (SELECT *, unnest(hits) AS value, generate_subscripts(hits, 1) AS i FROM found),
spans AS (
  SELECT doc_id, id, original_text, entity_type, confidence, value,
    CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS BIGINT) AS start_,
    length(value) AS size_
  FROM numbered),
kept AS (
  SELECT *, start_ + size_ AS end_ FROM spans
  WHERE NOT regexp_matches(lower(value), {text('|'.join(escape(w) for w in SETTINGS.pii_whitelist))}))"""

ORACLE_SQL["pii_gazetteer"] = """WITH
parts AS (SELECT c_custkey::VARCHAR AS id, c_name AS person, n_name AS place,
          '206-' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone, 'u' || c_custkey || '@example.org' AS mail,
          strftime(DATE '2024-01-01' + (c_custkey % 366)::INTEGER, '%Y-%m-%d') AS day FROM customer JOIN nation ON c_nationkey = n_nationkey),
starts AS (SELECT *, length('Dear all, ') AS a, a + length(person) + length(' from ') AS b, b + length(place) + length(' can be called at ') AS c,
           c + length(phone) + length(' or written to under ') AS d, d + length(mail) + length(' since ') AS e FROM parts)
SELECT id, 'PERSON' AS entity_type, a AS start, a + length(person) AS "end", 0.85::DOUBLE AS confidence FROM starts
UNION ALL SELECT id, 'LOCATION', b, b + length(place), 0.85 FROM starts
UNION ALL SELECT id, 'PHONE_NUMBER', c, c + length(phone), 0.75 FROM starts
UNION ALL SELECT id, 'EMAIL_ADDRESS', d, d + length(mail), 1.0 FROM starts
UNION ALL SELECT id, 'DATE_TIME', e, e + 10, 0.6 FROM starts"""
REDACTED = SPANS + """,
ordered AS (SELECT *, max(end_) OVER (PARTITION BY doc_id ORDER BY start_, end_, entity_type
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM kept),
islands AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ >= reach THEN 1 ELSE 0 END) OVER (
              PARTITION BY doc_id ORDER BY start_, end_, entity_type ROWS UNBOUNDED PRECEDING) AS island FROM ordered),
merged AS (SELECT doc_id, original_text, island, min(start_) AS start_, max(end_) AS end_
           FROM islands GROUP BY ALL),
pieces AS (SELECT *, coalesce(lag(end_) OVER (PARTITION BY doc_id ORDER BY start_), 0) AS from_ FROM merged),
rebuilt AS (
  SELECT doc_id, string_agg(substring(original_text, from_ + 1, start_ - from_) || '[REDACTED]', '' ORDER BY start_)
      || substring(any_value(original_text), max(end_) + 1) AS redacted_text
  FROM pieces GROUP BY doc_id)"""

SUMMARY = SPANS + """,
summaries AS (
  SELECT m.id, count(k.doc_id) AS pii_count,
         coalesce(string_agg(DISTINCT k.entity_type, ',' ORDER BY k.entity_type), '') AS pii_types
  FROM messages m LEFT JOIN kept k ON m.doc_id = k.doc_id GROUP BY m.id)"""

# --- sources ---------------------------------------------------------------------------------

ORACLE_SQL["src_items"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, string_split(text, chr(10))[1] AS title, CAST(NULL AS VARCHAR) AS body, doc_id AS created_at,
       n_chars AS up_votes, CAST(2 AS BIGINT) AS down_votes, source AS subreddit, 'u/' || doc_id AS url, lang AS author,
       contains(text, chr(10)) AS has_comments FROM documents"""
ORACLE_SQL["src_processed"] = f"""WITH {DATED}
SELECT id, clean_text, {rounded('sentiment_score')} AS sentiment_score, sentiment_label, search_category,
       year_month, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM dated"""

# --- threads and timestamps --------------------------------------------------------------------

THREADS = """
lines AS (SELECT doc_id, source, n_chars, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
sentences AS (SELECT doc_id, source, i - 1 AS i, unnest(string_split(line, '. ')) AS body,
                     generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM lines WHERE i > 0),
every AS (
  SELECT doc_id, -1 AS i, -1 AS j, CAST(doc_id AS VARCHAR) AS id, NULL AS parent_id, line AS text,
         n_chars - 2 AS score, source, 'Post' AS type, doc_id AS created_at FROM lines WHERE i = 0
  UNION ALL
  SELECT doc_id, i, j, doc_id || '_' || i || '_' || j,
         CASE WHEN j % 8 = 0 THEN CAST(doc_id AS VARCHAR) ELSE doc_id || '_' || i || '_' || (j - 1) END,
         body, j - 1, source, 'Comment', 1577836800 + j * 86400 FROM sentences)
"""
ORACLE_SQL["flatten_threads"] = f"""WITH {THREADS}
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS position, id, parent_id,
       trim(text, {SPACE_TEXT}) AS text, CAST(score AS BIGINT) AS score, source AS subreddit, type,
       CAST(created_at AS BIGINT) AS created_at FROM every"""
ORACLE_SQL["landing_threads"] = f"SELECT * EXCLUDE (doc_id) FROM ({ORACLE_SQL['flatten_threads']})"
ORACLE_SQL["landing_arrays"] = ORACLE_SQL["landing_threads"]
ORACLE_SQL["dedupe_first"] = """
SELECT md5(text) AS id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS subreddit FROM documents GROUP BY md5(text)"""

_PARSED = """WITH parsed AS (
SELECT event_id, CASE event_type
    WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN date_trunc('second', ts)
    WHEN 'purchase' THEN TIMESTAMP '1970-01-01' + to_seconds(CAST(strftime(ts, '%Y%m%d') AS BIGINT))
    WHEN 'signup' THEN date_trunc('second', ts) - INTERVAL '5 hours 30 minutes' END AS ts FROM events)"""
ORACLE_SQL["parse_ts"] = _PARSED + """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM parsed"""
_SHAPE = f"event_id % {len(TIME_SHAPES)}"
_LEFT = " ".join(f"WHEN {i} THEN date_trunc('{left}', ts)" for i, (_, left) in enumerate(TIME_SHAPES) if left)
_LOST = [i for i, (_, left) in enumerate(TIME_SHAPES) if not left]
ORACLE_SQL["parse_ts_shapes"] = f"""
SELECT event_id, strftime(CASE {_SHAPE} {_LEFT} END, '%Y-%m-%d %H:%M:%S') AS ts FROM events"""
ORACLE_SQL["unreadable_ts"] = f"""WITH texts AS (
  SELECT CASE {_SHAPE} WHEN {_LOST[0]} THEN 'never on ' || dayname(ts) ELSE 'week ' || weekofyear(ts) || ' of ' || year(ts) END AS text
  FROM events WHERE {_SHAPE} IN ({_LOST[0]}, {_LOST[1]}))
SELECT regexp_replace(regexp_replace(text, '[0-9]', '9', 'g'), '[A-Za-z]+', 'a', 'g') AS shape, count(*) AS rows, min(text) AS example
FROM texts GROUP BY ALL"""
ORACLE_SQL["impute_ts"] = _PARSED + """
SELECT event_id, strftime(coalesce(ts, TIMESTAMP '2025-01-01'), '%Y-%m-%d %H:%M:%S') AS ts,
       ts IS NULL AS timestamp_imputed FROM parsed"""
ORACLE_SQL["since_filter"] = """
SELECT event_id, user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'"""
ORACLE_SQL["volume_gate"] = "SELECT count(*) AS rows FROM documents HAVING count(*) >= 10"

# --- text ------------------------------------------------------------------------------------------

ORACLE_SQL["filter_deleted"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, length(text) AS chars FROM documents
WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND coalesce(text, '') NOT IN ('[deleted]', '[removed]', '')"""
ORACLE_SQL["clean_text"] = f"WITH {CLEANED} SELECT id, whole_text AS clean_text FROM cleaned"
ORACLE_SQL["clean_html"] = f"SELECT page_id, {clean(chr(40) + 'url || chr(32) || html' + chr(41))} AS clean_text FROM pages"
ORACLE_SQL["filter_short"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, length(text) AS text_length FROM documents WHERE length(text) >= 15"""
ORACLE_SQL["detect_language"] = f"WITH {LANGUAGES} SELECT id, language FROM languages"
ORACLE_SQL["filter_language"] = f"WITH {LANGUAGES} SELECT id, language FROM languages WHERE language = 'en'"
ORACLE_SQL["filter_relevance"] = f"""WITH {CLEANED}
SELECT id, true AS is_relevant FROM cleaned WHERE {any_term('whole_text', S.relevance_terms)}"""
ORACLE_SQL["truncate_text"] = f"WITH {CLEANED} SELECT id, {truncated('whole_text')} AS clean_text FROM cleaned"
ORACLE_SQL["preprocess_messages"] = f"""WITH {PREPROCESSED}
SELECT id, length(original_text) AS text_length, language, true AS is_relevant, clean_text FROM preprocessed"""
ORACLE_SQL["stage_counts"] = f"""WITH {LANGUAGES},
dropped AS (SELECT CASE WHEN original_text IN ('[deleted]', '[removed]', '') THEN 1
    WHEN length(original_text) < 15 THEN 2 WHEN language <> 'en' THEN 3
    WHEN NOT {any_term('whole_text', S.relevance_terms)} THEN 4 ELSE 0 END AS stage FROM languages)
SELECT count(*) AS rows_in, count(*) FILTER (stage = 1) AS dropped_deleted,
       count(*) FILTER (stage = 2) AS dropped_short, count(*) FILTER (stage = 3) AS dropped_language,
       count(*) FILTER (stage = 4) AS dropped_irrelevant, count(*) FILTER (stage = 0) AS rows_kept FROM dropped"""
ORACLE_SQL["remove_stopwords"] = f"""WITH {CLEANED}
SELECT id, array_to_string(list_filter(string_split(whole_text, ' '), lambda w: w <> ''
    AND NOT list_contains({array(S.stop_words + S.custom_stop_words)}, w)), ' ') AS kept FROM cleaned"""

# --- keywords --------------------------------------------------------------------------------------

_MATCH = ("the", "on", "on the", "of the", "the of", "With", "from", "to be")
ORACLE_SQL["keyword_match"] = f"""WITH {CLEANED},
m AS (SELECT id, {matched('whole_text', _MATCH)} AS matches FROM cleaned)
SELECT id, len(matches) > 0 AS found, array_to_string(matches, '|') AS matches FROM m"""
ORACLE_SQL["keyword_table"] = f"""WITH {CLEANED},
asked AS (SELECT regexp_extract_all({clean("text")}, '\\w+') AS w FROM benchmark),
terms AS (SELECT DISTINCT unnest(w) AS term FROM asked
          UNION SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM asked WHERE len(w) > 1),
runs AS (SELECT id, regexp_extract_all(whole_text, '\\w+|[^\\w]+') AS r FROM cleaned),
held AS (SELECT id, unnest(r) AS term FROM runs
         UNION SELECT id, unnest(list_transform(list_filter(range(1, len(r) - 1), lambda i: r[i + 1] = ' '), lambda i: r[i] || ' ' || r[i + 2])) FROM runs),
met AS (SELECT id, count(*) AS n, string_agg(term, '|' ORDER BY term) AS matches FROM held JOIN terms USING (term) GROUP BY id)
SELECT id, n IS NOT NULL AS found, coalesce(n, 0) AS n, md5(coalesce(matches, '')) AS matches FROM cleaned LEFT JOIN met USING (id)"""
for _name, _column in {
        "flag_region": "mentions_oregon", "flag_partner": "mentions_partner",
        "flag_faculty": "mentions_faculty", "flag_attrition": "mentions_attrition",
        "classify_category": "search_category", "keyword_matches": "keyword_matches"}.items():
    ORACLE_SQL[_name] = f"WITH {CLEAN_FLAGS} SELECT id, {_column} FROM flagged"
_ENDED = CLEANED + f""",
ended AS (SELECT * REPLACE (CASE WHEN doc_id % 5 = 0 THEN whole_text || ' ' ||
    list_extract({array(ALUMNI_PHRASES)}, (doc_id // 5) % {len(ALUMNI_PHRASES)} + 1) ELSE whole_text END AS whole_text) FROM cleaned)"""
ORACLE_SQL["lifecycle_stage"] = f"WITH {_ENDED}{flags('ended', 'whole_text')} SELECT id, is_recruitment, is_retention, is_alumni FROM flagged"
ORACLE_SQL["keyword_counts"] = f"""WITH {CLEAN_FLAGS}
SELECT count(*) FILTER (mentions_oregon) AS oregon_count,
       count(*) FILTER (mentions_partner) AS partner_count FROM flagged"""

# --- sentiment -------------------------------------------------------------------------------------

ORACLE_SQL["sentiment_score"] = f"""WITH {CLEANED}{scores('cleaned', 'whole_text')}
SELECT id, {rounded('neg')} AS neg, {rounded('neu')} AS neu, {rounded('pos')} AS pos FROM shares"""
ORACLE_SQL["sentiment_label"] = f"WITH {SCORED} SELECT id, sentiment_label FROM scored"
ORACLE_SQL["compound_score"] = f"WITH {SCORED} SELECT id, {rounded('sentiment_score')} AS sentiment_score FROM scored"
ORACLE_SQL["sentiment_uncertain"] = f"""WITH {SCORED}
SELECT id, {rounded('sentiment_confidence')} AS sentiment_confidence,
       sentiment_confidence < 0.7 AS sentiment_uncertain FROM scored"""
ORACLE_SQL["sentiment_blank"] = f"""WITH {CLEANED}{scores('cleaned', 'whole_text')},
blanked AS (SELECT *, doc_id % 3 = 0 OR whole_text = '' AS blank FROM scored)
SELECT id, CASE WHEN blank THEN 0.0 ELSE {rounded('sentiment_score')} END AS sentiment_score,
       CASE WHEN blank THEN 'Neutral' ELSE sentiment_label END AS sentiment_label,
       CASE WHEN blank THEN 0.0 ELSE {rounded('sentiment_confidence')} END AS sentiment_confidence,
       blank OR sentiment_confidence < 0.7 AS sentiment_uncertain FROM blanked"""

# --- personal data ---------------------------------------------------------------------------------

ORACLE_SQL["pii_spans"] = f"""WITH {SPANS}
SELECT id, entity_type, start_ AS "start", start_ + size_ AS "end", confidence FROM spans"""
ORACLE_SQL["pii_whitelist"] = f"""WITH {SPANS} SELECT id, entity_type, start_ AS "start", end_ AS "end" FROM kept"""
ORACLE_SQL["pii_whitelisted_words"] = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       regexp_matches(lower(line), 'er|the resident|dr\. house') AS substring,
       regexp_matches(lower(line), '(^|[^\p{L}\p{M}\p{N}_])(er|the resident|dr\. house)($|[^\p{L}\p{M}\p{N}_])') AS word
FROM lines"""
ORACLE_SQL["redact_text"] = f"""WITH {REDACTED}
SELECT m.id, coalesce(r.redacted_text, m.original_text) AS redacted_text
FROM messages m LEFT JOIN rebuilt r ON m.doc_id = r.doc_id"""
ORACLE_SQL["pii_summary"] = f"""WITH {SUMMARY}
SELECT id, pii_count > 0 AS pii_detected, pii_types, pii_count FROM summaries"""
ORACLE_SQL["pii_audit"] = f"""WITH {SPANS}
SELECT id AS post_id, entity_type, start_ AS start_position, end_ AS end_position, confidence,
       '2025-01-01 00:00:00' AS detected_at FROM kept"""
ORACLE_SQL["pii_posts"] = f"WITH {SPANS} SELECT count(DISTINCT id) AS pii_redacted_count FROM kept"

# --- topics ----------------------------------------------------------------------------------------

_TOPIC = "CAST(regexp_extract(subreddit, '[0-9]+') AS INTEGER) % 5 - 1"


def tokens(column: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({column}), '\\w\\w+'), "
            f"lambda t: NOT list_contains({array(S.stop_words)}, t))")


TOPIC_ASSIGNED = SCORED + f""",
assigned AS (SELECT *, {_TOPIC} AS topic_id FROM scored)"""
TOPIC_LISTS = f"""
words AS (SELECT topic_id, unnest({tokens('clean_text')}) AS term FROM assigned),
tf AS (SELECT topic_id, term, count(*) AS tf FROM words GROUP BY ALL),
spread AS (SELECT *, sum(tf) OVER (PARTITION BY term) AS f, count(*) OVER (PARTITION BY term) AS topics FROM tf),
common AS (SELECT * FROM spread WHERE topics >= 2),
totals AS (SELECT topic_id, sum(tf) AS words FROM common GROUP BY topic_id),
weights AS (SELECT topic_id, term, tf / words * ln(1 + (SELECT floor(avg(words)) FROM totals) / f) AS weight
            FROM common JOIN totals USING (topic_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rank FROM weights),
best AS (SELECT * FROM ranked WHERE rank <= 10),
lists AS (SELECT topic_id, string_agg(term, ', ' ORDER BY rank) AS keywords,
    string_agg(upper(substring(term, 1, 1)) || substring(term, 2), ', ' ORDER BY rank) FILTER (rank <= 4) AS top_words
  FROM best GROUP BY topic_id),
summary AS (SELECT a.topic_id, count(id) AS post_count, avg(sentiment_score) AS avg_sentiment,
    any_value(l.top_words) AS top_words
  FROM assigned a LEFT JOIN lists l ON a.topic_id = l.topic_id GROUP BY a.topic_id)"""
TOPIC_WORDS = TOPIC_ASSIGNED + "," + TOPIC_LISTS
NEAREST = """
normed AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings),
units AS (SELECT vec_id, label, list_transform(e, lambda x: x / norm) AS v FROM normed),
far AS (SELECT u.vec_id, u.label, c.vec_id AS cluster, round(sqrt(greatest(0, 2 - 2 * list_inner_product(u.v, c.v))), 4) AS d
        FROM units u, units c WHERE c.vec_id < 5),
near AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1),
sized AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS size, count(*) OVER () AS total,
          row_number() OVER (PARTITION BY cluster ORDER BY d) AS place FROM near),
reached AS (SELECT cluster, size, min(d) AS reach FROM sized WHERE size >= greatest(10, total // 100) AND place >= ceil(size * 0.95::DOUBLE)
            GROUP BY cluster, size),
numbers AS (SELECT cluster, reach, row_number() OVER (ORDER BY size DESC, cluster) - 1 AS topic FROM reached),
placed AS (SELECT vec_id, label, CAST(CASE WHEN d <= reach THEN topic ELSE -1 END AS INTEGER) AS dominant_topic
           FROM near LEFT JOIN numbers USING (cluster))"""
ORACLE_SQL["topic_from_centres"] = f"WITH {NEAREST} SELECT * FROM placed"
ORACLE_SQL["topic_chain"] = f"""WITH {SCORED}, {NEAREST},
assigned AS (SELECT s.*, dominant_topic AS topic_id FROM scored s JOIN placed p ON s.id = p.vec_id::VARCHAR), {TOPIC_LISTS}
SELECT CAST(topic_id AS BIGINT) AS topic_id, CASE WHEN topic_id = -1 THEN 'Miscellaneous / Outliers' ELSE top_words END AS topic_name,
       top_words, post_count, {rounded('avg_sentiment')} AS avg_sentiment FROM summary"""
ORACLE_SQL["sentiment_fitted"] = f"""WITH {PREPROCESSED},
words AS (SELECT id, unnest({tokens('clean_text')}) AS term FROM preprocessed),
tf AS (SELECT id, term, count(*) AS tf FROM words GROUP BY ALL),
top AS (SELECT term, sum(tf) AS total, count(*) AS docs FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 300),
model AS (SELECT term, 1 + 1 / docs AS idf, CAST(length(term) % 3 - 1 AS DOUBLE) AS neg, ascii(term) % 5 / 4.0::DOUBLE AS neu,
          length(term) % 4 - 1.5::DOUBLE AS pos FROM top),
valued AS (SELECT id, tf * idf AS v, neg, neu, pos FROM tf JOIN model USING (term)),
dots AS (SELECT id, 0.1::DOUBLE + coalesce(sum(v * neg) / sqrt(sum(v * v)), 0) AS a, -0.2::DOUBLE + coalesce(sum(v * neu) / sqrt(sum(v * v)), 0) AS b,
         coalesce(sum(v * pos) / sqrt(sum(v * v)), 0) AS c FROM preprocessed LEFT JOIN valued USING (id) GROUP BY id),
shares AS (SELECT id, exp(a) / (exp(a) + exp(b) + exp(c)) AS neg, exp(b) / (exp(a) + exp(b) + exp(c)) AS neu,
           exp(c) / (exp(a) + exp(b) + exp(c)) AS pos FROM dots),
labelled AS (SELECT s.id, CASE WHEN clean_text = '' THEN 'Neutral' WHEN neg >= neu AND neg >= pos THEN 'Negative'
             WHEN neu >= pos THEN 'Neutral' ELSE 'Positive' END AS sentiment_label,
             CASE WHEN clean_text = '' THEN 0 ELSE greatest(neg, neu, pos) END AS confidence FROM shares s JOIN preprocessed USING (id))
SELECT id, {rounded("CASE sentiment_label WHEN 'Positive' THEN confidence WHEN 'Negative' THEN -confidence ELSE 0 END")} AS sentiment_score,
       sentiment_label, {rounded('confidence')} AS sentiment_confidence FROM labelled"""
ORACLE_SQL["topic_count"] = f"""WITH {PREPROCESSED}
SELECT count(DISTINCT t) FILTER (t <> -1) AS topics FROM (SELECT {_TOPIC} AS t FROM preprocessed)"""
ORACLE_SQL["topic_top_words"] = f"""WITH {TOPIC_WORDS}
SELECT CAST(topic_id AS BIGINT) AS topic_id, term, {rounded('weight')} AS weight, rank FROM best"""
ORACLE_SQL["topic_keywords"] = f"""WITH {TOPIC_WORDS}
SELECT id, CASE WHEN a.topic_id = -1 THEN 'outlier' ELSE coalesce(keywords, '') END AS topic_keywords
FROM assigned a LEFT JOIN lists l ON a.topic_id = l.topic_id"""
ORACLE_SQL["topic_names"] = f"WITH {TOPIC_WORDS} SELECT CAST(topic_id AS BIGINT) AS topic_id, top_words FROM lists"
ORACLE_SQL["topic_summary"] = f"""WITH {TOPIC_WORDS}
SELECT CAST(topic_id AS BIGINT) AS topic_id,
       CASE WHEN topic_id = -1 THEN 'Miscellaneous / Outliers' ELSE top_words END AS topic_name,
       top_words, post_count, {rounded('avg_sentiment')} AS avg_sentiment FROM summary"""

# --- calendar, aggregates, windows -----------------------------------------------------------------

ORACLE_SQL["calendar_cols"] = f"""WITH {MESSAGES}{CALENDAR.format(source='messages')}
SELECT id, strftime(local_time, '%Y-%m-%d %H:%M:%S') AS local_time, year_month, year(local_time) AS year,
       month(local_time) AS month, dayname(local_time) AS day_of_week FROM dated"""
_STATS = ", ".join(f"{rounded(f'{s}_sentiment')} AS {s}_sentiment" for s in ("avg", "median", "std"))
ORACLE_SQL["monthly_sentiment"] = f"""WITH {MONTHS}
SELECT year_month, CAST(substring(year_month, 1, 4) AS BIGINT) AS year,
       CAST(substring(year_month, 6, 2) AS BIGINT) AS month, total_posts, {_STATS}, oregon_mentions,
       partner_mentions FROM months"""
ORACLE_SQL["monthly_label_counts"] = f"""WITH {MONTHS}
SELECT year_month, positive_count, negative_count, neutral_count FROM months"""
ORACLE_SQL["monthly_pct_negative"] = f"""WITH {MONTHS}
SELECT year_month, {rounded('negative_count / total_posts * 100')} AS pct_negative FROM months"""

_ORDERS = """
order_scores AS (SELECT *, o_totalprice % 2000 / 1000 - 1 AS score FROM orders),
order_messages AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m') AS year_month, score AS sentiment_score,
         CASE WHEN score < 0 THEN 'Negative' ELSE 'Positive' END AS sentiment_label,
         o_orderstatus = 'P' AS mentions_oregon, starts_with(o_orderpriority, '1') AS mentions_partner
  FROM order_scores)""" + monthly("order_messages")
ORACLE_SQL["monthly_orders"] = f"""WITH {_ORDERS}
SELECT year_month, total_posts, {_STATS}, oregon_mentions, partner_mentions, positive_count, negative_count FROM months"""
_NUDGED = ", ".join(f"{rounded(f'{s}_sentiment + 1e-9')} AS {s}_sentiment" for s in ("avg", "median", "std", "rolling_3mo"))
ORACLE_SQL["monthly_state"] = f"""WITH {_ORDERS},
rolled AS (SELECT *, CASE WHEN count(avg_sentiment) OVER w = 3 THEN avg(avg_sentiment) OVER w END AS rolling_3mo_sentiment
           FROM months WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT year_month, total_posts, {_NUDGED}, oregon_mentions, partner_mentions, positive_count, negative_count FROM rolled"""
for _k in (3, 6, 12):
    ORACLE_SQL[f"rolling_{_k}mo"] = f"""WITH {_ORDERS}
SELECT year_month, {rolling(_k)} AS rolling_{_k}mo_sentiment FROM months"""
ORACLE_SQL["complete_months"] = f"""WITH {_ORDERS},
busy AS (SELECT * FROM months WHERE total_posts > (SELECT avg(total_posts) FROM months)),
days AS (SELECT unnest(generate_series(CAST(min(year_month) || '-01' AS TIMESTAMP),
                                       CAST(max(year_month) || '-01' AS TIMESTAMP), INTERVAL 1 MONTH)) AS day FROM busy),
filled AS (SELECT strftime(day, '%Y-%m') AS year_month, coalesce(total_posts, 0) AS total_posts, avg_sentiment
           FROM days LEFT JOIN busy ON strftime(day, '%Y-%m') = busy.year_month)
SELECT year_month, total_posts, {rolling(3, 'filled')} AS rolling_3mo_sentiment FROM filled"""

ORACLE_SQL["negative_keywords"] = f"""WITH {SCORED},
negative AS (SELECT id, clean_text, {tokens('clean_text')} AS tokens FROM scored WHERE sentiment_label = 'Negative'),
occurrences AS (SELECT id, unnest(tokens) AS term FROM negative),
tf AS (SELECT id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
terms AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
vocabulary AS (SELECT term, ln((1 + (SELECT count(*) FROM negative)) / (1 + df)) + 1 AS idf
               FROM terms ORDER BY total DESC, term LIMIT 50),
weights AS (SELECT id, term, tf * idf AS w FROM tf JOIN vocabulary USING (term)),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY id),
summed AS (SELECT term, sum(w / norm) AS score FROM weights JOIN norms USING (id) GROUP BY term)
SELECT term AS keyword, {rounded('score', 4)} AS tfidf_score,
       (SELECT count(*) FROM negative n WHERE contains(n.clean_text, s.term)) AS frequency,
       'negative_tfidf' AS category
FROM summed s WHERE (SELECT count(*) FROM negative) >= 5"""
ORACLE_SQL["vocabulary"] = f"""WITH {CLEANED},
occurrences AS (SELECT id, unnest({tokens('whole_text')}) AS term FROM cleaned)
SELECT term, count(*) AS total, count(DISTINCT id) AS docs FROM occurrences GROUP BY term
ORDER BY total DESC, term LIMIT 50"""


def percent(condition: str) -> str:
    return f"coalesce(CAST(printf('%.1f', count(*) FILTER ({condition}) / count(*) * 100) AS DOUBLE), 0.0)"


_WITH_PII = DATED + SUMMARY.removeprefix(MESSAGES)
_PII_COUNT = "count(*) FILTER (pii_count > 0)"
ORACLE_SQL["run_stats"] = f"""WITH {_WITH_PII}
SELECT {percent("sentiment_label = 'Positive'")} AS positive_pct, {percent("sentiment_label = 'Negative'")} AS negative_pct,
       {percent("sentiment_label = 'Neutral'")} AS neutral_pct, {percent('mentions_oregon')} AS oregon_mention_pct,
       {percent('mentions_partner')} AS partner_mention_pct, {_PII_COUNT} AS pii_redacted_count,
       count(*) AS records_final FROM dated JOIN summaries USING (id)"""
ORACLE_SQL["run_metadata"] = f"""WITH {_WITH_PII}
SELECT '2024-07-01T03:04:05.000000+00:00' AS run_timestamp,
       '2024-06-30T20:04:05.000000-07:00' AS run_timestamp_pacific, count(*) AS records_final, 'v1.0' AS version,
       {percent("sentiment_label = 'Positive'")} AS positive_pct, {_PII_COUNT} AS pii_redacted_count
FROM dated JOIN summaries USING (id)"""

# --- top-k and deep analysis -----------------------------------------------------------------------

TOP = SCORED + """,
top AS (SELECT *, row_number() OVER (ORDER BY sentiment_score, id) AS rank FROM scored
        WHERE sentiment_score < -0.3 QUALIFY rank <= 100)"""
ORACLE_SQL["top_negative"] = f"WITH {TOP} SELECT id, {rounded('sentiment_score')} AS sentiment_score FROM top"
ORACLE_SQL["batch_numbers"] = f"WITH {TOP} SELECT id, rank, (rank - 1) // 10 AS batch FROM top"
ORACLE_SQL["prompt_batches"] = f"""WITH {TOP}
SELECT (rank - 1) // 10 AS batch, count(*) AS posts,
       'HEAD' || string_agg(chr(10) || '---' || chr(10) || 'POST_ID: ' || id || chr(10) || 'TEXT: '
         || substring(clean_text, 1, 1500) || chr(10), '' ORDER BY rank) || 'TAIL' AS prompt FROM top GROUP BY ALL"""
ORACLE_SQL["model_calls"] = f"""WITH {TOP}
SELECT id AS post_id, 'other' AS primary_complaint, 1 + CAST(id AS BIGINT) % 5 AS severity FROM top"""

_INSIGHTS = f"""
insights AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS post_id, list_extract({array(COMPLAINTS)}, length(text) % 8 + 1) AS primary_complaint,
         source AS quotable_line, length(text) % 2 = 0 AS mentions_leaving, lang = 'en' AS mentions_rural,
         CAST(NULL AS BOOLEAN) AS mentions_partner, CAST(length(text) % 5 + 1 AS BIGINT) AS severity
  FROM documents WHERE lang IN ('en', 'de'))"""
ORACLE_SQL["parse_insights"] = f"""WITH {_INSIGHTS}
SELECT post_id, primary_complaint, quotable_line, mentions_leaving, mentions_rural, mentions_partner, severity
FROM insights"""
ORACLE_SQL["complaint_counts"] = f"WITH {_INSIGHTS} SELECT primary_complaint, count(*) AS n FROM insights GROUP BY ALL"
ORACLE_SQL["insight_summary"] = f"""WITH {_INSIGHTS}
SELECT count(*) AS total_analyzed, count(*) FILTER (mentions_leaving) AS posts_mentioning_leaving,
       count(*) FILTER (mentions_rural) AS posts_mentioning_rural,
       count(*) FILTER (mentions_partner) AS posts_mentioning_partner, {rounded('avg(severity)')} AS avg_severity,
       (SELECT string_agg(quotable_line, '|' ORDER BY doc_id) FROM
          (SELECT * FROM insights ORDER BY doc_id LIMIT 10)) AS top_quotes FROM insights"""

# --- relations -------------------------------------------------------------------------------------

ORACLE_SQL["join_audit"] = f"""WITH {SPANS}
SELECT m.id, k.entity_type, k.start_ AS start_position FROM messages m LEFT JOIN kept k ON m.id = k.id"""
ORACLE_SQL["join_audit_without"] = f"WITH {SPANS} SELECT id FROM messages WHERE id NOT IN (SELECT id FROM kept)"
ORACLE_SQL["join_monthly"] = f"""WITH {MONTHS}
SELECT id, year_month, {rounded('sentiment_score - avg_sentiment')} AS difference FROM dated JOIN months USING (year_month)"""
ORACLE_SQL["join_topic"] = f"""WITH {TOPIC_WORDS}
SELECT a.id, CASE WHEN s.topic_id = -1 THEN 'Miscellaneous / Outliers' ELSE s.top_words END AS topic_name, s.post_count
FROM assigned a JOIN summary s ON a.topic_id = s.topic_id"""
ORACLE_SQL["keyword_containment"] = f"""WITH {CLEANED},
occurrences AS (SELECT unnest(regexp_extract_all({clean('text')}, '\\w\\w+')) AS term FROM benchmark),
top AS (SELECT term FROM occurrences GROUP BY term ORDER BY count(*) DESC, term LIMIT 50)
SELECT id, term FROM cleaned JOIN top ON contains(whole_text, term)"""

# --- incremental and streaming ---------------------------------------------------------------------

ORACLE_SQL["incremental"] = """
SELECT event_id, event_type FROM events
WHERE ts > (SELECT TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(avg(CAST(floor(epoch(ts)) AS BIGINT))) AS BIGINT)) FROM events)"""
ORACLE_SQL["landing_ledger"] = f"""WITH {THREADS}
SELECT id, parent_id, trim(text, {SPACE_TEXT}) AS text, CAST(score AS BIGINT) AS score, type FROM every
WHERE doc_id % 4 = 3 OR doc_id % 4 = 1 AND doc_id % 3 = 0"""
ORACLE_SQL["stream_monthly_counts"] = f"""
SELECT strftime(ts, '%Y-%m-%d') AS year_month, count(*) AS total_posts,
       count(*) FILTER (event_type = 'purchase') AS positive_count,
       count(*) FILTER (event_type = 'error') AS negative_count,
       count(*) FILTER (event_type NOT IN ('purchase', 'error')) AS neutral_count,
       {rounded('avg(value)')} AS avg_sentiment FROM events GROUP BY ALL"""
ORACLE_SQL["stream_dedupe"] = "SELECT DISTINCT user_id AS id FROM events"
ORACLE_SQL["stream_merge"] = f"""WITH {MESSAGES}{CALENDAR.format(source='messages')}
SELECT id, year_month, CASE WHEN length(original_text) > 1000 THEN 2 * length(original_text)
       ELSE length(original_text) END AS chars,
       CAST(CASE WHEN length(original_text) > 1000 THEN 2 ELSE 1 END AS BIGINT) AS version FROM dated"""
ORACLE_SQL["monthly_trend"] = f"""WITH {MONTHS}
SELECT year_month, total_posts, {rounded('avg_sentiment')} AS avg_sentiment,
       {rounded('negative_count / total_posts * 100')} AS pct_negative,
       {rolling(3)} AS rolling_3mo_sentiment FROM months"""

# --- writers and batched inference -------------------------------------------------------------------

ORACLE_SQL["sink_main"] = f"""WITH {DATED}
SELECT id, year_month, sentiment_label, sentiment_label AS csv_label, {rounded('sentiment_score')} AS sentiment_score FROM dated"""
for _sink, _same in {"sink_monthly": "monthly_sentiment", "sink_negative_keywords": "negative_keywords", "sink_audit": "pii_audit",
                     "sink_topics": "topic_summary", "sink_insights": "parse_insights"}.items():
    ORACLE_SQL[_sink] = ORACLE_SQL[_same]
ORACLE_SQL["sink_history"] = """
SELECT 'run ' || lang AS timestamp, count(*) >= 100 AS success, count(*) AS records_processed,
       CASE WHEN count(*) < 100 THEN 'too few' END AS error FROM documents GROUP BY lang"""
_LETTERS = ", ".join(f"length(whole_text) - length(replace(whole_text, '{c}', '')) AS {c}" for c in "eao")
ORACLE_SQL["sentiment_batched"] = f"""WITH {CLEANED},
counted AS (SELECT id, whole_text, {_LETTERS} FROM cleaned),
shares AS (SELECT id, whole_text = '' OR length(whole_text) > 15000 AS none, e / (e + a + 1 + o) AS neg, (a + 1) / (e + a + 1 + o) AS neu,
                  o / (e + a + 1 + o) AS pos FROM counted),
labelled AS (SELECT *, CASE WHEN none THEN 'Neutral' WHEN neg >= neu AND neg >= pos THEN 'Negative' WHEN neu >= pos THEN 'Neutral'
                            ELSE 'Positive' END AS sentiment_label FROM shares)
SELECT id, {rounded("CASE sentiment_label WHEN 'Positive' THEN pos WHEN 'Negative' THEN -neg ELSE 0 END")} AS sentiment_score, sentiment_label
FROM labelled"""
