"""Quality rules as a short-circuit cascade, ordered by what a sample says of cost and selectivity."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from textpulse.llm.common import map_batches, raw, table

SAMPLE = 1_000  # rows, about, on which rules are timed; the verdict does not depend on it
BLANKS = bytes([*range(9, 14), 32])
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
LETTERED = re.compile(rb"[A-Za-z\x80-\xFF]")
CAPITALS = re.compile(rb"[A-Z][A-Z]+")


class Text:
    """Statistics of one text, each computed when it is first asked for. A null text is empty."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points: bytes that are neither blank nor a continuation."""
        return len(self.text.translate(None, BLANKS + bytes(range(128, 192))))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_digits(self) -> int:
        return len(self.text) - len(self.text.translate(None, DIGITS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three that is found again."""
        windows = list(zip(self.words, self.words[1:], self.words[2:]))
        seen = Counter(windows)
        if len(seen) == len(windows):
            return 0
        total, reach = 0, 0
        for at, window in enumerate(windows):
            if seen[window] > 1:
                total += at + 3 - max(at, reach)
                reach = at + 3
        return total

    @cached_property
    def n_lettered(self) -> int:
        """Words with an ASCII letter or a character beyond ASCII."""
        return sum(map(bool, map(LETTERED.search, self.words)))

    @cached_property
    def n_capitals(self) -> int:
        """Words of two or more capitals A-Z alone."""
        return sum(map(bool, map(CAPITALS.fullmatch, self.words)))


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


#: The rules that the contract fixes, and in integers, so that no rounding decides.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("without_letters", lambda t: 10 * t.n_lettered < 7 * t.n_words),
    Rule("one_word", lambda t: 10 * max(t.counts.values(), default=0) > 3 * t.n_words),
    Rule("digits", lambda t: 5 * t.n_digits > t.word_chars),
    Rule("capitals", lambda t: 2 * t.n_capitals > t.n_words),
)


def profile(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """What each rule says of about ``sample`` rows and what it costs: [row, rule] verdicts and nanoseconds.

    Rows are timed where they are; only verdicts and times come to the driver. Words are split before
    the clock starts, since all rules share them.
    """
    total = docs.count()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdicts, nanos = [], []
        for text in batch.column(0).to_pylist():
            verdicts.append([])
            nanos.append([])
            for rule in rules:
                own = Text(text)
                own.words
                began = time.perf_counter_ns()
                verdicts[-1].append(rule.rejects(own))
                nanos[-1].append(time.perf_counter_ns() - began)
        return pa.record_batch([pa.array(verdicts, pa.list_(pa.bool_())), pa.array(nanos, pa.list_(pa.int64()))], ["verdicts", "nanos"])

    some = docs.select(raw("text")).sample(min(1.0, sample / max(1, total)), seed=1)
    rows = map_batches(some, run, "verdicts array<boolean>, nanos array<long>").collect()
    shape = (len(rows), len(rules))
    return (np.array([r.verdicts for r in rows], bool).reshape(shape), np.array([r.nanos for r in rows], np.int64).reshape(shape))


def cascade(verdicts: np.ndarray, nanos: np.ndarray) -> list[int]:
    """Order of the rules: next comes the one that rejects most of what is left per time it takes there.

    Rules that reject nothing in the sample come last, the cheapest first.
    """
    left, order = np.ones(len(verdicts), bool), []
    waiting = list(range(verdicts.shape[1]))
    while waiting:
        cost = {r: 1 + int(nanos[left, r].sum()) for r in waiting}
        best = max(waiting, key=lambda r: (int(verdicts[left, r].sum()) / cost[r], -int(nanos[:, r].sum()), -r))
        waiting.remove(best)
        order.append(best)
        left &= ~verdicts[:, best]
    return order


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[Rule]:
    return [rules[i] for i in cascade(*profile(docs, rules, sample))]


def failed(text: Text, rules: Sequence[Rule]) -> str | None:
    """The first rule that rejects the text; those behind it are not evaluated."""
    return next((rule.name for rule in rules if rule.rejects(text)), None)


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, measures: Sequence[str] = (), sample: int = SAMPLE) -> DataFrame:
    """(doc_id, the named ``measures``, failed_rule) per row of ``docs``.

    failed_rule is the first rule of the cascade that rejects the text, null if none does. Which of
    several rules is named depends on the times measured; whether there is one does not. Measures
    are statistics of ``Text`` that are wanted of every row, rejected or not; without them a
    rejected text costs no more than the rules up to the one that fails.

    A null or empty text has no word and fails for it; repeated rows and null ids keep a row each;
    an empty table gives an empty one. Texts are judged whole and stay where they are: no shuffle.
    """
    chosen, names = ordered(docs, rules, sample), list(measures)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        reasons, values = [], [[] for _ in names]
        for text in batch.column(1).to_pylist():
            own = Text(text)
            reasons.append(failed(own, chosen))
            for name, column in zip(names, values):
                column.append(getattr(own, name))
        return pa.record_batch([batch.column(0), *(pa.array(v, pa.int64()) for v in values), pa.array(reasons, pa.string())],
                               ["doc_id", *names, "failed_rule"])

    schema = ["doc_id long", *(f"{name} long" for name in names), "failed_rule string"]
    return map_batches(docs.select(F.col("doc_id").cast("long"), raw("text")), run, ", ".join(schema))


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    chosen = ordered(docs, rules, sample)

    @F.pandas_udf("boolean")
    def passes(texts):
        return texts.map(lambda text: failed(Text(text), chosen) is None).astype(bool)

    return docs.filter(passes(F.coalesce(raw("text"), F.lit(b""))))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"), measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", base).withColumn("kept", F.col("failed_rule").isNull()).drop("failed_rule")


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, unnest(range(len(w) - 2)) AS pos, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c FROM docs WHERE len(w) > 2),
again AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT pos + k) AS n_repeat_words FROM again, range(3) AS step(k) GROUP BY r),
most AS (SELECT r, max(n) AS most FROM (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM docs) GROUP BY ALL) GROUP BY r),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(most, 0) AS most,
    len(regexp_extract_all(text, '[0-9]')) AS n_digits,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_lettered,
    len(list_filter(w, lambda x: regexp_full_match(x, '[A-Z][A-Z]+'))) AS n_capitals
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r) LEFT JOIN most USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 10 * n_symbols <= n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND 2 * n_dup_lines <= n_lines AND 10 * n_lettered >= 7 * n_words AND 10 * most <= 3 * n_words
    AND 5 * n_digits <= word_chars AND 2 * n_capitals <= n_words AS kept
FROM based
"""
