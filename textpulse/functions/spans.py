"""Entity spans of a text: detection by pattern, filtering, merging, redaction.

A span is ``struct<entity_type, start, end, confidence>`` with a 0-based start and
an exclusive end, counted in characters. All of it stays in JVM expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from textpulse.config import Settings
from textpulse.functions.plan import literals
from textpulse.functions.terms import escape
from textpulse.schemas import SPANS

# ASCII word boundaries: ``\b`` differs between regex engines on accented letters.
START = "(?<![A-Za-z0-9_])"
END = "(?![A-Za-z0-9_])"

_MONTHS = ("(?:January|February|March|April|May|June|July|August|September|October|November"
           "|December)")


@dataclass(frozen=True)
class Pattern:
    """A detector: every match of ``regex`` is an entity of this type.

    ``sign`` is a cheaper regex that every text with a match also matches; texts without
    it are not searched further.
    """

    entity_type: str
    regex: str
    confidence: float
    sign: str | None = None


def _names(names) -> str:
    """Alternation grouped by first letter, so that a position tries few names. Longer names
    come first: "New York City" wins over "New York"."""
    groups: dict[str, list[str]] = {}
    for name in sorted(names, key=lambda n: (n[0], -len(n), n)):
        groups.setdefault(name[0], []).append(name[1:])
    return "|".join(f"{escape(first)}(?:{'|'.join(map(escape, rest))})" for first, rest in groups.items())


def default_patterns(settings: Settings) -> tuple[Pattern, ...]:
    surname = "(?: [A-Z][a-z]+)"
    person = rf"(?:Dr|Mr|Mrs|Ms|Prof)\.? [A-Z][a-z]+{surname}?"
    if settings.given_names:
        person += rf"|(?:{_names(settings.given_names)}){surname}?"
    patterns = [
        Pattern("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 1.0, "@"),
        Pattern("PHONE_NUMBER",
                r"(?:\+?[0-9]{1,2}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
                rf"|{START}[0-9]{{3}}-[0-9]{{4}}{END}", 0.75, "[0-9][ .-][0-9]{4}"),
        Pattern("DATE_TIME",
                rf"{START}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}"
                rf"|{_MONTHS} [0-9]{{1,2}}(?:st|nd|rd|th)?(?:,? [0-9]{{4}})?|{_MONTHS} [0-9]{{4}}"
                rf"|yesterday|tomorrow){END}", 0.6, "[a-z] [0-9]|[0-9][/-][0-9]|yesterday|tomorrow"),
        Pattern("PERSON", rf"(?=[A-Z]){START}(?:{person}){END}", 0.85),
    ]
    if settings.place_names:
        patterns.append(Pattern(
            "LOCATION", rf"(?=[A-Z]){START}(?:{_names(settings.place_names)}){END}", 0.85))
    return tuple(p for p in patterns if p.entity_type in settings.pii_entities)


def pattern_spans(text: Column, pattern: Pattern) -> Column:
    """Spans of one pattern.

    Splitting by the pattern gives the text between matches; summing the lengths of
    both sides gives the offsets. Rows without a match stop at ``rlike``.
    """
    gaps = F.split(text, pattern.regex, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(
        F.length(gap).alias("gap"), F.length(hit).alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def advance(acc, size):
        begin = acc["at"] + size["gap"]
        end = begin + size["hit"]
        span = F.struct(F.lit(pattern.entity_type).alias("entity_type"), begin.alias("start"),
                        end.alias("end"), F.lit(pattern.confidence).alias("confidence"))
        return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    found = F.aggregate(lengths, start, advance, lambda acc: acc["spans"])
    present = text.rlike(pattern.regex)
    if pattern.sign:
        present = text.rlike(pattern.sign) & present
    return F.when(present, found).otherwise(F.array().cast(SPANS))


def detect_spans(text: Column, patterns) -> Column:
    """Spans of all patterns, ordered by position. NULL or empty text gives none."""
    if not patterns:
        return F.array().cast(SPANS)
    text = F.coalesce(text, F.lit(""))
    return in_order(F.concat(*[pattern_spans(text, p) for p in patterns]))


def in_order(found: Column) -> Column:
    """Spans by position, the longer of two that begin together first."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("longest"),
        s["entity_type"].alias("entity_type"), s["confidence"].alias("confidence"))))
    return F.transform(ordered, lambda s: F.struct(
        s["entity_type"].alias("entity_type"), s["start"].alias("start"),
        (-s["longest"]).alias("end"), s["confidence"].alias("confidence")))


def is_whitelisted(value: Column, whitelist, match: str = "substring") -> Column:
    """True if an item occurs in the lower-cased value: anywhere, or as whole words."""
    items = [w.lower() for w in whitelist if w]
    if not items:
        return F.lit(False)
    lowered = F.lower(value)
    if match == "word":
        return lowered.rlike(rf"(?U)\b(?:{'|'.join(map(escape, items))})\b")
    return F.exists(literals(items), lambda w: F.contains(lowered, w))


def drop_whitelisted(text: Column, spans: Column, whitelist, match: str = "substring") -> Column:
    return F.filter(spans, lambda s: ~is_whitelisted(
        F.substr(text, s["start"] + 1, s["end"] - s["start"]), whitelist, match))


def merge_spans(spans: Column) -> Column:
    """Position-ordered, non-overlapping ``struct<start, end>``; touching spans stay apart."""
    bounds = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def extend(acc, s):
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"),
                          F.greatest(last["end"], s["end"]).alias("end"))
        return (F.when(F.size(acc) == 0, F.array(s))
                .when(s["start"] < last["end"],
                      F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), joined))
                .otherwise(F.array_append(acc, s)))

    return F.aggregate(bounds, empty, extend)


def redact(text: Column, spans: Column, replacement: str = "[REDACTED]") -> Column:
    """Text with every span replaced; overlapping spans give one replacement."""
    text = F.coalesce(text, F.lit(""))

    def rebuild(merged):
        begins = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
        ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text)))
        kept = F.zip_with(begins, ends, lambda b, e: F.substr(text, b + 1, e - b))
        return F.array_join(kept, replacement)

    # One-element transform: binds the merged spans to a name instead of repeating them.
    rebuilt = F.element_at(F.transform(F.array(merge_spans(spans)), rebuild), 1)
    return F.when(F.size(spans) > 0, rebuilt).otherwise(text)
