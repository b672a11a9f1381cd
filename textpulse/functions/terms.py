"""Whole-word term matching.

A term matches where it stands between word boundaries. For a term that is one
run of word characters this is the same as being an element of the text's word
array, so such terms need no regex: a list of them is one hash-based array
operation. Terms of several words run a literal regex, and only on rows where
one of their words occurs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from textpulse.functions.plan import keep_listed, literals, sql_string

_RUN = re.compile(r"\w+")


def escape(term: str) -> str:
    """Regex that matches ``term`` literally."""
    return re.sub(r"([^\w\s])", r"\\\1", term)


def _boundary(pattern: str) -> str:
    return rf"(?U)\b{pattern}\b"


def _single(term: str) -> bool:
    return _RUN.fullmatch(term) is not None


def _may_occur(tokens: Column, terms) -> Column:
    """False only where no term can match: each term must bring its longest word along."""
    anchors = []
    for term in terms:
        runs = _RUN.findall(term)
        if not runs:
            return F.lit(True)
        anchors.append(max(runs, key=len))
    return F.arrays_overlap(tokens, literals(sorted(set(anchors))))


def relevant_words(tokens: Column, terms) -> Column:
    """Distinct tokens that occur in any of the terms.

    For the functions below this short array is as good as the full one, so many lists can
    be matched after a single pass over the words.
    """
    vocabulary = sorted({run for t in terms for run in _RUN.findall(t)})
    return F.array_distinct(keep_listed(tokens, vocabulary))


def has_term(text: Column, tokens: Column, terms) -> Column:
    """True if any term occurs. ``tokens`` is ``words(text)``."""
    single = [t for t in terms if _single(t)]
    longer = [t for t in terms if t and not _single(t)]
    found = F.arrays_overlap(tokens, literals(single)) if single else F.lit(False)
    if longer:
        pattern = _boundary("(?:" + "|".join(map(escape, longer)) + ")")
        found = found | (_may_occur(tokens, longer) & text.rlike(pattern))
    return F.coalesce(found, F.lit(False))


def matched_terms(text: Column, tokens: Column, terms) -> Column:
    """All distinct terms that occur, in list order, overlapping ones included."""
    terms = list(dict.fromkeys(t for t in terms if t))
    longer = [t for t in terms if not _single(t)]
    hits = tokens
    if longer:
        # A substring test comes first: patterns are compiled only for terms that pass it.
        pairs = ", ".join(
            f"struct({sql_string(t)} AS term, {sql_string(_boundary(escape(t)))} AS pattern)" for t in longer)
        found = F.transform(
            F.filter(F.expr(f"array({pairs})"), lambda p: (
                F.contains(text, p["term"]) & F.rlike(text, p["pattern"]))), lambda p: p["term"])
        hits = F.when(_may_occur(tokens, longer), F.concat(tokens, found)).otherwise(tokens)
    return F.array_intersect(literals(terms), hits)


def normalize_terms(terms) -> tuple[str, ...]:
    """Terms in the alphabet of cleaned text, so that capitals and hyphens can match."""
    cleaned = (re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s.,!?']", "", t.lower())).strip()
               for t in terms)
    return tuple(dict.fromkeys(t for t in cleaned if t))
