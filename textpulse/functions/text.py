"""Text functions: stripping, cleaning, truncation, tokens, title case."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textpulse.functions.plan import drop_listed, keep_listed

# The characters a Unicode-aware strip removes; SQL ``trim`` alone knows only U+0020.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# (?U) makes \s Unicode-aware but leaves out U+001C to U+001F, hence the explicit range.
_SPACE = r"\s\x1c-\x1f"

# --- Fixed values: the cleaning patterns, in the order they are applied ------
URLS = rf"(?U)https?://[^{_SPACE}]+|www\.[^{_SPACE}]+"
MARKUP = r"&[a-z]+;|x200b|\[deleted\]|\[removed\]"
OTHER_CHARS = rf"(?U)[^a-zA-Z0-9{_SPACE}.,!?']+"
SPACES = rf"(?U)[{_SPACE}]+"
# --- End of fixed values -----------------------------------------------------


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def clean_text(text: Column) -> Column:
    """Lower-case text reduced to ``[a-z0-9 .,!?']``; each removal joins its neighbours."""
    kept = F.coalesce(text, F.lit(""))
    for pattern in (URLS, MARKUP, OTHER_CHARS):
        kept = F.regexp_replace(kept, pattern, "")
    return F.trim(F.regexp_replace(F.lower(kept), SPACES, " "))


def truncate_text(text: Column, max_length: int = 2000) -> Column:
    """Head and tail of a long text, cut at spaces and joined by ``" ... "``.

    The shares of head and tail are 1600 and 400 of every 2000 characters.
    """
    share = max_length / 2000
    head_length, tail_length = int(1600 * share), int(400 * share)
    head = F.substring(text, 1, head_length)
    tail = F.right(text, F.lit(tail_length)) if tail_length else text
    after_last_space = F.instr(F.reverse(head), " ")
    head = F.when(after_last_space > 0,
                  F.left(head, F.length(head) - after_last_space)).otherwise(head)
    tail = F.substr(tail, F.instr(tail, " ") + 1)
    return F.when(F.length(text) > max_length,
                  F.concat(head, F.lit(" ... "), tail)).otherwise(text)


def words(text: Column) -> Column:
    """Maximal runs of word characters, in order. NULL gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\w+"), F.lit(0))


def runs(text: Column) -> Column:
    """The whole text as maximal runs of word characters and of other characters, in turn."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\w+|\W+"), F.lit(0))


def sentiment_tokens(text: Column) -> Column:
    """Maximal runs of letters and apostrophes of a cleaned text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[a-z']+"), F.lit(0))


def count_in(tokens: Column, vocabulary) -> Column:
    """How many tokens belong to a list (repetitions count)."""
    return F.size(keep_listed(tokens, list(vocabulary)))


def remove_stop_words(text: Column, stop_words) -> Column:
    """Whitespace-separated words that are not in ``stop_words``, joined by one space."""
    parts = F.split(strip(F.coalesce(text, F.lit(""))), SPACES)
    return F.array_join(drop_listed(parts, ["", *stop_words]), " ")


def title_case(text: Column) -> Column:
    """Capital after every non-letter: unlike ``initcap``, also after digits (``3Rd``)."""
    mark = "\x01 "
    split_digits = F.regexp_replace(text, "([0-9'])([A-Za-z])", f"$1{mark}$2")
    return F.replace(F.initcap(split_digits), F.lit(mark), F.lit(""))
