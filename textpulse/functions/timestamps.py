"""Timestamps from mixed input: epoch numbers, numeric strings and date text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

# Range of a nanosecond timestamp; values outside count as unreadable.
EARLIEST = datetime(1677, 9, 21, 0, 12, 44, tzinfo=timezone.utc)
LATEST = datetime(2262, 4, 11, 23, 47, 16, tzinfo=timezone.utc)
_SECONDS = 9223372036.0

# Text dates beyond ISO 8601 are taken apart by one expression, whatever their shape: every part of every
# order of year, month and day is a group, and those that did not take part stay empty.
_WEEKDAY = r"(?i)\b(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"
_ORDINAL = r"(?i)(?<=[0-9])(st|nd|rd|th)\b"
_NAME = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_GAP = r"[-/.,\s]+"
_DATES = (  # order of the parts, and their expressions
    ("ymd", r"([0-9]{4})[-/. ]([0-9]{1,2})[-/. ]([0-9]{1,2})"),
    ("mdy", r"([0-9]{1,2})[-/. ]([0-9]{1,2})[-/. ]([0-9]{4}|[0-9]{2})"),
    ("dny", f"([0-9]{{1,2}}){_GAP}{_NAME}{_GAP}([0-9]{{4}}|[0-9]{{2}})"),
    ("ndy", f"{_NAME}{_GAP}([0-9]{{1,2}}){_GAP}([0-9]{{4}})"),
    ("ynd", f"([0-9]{{4}}){_GAP}{_NAME}{_GAP}([0-9]{{1,2}})"),
    ("ny", f"{_NAME}{_GAP}([0-9]{{4}})"),
    ("ymd", r"([0-9]{4})([0-9]{2})([0-9]{2})(?=T)"),
)
_TIME = r"(?:(?:T|\s+at\s+|[\s,]+)([0-9]{1,2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]{1,9}))?)?)?\s*(?:([ap])\.?m\.?)?)?"
_ZONE = r"\s*(z|[+-][0-9]{2}:?(?:[0-9]{2})?|\(?[a-z]{2,5}\)?)?"
_SHAPE = f"(?i)^(?:{'|'.join(e for _, e in _DATES)}){_TIME}{_ZONE}$"
_ORDER = "".join(order for order, _ in _DATES) + "HMSFPZ"


def epoch_seconds(seconds: Column) -> Column:
    """Epoch seconds (double) to timestamp; NULL outside the supported range."""
    return F.when(seconds.between(-_SECONDS, _SECONDS), F.timestamp_seconds(seconds))


def _from_parts(text: Column) -> Column:
    """Timestamp of a text date in any of the orders above; NULL if it has none of them.

    The month comes before the day where only numbers stand, unless it cannot be one. Two digits of a
    year lie between 1975 and 2074. Times are UTC if no offset is given; names of other zones are
    not known and count for nothing.
    """
    bare = F.regexp_replace(F.regexp_replace(text, _WEEKDAY, ""), _ORDINAL, "")
    parts = F.split(F.regexp_replace(bare, _SHAPE, "|".join(f"${i + 1}" for i in range(len(_ORDER)))), r"\|")

    def read(p: Column) -> Column:
        part = lambda kind: F.concat(*[p[i] for i, k in enumerate(_ORDER) if k == kind])  # noqa: E731  one at most is filled
        number = lambda kind: part(kind).try_cast("int")
        year, month, day = number("y"), number("m"), number("d")
        name = (F.call_function("locate", F.lower(part("n")), F.lit("janfebmaraprmayjunjulaugsepoctnovdec")) + 2) / 3
        month = F.when(part("n") != "", name.cast("int")).otherwise(month)
        swapped = (part("n") == "") & (month > 12) & (day <= 12)
        year = F.when(F.length(part("y")) > 2, year).when(year < 75, year + 2000).otherwise(year + 1900)
        day = F.when(part("d") == "", 1).otherwise(day)
        hour = F.coalesce(number("H"), F.lit(0))
        half = F.lower(part("P"))
        hour = F.when(half == "", hour).when(hour > 12, F.lit(None)).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
        second = F.concat(F.when(part("S") == "", "0").otherwise(part("S")), F.lit("."), F.rpad(part("F"), 6, "0")).try_cast("decimal(16,6)")
        zone = F.regexp_replace(part("Z"), "^([+-][0-9]{2}):?([0-9]{2})?$", "$1:$2")
        zone = F.when(~zone.startswith("+") & ~zone.startswith("-"), "+00:00").otherwise(F.rpad(zone, 6, "0"))
        return F.try_make_timestamp(year, F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day),
                                    hour, F.coalesce(number("M"), F.lit(0)), second, zone)

    # The parts are computed once and read by their place.
    read_all = F.transform(F.array(parts), lambda p: F.when(F.size(p) == len(_ORDER), read(p)))
    return F.when(~F.contains(bare, F.lit("|")), read_all[0])


def parse_text(text: Column) -> Column:
    """Digits with optional dots are epoch seconds, anything else a date in UTC.

    Unreadable text gives NULL. Requires the session time zone UTC.
    """
    bare = F.btrim(text)
    # A cast alone would also read times without a date. It is the fast path; the rest is taken apart.
    parsed = F.coalesce(F.when(bare.rlike(r"^[0-9]{4}-"), bare.try_cast("timestamp")), _from_parts(bare))
    parsed = F.when(parsed.between(F.lit(EARLIEST), F.lit(LATEST)), parsed)
    return (F.when(text.rlike(r"^[0-9.]*[0-9][0-9.]*$"), epoch_seconds(text.try_cast("double")))
            .otherwise(parsed))


def shape(text: Column) -> Column:
    """What a text date looks like: digits as 9, letters as a."""
    return F.regexp_replace(F.regexp_replace(F.btrim(text), "[0-9]", "9"), "[A-Za-z]+", "a")


def parse_variant(value: Column) -> Column:
    """As :func:`parse_text`, but a JSON number is always epoch seconds, sign or exponent."""
    kind = F.schema_of_variant(value)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    text = F.try_variant_get(value, "$", "string")
    return (F.when(number, epoch_seconds(F.try_variant_get(value, "$", "double")))
            .when(kind == "STRING", parse_text(text)))
