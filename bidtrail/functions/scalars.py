"""Scalar column functions of the enrichment jobs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that can be a number.  A failing try_cast builds an exception, which costs more than all other work on
# a row, so texts that cannot succeed are not tried.
_WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
_NUMBER_START = r"^\s*[+-]?[\d.NnIi]"
_FULL_TIMESTAMP = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?$"


def geo_point(latitude: Column, longitude: Column) -> Column:
    """[longitude, latitude], or [0, 0] where either is missing."""
    zero = F.lit(0).cast("float")
    return F.when(latitude.isNull() | longitude.isNull(), F.array(zero, zero)).otherwise(F.array(longitude, latitude))


def ad_slot_size(width: Column, height: Column) -> Column:
    """'WIDTHxHEIGHT', or 'Unknown' where either is missing."""
    return F.coalesce(F.concat(width.cast("string"), F.lit("x"), height.cast("string")), F.lit("Unknown"))


def split_text(text: Column, delimiter: str = ",") -> Column:
    """Split on a regular expression without trailing empty parts; '' gives [''], null gives null."""
    trimmed = F.regexp_replace(text, f"(?:{delimiter})+\\z", "")
    none = F.array().cast("array<string>")
    return F.when(text == "", F.array(text)).when(trimmed == "", none).otherwise(F.split(trimmed, delimiter))


def user_tags_array(tags: Column, delimiter: str = ",") -> Column:
    return split_text(tags, delimiter)


def keyword_or_tags(keyword_name: Column, user_tags: Column) -> Column:
    """Dictionary keyword, else the raw tag text."""
    return F.coalesce(keyword_name, user_tags)


def tag_key(user_tags: Column) -> Column:
    """Tag text as a keyword id; null for lists and other text, so such rows match no keyword."""
    return cast_text(user_tags, T.LongType())


def event_time(text: Column) -> Column:
    """17-digit yyyyMMddHHmmssSSS text as a timestamp; null if it is not one."""
    iso = F.concat(
        F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2),
        F.lit(" "),
        F.substring(text, 9, 2), F.lit(":"), F.substring(text, 11, 2), F.lit(":"), F.substring(text, 13, 2),
        F.lit("."), F.substring(text, 15, 3),
    )
    return F.when(text.rlike(r"^\d{17}$"), iso.try_cast("timestamp_ntz"))


def event_time_text(time: Column) -> Column:
    """Inverse of event_time: a zone-less timestamp as 17 digits, cut to milliseconds."""
    time = time.cast("timestamp_ntz")
    day = F.year(time) * 10_000 + F.month(time) * 100 + F.dayofmonth(time)
    millis = F.pmod(F.unix_millis(time.cast("timestamp")), F.lit(1000))
    clock = F.hour(time) * 10_000_000 + F.minute(time) * 100_000 + F.second(time) * 1000 + millis
    return (day.cast("bigint") * 1_000_000_000 + clock).cast("string")


def event_millis(time: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, time)


def cast_text(text: Column, to: T.DataType) -> Column:
    """Text to a typed value; null where the text is not of that type."""
    if isinstance(to, T.StringType):
        return text
    if isinstance(to, T.BooleanType):
        return F.lower(text) == "true"
    if isinstance(to, T.BinaryType):
        return F.encode(text, "UTF-8")
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        return F.when(text.rlike(_FULL_TIMESTAMP), text.try_cast(to))
    if isinstance(to, T.ArrayType):
        parts = split_text(text, ",")
        return parts if isinstance(to.elementType, T.StringType) else F.transform(parts, lambda p: cast_text(p, to.elementType))
    likely = _NUMBER_START if isinstance(to, T.FractionalType) else _WHOLE_NUMBER
    return F.when(text.rlike(likely), text.try_cast(to))


def date_in_name(name: Column, pattern: str = r"(\d{8})") -> Column:
    """First eight digits in a file name; an error if there are none."""
    found = F.regexp_extract(name, pattern, 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no date in file name: "), name)))


def index_for_name(name: Column, pattern: str) -> Column:
    """Index name for a file, e.g. pattern 'log_%s/bid'."""
    return F.format_string(pattern, date_in_name(name))


def matches_term(text: Column, term: str) -> Column:
    """Case-insensitive search for a plain term."""
    return F.lower(text).contains(term.lower())


def prediction_text(title: Column, probabilities: Column) -> Column:
    """'"title" = [p, ...]'."""
    numbers = F.array_join(F.transform(probabilities, lambda p: p.cast("string")), ", ")
    return F.concat(F.lit('"'), title, F.lit('" = ['), numbers, F.lit("]"))


def literal_pattern(delimiter: str) -> str:
    """A plain delimiter as a pattern for split_text."""
    return re.escape(delimiter)
