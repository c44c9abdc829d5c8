"""ISO and feed timestamps as Column expressions.  For text in any notation see `sluice.operators.instants`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+\-]\d{2}:?\d{2})?)?$"
# The forms a feed may use besides ISO 8601.
FEED_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd"]


def iso_instant(x: Column) -> Column:
    """The instant of an ISO 8601 text, UTC if it has no offset; null for null and any other text."""
    return F.when(x.rlike(_ISO), F.try_to_timestamp(x))


def feed_instant(x: Column) -> Column:
    """The instant of a text in one of the feed forms, with a year of four digits; other text gives null (see `unread`)."""
    return F.when(x.rlike(r"^\d{4}-"), F.coalesce(*[F.try_to_timestamp(x, F.lit(form)) for form in FEED_FORMATS]))


def unread(x: Column) -> Column:
    """Whether there is text that `feed_instant` does not understand: kept apart, not passed on."""
    return x.isNotNull() & (x != "") & feed_instant(x).isNull()


def iso_text(x: Column) -> Column:
    """A timestamp as ISO 8601 text with offset; microseconds only if there are any."""
    whole = F.date_format(x, "yyyy-MM-dd'T'HH:mm:ssXXX")
    return F.regexp_replace(F.when(F.unix_micros(x) % 1_000_000 == 0, whole).otherwise(F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")), "Z$", "+00:00")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def batches(rows: Column, size: int) -> Column:
    """How many batches of a size so many rows make."""
    return F.ceil(rows / F.lit(size))
