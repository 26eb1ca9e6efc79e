"""Timestamps as they occur in messages.

All functions return null for text they cannot read. ``zone`` is the wall clock the text is
taken to be in; it is shifted from there to UTC. ``zone=None`` keeps the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the messages and the zone of their wall clock.
STAMP14 = "yyyyMMddHHmmss"
ISO_MILLIS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
BERLIN = "Europe/Berlin"


def _shift(ts: Column, zone: str | None) -> Column:
    return ts if zone is None else F.to_utc_timestamp(ts, zone)


def stamp14(text: Column) -> Column:
    """``20190624094654`` to timestamp."""
    return F.try_to_timestamp(text.cast("string"), F.lit(STAMP14))


def iso_millis(text: Column, zone: str | None = BERLIN) -> Column:
    """``2019-06-24T09:46:54.123Z`` to timestamp; exactly three fractional digits, Z is a literal."""
    return _shift(F.try_to_timestamp(text.cast("string"), F.lit(ISO_MILLIS_Z)), zone)


def iso_seconds(text: Column, zone: str | None = BERLIN) -> Column:
    """The first 19 characters of an ISO text to timestamp; whatever follows is ignored."""
    head = F.substring(text.cast("string"), 1, 19)
    return _shift(F.try_to_timestamp(head, F.lit(ISO_SECONDS)), zone)


def epoch_millis_text(millis: Column) -> Column:
    """Epoch milliseconds (number or digits) to ``yyyy-MM-dd HH:mm:ss`` text."""
    seconds = F.floor(millis.try_cast("bigint") / F.lit(1000))
    return F.from_unixtime(seconds)


def run_time() -> Column:
    """The time of the run, one value for the whole query."""
    return F.current_timestamp()


def run_time_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
