"""Column functions over dates, durations and delays."""

from __future__ import annotations

from datetime import datetime, timezone

import pyarrow as pa
from dateutil import parser
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.functions.text import strip, text_of

#: Where an item has no date at all.
EPOCH = "2001-01-01 00:00:00"
#: Days to wait after a failure double up to this many attempts and days.
MOST_DOUBLINGS, MOST_DAYS = 5, 30

#: Forms of a date beside ISO 8601, tried in this order after a weekday's name is cut off.
FORMATS = (
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm z",
    "d MMM yyyy HH:mm Z",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
    "MMMM d yyyy",
    "MMM d yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "yyyyMMdd",
    "M/d/yyyy",
)


def parse_date(c: Column) -> Column:
    """A UTC timestamp from ISO 8601, RFC 822 and the other FORMATS; without a zone it is UTC. Else null.

    A text with only some parts of a date stays null: filling the rest from today would give
    another result each day.
    """
    bare = F.regexp_replace(strip(text_of(c)), r"(?i)^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?\.?,?\s+", "")
    iso = F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"), F.regexp_replace(bare, r"\s+([+-]\d{2}:?\d{2}|Z)$", "$1").try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(bare, F.lit(f)) for f in FORMATS])


def _free(text: str | None) -> datetime | None:
    """The UTC time that a free-form text names, if it names a day whole: parts that are filled in from elsewhere don't count."""
    if not text:
        return None
    try:
        found = {parser.parse(text, default=datetime(year, month, day)) for year, month, day in ((2000, 1, 1), (2004, 2, 2))}
    except (ValueError, OverflowError, TypeError):
        return None
    if len(found) != 1:
        return None
    one = found.pop()
    return one.astimezone(timezone.utc) if one.tzinfo else one.replace(tzinfo=timezone.utc)


@F.arrow_udf(T.TimestampType())
def _free_dates(texts: pa.Array) -> pa.Array:
    return pa.array([_free(t) for t in texts.to_pylist()], pa.timestamp("us", "UTC"))


def parse_any_date(c: Column) -> Column:
    """parse_date, and what a lenient parser makes of the texts that this leaves; only those reach Python as texts."""
    quick = parse_date(c)
    return F.coalesce(quick, _free_dates(F.when(quick.isNull(), strip(text_of(c)))))


def sort_date(published: Column, discovered: Column) -> Column:
    """What feeds are ordered by."""
    return F.coalesce(published, discovered, F.lit(EPOCH).cast("timestamp"))


def minutes(c: Column) -> Column:
    """Whole minutes over 0, from a text, else null."""
    n = F.regexp_extract(strip(text_of(c.cast("string"))), r"^([+-]?\d+)$", 1).try_cast("int")
    return F.when(n > 0, n)


def number_minutes(c: Column) -> Column:
    """minutes() of a numeric column, which is cut to whole ones first."""
    n = c.try_cast("int")
    return F.when(n > 0, n)


def iso_minutes(c: Column) -> Column:
    """95 to PT1H35M; "" for null and what isn't over 0."""
    part = lambda n, sign: F.when(n > 0, F.concat(n.cast("string"), F.lit(sign))).otherwise("")
    return F.when(c > 0, F.concat(F.lit("PT"), part(F.floor(c / 60), "H"), part(c % 60, "M"))).otherwise("")


def human_duration(c: Column) -> Column:
    """PT1H35M to 1 hr 35 min; a text that doesn't start with PT stays."""
    rest = F.substring_index(text_of(c), "PT", -1)
    number = lambda unit: F.coalesce(F.regexp_extract(rest, rf"(\d+){unit}", 1).try_cast("int"), F.lit(0))
    said = lambda n, name: F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {name}")))
    return F.when(~F.startswith(text_of(c), F.lit("PT")), text_of(c)).otherwise(F.concat_ws(" ", said(number("H"), "hr"), said(number("M"), "min")))


def backoff_days(attempts: Column) -> Column:
    """2, 4, 8, 16, then 30 days."""
    return F.least(F.pow(F.lit(2), F.least(attempts, F.lit(MOST_DOUBLINGS))), F.lit(float(MOST_DAYS))).cast("int")


def next_retry(now: Column, attempts: Column) -> Column:
    return now + F.make_dt_interval(backoff_days(attempts))


def iso_text(ts: Column) -> Column:
    """A timestamp as ISO 8601 text in UTC (the session's zone)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
