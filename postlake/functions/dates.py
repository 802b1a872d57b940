"""Instants: ISO, epoch, written and relative dates, and their text form."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import clean, squeeze

# A post is recent for this many days.
RECENT_DAYS = 30
# The instants of years 1 to 9999, in microseconds.
MIN_MICROS = -62135596800000000
MAX_MICROS = 253402300799999999

# Accepted ISO shape; a date, or date and time with an optional zone.
ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-]\d{2}(?::\d{2}(?::\d{2})?)?)?)?$"
)
# English month names, full and short.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
    "december", "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)
# Words for "now" and for one day ago.
NOW_WORDS = ("today", "hari ini", "just now", "baru saja", "sekarang")
YESTERDAY_WORDS = ("yesterday", "kemarin")
# Unit words of "<n> <unit> ago", with their seconds, in search order.
UNIT_WORDS = (
    (60, ("minute", "minutes", "min", "mins", "menit")),
    (3600, ("hour", "hours", "hr", "hrs", "jam")),
    (86400, ("day", "days", "hari")),
    (7 * 86400, ("week", "weeks", "minggu")),
    (30 * 86400, ("month", "months", "bulan")),
    (365 * 86400, ("year", "years", "tahun")),
)


def parse_iso(text: Column) -> Column:
    """ISO text to an instant; no zone means UTC; anything else is NULL."""
    plain = F.regexp_replace(text, ",", ".")
    return F.when(text.rlike(ISO_SHAPE), plain.try_cast("timestamp"))


def render_utc(ts: Column) -> Column:
    """UTC ISO text with ``Z``; six fraction digits only when they are not zero."""
    return F.replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(".000000Z"), F.lit("Z"))


def snapshot_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def is_recent(posted_ts: Column, scraped_ts: Column) -> Column:
    """Posted within the last 30 days, both ends included; NULL counts as not recent."""
    window = F.expr(f"INTERVAL {RECENT_DAYS} DAYS")
    return F.coalesce(posted_ts.between(scraped_ts - window, scraped_ts), F.lit(False))


def from_micros(micros: Column) -> Column:
    """Epoch microseconds (BIGINT); out of the calendar range is NULL."""
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.timestamp_micros(micros))


def from_seconds(seconds: Column) -> Column:
    """Epoch seconds (BIGINT); out of the calendar range is NULL."""
    inside = seconds.between(MIN_MICROS // 1_000_000, MAX_MICROS // 1_000_000)
    return F.when(inside, F.timestamp_seconds(seconds))


def from_epoch(value: Column) -> Column:
    """Epoch number whose unit follows its size: from 1e15 us, from 1e12 ms, else s."""
    number = value.cast("double")
    size = F.abs(number)
    micros = F.rint(F.when(size >= 1e15, number).when(size >= 1e12, number * 1e3).otherwise(number * 1e6))
    return F.when(micros.between(MIN_MICROS, MAX_MICROS), F.timestamp_micros(micros.cast("bigint")))


def parse_written(text: Column) -> Column:
    """``Y-m-d``, ``d-m-Y``, ``d/m/Y``, ``d Mon Y``; each with H:M:S, H:M or no time; UTC."""
    named = r"^(\d{1,2}) ([A-Za-z]+) (\d{4})(?= |$)"
    months = F.lit(list(MONTH_NAMES))

    def numbered(line: Column) -> Column:
        # Full names and their first three letters, twelve each.
        month = (F.array_position(months, F.lower(F.regexp_extract(line, named, 2))) - 1) % 12 + 1
        return F.regexp_replace(line, named, F.concat(F.lit("$3-"), month.cast("string"), F.lit("-$1")))

    def read(line: Column) -> Column:
        return F.when(line.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"), line.try_cast("timestamp"))

    # One-element arrays, so that each step is computed once.
    lines = F.array(F.regexp_replace(squeeze(text), r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})(?= |$)", "$4-$3-$1"))
    lines = F.transform(lines, lambda line: F.when(line.rlike(named), numbered(line)).otherwise(line))
    return F.transform(lines, read)[0]


def parse_relative(text: Column, base: Column) -> Column:
    """``2 days ago`` / ``3 jam lalu`` and the like, counted back from ``base``."""
    phrase = F.lower(clean(text))
    words = [word for _, names in UNIT_WORDS for word in names]
    unit_of = F.map_from_arrays(
        F.lit(words), F.lit([unit for unit, names in UNIT_WORDS for _ in names])
    )
    shape = rf"(\d+)\s*({'|'.join(words)})\s*(?:ago|lalu)"
    part = lambda hit, n: F.regexp_extract(hit, shape, n)
    # A count or a span too large for a number is beyond the calendar: NULL.
    count = lambda hit: part(hit, 1).try_cast("bigint")
    # The smallest unit wins, and of one unit the first place in the text.
    hits = F.transform(
        F.regexp_extract_all(phrase, F.lit(shape), F.lit(0)),
        lambda hit, i: F.struct(unit_of[part(hit, 2)].alias("unit"), i.alias("i"), count(hit).alias("n")),
    )
    words = F.when(phrase.isin(*NOW_WORDS), F.lit(0)).when(phrase.isin(*YESTERDAY_WORDS), F.lit(86400))
    # One-element arrays, so that the steps before are computed once.
    counted = F.transform(F.array(F.array_min(hits)), lambda hit: F.try_multiply(hit["unit"].cast("bigint"), hit["n"]))
    micros = F.try_subtract(F.unix_micros(base), F.try_multiply(F.coalesce(counted[0], words.cast("bigint")), F.lit(1_000_000)))
    return F.transform(F.array(micros), from_micros)[0]


def parse_posted(number: Column, text: Column, base: Column) -> Column:
    """An epoch number, or else ISO, written or relative text, to an instant."""
    by_text = F.coalesce(parse_iso(text), parse_written(text), parse_relative(text, base))
    return F.when(number.isNotNull(), from_epoch(number)).otherwise(by_text)
