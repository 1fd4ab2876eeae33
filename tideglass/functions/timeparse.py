"""Notations of times and dates, read by JVM expressions.

A text is brought to `year|month|day|hour|minute|second|fraction|AM or PM|zone` by the first pattern it fits, one replacement per
pattern, and the parts are checked by try_make_timestamp. Times are epoch microseconds; a time without zone stays local until
a zone is known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Usual offsets of zone letters, in minutes; CST and CDT are the American ones.
LETTER_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "BST": 60, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "SGT": 480, "HKT": 480, "JST": 540, "KST": 540,
    "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "NZST": 720, "NZDT": 780,
}
# Letters that stand for a place's clock, daylight saving included.
LETTER_ZONES = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r" ?([+-]\d{2}:?\d{2}|[+-]\d{2}|[A-Z]{1,5})?"
_HALF = r"(?: ?([AP]M))?"
#: Each with the order of its groups in year|month|day|hour|minute|second|fraction|half|zone. AB is two numbers whose order the
#: source decides.
_TIMES = {
    "YMD": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})[T ]" + _CLOCK + _HALF + _ZONE + "$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    "BASIC": (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?" + _ZONE + "$", "$1|$2|$3|$4|$5|$6|||$7"),
    "AB": (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})[T ,]{1,2}" + _CLOCK + _HALF + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    "DMY": (r"^(?:[A-Z]{3,9},? )?(\d{1,2})[- ]([A-Z]{3})[A-Z]*\.?[- ,]{1,2}(\d{4}),? " + _CLOCK + _HALF + _ZONE + "$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    "MDY": (r"^(?:[A-Z]{3,9},? )?([A-Z]{3})[A-Z]*\.? (\d{1,2}),? (\d{4}),? " + _CLOCK + _HALF + _ZONE + "$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
}
_DATES = {
    "ymd": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ].*|Z|[+-]\d{2}:?\d{2})?$", "$1|$2|$3"),
    "basic": (r"^(\d{4})(\d{2})(\d{2})(?:[T ].*|Z|[+-]\d{2}:?\d{2})?$", "$1|$2|$3"),
    "mdy": (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?:[T ].*|Z|[+-]\d{2}:?\d{2})?$", "$3|$1|$2"),
    "name-dmy": (r"^(?:[A-Z]{3,9},? )?(\d{1,2})[- ]([A-Z]{3})[A-Z]*\.?[- ,]{1,2}(\d{4}|\d{2})(?:[T ,].*)?$", "$3|$2|$1"),
    "name-mdy": (r"^(?:[A-Z]{3,9},? )?([A-Z]{3})[A-Z]*\.? (\d{1,2})(?:ST|ND|RD|TH)?,? (\d{4})(?:[T ,].*)?$", "$3|$1|$2"),
}
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    """In upper case, with outer white space gone and inner runs of it as one space."""
    return F.upper(F.trim(F.regexp_replace(text, r"[\s  ﻿]+", " ")))


def _fit(text: Column, patterns: dict[str, tuple[str, str]]) -> Column:
    """The parts by the first pattern that the text fits, with the pattern's name as the last of them."""
    parts = F.when(F.lit(False), F.lit(""))
    for name, (pattern, order) in patterns.items():
        parts = parts.when(text.rlike(pattern), F.regexp_replace(text, pattern, f"{order}|{name}"))
    return F.split(parts, r"\|", -1)


def _month(part: Column) -> Column:
    named = F.call_function("locate", part, F.lit(_MONTHS))
    return F.when(part.rlike(r"^\d+$"), part.cast("int")).when((named > 0) & (F.pmod(named, F.lit(3)) == 1), ((named + 2) / 3).cast("int"))


def _micros(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    return F.unix_micros(F.try_make_timestamp(y, mo, d, h, mi, s, F.lit("UTC")))


def epoch_number_micros(text: Column) -> Column:
    """An epoch in seconds, ms, microseconds or nanoseconds by its number of digits, as microseconds."""
    n = F.when(text.rlike(r"^\d{10}(\d{3}){0,3}$"), text.cast("bigint"))
    digits = F.length(text)
    return F.when(digits == 10, n * 1_000_000).when(digits == 13, n * 1000).when(digits == 16, n).when(digits == 19, F.call_function("div", n, F.lit(1000).cast("bigint")))


def read_time(text: Column, order: Column) -> Column:
    """struct(local: microseconds as if in UTC, zone: letters, offset or null, epoch: microseconds) of a text; exactly one of
    local and epoch is set if the text stands for a time, else neither. order: MDY or DMY, of dates in which only digits stand."""

    def read(parts: Column, clean: Column, order: Column) -> Column:
        get = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        swapped = (get(9) == "AB") & F.coalesce(order == "DMY", F.lit(False))
        month, day = F.when(swapped, get(2)).otherwise(get(1)), F.when(swapped, get(1)).otherwise(get(2))
        half, hour = get(7), get(3).cast("int")
        hour = F.when(half.isNull(), hour).when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(half == "PM", 12).otherwise(0))
        second = F.concat(F.coalesce(get(5), F.lit("0")), F.lit("."), F.rpad(F.coalesce(get(6), F.lit("0")), 6, "0")).cast("decimal(16,6)")
        local = _micros(get(0).cast("int"), let(month, _month), day.cast("int"), hour, get(4).cast("int"), second)
        return let(local, lambda at: F.struct(at.alias("local"), F.when(at.isNotNull(), get(8)).alias("zone"), epoch_number_micros(clean).alias("epoch")))

    return let(squeeze(text), lambda clean: let(_fit(clean, _TIMES), lambda parts: read(parts, clean, order)))


def to_utc(local: Column, zone_name: Column) -> Column:
    """Of microseconds of a local clock. A time that occurs twice is the earlier instant; one that is skipped moves forward."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), zone_name))


def offset_micros(zone: Column) -> Column:
    """Of a written offset or of letters; null for letters without a fixed offset."""
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).cast("int") * 60 + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).cast("int"), F.lit(0))
    table = F.create_map(*(F.lit(x) for pair in LETTER_MINUTES.items() for x in pair))
    return F.when(zone.rlike(r"^[+-]\d"), sign * minutes).otherwise(F.try_element_at(table, zone)).cast("bigint") * 60_000_000


def instant(read: Column, zone_name: Column) -> Column:
    """Epoch microseconds of what read_time gave; zone_name is for times without zone. Null if the zone isn't known."""
    zone, local = read["zone"], read["local"]
    places = F.create_map(*(F.lit(x) for pair in LETTER_ZONES.items() for x in pair))
    place = F.when(zone.isNull(), zone_name).otherwise(F.try_element_at(places, zone))
    found = let(place, lambda name: F.when(name.isNotNull(), to_utc(local, name)).otherwise(local - offset_micros(zone)))
    return F.when(read["epoch"].isNotNull(), read["epoch"]).otherwise(found)


def read_date(text: Column) -> Column:
    """A date as written, month before day where only digits stand; time and zone are dropped, years of two digits are 20yy."""

    def read(parts: Column) -> Column:
        get = lambda i: F.nullif(F.get(parts, F.lit(i)), F.lit(""))
        year = get(0).cast("int") + F.when(F.length(get(0)) == 2, 2000).otherwise(0)
        at = _micros(year, let(get(1), _month), get(2).cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
        return F.date_from_unix_date(F.call_function("div", at, F.lit(86_400_000_000).cast("bigint")).cast("int"))

    return let(squeeze(text), lambda clean: let(_fit(clean, _DATES), read))


def iso_ms(ms: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.fffZ in UTC, whatever the session's zone."""
    rest = F.pmod(ms, F.lit(86_400_000).cast("bigint"))
    day = F.date_from_unix_date(((ms - rest) / 86_400_000).cast("int"))
    part = lambda by, base: F.pmod(F.call_function("div", rest, F.lit(by).cast("bigint")), F.lit(base).cast("bigint"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.format_string("T%02d:%02d:%02d.%03dZ", part(3_600_000, 24), part(60_000, 60), part(1000, 60), part(1, 1000)))
