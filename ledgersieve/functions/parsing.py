"""Checked parsing of feed text. A value that does not parse gives null; a blank one also gives null,
so ``parse_failed`` tells the two apart.

The expressions are kept short on purpose: all parsing of a row ends up in one generated method, and the JVM
only compiles methods below 8,000 bytes of bytecode (longer ones are interpreted, many times slower).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 text that Spark's own cast reads the same way. ``\z`` and not ``$``: a trailing line break is an
# error. Year 0000 does not exist in the accepted grammar.
_PLAIN_ISO = r"^(?!0000)\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?)?\z"

# Other accepted spellings: compact dates and times, any one character as separator, a comma as the decimal
# sign; and, after a time, a zone offset.
_DATE = r"(?!0000)(?:\d{4}-\d{2}-\d{2}|\d{8})"
_CLOCK = r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
_OFFSET = r"(?:Z|[+-]\d{2}(?::?[0-5]\d(?::?[0-5]\d)?)?)"
_ANY_ISO = rf"(?s)^{_DATE}(?:.{_CLOCK}{_OFFSET}?)?\z"

# Rewrites of an accepted text to a full one with a zone, in this order.
_RESPELL = [
    (r"(?s)^(\d{4})-?(\d{2})-?(\d{2}).?", "$1-$2-$3T"),
    (r"(T[\d:]*)", "$1000000"),  # more than enough digits for the clock: group 1, then six zeros
    (r"T(\d{2}):?(\d{2}):?(\d{2})\d*", "T$1:$2:$3"),
    (r"(T[\d:.,]*)\z", "$1Z"),
]

# A week of a year, with or without its day, and what may follow. A hyphen before two digits is a separator.
_WEEK = r"(?:\d{4}-W\d{2}(?:-[1-7](?!\d))?|\d{4}W\d{2}[1-7]?(?!\d))"
_ANY_WEEK = rf"(?s)^(?!0000){_WEEK}(?:.{_CLOCK}{_OFFSET}?)?\z"

_SPACE_OR_UNDERSCORE = r"[_ \t\n\x0B\f\r\x85\p{Z}]"
_SPACE = r"[ \t\n\x0B\f\r\x85\p{Z}]*+"
_DIGITS = r"\d++(?:_\d++)*+"
_PLAIN_NUMBER = r"^[+-]?\d++(?:\.\d++)?\z"
_NUMBER = (
    rf"(?i)^{_SPACE}[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    rf"|inf(?:inity)?){_SPACE}\z"
)
_NAN = rf"(?i)^{_SPACE}[+-]?nan{_SPACE}\z"


def _matches(name: str, pattern: str) -> str:
    return f"rlike({name}, r'{pattern}')"


def calendar_text(name: str) -> Column:
    """The text with a date by week (``2024-W05-3``) put as a date by month; other texts as they are.

    Week 1 is the one with 4 January in it. A week that the year doesn't have gives a text that is no time.
    """
    year = "cast(substr(x, 1, 4) as int)"
    week = "cast(regexp_extract(x, 'W([0-9]{2})', 1) as int)"
    day = "coalesce(try_cast(regexp_extract(x, r'^[-0-9]+W[0-9]{2}-?([1-7])(?![0-9])', 1) as int), 1)"
    date = f"date_add(date_trunc('week', make_date({year}, 1, 4)), ({week} - 1) * 7 + {day} - 1)"
    rest = f"regexp_replace(x, r'^{_WEEK}', '')"
    there = f"{week} > 0 and extract(yearofweek from {date}) = {year}"
    # The lambda is no part of the generated method of the row, whose size is bounded; it runs for dates by week only.
    turned = f"transform(array({name}), x -> concat(if({there}, string({date}), 'no such week'), {rest}))[0]"
    # Most texts hold no W and need no pattern.
    return F.expr(f"if(contains({name}, 'W') and {_matches(name, _ANY_WEEK)}, {turned}, {name})")


def has_offset(name: str) -> Column:
    """Whether an accepted timestamp text names a zone offset. No date or separator reaches position 12."""
    signs = [f"contains(substr({name}, 12), '{sign}')" for sign in "Z+-"]
    return F.expr(" or ".join(signs))


def parse_timestamp(name: str) -> Column:
    """Zone-less timestamp of the ISO text in column ``name``; one with an offset is turned to UTC.

    The uncommon spellings go through an instant: a cast to a zone-less type would ignore the offset.
    """
    full = name
    for pattern, rewritten in _RESPELL:
        full = f"regexp_replace({full}, r'{pattern}', '{rewritten}')"
    instant = f"try_cast(replace({full}, ',', '.') as timestamp)"
    since_epoch = f"cast(unix_micros({instant}) / 1000000bd as decimal(18, 6))"
    return F.expr(
        f"""case
        when {_matches(name, _PLAIN_ISO)} then try_cast({name} as timestamp_ntz)
        when {_matches(name, _ANY_ISO)}
          then timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {since_epoch})
        end"""
    )


def parse_amount(name: str) -> Column:
    """Double of a decimal text; spaces around it and single underscores between digits are allowed."""
    compact = f"regexp_replace({name}, r'{_SPACE_OR_UNDERSCORE}', '')"
    return F.expr(
        f"""case
        when {_matches(name, _PLAIN_NUMBER)} then try_cast({name} as double)
        when {_matches(name, _NUMBER)} then try_cast({compact} as double)
        when {_matches(name, _NAN)} then double('nan')
        end"""
    )


def parse_failed(name: str, parsed: str) -> Column:
    return F.expr(f"coalesce({name} <> '', false) and {parsed} is null")
