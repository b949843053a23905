"""Date helpers (F1-F5), all built-in Catalyst expressions.

Times are carried as epoch milliseconds in documents and targets, as the
reference's documents do.  The session time zone must be UTC (see
``tidewater.session``) so that day boundaries and epoch values do not depend
on the machine.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two formats the reference formats and parses with.
DATE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"

MILLIS_PER_DAY = 86_400_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_days(ts, days) -> Column:
    """shift by whole days (negative allowed), keeping the time of day."""
    n = days if isinstance(days, Column) else F.lit(int(days))
    return _col(ts) + F.make_interval(days=n)


def format_date(ts, fmt: str = DATE_TIME_FORMAT) -> Column:
    """null in, null out."""
    return F.date_format(_col(ts), fmt)


def parse_date(text, fmt: str = DATE_TIME_FORMAT, strict: bool = False) -> Column:
    """text to timestamp.  ``strict`` raises on bad text like the
    reference does; the default returns null so one bad row does not fail a
    whole batch (such rows are routed by the caller)."""
    if strict:
        return F.to_timestamp(_col(text), fmt)
    return F.try_to_timestamp(_col(text), F.lit(fmt))


#: Pattern letters that the lenient parser knows, with the field of a calendar.
_FIELDS = {"y": "year", "M": "month", "d": "day", "H": "hour", "m": "minute", "s": "second", "S": "milli"}
_LENIENT_FORMAT = "yyyy-MM-dd[ HH:mm:ss]"


def _compile(fmt: str) -> tuple[str, list[str], set[str]]:
    """The regular expression of a date pattern, its fields, in order, and which
    of them may be absent or too long.

    A field next to another field has the pattern's width; else it takes all
    digits (ten at most), after blanks and a minus sign if there are any.  ``[...]`` is an
    optional part (one blank in it stands for any number), ``'...'`` and all
    other characters but letters stand for themselves.
    """
    out, fields, optional, depth = "^", [], set(), 0
    runs = re.findall(r"([A-Za-z])(\1*)|'([^']*)'|(.)", fmt, re.DOTALL)
    for i, (letter, more, quoted, other) in enumerate(runs):
        if letter:
            if letter not in _FIELDS or (letter == "y" and len(more) != 3) or (letter == "M" and len(more) > 1):
                raise ValueError(f"pattern {letter + more!r} in {fmt!r} is not supported")
            close = i + 1 < len(runs) and bool(runs[i + 1][0])
            after = i > 0 and bool(runs[i - 1][0])
            fields.append(_FIELDS[letter])
            # what follows may take its last digits
            shared = i + 1 < len(runs) and (runs[i + 1][2] or runs[i + 1][3])[:1].isdigit()
            if depth or shared:
                optional.add(_FIELDS[letter])
            free = r"\s*(-?\d+)" if depth or shared else r"\s*(-?\d{1,10})(?!\d)"
            out += rf"(\d{{{len(more) + 1}}})" if close or after else free
        elif other == "[":
            out, depth = out + "(?:", depth + 1
        elif other == "]":
            out, depth = out + ")?", depth - 1
        elif other == " " and depth:
            out += r"\s+"
        else:
            out += re.escape(quoted or other)
    return out, fields, optional


def parse_date_lenient(text, fmt: str = _LENIENT_FORMAT) -> Column:
    """F3, lenient, for any pattern of numeric fields: out-of-range and
    negative fields roll over as a lenient calendar's do (month 13 -> January
    next year, day 0 -> the last of the month before, Feb 30 -> Mar 1, hour 24
    -> next day), text after the pattern is ignored, and fields that the
    pattern lacks are those of 1970-01-01 00:00:00.  Text that does not begin
    as the pattern says is null.  The pattern is compiled to an extraction plus
    calendar arithmetic, no UDF.
    """
    t = _col(text)
    shape, fields, optional = _compile(fmt)

    def num(field: str, absent: int) -> Column:
        if field not in fields:
            return F.lit(absent).cast("bigint")
        part = F.regexp_extract(t, shape, fields.index(field) + 1)
        if field not in optional:  # always digits: one extraction
            return part.try_cast("bigint")
        return F.when(part == "", F.lit(absent)).otherwise(F.try_to_number(part, F.lit("S9999999999")).cast("bigint"))

    months = num("year", 1970) * 12 + num("month", 1) - 1
    # named once: an expression inside a condition is evaluated wherever it is named
    first = F.add_months(F.lit("1970-01-01").cast("date"), (months - 1970 * 12).cast("int"))
    days = F.unix_date(first) + num("day", 1) - 1
    millis = ((days * 24 + num("hour", 0)) * 60 + num("minute", 0)) * 60000 + num("second", 0) * 1000 + num("milli", 0)
    return F.when(t.rlike(shape), F.timestamp_millis(millis))


def epoch_millis(ts) -> Column:
    """epoch milliseconds.  ``timestamp_ntz`` is read as session-zone
    (UTC) wall time."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def day_start(ts) -> Column:
    """truncate to the start of the day."""
    return F.date_trunc("day", _col(ts).cast("timestamp"))


def day_start_millis(ts) -> Column:
    return epoch_millis(day_start(ts))
