"""Dates, times and durations sent as text in one of several layouts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts that sources are known to send besides ISO 8601.
DATE_LAYOUTS = ("MM/dd/yyyy", "dd-MMM-yyyy", "yyyyMMdd")
DATETIME_LAYOUTS = ("MM/dd/yyyy HH:mm:ss", "dd-MMM-yyyy HH:mm", "yyyyMMddHHmmss")

# Further layouts that automatic recognition on load takes.
AUTO_LAYOUTS = (
    "MM/dd/yyyy HH:mm",
    "MM-dd-yyyy HH:mm:ss",
    "MM-dd-yyyy",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
    "dd-MMM-yyyy HH:mm:ss",
    "MMM-dd-yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
)

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"
_ISO_DURATION = (
    r"^(-?)P(?:(\d+)D)?(?:T(?=\d)(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.\d+)?S)?)?$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _shape(layout: str) -> str:
    """A pattern that texts of the layout match: ``dd-MMM-yyyy`` -> ``\\d{2}-[A-Za-z]{3}-\\d{4}``."""
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", layout)
    return "^" + "".join(
        re.escape(other)
        or (r"[A-Za-z]{3}" if letter + more == "MMM" else rf"\d{{{len(letter + more)}}}")
        for letter, more, other in parts
    ) + "$"


def _parse(c: Column, layouts: tuple[str, ...]) -> list[Column]:
    # Text of another shape is not handed to the parser: a failed parse costs
    # far more than a failed match.
    return [
        F.when(c.rlike(_shape(layout)), F.try_to_timestamp(c, F.lit(layout))).cast("timestamp_ntz")
        for layout in layouts
    ]


def _iso(c: Column) -> Column:
    # Through TIMESTAMP, so that an offset in the text is applied and not dropped.
    return F.when(c.rlike(_ISO), c.try_cast("timestamp")).cast("timestamp_ntz")


def coerce_timestamp(c: Column | str) -> Column:
    """ISO text, one of the known layouts, or a bare date (midnight); else NULL."""
    c = F.trim(_col(c))
    return F.coalesce(_iso(c), *_parse(c, DATETIME_LAYOUTS + DATE_LAYOUTS))


def coerce_date(c: Column | str) -> Column:
    """Like ``coerce_timestamp``, cut to the day."""
    c = F.trim(_col(c))
    return F.coalesce(_iso(c), *_parse(c, DATE_LAYOUTS + DATETIME_LAYOUTS)).cast("date")


def auto_timestamp(c: Column | str) -> Column:
    """Recognise the layout of a timestamp on load.

    One pass over the text picks the layout by its shape: digits count as 9 and
    letters as a. Then one parse follows.
    """
    c = F.trim(_col(c))
    shape = F.regexp_replace(F.regexp_replace(c, "[0-9]", "9"), "[A-Za-z]", "a")
    by_shape: dict[str, list[str]] = {}
    for layout in DATETIME_LAYOUTS + DATE_LAYOUTS + AUTO_LAYOUTS:
        by_shape.setdefault(re.sub("[A-Za-z]", "9", layout.replace("MMM", "\0")).replace("\0", "aaa"), []).append(layout)
    parsed = [
        (shape == key, F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in layouts]).cast("timestamp_ntz"))
        for key, layouts in by_shape.items()
    ]
    out = F.when(*parsed[0])
    for condition, value in parsed[1:]:
        out = out.when(condition, value)
    return out.otherwise(_iso(c))


#: Parts of a declared layout and the pattern letters they stand for, longest first.
_PARTS = (
    ("YYYY", "yyyy"), ("HH24", "HH"), ("HH12", "hh"), ("MON", "MMM"), ("MM", "MM"), ("MI", "mm"), ("DD", "dd"),
    ("HH", "HH"), ("SS", "ss"), ("US", "SSSSSS"), ("MS", "SSS"), ("AM", "a"), ("PM", "a"), ("YY", "yy"), ("OF", "xxx"),
)


def declared_timestamp(c: Column | str, layout: str) -> Column:
    """Text in one declared layout, such as ``MM.DD.YYYY HH:MI:SS``, or seconds since 1970."""
    c = F.trim(_col(c))
    if layout.lower() in ("epochsecs", "epochmillisecs"):
        number = c.try_cast("decimal(38,6)") / (1 if layout.lower() == "epochsecs" else 1000)
        return F.timestamp_micros((number * 1_000_000).cast("bigint")).cast("timestamp_ntz")
    pattern = re.sub(
        "|".join(part for part, _ in _PARTS) + "|[A-Za-z]",
        lambda m: dict(_PARTS).get(m[0].upper(), "'" + m[0] + "'"),
        layout,
        flags=re.IGNORECASE,
    )
    if "hh" not in pattern and " a" in pattern:
        pattern = pattern.replace("HH", "hh")
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def duration_seconds(c: Column | str) -> Column:
    """Whole seconds from a plain number or an ISO 8601 duration such as ``PT1H1M30S``."""
    c = F.trim(_col(c))

    def part(group: int, unit: int) -> Column:
        digits = F.regexp_extract(c, _ISO_DURATION, group)
        return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(
            F.try_multiply(digits.try_cast("bigint"), F.lit(unit))
        )

    seconds = F.try_add(
        F.try_add(part(2, 86400), part(3, 3600)), F.try_add(part(4, 60), part(5, 1))
    )
    total = F.when(
        c.rlike(_ISO_DURATION) & c.rlike(r"\d"),
        F.when(c.startswith("-"), -seconds).otherwise(seconds),
    )
    plain = F.when(c.rlike(r"^[+-]?\d+(\.\d+)?$"), c.try_cast("double").try_cast("bigint"))
    return F.coalesce(plain, total).try_cast("int")
