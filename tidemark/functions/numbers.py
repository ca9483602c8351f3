"""Numbers that may arrive as JSON numbers or as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_number(v: Column | str, path: str, kind: str = "double") -> Column:
    """Read a number at a VARIANT path, whether it was sent as 12.5 or as "12.5".

    Anything else, NaN and infinities included, gives NULL.
    """
    return number_from_text(F.try_variant_get(v, path, "string"), kind)


def number_from_text(c: Column | str, kind: str = "double") -> Column:
    """Text to a finite number of the given type, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    value = c.try_cast(kind)
    if kind in ("double", "float"):
        return F.when(F.abs(value) < F.lit(float("inf")), value)
    return value
