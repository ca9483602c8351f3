"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def initcap_words(c: Column | str) -> Column:
    """Capitalise every run of letters and digits: ``mary-ann o'neil`` -> ``Mary-Ann O'Neil``.

    Spark's own ``initcap`` only starts a new word at white space.
    """
    words = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        "",
    )


def truncate_to(c: Column | str, n: int) -> Column:
    """At most ``n`` characters."""
    return F.left(F.col(c) if isinstance(c, str) else c, F.lit(n))


def truncate_bytes(c: Column | str, n: int) -> Column:
    """At most ``n`` bytes of UTF-8, cut between characters."""
    c = F.col(c) if isinstance(c, str) else c
    raw = F.encode(c, "utf-8")
    # A character has at most four bytes, so one of these four cuts is between two.
    cuts = [
        F.try_validate_utf8(F.substring(raw, 1, k).cast("string"))
        for k in range(n, max(n - 4, -1), -1)
    ]
    return F.when(F.octet_length(c) <= n, c).otherwise(F.coalesce(*cuts))


def blank_as_null(c: Column | str) -> Column:
    """NULL for text of white space only; the empty string is left to ``empty_as_null``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"^\s+$"), None).otherwise(c)


def empty_as_null(c: Column | str) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def snake_name(name: str) -> str:
    """``TagID`` -> ``tag_id``, ``GPSCoordinates`` -> ``gps_coordinates``."""
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
