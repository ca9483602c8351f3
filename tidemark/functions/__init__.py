"""Column expressions. All of them stay inside the JVM; none is a Python UDF."""

from tidemark.functions.keys import surrogate_key
from tidemark.functions.numbers import coerce_number, number_from_text
from tidemark.functions.text import (
    blank_as_null,
    empty_as_null,
    initcap_words,
    snake_name,
    truncate_bytes,
    truncate_to,
)
from tidemark.functions.times import (
    auto_timestamp,
    coerce_date,
    coerce_timestamp,
    declared_timestamp,
    duration_seconds,
)

__all__ = [
    "auto_timestamp",
    "blank_as_null",
    "coerce_date",
    "coerce_number",
    "coerce_timestamp",
    "declared_timestamp",
    "duration_seconds",
    "empty_as_null",
    "initcap_words",
    "number_from_text",
    "snake_name",
    "surrogate_key",
    "truncate_bytes",
    "truncate_to",
]
