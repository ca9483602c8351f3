"""Row rules. A rule is a name and a condition that is true for a row breaking it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def null_rules(columns: Sequence[str]) -> list[Rule]:
    return [(f"null:{c}", F.col(c).isNull()) for c in columns]


def domain_rules(domains: Mapping[str, Sequence]) -> list[Rule]:
    """Values outside a fixed list. NULL is the business of ``null_rules``."""
    return [(f"domain:{c}", ~F.col(c).isin(*values)) for c, values in domains.items()]


def format_rules(formats: Mapping[str, str]) -> list[Rule]:
    return [(f"format:{c}", ~F.col(c).rlike(pattern)) for c, pattern in formats.items()]


def range_rules(conditions: Mapping[str, str | Column]) -> list[Rule]:
    """Conditions that must hold, by rule name. One that comes out NULL is not broken."""
    return [
        (f"range:{name}", ~(F.expr(c) if isinstance(c, str) else c))
        for name, c in conditions.items()
    ]


def length_rules(lengths: Mapping[str, int]) -> list[Rule]:
    return [(f"length:{c}", F.octet_length(c) > n) for c, n in lengths.items()]


def suffix_rules(name: str, columns: Sequence[str], suffix: str) -> list[Rule]:
    return [(f"{name}:{c}", F.col(c).endswith(suffix)) for c in columns]


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in the order of the rules."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("reasons", reasons(rules))


def is_valid() -> Column:
    return F.size("reasons") == 0


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the reasons, and bad rows with them."""
    return checked.filter(is_valid()).drop("reasons"), checked.filter(~is_valid())
