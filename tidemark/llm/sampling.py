"""Bounded samples for the driver, and column names that clash with none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """All rows of ``df`` if they are ``most`` at most, else about so many, never more, chosen by a hash of ``key``.

    The rows are counted, then counted in the first few of so many hash buckets that about
    64 hold the sample; whole buckets are taken as long as they fit. So only the sample
    ever leaves the executors. A bucket that a repeated key fills beyond the bound is
    passed over. ``df`` is read three times: it should be a written table, or narrow.
    """
    rows = df.count()
    if rows <= most:
        return df
    buckets = 64 * -(-rows // most)
    bucket = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(buckets))
    near = df.select(bucket.alias("b")).filter("b < 256").groupBy("b").count()
    chosen, held = [], 0
    for b, n in sorted(map(tuple, near.collect())):
        if held + n <= most:
            chosen.append(b)
            held += n
    return df.filter(bucket.isin(chosen))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any case: longer than all of them."""
    longest = max((len(c) for c in df.columns), default=0)
    return ["_" * (longest + 1) + n for n in names]
