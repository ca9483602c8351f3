"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Existing keys were hashed with these.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the columns as text; NULL hashes as a placeholder, so it has a key too."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(
        F.concat_ws(
            SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_PLACEHOLDER)) for p in parts]
        )
    )
