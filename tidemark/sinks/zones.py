"""Zone writers, and the split into valid and bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rules import is_valid
from tidemark.session import write_through
from tidemark.sources.zones import ZONES


#: Rows in one file of a JSON zone. A packed file is read by one task, whatever its size.
ROWS_PER_FILE = 200_000


def write_zone(df: DataFrame, zone: str, path: str, mode: str = "append", packed: str = "snappy") -> None:
    """Envelopes as files of the zone. JSON lines are packed, by snappy or by gzip, which takes
    less room and more work; readers undo it by the files' names."""
    kind = ZONES[zone][0]
    writer = df.write.mode(mode).format(kind)
    if kind == "json":
        writer = writer.options(compression=packed, maxRecordsPerFile=ROWS_PER_FILE)
    writer.save(path)


def write_split(
    checked: DataFrame, good_path: str, bad_path: str, mode: str = "append"
) -> None:
    """Valid rows to one folder, bad rows with their reasons to another.

    The rows are checked once: the result is written to the shared folder by
    outcome, and each folder is filled from its own half.
    """
    staged = write_through(
        checked.withColumn("_valid", is_valid()), "checked", partition_by=("_valid",)
    )
    good = staged.filter("_valid").drop("_valid", "reasons")
    bad = staged.filter(~F.col("_valid")).drop("_valid")
    good.write.mode(mode).parquet(good_path)
    bad.write.mode(mode).parquet(bad_path)
