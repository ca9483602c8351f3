"""Envelope zones: raw and cleaned documents as JSON lines, validated ones as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Each zone's format and the name of its time column.
ZONES = {
    "raw": ("json", "ingested_at"),
    "cleaned": ("json", "transformed_at"),
    "validated": ("parquet", "validated_at"),
}


def zone_schema(zone: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("tag_id", T.StringType()),
            T.StructField("source_name", T.StringType()),
            T.StructField(ZONES[zone][1], T.TimestampType()),
            T.StructField("data", T.StringType()),
        ]
    )


def read_zone(spark: SparkSession, zone: str, path: str) -> DataFrame:
    return spark.read.schema(zone_schema(zone)).format(ZONES[zone][0]).load(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_zone(spark, "raw", path)


def register_zone(spark: SparkSession, name: str, zone: str, location: str) -> None:
    """Make a zone folder a catalog table."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in zone_schema(zone))
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {ZONES[zone][0]} "
        f"LOCATION '{location}'"
    )
