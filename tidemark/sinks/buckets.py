"""Facts and dimensions stored by the same hash of their key, so that joining them moves no row.

A key with more rows than one bucket should hold is salted: its fact rows are dealt to
several buckets, and the few dimension rows of such keys are stored once for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import write_through

#: Which part of a hot key a row belongs to; 0 for all other keys.
SALT = "_salt"


def hot_keys(fact: DataFrame, key: str, most_rows: int) -> DataFrame:
    """(key, salts): keys with more than ``most_rows`` rows, and into how many parts each is dealt."""
    counts = fact.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > most_rows).select(key, F.ceil(F.col("n") / most_rows).cast("int").alias("salts"))


def store_buckets(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, fact_name: str, dim_name: str, buckets: int, most_rows: int
) -> None:
    """Store a fact and its dimension as catalog tables with the same buckets, the fact sorted by key and time.

    ``most_rows`` is what a bucket may hold of one key. Rows of the fact without a key are
    dealt to all buckets, and match nothing. The dimension has one row per key.
    """
    spark = fact.sparkSession
    for name in (fact_name, dim_name):
        database = name.rpartition(".")[0]
        if database:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    # At most a row of the fact in ``most_rows`` of them: settled once, for both tables.
    hot = write_through(hot_keys(fact, key, most_rows), "hot-keys")
    numbered = fact.join(hot, key, "left").withColumn("_row", F.monotonically_increasing_id())
    parts = F.when(F.col(f"`{key}`").isNull(), F.lit(buckets)).otherwise(F.coalesce("salts", F.lit(1)))
    salted = numbered.withColumn(SALT, F.pmod(F.col("_row"), parts).cast("int")).drop("salts", "_row")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias(SALT)
    copies = dim.join(hot, key, "left").select(*[f"`{c}`" for c in dim.columns], every)
    for df, name, order in ((salted, fact_name, (key, SALT, ts)), (copies, dim_name, (key, SALT))):
        # By the same hash as the buckets, so that each task writes the one file of its bucket.
        df.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT).sortBy(*order).saveAsTable(name)


def join_buckets(spark: SparkSession, fact_name: str, dim_name: str, key: str, how: str = "left") -> DataFrame:
    """The fact with its dimension. Both lie in the same buckets, so neither is shuffled."""
    return spark.table(fact_name).join(spark.table(dim_name), [key, SALT], how).drop(SALT)
