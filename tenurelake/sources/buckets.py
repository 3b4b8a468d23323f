"""The keys that a large table already holds, bucketed, so that a load finds its new rows without
shuffling what was loaded before.

The keys lie in a bucketed Parquet table beside the data. An anti-join against it shuffles the batch to
the buckets and reads the keys as they lie. Files are sorted, and a batch reads only row groups within
the range of its own keys: where keys grow, as ids do, history is skipped by its statistics.

Keep at least as many buckets as ``spark.sql.shuffle.partitions``, or Spark prefers to shuffle both sides.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F


class KeyBuckets:
    """Keys of one column under ``path``. Every session sees the same keys; the number of buckets is
    that of the first one and must be given again if it is not the session's number of partitions."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "bigint", buckets: int | None = None):
        self.spark, self.path, self.key, self.kind = spark, path, key, kind
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"keys_{zlib.crc32(path.encode()):08x}_{len(path)}"
        spark.sql(
            f"create table if not exists {self.table} (`{key}` {kind}) using parquet"
            f" clustered by (`{key}`) sorted by (`{key}`) into {self.buckets} buckets location '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, keys: DataFrame) -> None:
        """Adds keys, whose files hold only them; NULL is never a key."""
        told = keys.select(F.col(self.key).cast(self.kind).alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()
        # one task a bucket, or every task would write a file for each
        told.repartition(self.buckets, self.key).write.format("parquet").mode("append").bucketBy(
            self.buckets, self.key).sortBy(self.key).option("path", self.path).saveAsTable(self.table)

    def new(self, rows: DataFrame) -> DataFrame:
        """The ``rows`` whose key is not among the keys; a NULL key never is."""
        key = F.col(self.key)
        span = rows.agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi")).first()
        held = self.read().filter(key.between(F.lit(span["lo"]).cast(self.kind), F.lit(span["hi"]).cast(self.kind)))
        known = held.select(key.alias("_held"))
        return rows.join(known, rows[self.key].cast(self.kind) == F.col("_held"), "left_anti")
