"""Stored tables that are changed in place, one block of keys at a time.

Rows lie in folders by the upper bits of a whole-number key. A change reads the folders its keys fall
into, works out their rows anew and puts them back by Spark's dynamic partition overwrite; all other
files stay as they are. A folder is replaced when the job commits, so a failed job leaves the table as it
was; readers during a commit may see some folders before others. Where that matters, use versions
(``tables.Warehouse``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenurelake.operators import ingest, scale
from tenurelake.session import checkpointed
from tenurelake.sources import folders

BITS, BLOCK = "_bits", "_block"
FOLDERS = 512  # a table is created with about this many blocks at most, whatever its size


class BlockTable:
    """A Parquet table under ``path``, in blocks of 2^``bits`` values of ``key`` or more; NULL keys have a block.

    Where blocks of that width would be more than ``FOLDERS``, the table is created with wider ones, as each
    folder costs files to open, write and commit. Its folders tell the width, and later changes keep it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, bits: int = 16):
        self.spark, self.path, self.key, self.bits = spark, path, key, bits

    def _block(self, bits: int) -> Column:
        return F.shiftright(F.col(self.key).cast("bigint"), bits)

    def _put(self, df: DataFrame, mode: str, bits: int) -> None:
        blocked = df.withColumn(BLOCK, self._block(bits)).hint("rebalance", BLOCK).sortWithinPartitions(BLOCK, self.key)
        laid = blocked.withColumn(BITS, F.lit(bits)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        laid.partitionBy(BITS, BLOCK).parquet(self.path)

    def _fitting(self, df: DataFrame) -> int:
        """The least width, ``bits`` or more, with about ``FOLDERS`` blocks at most."""
        blocks = df.select(self._block(self.bits).alias(BLOCK)).distinct()
        wider = range(64 - self.bits)
        counts = blocks.agg(*[F.approx_count_distinct(F.shiftright(BLOCK, k)) for k in wider]).first()
        return self.bits + next((k for k in wider if counts[k] <= FOLDERS), wider[-1])

    def _width(self) -> int:
        """The width that the table was created with."""
        held = folders.numbered(self.spark, self.path, rf"{BITS}=(\d+)")
        if not held:
            raise ValueError(f"no table of blocks under {self.path}")
        return held[0]

    def create(self, df: DataFrame) -> None:
        df = checkpointed(df)  # looked at for the width of its blocks, then written
        self._put(df, "errorifexists", self._fitting(df))

    def read(self) -> DataFrame:
        return self._stored().drop(BITS, BLOCK)

    def _stored(self) -> DataFrame:
        # the block is declared, so that no value of a folder name decides its type
        held = self.spark.read.parquet(self.path)
        return held.withColumn(BLOCK, F.col(BLOCK).cast("bigint"))

    def change(self, keys: DataFrame, work: Callable[[DataFrame], DataFrame]) -> None:
        """Replaces the blocks that ``keys`` (a column named as the key) fall into by ``work`` of their rows."""
        bits = self._width()
        block = self._block(bits).alias(BLOCK)
        touched = checkpointed(keys.select(block).distinct())
        held = scale.null_safe_join(self._stored(), scale.small(touched), [BLOCK], "left_semi").drop(BITS, BLOCK)
        after = checkpointed(work(held))  # it is read from the files that it replaces
        self._put(after, "overwrite", bits)
        emptied = scale.null_safe_join(touched, after.select(block).distinct(), [BLOCK], "left_anti")
        self._remove([r[BLOCK] for r in emptied.toLocalIterator()], bits)

    def _remove(self, blocks: list[int | None], bits: int) -> None:
        """An overwrite leaves a folder alone for which there are no rows any more."""
        jvm = self.spark._jvm
        for block in blocks:
            name = "__HIVE_DEFAULT_PARTITION__" if block is None else block
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BITS}={bits}/{BLOCK}={name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.spark.catalog.refreshByPath(self.path)

    def upsert(
        self, new: DataFrame, keys: list[str], update: list[str], order: list[str], insert: list[str] | None = None
    ) -> None:
        """``ingest.upsert`` on the blocks of the batch; ``keys`` hold the table's key."""
        self.change(new, lambda held: ingest.upsert(new, held, keys, update, order, insert))

    def delete(self, gone: DataFrame, column: str | None = None) -> None:
        """Rows whose key is among ``gone``."""
        gone = gone.select(F.col(column or self.key).alias(self.key)).distinct()
        self.change(gone, lambda held: held.join(gone, self.key, "left_anti").select(*held.columns))
