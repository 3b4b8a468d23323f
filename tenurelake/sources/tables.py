"""Reading and writing warehouse tables and feeds."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenurelake import schemas
from tenurelake.sources import folders

# Columns a table is laid out by: directories for the values most queries filter on.
PARTITIONS = {"fact_performance_reviews": ["review_year"], "performance_reviews": ["review_year"]}
# and the order of rows inside files, so that min/max statistics can skip row groups
CLUSTERED = {"dim_employee": ["employee_id"], "employees": ["employee_id"],
             "fact_performance_reviews": ["employee_id"], "performance_reviews": ["employee_id"],
             "project_assignments": ["project_id"], "salary_history": ["employee_id"]}
MAX_ROWS_PER_FILE = 5_000_000
ADDED = "_append"  # numbers the folders of appended rows


class Warehouse:
    """Parquet tables under one root folder, each in numbered versions ``v00000001``, ….

    A table's content is its newest version that carries Spark's success marker, so a replacement
    appears whole or not at all, and readers of the version before are not disturbed. Rows that will
    never change again can be archived: they are written once, next to the versions, and become
    visible together with the version that archived them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _numbered(self, folder: str, complete: bool, named: str = r"v(\d+)") -> list[int]:
        return folders.numbered(self.spark, folder, named, complete)

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:08d}"

    def _archive(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/archive/v{version:08d}"

    def _added(self, name: str, version: int) -> str:
        return f"{self._path(name, version)}.added"

    def exists(self, name: str) -> bool:
        return bool(self._numbered(f"{self.root}/{name}", True))

    def _load(self, name: str, *paths: str, base: str | None = None) -> DataFrame:
        reader = self.spark.read.option("basePath", base) if base else self.spark.read
        if name not in schemas.TABLES:
            return reader.parquet(*paths).drop(ADDED)
        # the declared schema: no file is opened to find it, and folders without rows are read too
        df = reader.schema(schemas.struct_of(name)).parquet(*paths)
        return schemas.conform(df, name)  # partition columns come back last

    def read_live(self, name: str) -> DataFrame:
        """The rows of the newest version, without the archive."""
        versions = self._numbered(f"{self.root}/{name}", True)
        if not versions:
            return self.spark.createDataFrame([], schemas.struct_of(name))
        live, added = self._load(name, self._path(name, versions[-1])), self._added(name, versions[-1])
        more = [f"{added}/{ADDED}={k}" for k in self._numbered(added, True, rf"{ADDED}=(\d+)")]
        # one scan for all that was appended
        return live.unionByName(self._load(name, *more, base=added)) if more else live

    def read(self, name: str) -> DataFrame:
        """The whole table, or an empty one of its declared schema if it was never written."""
        live, held = self.read_live(name), self._archives(name)
        # one scan for all archive folders, however many nights there were
        return live.unionByName(self._load(name, *[self._archive(name, v) for v in held])) if held else live

    def _archives(self, name: str) -> list[int]:
        """Archives that belong to the table; one without its version is what a failed replacement left."""
        since, versions = self._retired(name), set(self._numbered(f"{self.root}/{name}", True))
        return [v for v in self._numbered(f"{self.root}/{name}/archive", True) if v >= since and v in versions]

    def _state(self, name: str) -> str:
        """The folders that the table consists of; any write changes them."""
        newest = self._numbered(f"{self.root}/{name}", True)[-1:]
        added = [k for v in newest for k in self._numbered(self._added(name, v), True, rf"{ADDED}=(\d+)")]
        return f"{newest} {added} {self._archives(name)}"

    def rows(self, name: str) -> int:
        """How many rows the table has: as noted, or counted if it was written to since."""
        state, kept = self._state(name), f"{self.root}/{name}/rows"
        if folders.exists(self.spark, f"{kept}/_SUCCESS"):
            noted = self.spark.read.schema("state string, n bigint").parquet(kept).first()
            if noted and noted["state"] == state:
                return noted["n"]
        return self.read(name).count()

    def note_rows(self, name: str, n: int) -> None:
        """Notes how many rows the table has as it is now, for ``rows``."""
        self.spark.createDataFrame([(self._state(name), n)], "state string, n bigint").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/{name}/rows")

    def _retired(self, name: str) -> int:
        """The newest complete version that replaced the whole table, archive included."""
        versions = self._numbered(f"{self.root}/{name}", True)
        whole = self._numbered(f"{self.root}/{name}/whole", True)
        return max([v for v in whole if v in versions], default=0)

    def _write(self, df: DataFrame, name: str, path: str, mode: str) -> None:
        parts, order = PARTITIONS.get(name, []), CLUSTERED.get(name, [])
        if parts:
            # as many tasks a partition value as its size asks for, so files do not multiply by tasks
            df = df.hint("rebalance", *parts)
        self._put(df, name, path, mode, [*parts, *order])

    def _put(self, df: DataFrame, name: str, path: str, mode: str, order: list[str]) -> None:
        if order:
            df = df.sortWithinPartitions(*order)
        writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        if name in PARTITIONS:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.parquet(path)

    def append(self, df: DataFrame, name: str) -> None:
        """Adds rows to the newest version, all or none: they appear with the success marker of their own
        folder. Nothing already written is read or moved."""
        versions = self._numbered(f"{self.root}/{name}", True)
        if not versions:
            return self.replace(df, name)
        added = self._added(name, versions[-1])
        taken = self._numbered(added, False, rf"{ADDED}=(\d+)")
        self._write(df, name, f"{added}/{ADDED}={(taken[-1] if taken else 0) + 1}", "errorifexists")

    def compact(self, name: str, files: int | None = None) -> None:
        """Writes the newest version anew with what was appended to it, ranged over its partition values
        and cluster columns, so that a file holds few of their values and a look-up opens few files.

        Rows of one value may fill several files. Ranges are drawn from a sample of the stored rows;
        ``files`` is how many there should be (by size, if not given).
        """
        df, order = self.read_live(name), [*PARTITIONS.get(name, []), *CLUSTERED.get(name, [])]
        if order:
            keys = [*order, F.xxhash64(*df.columns)]  # the hash splits a value that fills many files
            df = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        taken = self._numbered(f"{self.root}/{name}", False)
        self._put(df, name, self._path(name, (taken[-1] if taken else 0) + 1), "errorifexists", order)

    def replace_whole(self, df: DataFrame, name: str) -> None:
        """Writes ``df``, the whole table with its closed rows, as the next version; archives written
        before are no longer part of the table. ``df`` may read the current table."""
        taken = self._numbered(f"{self.root}/{name}", False)
        version = (taken[-1] if taken else 0) + 1
        # takes effect only once the version itself is complete
        mark = f"{self.root}/{name}/whole/v{version:08d}"
        self.spark.range(1).write.mode("overwrite").parquet(mark)
        self._write(df, name, self._path(name, version), "errorifexists")

    def replace(self, df: DataFrame, name: str, archive: DataFrame | None = None) -> None:
        """Writes ``df`` as the next version, and ``archive`` as rows that version leaves behind.
        Both may read the current version. Use ``replace_whole`` for a frame that holds the archive."""
        taken = self._numbered(f"{self.root}/{name}", False)
        version = (taken[-1] if taken else 0) + 1
        if archive is not None:  # overwrites what a failed run may have left under this number
            self._write(archive, name, self._archive(name, version), "overwrite")
        self._write(df, name, self._path(name, version), "errorifexists")


    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        """Removes what no reader needs that began with one of the ``keep`` newest versions: older versions
        with what was appended to them, what failed writes left, and archives that a later version replaced.
        Returns the folders removed.

        The table reads the same before and after. Do not run it beside a writer of the same table: a
        version that is still being written looks like one that failed. A removal that breaks off can be repeated.
        """
        if keep < 1:
            raise ValueError("the newest version is the table: keep at least 1")
        home = f"{self.root}/{name}"
        versions = self._numbered(home, True)
        if not versions:
            return []
        oldest = versions[-keep:][0]
        whole = [v for v in self._numbered(f"{home}/whole", True) if v in versions and v <= oldest]
        since = whole[-1] if whole else 0
        archives = self._numbered(f"{home}/archive", False)
        lost = [v for v in archives if v < since or (v < versions[-1] and v not in versions)]
        gone = [self._archive(name, v) for v in lost]  # first, as older marks hide them
        # the marker of a version stays where it says that an archive counts
        marked = [v for v in archives if v not in lost and v < oldest]
        failed = [v for v in self._numbered(home, False) if v < versions[-1] and v not in versions]
        old = [v for v in versions if v < oldest]
        gone += [self._path(name, v) for v in [*failed, *old] if v not in marked]
        gone += [f"{home}/whole/v{v:08d}" for v in self._numbered(f"{home}/whole", False) if v < since]
        gone += [self._added(name, v) for v in self._numbered(home, False, r"v(\d+)\.added") if v < oldest]
        removed = [folder for folder in gone if folders.remove(self.spark, folder)]
        for v in marked:
            folders.empty(self.spark, self._path(name, v))
        return removed


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for every first line that files of ``path`` have."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"), F.col("value"),
    )
    firsts = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("line"))
    found = firsts.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line")
    return [(next(csv.reader([r["line"]]), []), r["files"]) for r in found.collect()]


def read_feed_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(the wanted columns of a feed as texts, the lines that do not fit their file's header).

    Columns are found by the names in each file's own header, in any order and among others; one that a
    file lacks is NULL there. Files with one header are read in one scan. Quotes inside quoted values
    are doubled. A malformed line is whole in ``_corrupt_record``. No file gives no rows.
    """
    wanted, broken = [], []
    for names, files in _headers(spark, path):
        reader = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
        ddl = ", ".join("`" + c.replace("`", "``") + "` string" for c in [*names, "_corrupt_record"])
        lines = reader.schema(ddl).option("columnNameOfCorruptRecord", "_corrupt_record").csv(files)
        fits = F.col("_corrupt_record").isNull()
        column = lambda c: F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c)  # noqa: E731, B023
        wanted.append(lines.filter(fits).select(*map(column, columns)))
        # Spark refuses to parse a file for that column alone, so the filter names another one as well
        told = ~fits & (F.length(F.concat_ws("", F.col(f"`{names[0]}`"), "_corrupt_record")) >= 0)
        broken.append(lines.filter(told).select(*map(column, columns), "_corrupt_record"))
    if not wanted:
        empty = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([], empty), spark.createDataFrame([], f"{empty}, _corrupt_record string")
    return reduce(DataFrame.unionByName, wanted), reduce(DataFrame.unionByName, broken)


def write_feed_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def seed_departments(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        schemas.SEED_DEPARTMENTS, "department_id int, department_name string, location string"
    )
    return rows.withColumn("created_at", F.lit(None).cast("timestamp"))
