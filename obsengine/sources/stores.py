"""Where the layers of tables are kept.

A table is replaced without a gap: its rows go to a fresh place, and only when all are written
does the name point there.  A run that fails leaves the table as it was, and a plan may read the
table it replaces.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_POINTER = "current-"


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value together, in even pieces that adaptive execution sizes.

    Without it every task would write a small file into every partition folder.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


@dataclass(frozen=True)
class FolderStore:
    """Parquet folders ``base/layer/name/<version>``, and beside them files that name the version.

    The file with the highest number counts.  It is made under another name and then renamed,
    which fails if a run got there first, so of two runs that replace a table one is an error.
    """

    spark: SparkSession
    base: str

    def _files(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _number(self, folder: str) -> int:
        """Number of the newest version; 0 if the table was never written."""
        files, path = self._files(folder)
        if not files.exists(path):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return max([int(n.removeprefix(_POINTER)) for n in names if n.startswith(_POINTER)], default=0)

    def _version(self, folder: str) -> str | None:
        number = self._number(folder)
        if not number:
            return None
        return self.spark.read.text(f"{folder}/{_POINTER}{number}").first()[0]

    def _point(self, folder: str, version: str, number: int) -> None:
        files, path = self._files(folder)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        made = hadoop.Path(path, f".{version}")
        out = files.create(made, False)
        out.write(bytearray(version.encode()))
        out.close()
        target = hadoop.Path(path, f"{_POINTER}{number}")
        if files.exists(target) or not files.rename(made, target):
            files.delete(made, False)
            raise RuntimeError(f"{folder} was replaced by another run")

    def table(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write a table, replacing an older one, and read it back.

        Plain folders know no buckets, so ``bucket_by`` is left to the catalog store.
        """
        folder = f"{self.base}/{layer}/{name}"
        number = self._number(folder) + 1
        version = uuid.uuid4().hex
        pieces = _gathered(df, partition_by)
        pieces.write.partitionBy(*partition_by).parquet(f"{folder}/{version}")
        self._point(folder, version, number)
        return self._open(folder, version, df)

    def _open(self, folder: str, version: str, like: DataFrame) -> DataFrame:
        found = self.spark.read.schema(like.schema).parquet(f"{folder}/{version}")
        return found.select(*like.columns)

    def read(self, layer: str, name: str) -> DataFrame:
        """The table as it was last written."""
        folder = f"{self.base}/{layer}/{name}"
        version = self._version(folder)
        if version is None:
            raise ValueError(f"{folder} was never written")
        return self.spark.read.parquet(f"{folder}/{version}")

    def drop_old(self, layer: str, name: str) -> int:
        """Delete versions that are not the newest, also of failed runs; returns their number.

        Call it when no plan reads an older version and no run is writing one.
        """
        folder = f"{self.base}/{layer}/{name}"
        current, number = self._version(folder), self._number(folder)
        files, path = self._files(folder)
        kept = {current, f"{_POINTER}{number}"}
        old = [s for s in files.listStatus(path) if s.getPath().getName() not in kept]
        for status in old:
            files.delete(status.getPath(), True)
        return sum(s.isDirectory() for s in old)


@dataclass(frozen=True)
class CatalogStore:
    """Views ``layer.name`` of the session catalog over managed tables ``layer.name__<version>``.

    Tables with ``bucket_by`` are kept in ``buckets`` buckets sorted by these columns, so joins on
    them move no row of theirs; let the number follow the size of the largest such table.
    """

    spark: SparkSession
    buckets: int = 8

    def table(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write a table, replacing an older one, and read it back."""
        self.spark.sql(f"create database if not exists {layer}")
        target = f"{layer}.{name}__{uuid.uuid4().hex}"
        if bucket_by:
            # One task a bucket, or every task would write a file into every bucket.
            placed = df.repartition(self.buckets, *bucket_by)
            writer = placed.write.bucketBy(self.buckets, *bucket_by).sortBy(*bucket_by)
        else:
            writer = _gathered(df, partition_by).write
        writer.format("parquet").partitionBy(*partition_by).saveAsTable(target)
        self.spark.sql(f"create or replace view {layer}.{name} as select * from {target}")
        return self.spark.table(target).select(*df.columns)

    def drop_old(self, layer: str, name: str) -> int:
        """Drop versions that the view does not show; returns their number.

        Call it when no plan reads an older version and no run is writing one.
        """
        shown = self.spark.sql(f"show create table {layer}.{name}").first()[0]
        tables = self.spark.sql(f"show tables in {layer} like '{name}__*'").collect()
        old = [r.tableName for r in tables if r.tableName.startswith(f"{name}__") and r.tableName not in shown]
        for table in old:
            self.spark.sql(f"drop table {layer}.{table}")
        return len(old)


def view(name: str, df: DataFrame) -> DataFrame:
    """Register a lazy table under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
