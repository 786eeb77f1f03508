"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch is a table of changes.  An insert adds a count, a delete withdraws one, a revision
withdraws the old count and adds the new one.  Each batch is added up to one small table of
signed totals and written once under its id; the totals are the sum over all batches.  A batch
counts from the moment its folder has the marker of a finished write; one whose id is already
committed is not applied again, and files of one that failed half-way are neither read nor
folded, so a batch may be repeated at will.  ``compact`` folds committed batches
into one table and keeps their ids.

Defined results: null sources, languages and versions are groups of their own; null counts
count as 0; an unknown kind of change raises an error; groups whose documents are all withdrawn
disappear; an empty batch commits and changes nothing; repeated rows of a batch each count.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ["source", "lang", "version"]
_CHANGE = "op string, source string, lang string, version string, n_tokens long, old_tokens long"
_DELTA = "batch string, source string, lang string, version string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Signed ``n_docs`` and ``n_tokens`` by group.

    ``changes`` has ``op`` (insert, delete, revise), the group, ``n_tokens`` (the new count) and
    ``old_tokens`` (the count withdrawn by a delete or revision).
    """
    op = F.col("op")
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null"))))
    docs = (
        F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0)
        .otherwise(unknown.cast("int"))
    )
    tokens = F.when(op == "insert", new).when(op == "delete", -old).otherwise(new - old)
    return changes.groupBy(*GROUP).agg(
        F.sum(docs).alias("n_docs"), F.sum(tokens).alias("n_tokens")
    )


class TokenRollup:
    """Totals in one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self._spark._jsc.hadoopConfiguration()
        return target.getFileSystem(conf).exists(target)

    def _path(self, batch: str) -> str:
        return f"{self._folder}/deltas/{batch.encode().hex()}"

    def committed(self, batch: str) -> bool:
        """Whether a batch counts already, by itself or inside a compacted table."""
        if self._exists(f"{self._path(batch)}/_SUCCESS"):
            return True
        folded = self._folded()
        return folded is not None and bool(folded[1].where(F.col("batch") == batch).head(1))

    def _folded(self) -> tuple[DataFrame, DataFrame] | None:
        """The newest compacted totals, and the ids of the batches inside."""
        number = 0
        while self._exists(f"{self._folder}/folded/{number + 1}/batches/_SUCCESS"):
            number += 1
        if not number:
            return None
        base = f"{self._folder}/folded/{number}"
        return self._spark.read.parquet(f"{base}/totals"), self._spark.read.parquet(
            f"{base}/batches"
        )

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False when it was committed before."""
        if self.committed(batch):
            return False
        delta = signed(changes).select(F.lit(batch).alias("batch"), *GROUP, "n_docs", "n_tokens")
        delta.write.mode("overwrite").parquet(self._path(batch))
        return True

    def _committed(self) -> list[str]:
        """Folders of the batches that were written to the end, a name a batch."""
        base = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/deltas")
        files = base.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not files.exists(base):
            return []
        names = sorted(f.getPath().getName() for f in files.listStatus(base) if f.isDirectory())
        folders = [f"{self._folder}/deltas/{name}" for name in names]
        return [folder for folder in folders if self._exists(f"{folder}/_SUCCESS")]

    def _deltas(self, folders: list[str]) -> DataFrame:
        """Signed totals of the batches in ``folders`` that are not compacted yet."""
        if not folders:
            return self._spark.createDataFrame([], _DELTA)
        found = self._spark.read.schema(_DELTA).parquet(*folders)
        folded = self._folded()
        return found if folded is None else found.join(folded[1], "batch", "left_anti")

    def _summed(self, folders: list[str]) -> DataFrame:
        columns = [*GROUP, "n_docs", "n_tokens"]
        rows = self._deltas(folders).select(*columns)
        folded = self._folded()
        if folded is not None:
            rows = rows.union(folded[0].select(*columns))
        return (
            rows.groupBy(*GROUP)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0 or n_tokens <> 0")
        )

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``version``, ``n_docs`` and ``n_tokens`` of all live documents."""
        return self._summed(self._committed())

    def compact(self) -> None:
        """Fold all committed batches into one table of totals and drop their folders.

        The batches are listed once, so one that commits meanwhile is left for the next time.
        The ids of the folded batches are written last, which is what makes the new table count;
        only then are the folders dropped, so a failure in between changes no total.  Folders of
        unfinished batches stay for their repeat.
        """
        number = 1
        while self._exists(f"{self._folder}/folded/{number}/batches/_SUCCESS"):
            number += 1
        gone = self._committed()
        names = [(bytes.fromhex(folder.rpartition("/")[2]).decode(),) for folder in gone]
        batches = self._spark.createDataFrame(names, "batch string")  # a row a batch
        folded = self._folded()
        if folded is not None:
            batches = batches.union(folded[1]).distinct()
        base = f"{self._folder}/folded/{number}"
        self._summed(gone).write.mode("overwrite").parquet(f"{base}/totals")
        batches.write.mode("overwrite").parquet(f"{base}/batches")
        for path in gone:
            target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(target, True)
