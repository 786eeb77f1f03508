"""Python code on Spark's workers: shipping this package and mapping Arrow batches."""

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: its sources go to them once, through Spark."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="obsengine-code-")) / "obsengine_code.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(_PACKAGE.rglob("*.py")):
            files.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """``mapInArrow`` with this package importable on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
