"""Text tables by file extension."""

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Cell separator by extension.
SEPARATORS = {"csv": ",", "tsv": "\t", "ssv": ";", "psv": "\U0001f4a9"}

# NULL, empty text and outer blanks survive a round trip.
_DELIMITED = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def extension(path: str) -> str:
    return PurePosixPath(path).suffix.lower().removeprefix(".")


def _kind(path: str, kind: str | None) -> str:
    """The format the caller names, else that of the extension."""
    found = kind or extension(path)
    if found not in (*SEPARATORS, "json", "ndjson"):
        raise ValueError(f"no table format for {path!r}")
    return found


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    line_breaks: bool = False,
    json_array: bool = False,
    kind: str | None = None,
) -> DataFrame:
    """Read a delimited or JSON table; ``kind`` overrides the extension.

    Without a schema, delimited cells are text and JSON columns are the union of the keys over
    all rows.  Files are split among tasks, so a row is a line: ``.json`` and ``.ndjson`` alike
    hold one object a line, as ``write_table`` writes them.  With ``line_breaks`` delimited
    cells may hold line breaks, and with ``json_array`` a JSON file is one array or value of
    any layout; either makes each file one task.
    """
    kind = _kind(path, kind)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind in SEPARATORS:
        options = {**_DELIMITED, "sep": SEPARATORS[kind], "emptyValue": ""}
        return reader.options(**options, multiLine=line_breaks).csv(path)
    return reader.option("multiLine", json_array).json(path)


def write_table(
    df: DataFrame, path: str, line_breaks: bool = False, kind: str | None = None
) -> str:
    """Write a table; the path must not exist yet and ``kind`` overrides its extension.

    A delimited cell with a line break is an error unless ``line_breaks`` is set, because only
    a reader that is told of it brings such a cell back.
    """
    kind = _kind(path, kind)
    if kind in SEPARATORS:
        if not line_breaks:
            df = df.withColumns(
                {f.name: _one_line(f.name) for f in df.schema if isinstance(f.dataType, StringType)}
            )
        options = {**_DELIMITED, "sep": SEPARATORS[kind]}
        df.write.mode("errorifexists").options(**options).csv(path)
    else:
        df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def _one_line(name: str) -> Column:
    cell = F.col("`" + name.replace("`", "``") + "`")
    error = F.raise_error(F.lit(f"column {name} has a line break; write it with line_breaks=True"))
    return F.when(cell.rlike("[\r\n]"), error.cast("string")).otherwise(cell)


def copy_table(
    spark: SparkSession,
    source: str,
    target: str,
    line_breaks: bool = False,
    json_array: bool = False,
) -> str:
    """Convert a table from one format to another."""
    table = read_table(spark, source, line_breaks=line_breaks, json_array=json_array)
    return write_table(table, target, line_breaks)
