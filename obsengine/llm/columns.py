"""Shared column helpers of the text operators."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.llm.workers import map_arrow

Maker = Callable[[Iterator[pa.RecordBatch], int], Iterator[list[pa.Array]]]


def keep_rows_with(
    df: DataFrame, source: str, added: list[tuple[str, str]], maker: Maker
) -> DataFrame:
    """``df`` with columns that ``maker`` derives, batch by batch, from column ``source``.

    ``maker`` gets the task's batches and the position of ``source`` and yields the new arrays
    of each batch.  An added column replaces one of the same name.
    """
    names = {name for name, _ in added}
    kept = [f for f in df.schema.fields if f.name not in names]
    inner = [*kept] if source not in names else [*kept, df.schema[source]]
    fed = df.select(*(F.col(_quoted(f.name)) for f in inner))
    at = [f.name for f in inner].index(source)
    types = [T._parse_datatype_string(kind) for _, kind in added]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in kept]
        + [T.StructField(n, t, True) for (n, _), t in zip(added, types, strict=True)]
    )
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.RecordBatch] = []

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen.append(batch)
                yield batch

        for arrays in maker(watched(), at):
            batch = seen.pop(0)
            columns = [*batch.columns[:width], *arrays]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(fed, run, schema)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor``; a null id counts as the empty text."""
    text = F.coalesce(F.col(_quoted(key)).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def row_digest(key: str, text: str) -> Column:
    """A digest by which rows of equal key and text are one; nulls count as empty."""
    return F.md5(
        F.concat_ws(
            ":",
            F.coalesce(F.col(_quoted(key)).cast("string"), F.lit("")),
            F.coalesce(F.col(_quoted(text)), F.lit("")),
        )
    )
