"""Applying a row difference to a table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.operators.tablediff.columns import ColumnChange
from obsengine.operators.tablediff.compare import ADDED_CELLS, DELETE, INSERT, UPDATE

# Fixed value: action of a row that describes a column.
SCHEMA = "!"


def with_schema_rows(diff: DataFrame, columns: Sequence[ColumnChange]) -> DataFrame:
    """A difference that carries its column changes, so that it can be stored and applied alone.

    Each added, dropped or renamed column is a row of its own with the action ``!``; ``changed``
    holds the old and new name and the old and new type, NULL where a side lacks the column, and
    the other cells are NULL.
    """
    said = [
        F.array(*[F.lit(v).cast("string") for v in (c.old, c.new, c.old_type, c.new_type)])
        for c in columns
        if c.old != c.new
    ]
    if not said:
        return diff
    cells = {"action": F.lit(SCHEMA), "changed": F.col("_said")}
    described = diff.sparkSession.range(1).select(F.explode(F.array(*said)).alias("_said"))
    return diff.unionByName(
        described.select(
            *[cells.get(n, F.lit(None)).cast(t).alias(n) for n, t in diff.dtypes]
        )
    )


def schema_rows(patch: DataFrame) -> list[ColumnChange]:
    """The column changes that a difference carries.  Runs a job that returns a row a column."""
    found = patch.filter(F.col("action") == SCHEMA).select("changed").collect()
    return sorted((ColumnChange(*r.changed) for r in found), key=lambda c: c.name)


def apply_patch(
    table: DataFrame,
    patch: DataFrame,
    keys: Sequence[str],
    columns: Sequence[ColumnChange] | None = (),
) -> DataFrame:
    """The table after a difference made by ``diff_rows``.

    Deletes and updates apply where the key and all old cells of the patch row
    match; conflicting rows of a three-way difference are skipped.  A difference by key text
    has old and new key cells: the old ones find the row, whose key becomes the new one.  ``columns``
    adds, drops and renames columns; None takes them from the patch's own schema rows
    (``with_schema_rows``), which are skipped otherwise.  Both kinds of change find their rows in one
    join, so the table is shuffled once, or not at all under a small patch.
    """
    columns = schema_rows(patch) if columns is None else columns
    for change in columns:
        if change.old is not None and change.new not in (None, change.old):
            table = table.withColumnRenamed(change.old, change.new)
    dropped = {c.old for c in columns if c.new is None}
    added = {c.new: c.new_type for c in columns if c.old is None}
    for name, kind in added.items():
        table = table.withColumn(name, F.lit(None).cast(kind))
    shown = [c for c in table.columns if f"old_{c}" in patch.columns]
    renewed = [c for c in table.columns if f"new_{c}" in patch.columns]
    # Equal deletes of repeated rows are one instruction.
    changes = (
        patch.filter(F.col("action").isin(DELETE, UPDATE, ADDED_CELLS))
        .drop("changed")
        .distinct()
        .alias("_p")
    )
    match = [
        F.col(f"_t.`{k}`").eqNullSafe(F.col(f"_p.`{k}`")) for k in keys if k not in shown
    ]
    match += [F.col(f"_t.`{c}`").eqNullSafe(F.col(f"_p.`old_{c}`")) for c in shown]
    action = F.col("_p.action")
    kept = [c for c in table.columns if c not in dropped]
    changed = (
        table.alias("_t")
        .join(changes, reduce(lambda a, b: a & b, match), "left")
        .filter(action.isNull() | (action != DELETE))
        .select(
            *[
                F.when(action.isNotNull(), F.col(f"_p.`new_{c}`"))
                .otherwise(F.col(f"_t.`{c}`"))
                .alias(c)
                if c in renewed
                else F.col(f"_t.`{c}`").alias(c)
                for c in kept
            ]
        )
    )
    types = dict(table.dtypes)
    inserted = patch.filter(F.col("action") == INSERT).select(
        *[
            (F.col(f"new_{c}") if c in renewed else F.col(c) if c in keys else F.lit(None))
            .cast(types[c])
            .alias(c)
            for c in kept
        ]
    )
    return changed.unionByName(inserted)
