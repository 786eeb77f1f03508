"""Row differences of two snapshots."""

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.operators.tablediff.align import align_rows
from obsengine.operators.tablediff.columns import ColumnChange, column_changes
from obsengine.operators.tablediff.digests import unequal_rows
from obsengine.operators.tablediff.equality import Equality

# Action markers.
INSERT, DELETE, UPDATE, ADDED_CELLS, CONFLICT = "+++", "---", "->", "+", "!->"

ACTS = {"insert": INSERT, "delete": DELETE, "update": UPDATE, "column": ADDED_CELLS}

KEY_TEXT = "_key"


class TablesDiffer(AssertionError):
    """Two tables expected to be equal are not."""


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def names_where(tests: Mapping[str, Column]) -> Column:
    """Array of the names whose test holds."""
    if not tests:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))


def with_listed(diff: DataFrame, *columns: str) -> DataFrame:
    """Arrays of names as one text, joined by commas: for display only."""
    return diff.withColumns({c: F.array_join(c, ",") for c in columns or ("changed",)})


def check_names(columns: Sequence[str]) -> None:
    """A difference names its cells after side and column; two must not end up alike."""
    twice = sorted({c for c in columns if columns.count(c) > 1})
    if twice:
        raise ValueError(f"columns {twice} of the difference have the same name; rename the table's")


def renamed(df: DataFrame, renames: Mapping[str, str] | None) -> DataFrame:
    return df.withColumnsRenamed(dict(renames or {}))


def _aligned(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    equality: Equality,
    text_keys: bool,
    keys_unique: bool,
) -> tuple[DataFrame, list[str]]:
    """Pairs of rows (``old``, ``new``), and the columns whose cells are compared."""
    names = list(dict.fromkeys([*right.columns, *left.columns]))
    if not text_keys:
        rows = align_rows({"old": left, "new": right}, keys, keys_unique)
        return rows, [n for n in names if n not in keys]
    sides = {
        side: df.withColumn(KEY_TEXT, equality.key_text(keys))
        for side, df in {"old": left, "new": right}.items()
    }
    return align_rows(sides, [KEY_TEXT], keys_unique), names


def diff_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ignore: Sequence[str] = (),
    equality: Equality = Equality(),
    acts: Collection[str] = tuple(ACTS),
    renames: Mapping[str, str] | None = None,
    text_keys: bool = False,
    keys_unique: bool = False,
    keep_equal: bool = False,
) -> DataFrame:
    """What turns ``left`` into ``right``: action, keys, old and new cells, ``changed`` columns.

    ``+++`` marks a row only in ``right``, ``---`` one only in ``left``, ``->`` a
    linked pair with a changed cell, ``+`` one that only got data in a new column.
    Keys match null-safe, or with ``text_keys`` as normalised text.  ``keep_equal``
    also returns linked pairs without a change, with an empty action.
    """
    left = renamed(left, renames).drop(*ignore)
    right = right.drop(*ignore)
    rows, data = _aligned(left, right, keys, equality, text_keys, keys_unique)
    return mark_actions(rows, left, right, data, keys, equality, acts, keep_equal)


@dataclass(frozen=True)
class _Verdict:
    """What a pair of rows is: columns by side, the action, and the test of each changed column."""

    old: dict[str, Column]
    new: dict[str, Column]
    action: Column
    changed: dict[str, Column]


def _judge(
    left: DataFrame, right: DataFrame, data: Sequence[str], equality: Equality
) -> _Verdict:
    old_types, new_types = dict(left.dtypes), dict(right.dtypes)
    old = {c: F.col(f"old.`{c}`") for c in old_types}
    new = {c: F.col(f"new.`{c}`") for c in new_types}
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    changed = {
        c: both & ~equality.same(old[c], new[c], old_types[c] == new_types[c])
        for c in data
        if c in old and c in new
    }
    filled = [
        F.coalesce(new[c].cast("string") != "", F.lit(False))
        for c in data
        if c in new and c not in old
    ]
    action = (
        F.when(F.col("old").isNull(), INSERT)
        .when(F.col("new").isNull(), DELETE)
        .when(any_of(list(changed.values())), UPDATE)
        .when(any_of(filled), ADDED_CELLS)
        .otherwise("")
    )
    return _Verdict(old, new, action, changed)


def mark_actions(
    rows: DataFrame,
    left: DataFrame,
    right: DataFrame,
    data: Sequence[str],
    keys: Sequence[str],
    equality: Equality = Equality(),
    acts: Collection[str] = tuple(ACTS),
    keep_equal: bool = False,
) -> DataFrame:
    """Action, keys and cells of aligned pairs with the structs ``old`` and ``new``."""
    found = _judge(left, right, data, equality)
    old, new = found.old, found.new
    kept = [ACTS[a] for a in acts] + ([""] if keep_equal else [])
    cells, names = [], ["action", *keys, "changed"]
    for c in data:
        for side, there in (("old", old), ("new", new)):
            if c in there:
                cells.append(there[c].alias(f"{side}_{c}"))
                names.append(f"{side}_{c}")
    check_names(names)
    key_cells = [F.coalesce(new[k], old[k]).alias(k) for k in keys]
    return rows.select(
        found.action.alias("action"), *key_cells, *cells, names_where(found.changed).alias("changed")
    ).filter(F.col("action").isin(*kept))


def changed_cells(diff: DataFrame) -> DataFrame:
    """Number of changed cells per column."""
    return (
        diff.filter(F.col("action") == UPDATE)
        .select(F.explode("changed").alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("changed_cells"))
    )


def diff_columns(
    diff: DataFrame, changes: Sequence[ColumnChange]
) -> DataFrame:
    """One row per aligned column: marker, types and number of changed cells."""
    listed = diff.sparkSession.createDataFrame(
        [(c.name, c.marker, c.old_type, c.new_type) for c in changes],
        "column_name string, marker string, old_type string, new_type string",
    )
    counted = listed.join(changed_cells(diff), "column_name", "left")
    return counted.fillna(0, ["changed_cells"])


def diff_summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ignore: Sequence[str] = (),
    equality: Equality = Equality(),
    acts: Collection[str] = tuple(ACTS),
    renames: Mapping[str, str] | None = None,
    text_keys: bool = False,
    keys_unique: bool = False,
) -> DataFrame:
    """One row of row, column and cell counts, and whether the tables differ.

    Sizes and differences are counted in one pass over the aligned rows.
    """
    changes = column_changes(left, right, renames, ignore)
    a, b = renamed(left, renames).drop(*ignore), right.drop(*ignore)
    rows, data = _aligned(a, b, keys, equality, text_keys, keys_unique)
    return _counted(rows, a, b, data, changes, equality, acts, (len(left.columns), len(right.columns)))


def _counted(
    rows: DataFrame,
    left: DataFrame,
    right: DataFrame,
    data: Sequence[str],
    changes: Sequence[ColumnChange],
    equality: Equality,
    acts: Collection[str],
    widths: tuple[int, int],
    equal_rows: int = 0,
) -> DataFrame:
    """The summary of aligned rows; ``equal_rows`` more on either side are known to be equal."""
    found = _judge(left, right, data, equality)
    judged = rows.select(
        F.col("old").isNotNull().alias("_old"),
        F.col("new").isNotNull().alias("_new"),
        F.when(found.action.isin(*[ACTS[a] for a in acts]), found.action).alias("_action"),
        names_where(found.changed).alias("_changed"),
    )
    action = F.col("_action")
    common = [c.name for c in changes if c.old is not None and c.new is not None]
    # A changed cell counts where its row does.
    updated = [
        F.coalesce(F.max((action.isNotNull() & F.array_contains("_changed", c)).cast("int")), F.lit(0))
        for c in common
    ]
    summed = judged.agg(
        F.count_if(action == INSERT).alias("row_inserts"),
        F.count_if(action == DELETE).alias("row_deletes"),
        F.count_if(action == UPDATE).alias("row_updates"),
        reduce(lambda a, b: a + b, updated, F.lit(0)).cast("bigint").alias("col_updates"),
        (F.count_if("_old") + equal_rows).alias("row_count_initial"),
        (F.count_if("_new") + equal_rows).alias("row_count_final"),
    )
    columns = {
        "col_inserts": sum(c.old is None for c in changes),
        "col_deletes": sum(c.new is None for c in changes),
        "col_renames": sum(c.old is not None and c.new not in (None, c.old) for c in changes),
        "col_reorders": sum(c.moved for c in changes),
        "col_type_changes": sum(
            None not in (c.old, c.new) and c.old_type != c.new_type for c in changes
        ),
        "col_count_initial": widths[0],
        "col_count_final": widths[1],
    }
    for name, count in columns.items():
        summed = summed.withColumn(name, F.lit(count).cast("bigint"))
    counted = ["row_inserts", "row_deletes", "row_updates", "col_updates"]
    counted += [name for name in columns if not name.startswith("col_count")]
    different = reduce(lambda a, b: a + b, [F.col(n) for n in counted]) > 0
    return summed.withColumn("different", different)


def unequal_summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ignore: Sequence[str] = (),
    equality: Equality = Equality(),
    acts: Collection[str] = tuple(ACTS),
    renames: Mapping[str, str] | None = None,
    text_keys: bool = False,
) -> dict | None:
    """The summary of two tables that differ, or None.

    Tables are compared by digests first (see ``unequal_rows``), so equal ones are each read
    once and never joined.  Only rows of keys whose rows are not the same on both sides are
    joined and make the counts of differences; a repeated key with the same rows on both sides
    is no difference here.  Runs jobs.
    """
    changes = column_changes(left, right, renames, ignore)
    a, b = renamed(left, renames).drop(*ignore), right.drop(*ignore)
    rest = unequal_rows(a, b, keys, equality.key_text(keys) if text_keys else None)
    if rest is None:
        if all(c.marker == "" and c.old_type == c.new_type for c in changes):
            return None
        rest = a.limit(0), b.limit(0), a.count()
    rows, data = _aligned(rest[0], rest[1], keys, equality, text_keys, keys_unique=False)
    widths = len(left.columns), len(right.columns)
    counts = _counted(rows, a, b, data, changes, equality, acts, widths, rest[2]).first().asDict()
    return counts if counts["different"] else None


def assert_no_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> None:
    """Raise ``TablesDiffer`` with the summary if the tables differ, as ``unequal_summary`` finds."""
    summary = unequal_summary(left, right, keys, **options)
    if summary is not None:
        raise TablesDiffer(str(summary))
