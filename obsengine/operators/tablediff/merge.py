"""Three-way comparison and merge against a common parent."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.operators.tablediff.align import KEY, align_rows
from obsengine.operators.tablediff.compare import (
    ADDED_CELLS,
    CONFLICT,
    DELETE,
    INSERT,
    UPDATE,
    any_of,
    check_names,
    names_where,
)
from obsengine.operators.tablediff.equality import Equality

_SIDES = ("parent", "local", "remote")


def _there(side: str) -> Column:
    return F.col(side).isNotNull()


def _cell(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name}`")


def align_three(
    parent: DataFrame,
    local: DataFrame,
    remote: DataFrame,
    keys: Sequence[str],
    keys_unique: bool = False,
) -> DataFrame:
    """The key struct and the rows of three tables, which meet only through a parent row."""
    sides = dict(zip(_SIDES, (parent, local, remote)))
    rows = align_rows(sides, keys, keys_unique)
    nothing = {side: F.lit(None).cast(df.schema) for side, df in sides.items()}
    # A key new on both sides is two rows.
    apart = ~_there("parent") & _there("local") & _there("remote")
    whole = F.struct(*[F.col(s).alias(s) for s in _SIDES])
    only = {
        side: F.struct(*[(F.col(s) if s == side else nothing[s]).alias(s) for s in _SIDES])
        for side in ("local", "remote")
    }
    pieces = F.when(apart, F.array(only["local"], only["remote"])).otherwise(F.array(whole))
    return rows.select(KEY, F.explode(pieces).alias("_row")).select(
        KEY, *[F.col(f"_row.{s}").alias(s) for s in _SIDES]
    )


def diff3(
    parent: DataFrame,
    local: DataFrame,
    remote: DataFrame,
    keys: Sequence[str],
    equality: Equality = Equality(),
    keys_unique: bool = False,
) -> DataFrame:
    """What the remote table would do to the local one, both grown from the parent.

    A remote cell equal to the parent's changes nothing; another one is an update
    (``->``), or a conflict (``!->``) when local changed the cell to something else.
    """
    rows = align_three(parent, local, remote, keys, keys_unique)
    in_all = [c for c in parent.columns if c in local.columns and c in remote.columns]
    data = [c for c in in_all if c not in keys]
    added = [c for c in remote.columns if c not in parent.columns]
    based = _there("parent") & _there("remote")
    changed, conflict = {}, {}
    for c in data:
        p, mine, theirs = (_cell(side, c) for side in _SIDES)
        changed[c] = based & ~equality.same(p, theirs)
        conflict[c] = changed[c] & ~equality.same(p, mine) & ~equality.same(theirs, mine)
    filled = [F.coalesce(_cell("remote", c).cast("string") != "", F.lit(False)) for c in added]
    action = (
        F.when(~_there("parent") & ~_there("local"), INSERT)
        .when(_there("parent") & _there("local") & ~_there("remote"), DELETE)
        .when(any_of(list(conflict.values())), CONFLICT)
        .when(any_of(list(changed.values())), UPDATE)
        .when(based & any_of(filled), ADDED_CELLS)
    )
    cells = [_cell(side, c).alias(f"{side}_{c}") for c in data for side in _SIDES]
    cells += [_cell("remote", c).alias(f"remote_{c}") for c in added]
    check_names(
        ["action", "changed", "conflicts", *keys, *(f"remote_{c}" for c in added)]
        + [f"{side}_{c}" for c in data for side in _SIDES]
    )
    return rows.select(
        action.alias("action"),
        *[_cell(KEY, k).alias(k) for k in keys],
        *cells,
        names_where(changed).alias("changed"),
        names_where(conflict).alias("conflicts"),
    ).filter(F.col("action").isNotNull())


def three_way_patch(
    diff: DataFrame, keys: Sequence[str], data: Sequence[str], added: Sequence[str] = ()
) -> DataFrame:
    """A three-way difference as a patch for the local table; conflicting cells stay.

    ``data`` names the compared columns, those of all three tables but the keys, and ``added``
    those that only the remote table has.
    """
    insert = F.col("action") == INSERT
    cells = []
    for c in data:
        taken = F.array_contains("changed", c) & ~F.array_contains("conflicts", c)
        mine, theirs = F.col(f"`local_{c}`"), F.col(f"`remote_{c}`")
        cells.append(mine.alias(f"old_{c}"))
        cells.append(F.when(insert | taken, theirs).otherwise(mine).alias(f"new_{c}"))
    cells += [F.col(f"`remote_{c}`").alias(f"new_{c}") for c in added]
    action = F.when(F.col("action") == CONFLICT, UPDATE).otherwise(F.col("action"))
    return diff.select(
        action.alias("action"), *[F.col(f"`{k}`") for k in keys], *cells, "changed"
    )


def conflict_text(p: Column, mine: Column, theirs: Column) -> Column:
    """Fixed format of a conflicting cell: parent in brackets, local, remote."""

    def text(cell):
        return F.coalesce(cell.cast("string"), F.lit(""))

    return F.concat(
        F.lit("((( "), text(p), F.lit(" ))) "), text(mine), F.lit(" /// "), text(theirs)
    )


def merge3(
    parent: DataFrame,
    local: DataFrame,
    remote: DataFrame,
    keys: Sequence[str],
    keys_unique: bool = False,
) -> DataFrame:
    """Local with the remote changes applied.

    Rows and columns new on either side are kept, those deleted on either side are
    dropped.  A cell both sides changed differently keeps its local value; it is
    listed in ``conflicts`` (column, text) and counted in ``conflict_count``.
    """
    rows = align_three(parent, local, remote, keys, keys_unique)
    linked = _there("parent") & _there("local") & _there("remote")
    kept = linked | ~_there("parent")
    merged, conflicts = [], []
    names = [c for c in local.columns if c in remote.columns or c not in parent.columns]
    names += [c for c in remote.columns if c not in parent.columns and c not in local.columns]
    for c in names:
        if c in keys:
            merged.append(_cell(KEY, c).alias(c))
        elif c not in local.columns:
            merged.append(_cell("remote", c).alias(c))
        elif c not in remote.columns:
            merged.append(_cell("local", c).alias(c))
        elif c not in parent.columns:
            merged.append(F.coalesce(_cell("local", c), _cell("remote", c)).alias(c))
        else:
            p, mine, theirs = (_cell(side, c) for side in _SIDES)
            untouched = p.eqNullSafe(mine)
            value = F.when(linked & untouched, theirs).when(_there("local"), mine)
            merged.append(value.otherwise(theirs).alias(c))
            clash = linked & ~untouched & ~p.eqNullSafe(theirs) & ~mine.eqNullSafe(theirs)
            named = F.struct(
                F.lit(c).alias("column"), conflict_text(p, mine, theirs).alias("text")
            )
            conflicts.append(F.when(clash, named))
    listed = F.array_compact(F.array(*conflicts)).alias("conflicts")
    return (
        rows.filter(kept)
        .select(*merged, listed)
        .withColumn("conflict_count", F.size("conflicts"))
    )


def with_conflict_texts(merged: DataFrame) -> DataFrame:
    """The merged table as text, conflicting cells replaced by their conflict text."""
    by_column = F.map_from_entries("conflicts")
    cells = [c for c in merged.columns if c not in ("conflicts", "conflict_count")]
    return merged.select(
        *[F.coalesce(F.element_at(by_column, c), F.col(c).cast("string")).alias(c) for c in cells],
        "conflict_count",
    )
