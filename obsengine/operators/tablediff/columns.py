"""Column differences of two tables."""

from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ColumnChange:
    """One aligned column; ``old`` or ``new`` is None where the side lacks it."""

    old: str | None
    new: str | None
    old_type: str | None
    new_type: str | None
    moved: bool = False

    @property
    def name(self) -> str:
        return self.new if self.new is not None else self.old

    @property
    def marker(self) -> str:
        """Fixed values: '+++' added, '---' dropped, '(old)' renamed, ':' moved."""
        if self.old is None:
            return "+++"
        if self.new is None:
            return "---"
        renamed = f"({self.old})" if self.old != self.new else ""
        return (":" if self.moved else "") + renamed


def column_changes(
    left: DataFrame,
    right: DataFrame,
    renames: Mapping[str, str] | None = None,
    ignore: Sequence[str] = (),
) -> list[ColumnChange]:
    """Columns of both tables aligned by name, in the order of ``right`` then dropped ones.

    ``renames`` maps old to new names.  Among the common columns the fewest that
    explain the new order count as moved.
    """
    renames = dict(renames or {})
    old_types, new_types = dict(left.dtypes), dict(right.dtypes)
    old_of = {renames.get(name, name): name for name in left.columns}
    common = [c for c in right.columns if c in old_of and c not in ignore]
    position = {renames.get(name, name): at for at, name in enumerate(left.columns)}
    steady = _longest_rising(common, position)
    changes = [
        ColumnChange(old_of[c], c, old_types[old_of[c]], new_types[c], c not in steady)
        if c in old_of
        else ColumnChange(None, c, None, new_types[c])
        for c in right.columns
        if c not in ignore
    ]
    dropped = [c for c in left.columns if renames.get(c, c) not in new_types and c not in ignore]
    return changes + [ColumnChange(c, None, old_types[c], None) for c in dropped]


def _longest_rising(names: list[str], position: dict[str, int]) -> set[str]:
    """Names of a longest run whose old positions rise."""
    ends: list[int] = []
    chains: list[list[str]] = []
    for name in names:
        at = bisect_left(ends, position[name])
        chain = [*(chains[at - 1] if at else []), name]
        if at == len(ends):
            ends.append(position[name])
            chains.append(chain)
        else:
            ends[at], chains[at] = position[name], chain
    return set(chains[-1]) if chains else set()
