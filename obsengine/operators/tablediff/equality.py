"""When two cells, or two key texts, count as equal."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key texts that stand for an empty cell, and the text between cells.
EMPTY_TEXTS = ("", "null", "undefined")
KEY_SEPARATOR = " // "


@dataclass(frozen=True)
class Equality:
    """Options for comparing cells; the default is exact and NULL equals only NULL."""

    epsilon: float = 0.0
    ignore_whitespace: bool = False
    ignore_case: bool = False

    def text(self, cell: Column) -> Column:
        out = cell.cast("string")
        if self.ignore_whitespace:
            out = F.regexp_replace(out, r"^\s+|\s+$", "")
        if self.ignore_case:
            out = F.lower(out)
        return out

    def same(self, a: Column, b: Column, alike: bool = True) -> Column:
        """Never NULL.  ``alike=False`` states that the types differ."""
        if self.ignore_whitespace or self.ignore_case or not alike:
            equal = self.text(a).eqNullSafe(self.text(b))
        else:
            equal = a.eqNullSafe(b)
        if self.epsilon > 0:
            # By way of text, as the reading of a cell as a number is defined on text.
            numbers = [cell.cast("string").try_cast("double") for cell in (a, b)]
            gap = F.abs(numbers[0] - numbers[1])
            equal = equal | F.coalesce(gap < self.epsilon, F.lit(False))
        return equal

    def key_text(self, cells: Sequence[str]) -> Column:
        """Key cells as one text; NULL, blank and the text 'null' are the same."""
        parts = []
        for name in cells:
            text = self.text(F.col(name))
            parts.append(F.when(text.isNull() | text.isin(*EMPTY_TEXTS), "").otherwise(text))
        return F.concat_ws(KEY_SEPARATOR, *parts)
