"""Bounded samples of labelled rows, drawn by a hash of the row's id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKETS = 1 << 30


def bounded_sample(
    rows: DataFrame, label: str, key: str, per_label: int, columns: list[str]
) -> DataFrame:
    """About ``per_label`` rows of each value of ``label`` at most, the same rows on every run.

    A row belongs to the sample when the hash of its ``key`` lies below the share that gives
    its label ``per_label`` rows; labels with fewer rows keep all.  Only the counts per label
    are looked at first, one row a label.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    place = F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.lit(_BUCKETS))
    wanted = F.lit(False)
    for r in counts:
        share = int(min(1.0, per_label / r.n) * _BUCKETS)
        wanted = wanted | ((F.col(label) == F.lit(r[label])) & (place < share))
    return rows.where(wanted).select(*columns)
