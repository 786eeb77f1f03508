"""Aligning two tables without a key."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.tablediff.align import align_rows
from obsengine.operators.tablediff.compare import mark_actions
from obsengine.operators.tablediff.equality import Equality
from obsengine.operators.tablediff.neighbours import link_neighbours
from obsengine.session import ensure_checkpoints, fresh_folder


@dataclass(frozen=True)
class KeylessRules:
    """Which column sets serve as keys; the values are the usual ones.

    The ``max_columns`` columns with most distinct values are combined.  A set is too coarse
    when its most frequent text makes up ``coarse_share`` of the rows plus ``coarse_slack``;
    when all are, the set of all columns is used.
    """

    max_columns: int = 5
    coarse_share: float = 0.1
    coarse_slack: int = 20


def pick_columns(left: DataFrame, right: DataFrame, most: int = 5) -> list[str]:
    """The common columns with most distinct values over both tables.  May run a job.

    All columns are counted in one pass: their values are counted before the shuffle.
    """
    common = [c for c in left.columns if c in right.columns]
    if len(common) <= most:
        return common

    def cells(df: DataFrame, side: int) -> DataFrame:
        each = [
            F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("string").alias("cell"))
            for i, c in enumerate(common)
        ]
        return df.select(F.lit(side).alias("side"), F.inline(F.array(*each)))

    values = cells(left, 0).union(cells(right, 1)).where("cell is not null").distinct()
    counts = {r["at"]: r["count"] for r in values.groupBy("at").count().collect()}
    return sorted(common, key=lambda c: (-counts.get(common.index(c), 0), common.index(c)))[:most]


def _numbered(left: DataFrame, right: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both tables with a lasting number; written once, as the number depends on the read."""
    sides = {"_left": left, "_right": right}
    packed = [
        df.select(
            F.lit(name == "_left").alias("_is_left"),
            *[
                (F.struct("*") if other == name else F.lit(None).cast(there.schema)).alias(other)
                for other, there in sides.items()
            ],
        )
        for name, df in sides.items()
    ]
    both = _settled(packed[0].union(packed[1]).withColumn("_id", F.monotonically_increasing_id()), folder)
    is_left = F.col("_is_left")
    return both.where(is_left).select("_left.*", "_id"), both.where(~is_left).select("_right.*", "_id")


class _Sets:
    """Sets of columns by their bit masks, and 128-bit digests of a row's cells in each."""

    def __init__(self, columns: Sequence[str], equality: Equality):
        self._columns = list(columns)
        self._equality = equality

    def _members(self, mask: int) -> list[int]:
        return [at for at in range(len(self._columns)) if mask >> at & 1]

    def below(self, mask: int) -> list[int]:
        """The sets with one column less."""
        return [mask & ~(1 << at) for at in self._members(mask)]

    def cells(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Rows of both sides: ``left``, ``_id`` and two hashes of every column's text, from which
        the digests of all sets are made."""
        each = [
            F.xxhash64(F.lit(seed), self._equality.key_text([c])).alias(f"_{seed}_{at}")
            for at, c in enumerate(self._columns)
            for seed in (1, 2)
        ]
        sides = [df.select(F.lit(at == 0).alias("left"), "_id", *each) for at, df in enumerate((left, right))]
        return sides[0].union(sides[1])

    def texts(self, cells: DataFrame, masks: Sequence[int]) -> DataFrame:
        """A row per row and set: ``mask`` and the digest ``a``, ``b``."""
        each = [
            F.struct(
                F.lit(mask).alias("mask"),
                *[
                    F.xxhash64(F.lit(seed), *[f"_{seed}_{at}" for at in self._members(mask)]).alias(name)
                    for seed, name in ((1, "a"), (2, "b"))
                ],
            )
            for mask in masks
        ]
        return cells.select("left", "_id", F.inline(F.array(*each)))


_TEXT = ["mask", "a", "b"]


def _counted(texts: DataFrame) -> DataFrame:
    """Rows of either side, and the smallest number, for every text of a set."""
    return texts.groupBy(*_TEXT).agg(
        F.count_if("left").alias("n_left"),
        F.count_if(~F.col("left")).alias("n_right"),
        F.min(F.when(F.col("left"), F.col("_id"))).alias("left_id"),
        F.min(F.when(~F.col("left"), F.col("_id"))).alias("right_id"),
    )


def _unique(counts: DataFrame) -> DataFrame:
    return counts.where("n_left = 1 and n_right = 1").select("mask", "left_id", "right_id")


def _settled(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def usable_sets(
    cells: DataFrame, sets: _Sets, width: int, rules: KeylessRules, folder: str
) -> tuple[list[int], dict[int, DataFrame]]:
    """Masks of the column sets that are fine enough (the set of all columns if none is), and the
    pairs of unique texts of those that were counted.

    A set of more columns is at least as fine, so whatever holds a fine set is fine and only sets
    whose parts are all coarse are counted: single columns first, then combinations of coarse
    ones.  Runs jobs per size of set, one size as a rule, and reads a row a set.
    """
    coarse: set[int] = set()
    unique: dict[int, DataFrame] = {}
    judged = {1 << at for at in range(width)}
    while judged:
        masks = sorted(judged)
        counts = _counted(sets.texts(cells, masks)).drop("a", "b")
        counts = _settled(counts, f"{folder}/counts-{masks[0]}")
        found = (
            counts.groupBy("mask")
            .agg(
                F.max(F.greatest("n_left", "n_right")).alias("top"),
                F.greatest(F.sum("n_left"), F.sum("n_right")).alias("rows"),
            )
            .collect()
        )
        now = {
            r.mask
            for r in found
            if r.top / (r.rows + 1 + rules.coarse_slack) >= rules.coarse_share
        }
        unique |= {mask: _unique(counts).where(F.col("mask") == mask) for mask in masks}
        coarse |= now
        wider = {mask | 1 << at for mask in now for at in range(width) if not mask >> at & 1}
        judged = {mask for mask in wider if coarse.issuperset(sets.below(mask))}
    full = 2**width - 1
    return [mask for mask in range(1, full + 1) if mask not in coarse] or [full], unique


def link_rows(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    equality: Equality = Equality(),
    rules: KeylessRules = KeylessRules(),
) -> DataFrame:
    """Pairs (left_id, right_id) of numbered rows, found by column sets in turn.

    Each set links the rows whose text is unique in both whole tables and that no earlier set
    linked.  The first set is one grouping of all rows.  For the others only texts that unlinked
    rows of both sides have matter, so both tables are met with these texts before anything is
    shuffled; few are left as a rule.  Of the pairs of unique texts a pair is a link when no
    earlier pair of either row is left, which settles most at once and the others in a few
    further steps over ever fewer pairs.  Runs jobs.
    """
    folder = fresh_folder(left.sparkSession, "keyless")
    sets = _Sets(columns, equality)
    cells = sets.cells(left, right)
    (first, *others), unique = usable_sets(cells, sets, len(columns), rules, folder)
    if first not in unique:
        unique[first] = _settled(_unique(_counted(sets.texts(cells, [first]))), f"{folder}/first")
    links = [unique[first].select("left_id", "right_id")]
    if not others:
        return links[0]
    linked = links[0].select(
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("left"), F.col("left_id").alias("_id")),
                F.struct(F.lit(False).alias("left"), F.col("right_id").alias("_id")),
            )
        )
    )
    waiting = sets.texts(cells.join(linked, ["left", "_id"], "left_anti"), others)
    sides = waiting.groupBy(*_TEXT).agg(F.max("left").alias("l"), F.min("left").alias("r"))
    shared = _settled(sides.where("l and not r").select(*_TEXT), f"{folder}/texts")
    near = sets.texts(cells, others).join(shared, _TEXT, "left_semi")
    # A pair counts for its first set only; placed by one side, where its windows are too.
    pairs = (
        _unique(_counted(near))
        .repartition("left_id")
        .groupBy("left_id", "right_id")
        .agg(F.min("mask").alias("mask"))
    )
    for step in range(len(others)):
        of_left, of_right = (
            F.min("mask").over(Window.partitionBy(side)) for side in ("left_id", "right_id")
        )
        judged = pairs.withColumn("_l", of_left == F.col("mask")).withColumn("_r", of_right == F.col("mask"))
        judged = judged.select("mask", "left_id", "right_id", F.expr("_l and _r").alias("linked"))
        judged = _settled(judged, f"{folder}/{step}")
        found = judged.where("linked").select("left_id", "right_id")
        links.append(found)
        pairs = judged.where("not linked").drop("linked")
        if step + 1 == len(others) or pairs.isEmpty():
            break
        for side in ("left_id", "right_id"):
            pairs = pairs.join(found.select(side), side, "left_anti")
        pairs = pairs.select("mask", "left_id", "right_id")
    return reduce(DataFrame.unionByName, links)


def diff_keyless(
    left: DataFrame,
    right: DataFrame,
    equality: Equality = Equality(),
    keep_equal: bool = False,
    rules: KeylessRules = KeylessRules(),
    order: Sequence[str] = (),
) -> DataFrame:
    """Row difference of two tables without a key.  Runs jobs.

    ``order`` names columns of both tables that tell where a row stands and are not compared.
    With them, rows that no column set links are linked with their like beside a linked row.
    """
    ensure_checkpoints(left.sparkSession)
    columns = pick_columns(left.drop(*order), right.drop(*order), rules.max_columns)
    a, b = _numbered(left, right, fresh_folder(left.sparkSession, "keyless-rows"))
    links = link_rows(a, b, columns, equality, rules)
    if order:
        links = links.union(link_neighbours(*_whole_texts(a, b, columns, equality, order), links, order))
    # The number of the linked left row is the key; an unlinked right row has its own.
    named_a = a.withColumnRenamed("_id", "_link").withColumn("_from", F.lit("left"))
    named_b = (
        b.join(links.withColumnRenamed("right_id", "_id"), "_id", "left")
        .withColumn("_from", F.when(F.col("left_id").isNull(), "right").otherwise("left"))
        .withColumn("_link", F.coalesce("left_id", "_id"))
        .drop("_id", "left_id")
    )
    rows = align_rows({"old": named_a, "new": named_b}, ["_link", "_from"], keys_unique=True)
    names = [c for c in dict.fromkeys([*right.columns, *left.columns]) if c not in order]
    return mark_actions(rows, left, right, names, [], equality, keep_equal=keep_equal)


def _whole_texts(
    left: DataFrame, right: DataFrame, columns: Sequence[str], equality: Equality, order: Sequence[str]
) -> list[DataFrame]:
    """Rows of each side with their number, order and the digest of all ``columns``."""
    return [
        df.select(
            "_id",
            *[F.xxhash64(F.lit(seed), *[equality.key_text([c]) for c in columns]).alias(n) for seed, n in ((1, "a"), (2, "b"))],
            *[F.col(f"`{c}`") for c in order],
        )
        for df in (left, right)
    ]
