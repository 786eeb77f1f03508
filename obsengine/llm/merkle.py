"""A Merkle manifest of a table, and proofs of all its rows by one multiproof per block.

Every row is a leaf, hashed over its fields.  The leaves of one group form a tree: while several
nodes remain, every ``WIDTH`` consecutive ones become their hash (the last run may be shorter,
even a single node).  The roots of the groups, in group order, form the top tree in the same
way.  Digests are SHA-256 as lowercase hex text, and a node hashes the texts below it.

Trees are built in rounds: blocks of ``BLOCK`` consecutive nodes are folded three levels up in
one task each, and what remains is the next round's level, so the longest task is one block.

Proofs are made block by block.  A block works out which nodes it cannot derive from its own
leaves (the smallest such set, each once, however many leaves want it), all blocks fetch these
in one join, and each derives the nodes that its proofs share and expands the proofs on the spot.

Defined results: a null group is a group of its own and comes first; null fields hash as ``-``,
empty texts as ``0:``; leaves of one key are ordered by digest (null keys first), and equal rows
are separate leaves; a lone leaf is the root of its group; an empty table has no rows and no
root; columns other than the named ones are not looked at, whatever their names.
"""

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm.columns import _quoted
from obsengine.llm.components import settled
from obsengine.llm.numbering import numbered
from obsengine.llm.workers import ship_package
from obsengine.session import fresh_folder

WIDTH = 8
ROUND = 3  # levels folded in one task
BLOCK = WIDTH**ROUND

#: Name of the top tree; names of groups are empty (null) or start with "=".
TOP = "!"
#: A node from this level on is wanted by at least 512 blocks, which are spread over copies of it.
_SHARED, _COPIES = 2 * ROUND, 64

_NODES = "tree string, level int, at long, hash string"


def digest(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def widths(n: int) -> list[int]:
    """Number of nodes of every level of a tree of ``n`` leaves, from the leaves to the root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // WIDTH))
    return out


def missing(positions: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Level and position of the fewest nodes that, with the given leaves, prove them all."""
    known, out = set(positions), []
    for level, width in enumerate(widths(n)[:-1]):
        runs = {p // WIDTH for p in known}
        for run in sorted(runs):
            members = range(run * WIDTH, min((run + 1) * WIDTH, width))
            out += [(level, p) for p in members if p not in known]
        known = runs
    return out


class Multiproof:
    """Some leaves of a tree and the nodes missing beside them; everything above is derived."""

    def __init__(self, n: int, leaves: Mapping[int, str], fetched: Mapping[tuple[int, int], str]):
        self._widths = widths(n)
        self._levels: list[dict[int, str]] = [{} for _ in self._widths]
        self._above: dict[tuple[int, int], str] = {}
        for (level, at), value in fetched.items():
            self._levels[level][at] = value
        known = dict(leaves)
        for level in range(len(self._widths) - 1):
            self._levels[level].update(known)
            known = {run: digest(self._run(level, run)) for run in {p // WIDTH for p in known}}
        self._levels[-1].update(known)

    def _run(self, level: int, run: int) -> list[str]:
        members = range(run * WIDTH, min((run + 1) * WIDTH, self._widths[level]))
        return [self._levels[level][p] for p in members]

    @property
    def root(self) -> str:
        return self._levels[-1][0]

    def siblings(self, at: int, level: int = 0) -> str:
        """The digests beside the way from a node to the root, as one text."""
        if level == len(self._widths) - 1:
            return ""
        found = self._above.get((level, at))
        if found is None:
            run = at // WIDTH
            beside = self._run(level, run)
            del beside[at - run * WIDTH]
            found = "".join(beside) + self.siblings(run, level + 1)
            # Leaves are asked for once; the nodes above them by several.
            if level:
                self._above[level, at] = found
        return found

    def fold(self, at: int, value: str) -> str:
        """The root that follows if the leaf at ``at`` had the digest ``value``."""
        for level in range(len(self._widths) - 1):
            run = at // WIDTH
            members = self._run(level, run)
            members[at - run * WIDTH] = value
            at, value = run, digest(members)
        return value


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hash of the fields: ``-`` for a null, else the number of bytes, a colon and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_name(group: Column) -> Column:
    """Group as text that is never null and keeps the order: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _fold_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes above one block of consecutive nodes of a tree, ``ROUND`` levels at most."""
    rows = rows.sort_values("at")
    tree, base, width = rows["tree"].iat[0], int(rows["level"].iat[0]), int(rows["width"].iat[0])
    first, known, out = int(rows["at"].iat[0]), list(rows["hash"]), []
    for level in range(base + 1, base + ROUND + 1):
        if width == 1:
            break
        known = [digest(known[i : i + WIDTH]) for i in range(0, len(known), WIDTH)]
        first, width = first // WIDTH, -(-width // WIDTH)
        out += [(tree, level, first + i, value, width) for i, value in enumerate(known)]
    return pd.DataFrame(out, columns=["tree", "level", "at", "hash", "width"])


def _fold(leaves: DataFrame, largest: int) -> DataFrame:
    """All nodes above ``leaves`` (tree, at, hash and width, the leaves of the tree)."""
    spark = leaves.sparkSession
    folder = fresh_folder(spark, "merkle-nodes")
    current = leaves.select("tree", F.lit(0).alias("level"), "at", "hash", "width")
    kind, last = f"{_NODES}, width long", len(widths(largest)) - 1
    parts = []
    for base in range(0, last, ROUND):
        block = F.floor(F.col("at") / BLOCK)
        grown = (
            current.where("width > 1")
            .groupBy("tree", block.alias("block"))
            .applyInPandas(_fold_block, kind)
        )
        parts.append(settled(grown, f"{folder}/{base}"))
        current = parts[-1].where(F.col("level") == base + ROUND)
    nodes = spark.createDataFrame([], kind)
    for part in parts:
        nodes = nodes.union(part)
    return nodes.drop("width")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the rows given, with ``tree`` and ``at``; ``trees``: name, leaves ``n``, ``top``
    (position in the top tree); ``nodes``: every node but the leaves of trees of several leaves;
    ``root`` is null for an empty table."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    n_trees: int
    root: str | None


def build(rows: DataFrame, order: Sequence[str]) -> Manifest:
    """The manifest of ``rows``, which have ``tree``, ``leaf`` and the columns of ``order``.  Runs jobs."""
    spark = rows.sparkSession
    folder = fresh_folder(spark, "merkle")
    # Written with a number of its own, by which equal rows can be dealt to several tasks.
    base = settled(rows.withColumn("_n", F.monotonically_increasing_id()), f"{folder}/rows")
    ties = [*(F.col(_quoted(c)).asc_nulls_first() for c in order), F.col("leaf"), F.col("_n")]
    leaves = settled(numbered(base, "tree", ties).drop("_n"), f"{folder}/leaves")
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    names = settled(sizes.withColumn("whole", F.lit(TOP)), f"{folder}/sizes")
    trees = settled(
        numbered(names, "whole", [F.col("tree")], "top").drop("whole"), f"{folder}/trees"
    )
    n_trees, largest = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    hashes = leaves.select("tree", "at", F.col("leaf").alias("hash")).join(
        trees.select("tree", F.col("n").alias("width")), "tree"
    )
    inner = _fold(hashes, largest or 1)
    lone = hashes.where("width = 1").select("tree", F.lit(0).alias("level"), "at", "hash")
    nodes = settled(inner.union(lone), f"{folder}/inner")
    # A root is the only node of its level; lower nodes at position 0 have a lower level.
    tops = nodes.where("at = 0").groupBy("tree").agg(F.max_by("hash", "level").alias("hash"))
    roots = settled(
        trees.join(tops, "tree").select(
            F.lit(TOP).alias("tree"), F.col("top").alias("at"), "hash",
            F.lit(n_trees).cast("long").alias("width"),
        ),
        f"{folder}/roots",
    )
    upper = roots.select("tree", F.lit(0).alias("level"), "at", "hash").union(
        _fold(roots, n_trees or 1)
    )
    upper = settled(upper, f"{folder}/upper")
    root = upper.where("at = 0").agg(F.max_by("hash", "level")).first()[0]
    return Manifest(leaves, trees, nodes.union(upper), n_trees, root)


def _wanted(n_trees: int):
    """What each block fetches: the nodes it cannot derive, and the published roots."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for blocks in batches:
            out = []
            for tree, n, top, block in blocks.itertuples(index=False):
                own = range(block * BLOCK, min((block + 1) * BLOCK, n))
                out += [(tree, block, n, top, tree, *node) for node in missing(own, n)]
                out.append((tree, block, n, top, tree, len(widths(n)) - 1, 0))
                out += [(tree, block, n, top, TOP, *node) for node in missing([top], n_trees)]
                out.append((tree, block, n, top, TOP, len(widths(n_trees)) - 1, 0))
            yield pd.DataFrame(out, columns=["tree", "block", "n", "top", "of", "level", "at"])

    return run


def _copy(spread: Column) -> Column:
    return F.when(F.col("level") >= _SHARED, spread).otherwise(0)


def fetch(manifest: Manifest) -> DataFrame:
    """The nodes every block of leaves fetches: ``tree``, ``block``, ``n``, ``top``, ``of`` (the
    node's tree), ``level``, ``at`` and ``hash``."""
    ship_package(manifest.trees.sparkSession)
    last = F.floor((F.col("n") - 1) / BLOCK)
    blocks = manifest.trees.select(
        "tree", "n", "top", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    kind = "tree string, block long, n long, top long, of string, level int, at long"
    wanted = blocks.mapInPandas(_wanted(manifest.n_trees), kind)
    wanted = wanted.withColumn("copy", _copy(F.pmod(F.xxhash64("tree", "block"), F.lit(_COPIES))))
    copies = F.when(F.col("level") >= _SHARED, _COPIES).otherwise(1)
    nodes = manifest.nodes.select(
        F.col("tree").alias("of"), "level", "at", "hash",
        F.explode(F.sequence(F.lit(0).cast("long"), (copies - 1).cast("long"))).alias("copy"),
    )
    return wanted.join(nodes, ["of", "level", "at", "copy"]).drop("copy")


def _prove(n_trees: int):
    def run(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        n, top, tree = int(nodes["n"].iat[0]), int(nodes["top"].iat[0]), nodes["tree"].iat[0]
        known: dict[str, dict[tuple[int, int], str]] = {tree: {}, TOP: {}}
        for of, level, at, value in nodes[["of", "level", "at", "hash"]].itertuples(index=False):
            known[of][level, at] = value
        subroot = known[tree].pop((len(widths(n)) - 1, 0))
        root = known[TOP].pop((len(widths(n_trees)) - 1, 0))
        inner = Multiproof(n, dict(zip(leaves["at"], leaves["leaf"])), known[tree])
        upper = Multiproof(n_trees, {top: inner.root}, known[TOP])
        rest, out = upper.siblings(top), []
        for at, changed in zip(leaves["at"], leaves["tampered"]):
            folded = upper.root if changed is None else upper.fold(top, inner.fold(at, changed))
            out.append((digest([inner.siblings(at), rest]), folded))
        made = pd.DataFrame(out, columns=["proof_sha256", "folded_root"])
        return leaves[["id", "leaf"]].reset_index(drop=True).assign(
            subroot=subroot, root=root, **made, verified=made["folded_root"] == root
        )

    return run


def prove(manifest: Manifest) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the siblings, level by level),
    ``folded_root`` and ``verified`` of every leaf.

    ``tampered`` is a column of the leaves: where it is not null, the proof is folded from that
    digest instead of the leaf's own, as a reader of an altered row would.
    """
    ship_package(manifest.leaves.sparkSession)
    kept = manifest.leaves.select(
        "id", "tree", F.floor(F.col("at") / BLOCK).alias("block"),
        "at", "leaf", "tampered",
    )
    kind = (
        f"id {dict(kept.dtypes)['id']}, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean"
    )
    return (
        kept.groupBy("tree", "block")
        .cogroup(fetch(manifest).groupBy("tree", "block"))
        .applyInPandas(_prove(manifest.n_trees), kind)
    )


def manifest_of(
    rows: DataFrame, key: str, group: str, fields: Sequence[str], altered: Mapping[str, Column]
) -> Manifest:
    """The manifest of a table whose leaves hash ``fields``, a tree per value of ``group``.

    ``altered`` maps fields to columns; rows where one of these is not null are taken to have
    been altered that way after the manifest was made.
    """
    own = {f: F.col(_quoted(f)) for f in fields}
    touched = reduce(lambda a, b: a | b, (c.isNotNull() for c in altered.values()), F.lit(False))
    later = [F.coalesce(altered[f], c) if f in altered else c for f, c in own.items()]
    prepared = rows.select(
        F.col(_quoted(key)).alias("id"),
        tree_name(F.col(_quoted(group))).alias("tree"),
        leaf_digest(list(own.values())).alias("leaf"),
        F.when(touched, leaf_digest(later)).alias("tampered"),
    )
    return build(prepared, ["id"])
