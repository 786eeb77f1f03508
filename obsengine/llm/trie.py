"""The trie of all conversation prefixes, in balanced parentheses, shard by shard.

A node is a distinct sequence of first turns; a conversation is a member of every node on its
way from the root.  Conversations are sorted by their sequence of turn digests (then by id) and
cut into shards.  A shard writes its part of the trie as balanced parentheses, one pair a node
in depth-first order: ``find_close`` over range-min excess blocks delimits a subtree, rank over
"()" counts its leaves, and cumulative arrays over the nodes give members and savings.

As the order is that of the trie, a node can occur in two shards only if it lies on the way to
the first or to the last conversation of a shard.  These nodes, the shared spines, are merged by
their digest; all others are finished within their shard.  What hangs below a spine node is added
up along the spines by doubling: each step joins sums over twice the distance, so there are as
many steps as the longest spine has binary digits, and no task sees more than the spines of one
partition.  Ids that end at a spine node come as texts of a thousand ids in order, which one
task streams through SHA-256.

Defined results: rows with a null ``conv_id`` belong to no conversation and are left out; null
roles and texts are empty; turns of one number are ordered by the digest of role and text, null
turn numbers first; repeated rows are separate turns; a conversation without a turn ends at the
root; an empty table has no node; other columns are not looked at.  A shard holds about
``shard_turns`` turns as digests and lengths, never texts, and at least one whole conversation.
"""

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.llm.components import settled
from obsengine.llm.workers import map_arrow
from obsengine.session import fresh_folder

SHARD_TURNS = 200_000
#: Hex digits of a turn's digest.
_DIGEST = 32
#: Ids per text that spine nodes pass on.
_PIECE = 1000

_EMPTY = sha256(b"").hexdigest()


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with a tree of minima over blocks of excess."""

    def __init__(self, bits: np.ndarray, block: int = 256):
        self._block = block
        self._excess = np.cumsum(np.where(bits == 1, 1, -1))
        minima = np.minimum.reduceat(self._excess, np.arange(0, len(bits), block))
        self._levels = [minima]
        while len(minima) > 1:
            if len(minima) % 2:
                minima = np.append(minima, np.iinfo(minima.dtype).max)
            minima = minima.reshape(-1, 2).min(axis=1)
            self._levels.append(minima)
        pairs = np.zeros(len(bits), dtype=np.int64)
        pairs[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self._pairs = np.concatenate(([0], np.cumsum(pairs)))

    def _below(self, start: int, end: int, excess: int) -> int:
        """First position of a range whose excess is smaller, or -1."""
        found = self._excess[start:end] < excess
        at = int(found.argmax()) if end > start else 0
        return start + at if end > start and found[at] else -1

    def find_close(self, at: int) -> int:
        """Position of the parenthesis that closes the one opened at ``at``."""
        excess, block = int(self._excess[at]), self._block
        b = at // block + 1
        found = self._below(at + 1, min(b * block, len(self._excess)), excess)
        if found >= 0:
            return found
        level = 0
        while self._levels[level][b] >= excess:
            if b % 2:
                b, level = (b + 1) // 2, level + 1
            else:
                b += 1
        while level:
            level -= 1
            b = 2 * b if self._levels[level][2 * b] < excess else 2 * b + 1
        return self._below(b * block, min((b + 1) * block, len(self._excess)), excess)

    def leaves(self, start: int, end: int) -> int:
        """Number of pairs "()" that open from ``start`` up to before ``end``."""
        return int(self._pairs[end] - self._pairs[start])


def _range_minima(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Smallest of ``lengths`` values from each of ``starts``; every length is positive."""
    out = np.empty(len(starts), dtype=values.dtype)
    power, table = 0, values
    steps = np.floor(np.log2(lengths)).astype(int)
    while True:
        now = steps == power
        first = starts[now]
        out[now] = np.minimum(table[first], table[first + lengths[now] - (1 << power)])
        if power >= steps.max():
            return out
        table = np.minimum(table[: -(1 << power)], table[1 << power :])
        power += 1


def _common(a: str, b: str) -> int:
    """Number of turns that two paths share at their start."""
    depth, most = 0, min(len(a), len(b))
    while depth < most and a[depth : depth + _DIGEST] == b[depth : depth + _DIGEST]:
        depth += _DIGEST
    return depth // _DIGEST


def _spine_keys(path: str) -> list[str]:
    """Digest of every node on a path, from the root on."""
    running = md5(b"")
    keys = [running.hexdigest()]
    for at in range(0, len(path), _DIGEST):
        running.update(path[at : at + _DIGEST].encode())
        keys.append(running.hexdigest())
    return keys


#: What a shard tells: finished nodes, spine nodes (``key`` set), and ids ending at spine nodes (``ids`` set).
_TOLD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved_tokens", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("shard", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ids", T.StringType()),
    ]
)


def shard_nodes(ids: list[int], paths: list[str], lengths: list[list[int]], shard: int) -> list[tuple]:
    """The rows of ``_TOLD`` for sorted conversations."""
    bits, opened = [1], [0]  # the root
    parent, depth, size_of_text, ends = [-1], [0], [0], [0]
    stack, before, on_spine = [0], "", set()
    for at, path in enumerate(paths):
        shared = _common(before, path)
        bits += [0] * (len(stack) - 1 - shared)
        del stack[shared + 1 :]
        for level in range(shared, len(path) // _DIGEST):
            parent.append(stack[-1])
            stack.append(len(parent) - 1)
            depth.append(level + 1)
            size_of_text.append(lengths[at][level])
            ends.append(0)
            opened.append(len(bits))
            bits.append(1)
        ends[stack[-1]] += 1
        before = path
        if at == 0:
            on_spine.update(stack)
    on_spine.update(stack)
    bits += [0] * len(stack)

    tree = Parentheses(np.array(bits, dtype=np.int8))
    nodes = len(parent)
    closes = [tree.find_close(p) for p in opened]
    after = np.array([k + (q - p + 1) // 2 for k, (p, q) in enumerate(zip(opened, closes))])
    ended = np.concatenate(([0], np.cumsum(ends)))
    starts = ended[:-1]
    members = ended[after] - starts
    least = _range_minima(np.array(ids, dtype=np.int64), starts, members)
    shown = np.ones(nodes, dtype=bool)
    shown[list(on_spine)] = False
    children = np.bincount(np.array(parent[1:], dtype=np.int64), shown[1:], nodes)
    childless = after == np.arange(1, nodes + 1)
    own = np.where(shown, (members - 1) * np.array(size_of_text, dtype=np.int64), 0)
    saved = np.concatenate(([0], np.cumsum(own)))
    finished = np.concatenate(([0], np.cumsum(shown & childless)))

    # Keys of the spine nodes: those of the first conversation come first in the order.
    keys = dict(enumerate(_spine_keys(paths[0])))
    keys.update(zip(stack, _spine_keys(paths[-1])))
    hangs = {k: [int(finished[after[k]] - finished[k]), int(saved[after[k]] - saved[k])] for k in on_spine}
    below = {k: list(v) for k, v in hangs.items()}
    for k in on_spine:
        if k:
            for i in (0, 1):
                below[parent[k]][i] -= hangs[k][i]

    out = []
    for k in range(nodes):
        here = ids[starts[k] : starts[k] + ends[k]]
        if shown[k]:
            up = parent[k]
            out.append((
                None, keys.get(up), int(least[k]), depth[k], int(least[up]) if shown[up] else None,
                int(members[k]), int(children[k]), tree.leaves(opened[k], closes[k]),
                int(saved[after[k]] - saved[k]), None,
                sha256(",".join(map(str, here)).encode()).hexdigest() if here else _EMPTY,
                None, None, None,
            ))
            continue
        out.append((
            keys[k], keys[parent[k]] if k else None, int(least[k]), depth[k], None, int(members[k]),
            int(children[k]), *below[k], size_of_text[k], None, shard, None, None,
        ))
        for seq, first in enumerate(range(0, len(here), _PIECE)):
            text = ",".join(map(str, here[first : first + _PIECE]))
            out.append((keys[k], *[None] * 10, shard, seq, text))
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, paths, lengths = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        paths += batch.column(1).to_pylist()
        lengths += batch.column(2).to_pylist()
    if not ids:
        return
    told = shard_nodes(ids, paths, lengths, TaskContext.get().partitionId())
    schema = pa.schema(
        [(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in _TOLD]
    )
    for first in range(0, len(told), 10_000):
        columns = zip(*told[first : first + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind.type) for c, kind in zip(columns, schema)], schema=schema
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's texts, joined by commas; rows come sorted by key and place."""
    key, running = None, None

    def told(key: str, digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest]})

    for batch in batches:
        for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at == key:
                running.update(b"," + text.encode())
                continue
            if key is not None:
                yield told(key, running.hexdigest())
            key, running = at, sha256(text.encode())
    if key is not None:
        yield told(key, running.hexdigest())


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order, as structs of ``turn``, ``key`` (a digest) and ``n``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where("conv_id is not null").select(
        "conv_id", F.struct("turn", key.alias("key"), F.length(text).alias("n")).alias("one")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def with_shared_starts(convs: DataFrame, start: Column, most: int) -> DataFrame:
    """Conversations whose first ``start`` (at most ``most``) turns are those of the
    conversation that opens their hundred; all of that one's turns if it has fewer."""
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = convs.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head")
    )
    rows = convs.withColumn("base", base).withColumn("h", start.cast("int")).join(heads, "base", "left")
    # A conversation without a head has no first turns.
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(first, own).alias("turns"))


def nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``convs`` (``conv_id``, unique, and ``turns``).  Runs jobs."""
    spark = convs.sparkSession
    folder = fresh_folder(spark, "trie")
    flat = settled(
        convs.select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["key"]), "").alias("path"),
            F.transform("turns", lambda t: t["n"]).alias("lengths"),
        ),
        f"{folder}/paths",
    )
    turns = flat.agg(F.sum(F.size("lengths") + 1)).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-turns // shard_turns), min(tasks, -(-turns // 5000)))
    dealt = flat.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    told = settled(map_arrow(dealt, _shards, _TOLD), f"{folder}/told")

    spines = settled(
        told.where("key is not null and ids is null")
        .groupBy("key")
        .agg(
            F.first("parent").alias("parent"), F.first("depth").alias("depth"),
            F.first("length").alias("length"), F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        ),
        f"{folder}/spines",
    )
    below = spines.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("more")
    )
    counted = (
        spines.join(below, "key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        .withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length"))
        .drop("more")
    )
    summed = settled(
        counted.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens"),
        f"{folder}/sums-0",
    )
    deepest = spines.agg(F.max("depth")).first()[0] or 0
    for step in range(deepest.bit_length()):
        # Sums reach 2^step levels down, and ``up`` is the node as many levels above.
        reached = summed.where("up is not null").groupBy(F.col("up").alias("key")).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        higher = summed.select(F.col("key").alias("up"), F.col("up").alias("higher"))
        summed = settled(
            summed.join(reached, "key", "left").join(higher, "up", "left").select(
                "key", F.col("higher").alias("up"),
                (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
            ),
            f"{folder}/sums-{step + 1}",
        )

    pieces = (
        told.where("ids is not null")
        .repartition("key")
        .sortWithinPartitions("key", "shard", "seq")
        .select("key", "ids")
    )
    ends = map_arrow(pieces, _hashed, "key string, ends_sha256 string")
    least = spines.select(F.col("key").alias("parent"), F.col("conv_id").alias("up_id"))
    merged = (
        counted.drop("n_leaves", "saved_tokens")
        .join(summed.drop("up"), "key")
        .join(ends, "key", "left")
        .join(least, "parent", "left")
    )
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    done = told.where("key is null")
    attached = done.where("parent is not null").drop("parent_conv_id").join(least, "parent", "left")
    return (
        merged.withColumnRenamed("up_id", "parent_conv_id")
        .select(*result, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
        .union(done.where("parent is null").select(*result, "ends_sha256"))
        .union(attached.withColumnRenamed("up_id", "parent_conv_id").select(*result, "ends_sha256"))
    )
