"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors of one label are projected on many random directions.  Two vectors collide on a
direction when the second lies in the window centred on the first.  The window and the number
of collisions asked for are calibrated: a pair at exactly the wanted cosine falls short with a
probability below ``1 - recall``.  Pairs with enough collisions are verified by their cosine
in double precision.

Work is cut into tiles: vectors are sorted by label and first projection and packed, and only
tiles of one label whose ranges lie within a window that practically no similar pair exceeds
are compared.  A pair of tiles gives link counts and a spanning forest of its links, never the
pairs themselves.  Equal vectors are compared once.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and vectors without a label, link with nothing and are their own component; vectors of other
lengths never link; rows with the same id are separate rows; a null id gets a null component
unless it links with a row that has an id.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.components import components, settled
from obsengine.llm.jaccard import forest_labels
from obsengine.llm.workers import map_arrow
from obsengine.session import fresh_folder


#: Tasks of one step; beyond it each task has more tiles, one after the other.
MAX_PARTS = 100_000


def directions(size: int, count: int, seed: int = 11) -> np.ndarray:
    """``count`` Gaussian directions for vectors of ``size`` components."""
    return np.random.default_rng([seed, size]).standard_normal((size, count))


def normal_within(width: float) -> float:
    """Probability that a standard normal number lies within ``width`` of 0."""
    return math.erf(width / math.sqrt(2))


def needed_collisions(count: int, chance: float, recall: float) -> int:
    """The largest number that a binomial count reaches with probability ``recall``."""
    below = 0.0
    for k in range(count + 1):
        below += math.comb(count, k) * chance**k * (1 - chance) ** (count - k)
        if below > 1 - recall:
            return k
    return count


class Window:
    """Window width and needed collisions for one cosine."""

    def __init__(self, cosine: float, recall: float = 0.999999, count: int = 48):
        spread = math.sqrt(2 - 2 * cosine)
        self.count = count
        self.width = 1.6 * spread + 1e-6
        self.needed = needed_collisions(count, normal_within(1.6), recall)
        #: Beyond this distance on the first direction tiles are not compared.
        self.reach = 6.0 * spread + 1e-6


def collisions(left: np.ndarray, right: np.ndarray, width: float) -> np.ndarray:
    """For each pair of rows, on how many columns the second lies in the first's window."""
    counts = np.zeros((len(left), len(right)), np.uint8)
    for a, b in zip(left.T, right.T, strict=True):
        order = np.sort(b)
        rank = np.searchsorted(order, b).astype(np.uint16)
        low = np.searchsorted(order, a - width).astype(np.uint16)
        span = np.searchsorted(order, a + width, side="right").astype(np.uint16) - low
        counts += (rank[None, :] - low[:, None]) < span[:, None]
    return counts


def _normalised(data: bytes, size: int) -> np.ndarray:
    vectors = np.frombuffer(data, "<f8").reshape(-1, size)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _vectors(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key``, ``label``, ``vector`` as doubles or null where it cannot link, ``node``."""
    values = F.col(vector).cast("array<double>")
    usable = (
        F.col(label).isNotNull()
        & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0)
    )
    name = F.concat_ws(",", F.col(label).cast("string"), values.cast("array<string>"))
    return table.select(
        F.col(key).alias("key"),
        F.col(label).cast("string").alias("label"),
        F.when(usable, values).alias("vector"),
        F.when(usable, F.md5(name)).alias("node"),
    )


def _tiles(nodes: DataFrame, n_nodes: int, tile: int, seed: int) -> DataFrame:
    """Packed vectors of one label and length, sorted by their first projection."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy()
            flat = batch.column(3).flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            places = np.zeros(len(sizes))
            data = []
            for i, (start, size) in enumerate(zip(starts, sizes, strict=True)):
                x = flat[start : start + size].astype("<f8")
                data.append(x.tobytes())
                places[i] = x @ directions(int(size), 1, seed)[:, 0] / np.sqrt(x @ x)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(sizes.astype(np.int32)),
                    pa.array(places),
                    pa.array(data, pa.binary()),
                ],
                names=["node", "label", "copies", "size", "place", "data"],
            )

    placed = map_arrow(
        nodes.select("node", "label", "copies", "vector"),
        project,
        "node string, label string, copies long, size int, place double, data binary",
    )
    parts = min(MAX_PARTS, max(1, n_nodes // (16 * tile)))
    ordered = placed.repartitionByRange(parts, "label", "size", "place").sortWithinPartitions(
        "label", "size", "place", "node"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seq = 0
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nodes, labels, copies, sizes, places, data = zip(*rows, strict=True)
            row = {
                "label": labels[0], "size": sizes[0], "tile": part << 32 | seq,
                "low": places[0], "high": places[-1], "nodes": list(nodes),
                "copies": list(copies), "data": b"".join(data),
            }
            return pa.RecordBatch.from_pylist([row], schema=_TILE)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (len(rows) == tile or row[1] != rows[0][1] or row[3] != rows[0][3]):
                    yield packed()
                    seq += 1
                    rows = []
                rows.append(row)
        if rows:
            yield packed()

    return map_arrow(ordered, pack, _TILE_DDL)


_TILE_DDL = (
    "label string, size int, tile long, low double, high double, nodes array<string>,"
    " copies array<long>, data binary"
)
_TILE = pa.schema(
    [
        ("label", pa.string()),
        ("size", pa.int32()),
        ("tile", pa.int64()),
        ("low", pa.float64()),
        ("high", pa.float64()),
        ("nodes", pa.list_(pa.string())),
        ("copies", pa.list_(pa.int64())),
        ("data", pa.binary()),
    ]
)


def _links(tiles: DataFrame, cosine: float, window: Window, seed: int) -> DataFrame:
    """``node``, ``links`` and a linked ``peer`` from every compared pair of tiles."""
    heads = tiles.select("label", "size", "tile", "low", "high")
    other = heads.toDF("label", "size", "tile_b", "low_b", "high_b")
    pairs = heads.join(other, ["label", "size"]).where(
        (F.col("tile") <= F.col("tile_b"))
        & (F.col("low_b") <= F.col("high") + window.reach)
        & (F.col("low") <= F.col("high_b") + window.reach)
    )
    pairs = pairs.select("size", "tile", "tile_b")
    count = pairs.count()
    body = tiles.select("tile", "nodes", "copies", "data")
    loaded = (
        pairs.join(body, "tile")
        .join(body.toDF("tile_b", "nodes_b", "copies_b", "data_b"), "tile_b")
        .repartition(min(MAX_PARTS, max(1, count // 8)), "tile", "tile_b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _compare(row, cosine, window, seed)
                if found:
                    names, links, peers = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names), pa.array(links, pa.int64()), pa.array(peers)],
                        names=["node", "links", "peer"],
                    )

    columns = ["size", "tile", "tile_b", *body.columns[1:], "nodes_b", "copies_b", "data_b"]
    return map_arrow(loaded.select(*columns), compare, "node string, links long, peer string")


def _compare(row: dict, cosine: float, window: Window, seed: int) -> list[tuple[str, int, str]]:
    size, same = row["size"], row["tile"] == row["tile_b"]
    base = directions(size, window.count, seed)
    left = _normalised(row["data"], size)
    right = left if same else _normalised(row["data_b"], size)
    counts = collisions(left @ base, right @ base, window.width)
    i, j = np.nonzero(counts >= window.needed)
    if same:
        i, j = i[i != j], j[i != j]
    links = np.zeros(len(left) + len(right), np.int64)
    kept_a, kept_b = [], []
    for start in range(0, len(i), 65536):
        a, b = i[start : start + 65536], j[start : start + 65536]
        near = np.einsum("ij,ij->i", left[a], right[b]) >= cosine
        kept_a.append(a[near])
        kept_b.append(b[near])
    if not kept_a:
        return []
    a, b = np.concatenate(kept_a), np.concatenate(kept_b)
    copies = np.array([*row["copies"], *row["copies_b"]], np.int64)
    shift = 0 if same else len(left)
    np.add.at(links, a, copies[b + len(left)])
    if not same:
        np.add.at(links, b + shift, copies[a])
    names = [*row["nodes"], *row["nodes_b"]]
    label = forest_labels(len(links), a, b + shift)
    return [(names[at], int(links[at]), names[label[at]]) for at in np.flatnonzero(links)]


def near_duplicates(
    table: DataFrame,
    cosine: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    tile: int = 512,
    seed: int = 11,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    ``n_links`` counts the other rows of the label with at least ``cosine``; ``component_id``
    is the smallest key that links lead to.
    """
    spark = table.sparkSession
    folder = fresh_folder(spark, "embeddings")

    def written(df: DataFrame, name: str) -> DataFrame:
        return settled(df, f"{folder}/{name}")

    rows = _vectors(table, key, vector, label)
    nodes = written(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.min("key").alias("first"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "nodes",
    )
    tiles = written(_tiles(nodes, nodes.count(), tile, seed), "tiles")
    links = written(_links(tiles, cosine, Window(cosine), seed), "links")
    labels = components(links.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    described = (
        nodes.select("node", "first", "copies")
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(labels, "node", "left")
        .select(
            "node",
            "first",
            F.coalesce("component", "node").alias("component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    described = written(described, "described")
    smallest = described.groupBy("component").agg(F.min("first").alias("component_id"))
    smallest = written(smallest, "smallest")
    described = described.join(smallest, "component").select("node", "component_id", "n_links")
    known = rows.where("node is not null").select("key", "node").join(described, "node")
    alone = rows.where("node is null").select(
        "key", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return (
        known.select("key", "component_id", "n_links")
        .union(alone)
        .select(
            F.col("key").alias(key),
            "n_links",
            "component_id",
            F.coalesce(F.col("key") == F.col("component_id"), F.col("component_id").isNull()).alias(
                "kept"
            ),
        )
    )
