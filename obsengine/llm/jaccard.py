"""Jaccard join of texts on word n-grams: MinHash bands, then full sets.

Texts with equal n-gram sets form one class of copies and are compared once.  Band and row
counts are chosen for a wanted recall at the threshold.  Classes that share a band hash are
candidates.  They meet bucket by bucket, or in the connected group of their buckets where that
takes fewer comparisons, and every pair there is verified on its full n-gram sets; a pair that
meets in several buckets counts in one.  Large buckets and groups are cut into blocks and each
pair of blocks is a task of its own.  Groups of results are components over verified links.

A word is a run of letters and digits in lower case.  A text with fewer words than an n-gram
has one n-gram of all its words.

Defined results: null, empty and wordless texts link with nothing; rows with the same key are
separate rows; a null key sorts after all others and such rows get a null class unless they
link with a row that has a key; ties do not exist, since the class is the smallest key.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.columns import _quoted
from obsengine.llm.components import components, settled
from obsengine.llm.pieces import ARRAY_CHARS, text_chunks
from obsengine.llm.vectors import MIX, spread, word_hashes
from obsengine.llm.workers import map_arrow
from obsengine.session import fresh_folder


def choose_bands(threshold: float, recall: float, max_hashes: int = 200) -> tuple[int, int]:
    """Bands and rows: the most rows whose bands reach ``recall`` at ``threshold``.

    Of several rows only as many are taken as ``max_hashes`` allows; a single row has as many
    bands as the recall needs, whatever that is.
    """
    best = (0, 0)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if rows == 1 or bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word n-grams."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    grams = np.zeros(len(words), np.uint64)
    for i in range(width):
        grams = grams * MIX + spread(padded[i : i + len(words)] + np.uint64(1))
    grams = spread(grams)
    out = []
    for n, end in zip(counts, ends, strict=True):
        if n >= width:
            out.append(np.unique(grams[end - n : end - width + 1]))
        elif n:
            alone = np.full(1, n, np.uint64)
            for at in range(end - n, end):
                alone = alone * MIX + spread(words[at : at + 1] + np.uint64(1))
            out.append(spread(alone))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_key(grams: np.ndarray) -> str | None:
    """The same 128 bits for equal sets; None for the empty set."""
    if not len(grams):
        return None
    mixed = spread(grams)
    total, folded = int(mixed.sum()), int(np.bitwise_xor.reduce(mixed * MIX))
    return f"{total:016x}{folded:016x}"


class MinHash:
    """Band hashes of n-gram sets by ``bands * rows`` linear permutations of 32-bit hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self._a = random.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2)
        self._a += np.uint32(1)
        self._b = random.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def buckets(self, grams: np.ndarray) -> np.ndarray:
        """One 64-bit bucket a band; buckets of different bands differ."""
        short = (grams >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self._a), 0xFFFFFFFF, np.uint32)
        for start in range(0, len(short), 1024):
            part = short[start : start + 1024, None] * self._a + self._b
            np.minimum(low, part.min(axis=0), out=low)
        found = np.arange(1, self.bands + 1, dtype=np.uint64)
        for row in low.reshape(self.bands, self.rows).T:
            found = spread(found * MIX + row)
        return found.view(np.int64)


def _key_type(docs: DataFrame, key: str) -> str:
    """Keys are whole numbers or texts."""
    return "string" if dict(docs.dtypes)[key] == "string" else "long"


def _signatures(
    docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(bands, rows)
        for batch in batches:
            for start, texts in text_chunks(batch, 1, ARRAY_CHARS):
                sets = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array([set_key(s) for s in sets], pa.string()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(
                            [hasher.buckets(s) if len(s) else None for s in sets],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    names=["key", "set_key", "n_grams", "buckets"],
                )

    kind = _key_type(docs, key)
    source = docs.select(F.col(key).cast(kind), F.col(text).cast("string"))
    return map_arrow(source, run, f"key {kind}, set_key string, n_grams long, buckets array<long>")


def _blocks(classes: int, grams: int) -> Column:
    """Number of blocks for the classes aggregated."""
    rows, size = F.count(F.lit(1)), F.sum("n_grams")
    return F.greatest(F.ceil(rows / classes), F.ceil(size / grams)).alias("blocks")


def candidate_places(
    classes: DataFrame, folder: str, block_classes: int = 400, block_grams: int = 1_000_000
) -> DataFrame:
    """``node`` and ``places`` (place, block, blocks) of classes that share a bucket with another.

    A pair is verified where both classes have the same place.  The classes that shared buckets
    connect meet in one place if that asks for no more comparisons than their buckets do one by
    one (near copies share most of their bands); otherwise, as in long chains of texts that
    resemble only the next one, each bucket is a place of its own.  The shared buckets are written
    before they are joined, so that adaptive execution can split one with very many classes.
    """
    placed = classes.select("node", "n_grams", F.explode("buckets").alias("bucket"))
    shared = (
        placed.groupBy("bucket")
        .agg(
            F.min("node").alias("hub"),
            F.max("node").alias("last"),
            F.count(F.lit(1)).alias("n"),
            _blocks(block_classes, block_grams),
        )
        .where("hub <> last")
        .drop("last")
    )
    shared = settled(shared, f"{folder}/buckets")
    edges = placed.join(shared, "bucket").where("node <> hub")
    groups = components(edges.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    by_bucket = (
        shared.join(groups.toDF("hub", "component"), "hub")
        .groupBy("component")
        .agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("apart"))
    )
    together = (
        classes.select("node", "n_grams")
        .join(groups, "node")
        .groupBy("component")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), _blocks(block_classes, block_grams))
    )
    ways = together.join(by_bucket, "component").select(
        "component", "blocks", (F.col("apart") < F.col("n") * (F.col("n") - 1)).alias("sparse")
    )
    ways = settled(ways, f"{folder}/ways")
    members = groups.join(ways, "component")

    def place(name: str) -> Column:
        block = F.pmod(F.xxhash64(F.lit(5), "node"), "blocks").alias("block")
        return F.struct(F.col(name).alias("place"), block, "blocks")

    sparse = members.where("sparse").select("node").join(placed.drop("n_grams"), "node")
    return (
        members.where("not sparse")
        .select("node", F.array(place("component")).alias("places"))
        .union(
            sparse.join(shared.select("bucket", "blocks"), "bucket")
            .groupBy("node")
            .agg(F.collect_list(place("bucket")).alias("places"))
        )
    )


def linked_pairs(
    sets: list[np.ndarray], threshold: float, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in ``left`` and ``right``) of all pairs with enough Jaccard similarity."""
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    numbers = np.cumsum(count > 1) - 1
    column = numbers[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, int((count > 1).sum()) + step, step))
    for i, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if begin < end:
            has = np.zeros((len(sets), step), np.float32)
            has[owner[begin:end], column[begin:end] - i * step] = 1
            common += has[left] @ has[right].T
    common = common.astype(np.float64)
    enough = common * (1 + threshold) >= threshold * (sizes[left][:, None] + sizes[right]) - 1e-6
    return np.nonzero(enough & (left[:, None] != right))


def forest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that the links (a, b) connect each of ``n`` positions with."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _verify(rows: list[tuple], threshold: float, place: int) -> Iterator[tuple[str, int, str]]:
    """Links and one linked class for each class of a pair of blocks.

    A pair with several places in common counts in the smallest alone.
    """
    unique = {r[0]: r for r in rows}  # rows that share a key and a text come twice
    rows = [unique[k] for k in sorted(unique)]
    blocks = np.array([r[1] for r in rows])
    low, high = blocks.min(), blocks.max()
    if rows[0][4] and low == high:
        return  # one side of this pair of blocks is empty
    left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    sets = [np.frombuffer(r[3], "<u8") for r in rows]
    i, j = linked_pairs(sets, threshold, left, right)
    a, b = left[i], right[j]
    if any(len(r[5]) > 1 for r in rows):
        places = [frozenset(r[5]) for r in rows]
        first = [min(places[x] & places[y]) == place for x, y in zip(a, b, strict=True)]
        a, b = a[first], b[first]
    copies = np.array([r[2] for r in rows], np.int64)
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, a, copies[b])
    if low != high:
        np.add.at(links, b, copies[a])
    label = forest_labels(len(rows), a, b)
    for at in np.flatnonzero(links):
        yield rows[at][0], int(links[at]), rows[label[at]][0]


def jaccard_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9995,
    block_classes: int = 400,
    block_grams: int = 1_000_000,
) -> DataFrame:
    """``key``, ``class_id``, ``n_links`` and ``kept`` of every row.

    ``n_links`` counts the other rows whose similarity reaches ``threshold``; ``class_id`` is
    the smallest key that links lead to and ``kept`` marks the rows that bear it.  A block has
    about ``block_classes`` classes or ``block_grams`` n-grams.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "jaccard")

    def written(df: DataFrame, name: str) -> DataFrame:
        return settled(df, f"{folder}/{name}")

    bands, rows = choose_bands(threshold, recall)
    signed = written(_signatures(docs, key, text, width, bands, rows), "signatures")
    classes = written(
        signed.where("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("key").alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_grams").alias("n_grams"),
            F.first("buckets").alias("buckets"),
        )
        .withColumn("node", F.xxhash64("set_key")),
        "classes",
    )
    places = candidate_places(classes, folder, block_classes, block_grams)
    members = classes.select("node", "set_key", "first", "copies").join(places, "node")
    links = written(_links(docs, members, key, text, width, threshold), "links")
    labels = components(links.select(F.col("set_key").alias("a"), F.col("peer").alias("b")))
    counted = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    described = (
        classes.select("set_key", "first", "copies")
        .join(counted, "set_key", "left")
        .join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
        .select(
            "set_key",
            "first",
            F.coalesce("component", "set_key").alias("component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    described = written(described, "described")
    smallest = described.groupBy("component").agg(F.min("first").alias("class_id"))
    smallest = written(smallest, "smallest")
    described = described.join(smallest, "component").select("set_key", "class_id", "n_links")
    known = signed.where("set_key is not null").join(described, "set_key")
    alone = signed.where("set_key is null").select(
        "key", F.col("key").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return (
        known.select("key", "class_id", "n_links")
        .union(alone)
        .select(
            F.col("key").alias(key),
            "class_id",
            "n_links",
            F.coalesce(F.col("key") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"),
        )
    )


def row_key(key: str, text: str) -> Column:
    """A text that tells rows by id and text and sorts them by id, null ids last."""
    known = F.col(_quoted(key)).cast("long")
    shifted = known.bitwiseAND(F.lit((1 << 63) - 1))  # negative ids moved up by 2^63
    place = F.concat(F.when(known < 0, "0").otherwise("1"), F.lpad(shifted.cast("string"), 19, "0"))
    digest = F.md5(F.coalesce(F.col(_quoted(text)), F.lit("")).cast("binary"))
    return F.concat_ws(":", F.coalesce(place, F.lit("2")), digest)


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of similar texts, the one with the smallest id.

    Rows are told apart by id and text, so rows of one id are judged by their own texts.  Of rows
    of one id and text the one whose other columns come first in their order stays, nulls first; wordless
    texts are similar to nothing else, and a null text counts as the empty one.  Runs jobs.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names)}
    plain = docs.toDF(*names)
    keyed = plain.withColumn("row", row_key(at[key], at[text]))
    groups = jaccard_groups(keyed.select("row", F.col(at[text]).alias("text")), "row", "text", **options)
    folder = fresh_folder(docs.sparkSession, "kept")
    kept = settled(groups.where("kept").groupBy("row").agg(F.count(F.lit(1)).alias("n")), f"{folder}/all")
    single = keyed.join(kept.where("n = 1"), "row", "left_semi")
    # Few as a rule, and of known size; copies are met before the shuffle, so many are no single task.
    many = settled(kept.where("n > 1").select("row"), f"{folder}/repeated")
    repeated = keyed.join(many, "row").groupBy("row").agg(F.min(F.struct(*names)).alias("one"))
    return single.select(*names).union(repeated.select("one.*")).toDF(*docs.columns)


def _links(
    docs: DataFrame, members: DataFrame, key: str, text: str, width: int, threshold: float
) -> DataFrame:
    """``set_key``, ``links`` and a linked ``peer`` from every pair of blocks with links."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch, 0, ARRAY_CHARS):
                sets = shingle_sets(texts, width)
                part = batch.slice(start, len(texts))
                same = [set_key(s) == k.as_py() for s, k in zip(sets, part.column(1), strict=True)]
                part = part.filter(pa.array(same, pa.bool_()))
                data = [s.astype("<u8").tobytes() for s, ok in zip(sets, same, strict=True) if ok]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(data, pa.binary())],
                    names=["set_key", "places", "copies", "grams"],
                )

    texts = docs.select(F.col(key).cast(_key_type(docs, key)).alias("first"), F.col(text).alias("body"))
    wanted = members.join(texts, texts["first"].eqNullSafe(members["first"])).select(
        "body", "set_key", "places", "copies"
    )
    place = "struct<place: bigint, block: bigint, blocks: bigint>"
    sets = map_arrow(
        wanted.withColumn("places", F.col("places").cast(f"array<{place}>")),
        grams,
        f"set_key string, places array<{place}>, copies long, grams binary",
    )
    paired = (
        sets.select("*", F.col("places.place").alias("all_places"), F.explode("places").alias("at"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("at.blocks") - 1)).alias("other"))
        .select(
            F.col("at.place").alias("place"),
            F.least("at.block", "other").alias("low"),
            F.greatest("at.block", "other").alias("high"),
            "set_key",
            F.col("at.block").alias("block"),
            "copies",
            "grams",
            "all_places",
        )
        .repartition("place", "low", "high")
        .sortWithinPartitions("place", "low", "high")
    )

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple[int, list[tuple]]]:
            current, rows = None, []
            for batch in batches:
                for p, low, high, name, block, copies, data, places in zip(*batch.columns, strict=True):
                    at = (p.as_py(), low.as_py(), high.as_py())
                    if at != current and rows:
                        yield current[0], rows
                        rows = []
                    current = at
                    rows.append(
                        (
                            name.as_py(), block.as_py(), copies.as_py(), data.as_py(),
                            at[1] != at[2], places.as_py(),
                        )
                    )
            if rows:
                yield current[0], rows

        for at, rows in groups():
            found = list(_verify(rows, threshold, at))
            if found:
                names, links, peers = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(links, pa.int64()), pa.array(peers)],
                    names=["set_key", "links", "peer"],
                )

    return map_arrow(paired, verified, "set_key string, links long, peer string")
