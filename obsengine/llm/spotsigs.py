"""Document fingerprints by spot signatures, in DataFrame operations.

Every content word that follows a run of common words starts a signature: a hash of the last
common word of the run, that content word and the next ones, ``chain`` in all.  The start of the
text and of every line counts as a common word, so that lists have signatures too; this holds
for texts of any length.  A text's fingerprint is its set of signatures.  Two fingerprints are
compared by Jaccard similarity.  For joins, sets are partitioned by length so that sets too
different in length never meet, and a pair is only looked at when it shares one of the rarest
signatures that a similar set must contain.

Words are runs of characters other than ASCII white space, punctuation and signs, in lower
case.

Defined results: a null text is the empty text; texts without content words have the empty fingerprint
and likeness 1 to each other, 0 to all others; equal texts have equal fingerprints; null ids
come first in the order of ids, and rows with one id are ordered by text.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Common words of English, German, French and Spanish that anchor signatures.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "were", "with",
    "als", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "ist", "mit",
    "nicht", "sich", "und", "von", "zu",
    "au", "avec", "dans", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas",
    "pour", "que", "qui", "un", "une",
    "con", "de", "del", "el", "es", "los", "las", "no", "por", "se", "su", "una", "y",
)

MIN_LONG = -(1 << 63)

_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


#: Stands for the start of a text or line; a character for private use, so no word.
_START = "\uE000"


def with_signatures(docs: DataFrame, text: str, signatures: str, chain: int = 3) -> DataFrame:
    """``docs`` with the sorted distinct signatures of a text as an array of longs.

    Each step is a projection of its own that later ones refer to more than once, so Spark
    evaluates it once a row.
    """
    lines = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\n\\r]+", f" {_START} ")
    line = F.regexp_replace(F.concat(F.lit(f"{_START} "), lines), _GAP, " ")
    words = docs.withColumn("__words", F.split(F.trim(line), " "))
    w = F.col("__words")
    anchors = (*ANCHORS, _START)
    # Content words, each with the common word right before it, if any.
    marked = F.transform(
        w,
        lambda x, i: F.when(x.isin(*anchors), None)
        .when((i > 0) & F.get(w, i - 1).isin(*anchors), F.concat(F.get(w, i - 1), F.lit(" "), x))
        .otherwise(x),
    )
    found = words.withColumn("__marked", F.filter(marked, lambda x: x.isNotNull()))
    m = F.col("__marked")
    found = found.withColumn("__plain", F.transform(m, lambda x: F.substring_index(x, " ", -1)))
    p = F.col("__plain")
    after = [F.slice(p, F.lit(k + 1), F.size(p)).alias(f"w{k}") for k in range(1, chain)]
    spots = F.filter(F.arrays_zip(m.alias("w0"), *after), lambda z: F.contains(z["w0"], F.lit(" ")))
    chains = F.transform(spots, lambda z: F.xxhash64(*(z[f"w{k}"] for k in range(chain))))
    return found.withColumn(signatures, F.array_sort(F.array_distinct(chains))).drop(
        "__words", "__marked", "__plain"
    )


def fingerprint(found: Column) -> Column:
    """A text form of a signature set: its size and a digest; empty for the empty set."""
    joined = F.sha2(F.array_join(found.cast("array<string>"), ","), 256)
    return F.when(F.size(found) > 0, F.concat_ws("-", F.size(found).cast("string"), joined)).otherwise(
        ""
    )


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets, 0 where their lengths rule out ``threshold``."""
    least, most = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    value = common / (F.size(a) + F.size(b) - common)
    return (
        F.when(most == 0, F.lit(1.0))
        .when(least < F.lit(threshold) * most, F.lit(0.0))
        .otherwise(value)
        .cast("double")
    )


def length_part(size: Column, threshold: float) -> Column:
    """Partition of a set length: similar sets lie in the same partition or the next."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1.0 / threshold))).cast("long")


def similar(
    docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pairs ``a`` < ``b`` of classes with likeness of at least ``threshold``, and members.

    Returns rows ``kind`` = ``member`` (``a`` the smallest key of a class of equal fingerprints,
    ``b`` another of its keys, likeness 1) and ``kind`` = ``pair`` between classes.  Texts
    without words take no part.
    """
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sets = with_signatures(texts, "text", "set").where(F.size("set") > 0).drop("text")
    classes = sets.groupBy("set").agg(F.min("key").alias("id"))
    members = (
        sets.join(classes, "set")
        .where("key <> id")
        .select(F.lit("member").alias("kind"), F.col("id").alias("a"), F.col("key").alias("b"),
                F.lit(1.0).alias("likeness"))
    )
    size = F.size("set")
    # A similar set shares one of the first size - ceil(t * size) + 1 signatures, rarest first.
    prefix = size - F.ceil(F.lit(threshold) * size) + 1
    spread = classes.select(
        "id",
        length_part(size, threshold).alias("part"),
        prefix.alias("prefix"),
        F.explode("set").alias("signature"),
    )
    sharing = spread.groupBy("signature").agg(F.count(F.lit(1)).alias("sets"))
    rare = F.row_number().over(Window.partitionBy("id").orderBy("sets", "signature"))
    probe = (
        spread.join(sharing, "signature")
        .withColumn("turn", rare)
        .where("turn <= prefix")
        .select("id", "part", "signature")
    )
    reach = probe.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    met = (
        probe.alias("x")
        .join(reach.alias("y"), ["part", "signature"])
        .where("x.id <> y.id")
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )
    left = classes.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = classes.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    pairs = (
        met.join(left, "a")
        .join(right, "b")
        .withColumn("likeness", likeness(F.col("set_a"), F.col("set_b"), threshold))
        .where(F.col("likeness") >= threshold)
        .select(F.lit("pair").alias("kind"), "a", "b", "likeness")
    )
    return members.union(pairs)


def _slice_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` a key has reached; a null key has reached none.

    Cuts are searched in groups, so a row looks at about twice the root of their number.
    """
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= key))

    def listed(values: list[int]) -> Column:
        return F.array(*(F.lit(c).cast("long") for c in values))

    group = F.coalesce(reached(listed([g[0] for g in groups])), F.lit(0))
    inside = F.get(F.array(*(listed(g) for g in groups)), group - 1)
    return F.when(key.isNull() | (group == 0), 0).otherwise((group - 1) * width + reached(inside))


def with_next(
    docs: DataFrame,
    slices: int,
    key: str = "doc_id",
    text: str = "text",
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``key``, ``text``, what ``derive`` adds, and each but the key of the next row as ``next_``.

    Next is the row with the next key; the row after the last is the first, and rows of one key
    are ordered by their text.  Rows are dealt by quantiles of the key into ``slices`` ranges;
    the first row of each range is copied to the range before it, so no task holds more than a
    range.  ``derive`` runs once a row, after the shuffle.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    shares = [i / slices for i in range(1, slices)]
    cuts = rows.approxQuantile("key", shares, 0.2 / slices) if shares else []
    placed = rows.withColumn("slice", _slice_of(F.col("key"), sorted({int(c) for c in cuts})))
    # The smallest key of each slice, a row a slice, finds the few rows that may come first.
    known = F.coalesce("key", F.lit(MIN_LONG))
    heads = placed.groupBy("slice").agg(F.min(known).alias("least"))
    least = placed.join(F.broadcast(heads), "slice").where(known == F.col("least"))
    first = least.groupBy("slice").agg(F.min(F.struct("key", "text")).alias("head"))
    # The first row of a slice goes to the slice before, that of the first slice to the last.
    earlier = F.lag("slice").over(Window.orderBy("slice"))
    last = F.max("slice").over(Window.partitionBy(F.lit(1)))
    copies = first.select(
        "head.*", F.coalesce(earlier, last).alias("slice"), F.lit(True).alias("copy")
    )
    own = placed.withColumn("copy", F.lit(False))
    # By range: a hash would put several slices into one partition and leave others empty.
    dealt = derive(own.unionByName(copies).repartitionByRange(slices, "slice"))
    order = Window.partitionBy("slice").orderBy("copy", F.col("key").asc_nulls_first(), "text")
    follow = [c for c in dealt.columns if c not in ("key", "slice", "copy")]
    return (
        dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in follow})
        .where("not copy")
        .withColumnRenamed("key", key)
        .withColumnRenamed("text", text)
        .drop("copy", "slice")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half replaced by the start of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    kept = F.substring(text, F.lit(1), F.length(text) - half)
    return F.concat(kept, F.substring(following, F.lit(1), half))
