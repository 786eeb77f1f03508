"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: compatibility forms, lower case, look-alike letters, digits and signs
that stand for letters.  The lexicon holds word starts and whole words with log-odds weights,
learned from a bounded sample of labelled texts in which near copies count once.  A word that
starts with several entries counts once, with the largest weight.  A match inside an exception
phrase does not count; exceptions are given phrases and longer words that the sample shows to
be harmless.  The sum of weights is divided by the logarithm of the number of words, and the
score is ``x / (x + theta)`` with ``theta`` set between the sample's classes.

Defined results: a null or empty text, or one without a match, scores 0; without labelled rows
of both kinds and without a given lexicon nothing scores above 0; equal texts score alike;
extra columns are kept and replaced only where a result column has the same name.
"""

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.columns import keep_rows_with
from obsengine.llm.samples import bounded_sample
from obsengine.llm.workers import map_arrow
from obsengine.session import fresh_folder

#: Letters of other scripts that look like Latin ones, and signs read as letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s",
    "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g",
}
SIGN_LETTERS = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l",
}

#: Phrases in which a lexicon entry is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "stupid simple")

#: Signs count as letters where a letter follows them.
_SIGN = re.compile(r"[01345789@$!|]+(?=[^\W\d_])")
_LIKE = {ord(k): v for k, v in LOOK_ALIKES.items()}
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """The form in which texts and lexicon entries are compared."""
    text = unicodedata.normalize("NFKC", text).lower()
    if any(c in text for c in LOOK_ALIKES):
        text = text.translate(_LIKE)
    if any(c in text for c in SIGN_LETTERS):
        text = _SIGN.sub(lambda m: "".join(SIGN_LETTERS[c] for c in m[0]), text)
    return text


@dataclass
class Lexicon:
    """Weights of word starts (``idio``) and whole words (``idiot `` with a space), exceptions."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    theta: float = 1.0

    def __post_init__(self):
        self._automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "theta": self.theta}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._automaton = None

    def _build(self):
        automaton = ahocorasick.Automaton()
        both: dict[str, list[str]] = {}
        for entry in self.weights:  # a start and the equal whole word share one string
            both.setdefault(entry.rstrip(" "), []).append(entry)
        for string, entries in both.items():
            automaton.add_word(string, ("", [(e, self.weights[e]) for e in entries]))
        for phrase in self.exceptions:
            found = both.get(phrase.rstrip(" "), [])
            pairs = [(e, self.weights[e]) for e in found]
            automaton.add_word(phrase.rstrip(" "), (phrase, pairs))
        if len(automaton):
            automaton.make_automaton()
        self._automaton = automaton
        return automaton

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """Place and weight of every counted word of a folded text."""
        automaton = self._automaton if self._automaton is not None else self._build()
        if not len(automaton):
            return []
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for last, (phrase, pairs) in automaton.iter(folded):
            after = folded[last + 1 : last + 2]
            closed = not after.isalpha()
            if phrase and closed:
                first = last + 1 - len(phrase.rstrip(" "))
                if first == 0 or not folded[first - 1].isalpha():
                    spared.append((first, last))
            for entry, weight in pairs:
                if entry[-1] == " " and not closed:
                    continue
                first = last + 1 - len(entry.rstrip(" "))
                if first and folded[first - 1].isalpha():
                    continue
                if weight > best.get(first, 0.0):
                    best[first] = weight
        spared.sort()
        kept, reach, i = [], -1, 0
        for at in sorted(best):
            while i < len(spared) and spared[i][0] <= at:
                reach = max(reach, spared[i][1])
                i += 1
            if at > reach:
                kept.append((at, best[at]))
        return kept

    def measure(self, text: str) -> tuple[float, int, int]:
        """Weight divided by log length, matched words, words."""
        folded = fold(text)
        found = self.hits(folded)
        if not found:
            return 0.0, 0, 0
        n_words = len(_WORD.findall(folded))
        total = sum(weight for _, weight in found)
        return total / math.log(math.e + n_words), len(found), n_words

    def score(self, text: str) -> tuple[float, int]:
        """Score from 0 to 1, and the number of matched words."""
        x, matched, _ = self.measure(text)
        return x / (x + self.theta), matched


def _terms(text: str, shortest: int, longest: int) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    starts = {w[:n] for w in words for n in range(shortest, min(longest, len(w)) + 1)}
    return starts | {w + " " for w in words}


def _copy_key(text: str, width: int = 3) -> int:
    """The smallest hash of the text's word shingles: mostly equal for near copies."""
    words = _WORD.findall(fold(text))
    last = max(1, len(words) - width + 1)
    return min(zlib.crc32(" ".join(words[i : i + width]).encode()) for i in range(last))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    per_label: int = 12_000,
    min_support: int = 6,
    min_share: float = 0.004,
    min_weight: float = 3.0,
    shortest: int = 4,
    longest: int = 8,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """Learn a lexicon from texts whose ``key`` has a ``label`` of 0 or 1 in ``labels``.

    Null texts, null keys and other labels are left out; of several labels the largest counts.
    The sample has about ``per_label`` keys of each label at most, so it can be broadcast to the
    texts.  An entry needs ``min_support`` toxic texts that are no copies of each other and a
    ``min_share`` of them, so there are at most 1 / ``min_share`` times as many entries as terms in
    a toxic text of the sample; all that qualify are taken, and so are all exceptions.
    """
    each = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    each = each.groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    chosen = bounded_sample(each, "toxic", key, per_label, [key, "toxic"])
    texts = docs.where(F.col(text).isNotNull()).select(key, F.col(text).alias("text"))
    source = texts.join(F.broadcast(chosen), key).select("text", "toxic")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_copy_key(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.int64())], names=["text", "toxic", "copy"]
            )

    once = (
        map_arrow(source, keyed, "text string, toxic int, copy long")
        .groupBy("copy", "toxic")
        .agg(F.min("text").alias("text"))
    )
    folder = fresh_folder(once.sparkSession, "toxicity-sample")
    once.write.parquet(folder)
    once = once.sparkSession.read.parquet(folder)
    totals = {r.toxic: r["count"] for r in once.groupBy("toxic").count().collect()}
    toxic_rows, clean_rows = totals.get(1, 0), totals.get(0, 0)
    if not toxic_rows or not clean_rows:
        return Lexicon(exceptions=exceptions)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for value, toxic in zip(batch.column(0), batch.column(1), strict=True):
                side = toxic.as_py()
                for term in _terms(value.as_py(), shortest, longest):
                    found.setdefault(term, [0, 0])[side] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.string()),
                    pa.array([v[1] for v in found.values()], pa.int64()),
                    pa.array([v[0] for v in found.values()], pa.int64()),
                ],
                names=["term", "toxic", "clean"],
            )

    support = max(min_support, math.ceil(min_share * toxic_rows))
    terms = (
        map_arrow(once.select("text", "toxic"), counted, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn(
            "weight",
            F.log((F.col("toxic") + 0.5) / (toxic_rows + 1))
            - F.log((F.col("clean") + 0.5) / (clean_rows + 1)),
        )
    )
    entries = (
        terms.where((F.col("toxic") >= support) & (F.col("weight") >= min_weight))
        .orderBy(F.desc(F.col("weight") * F.col("toxic")), "term")
        .collect()
    )
    weights = {r.term: round(r.weight, 6) for r in entries}
    stems = [e for e in weights if e[-1] != " "]
    if stems:
        start = F.lit(False)
        for n in range(shortest, longest + 1):
            group = [s for s in stems if len(s) == n]
            if group:
                start = start | F.substring("term", 1, n).isin(group)
        harmless = (
            terms.where(F.col("term").endswith(" ") & start)
            .where((F.col("clean") >= 2) & (F.col("weight") < 0))
            .orderBy(F.desc("clean"), "term")
            .collect()
        )
        exceptions = (*exceptions, *(r.term for r in harmless))
    lexicon = Lexicon(weights, exceptions)
    lexicon.theta = _theta(once, lexicon)
    return lexicon


def _theta(once: DataFrame, lexicon: Lexicon) -> float:
    """The cut with the fewest errors on the sample; between equal cuts the middle one."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [round(lexicon.measure(t.as_py())[0], 6) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.float64()), batch.column(1)], names=["x", "toxic"]
            )

    found = (
        map_arrow(once.select("text", "toxic"), measured, "x double, toxic int")
        .groupBy("x")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .orderBy("x")
        .collect()
    )
    values = [r.x for r in found]
    below_toxic, above_clean = 0, sum(r.n - r.toxic for r in found)
    cuts = []
    for i, r in enumerate(found):
        below_toxic += r.toxic
        above_clean -= r.n - r.toxic
        upper = values[i + 1] if i + 1 < len(values) else values[i] + 1.0
        cuts.append((below_toxic + above_clean, i, (values[i] + upper) / 2))
    fewest = min(c[0] for c in cuts)
    best = [c[2] for c in cuts if c[0] == fewest and c[2] > 0]
    return best[len(best) // 2] if best else 1.0


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (1 from a score of 0.5) and ``n_matches``."""

    def column(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        for batch in batches:
            found = [lexicon.score(t.as_py() or "") for t in batch.column(at)]
            yield [
                pa.array([s for s, _ in found], pa.float64()),
                pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                pa.array([n for _, n in found], pa.int64()),
            ]

    added = [("score", "double"), ("predicted", "int"), ("n_matches", "long")]
    return keep_rows_with(docs, text, added, column)
