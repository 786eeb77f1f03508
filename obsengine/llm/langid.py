"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of a text: lower case, every run of other characters
one space, a text between spaces.  N-grams are 64-bit hashes in one sorted array per language and
order, beside their discounted probabilities, and so are contexts with their back-off weights, so
a model is as large as the n-grams of its languages together.  Every distinct n-gram of a batch of
texts is looked up once.  The language with the lowest cross-entropy per character wins.  A text
whose cross-entropy lies a margin above what is usual for that language is marked as rejected.

The models are fitted on a bounded sample of labelled rows: ``per_language`` rows of each
language at most, one in five of which only calibrates the rejection.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected;
without labelled rows every text is ``und``; a sample too small for a calibrating row rejects
no text that has letters; between languages of equal cross-entropy the first
in alphabetical order wins; equal texts get equal results; other columns are kept and replaced
only where a result column has the same name.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.columns import keep_rows_with
from obsengine.llm.pieces import ARRAY_CHARS, text_chunks
from obsengine.llm.samples import bounded_sample
from obsengine.llm.vectors import MIX, code_points, letter_table, spread
from obsengine.llm.workers import map_arrow

SPACE = 32
UNKNOWN = "und"


def letter_stream(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, ``pad`` zeros before each.

    Returns the symbols, the text of each symbol, and how many letters each text has.
    """
    points, ends = code_points([t.lower() for t in texts])
    letter = letter_table()[points] == 1
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    symbols = np.where(letter, points, SPACE).astype(np.uint32)
    kept = letter.copy()
    kept[1:] |= letter[:-1] & (owner[1:] == owner[:-1])  # one space after each run of letters
    letters = np.bincount(owner[letter], minlength=len(texts))
    symbols, owner = symbols[kept], owner[kept]
    sizes = np.bincount(owner, minlength=len(texts))
    before = (np.cumsum(sizes) - sizes)[owner]
    place = np.arange(len(symbols)) - before
    block = sizes + pad + 1
    start = np.cumsum(block) - block
    out = np.zeros(int(block.sum()), np.uint32)
    out[start + pad] = SPACE
    out[start[owner] + pad + 1 + place] = symbols
    return out, np.repeat(np.arange(len(texts)), block), letters


def gram_hashes(symbols: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1- to ``order``-grams that end at each symbol (zeros before the first)."""
    base = spread(symbols.astype(np.uint64) + np.uint64(1))
    hashes = [base]
    for _ in range(order - 1):
        longer = hashes[-1] * MIX
        shifted = np.empty_like(longer)
        shifted[0] = 0
        shifted[1:] = longer[:-1]
        hashes.append(shifted + base)
    return hashes


@dataclass
class Grams:
    """Values by hash: ``values`` beside the sorted ``keys``, ``other`` for all other hashes."""

    keys: np.ndarray
    values: np.ndarray
    other: float

    @classmethod
    def of(cls, hashes: np.ndarray, values: np.ndarray, other: float) -> "Grams":
        order = np.argsort(hashes)
        return cls(hashes[order], values[order], other)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, self.values[at], self.other)


@dataclass
class Model:
    """Fitted languages: for each one by order the ``gains`` of n-grams, for each context length
    from 0 the back-off ``weights`` of contexts, and ``floor``, the probability below all orders."""

    languages: list[str]
    order: int
    gains: list[list[Grams]] = field(default_factory=list)
    weights: list[list[Grams]] = field(default_factory=list)
    floor: float = 1.0
    limits: np.ndarray | None = None

    def size(self) -> int:
        """Bytes of all arrays."""
        lists = [*self.gains, *self.weights]
        return sum(g.keys.nbytes + g.values.nbytes for grams in lists for g in grams)

    def log_probabilities(self, hashes: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Interpolated log probability of each symbol in each language.

        ``hashes[k]`` are the (k+1)-grams that end at the symbols, ``contexts[k]`` those before.
        """
        out = np.empty((len(hashes[0]), len(self.languages)))
        for j in range(len(self.languages)):
            p = np.full(len(hashes[0]), self.floor)
            for k in range(self.order):
                before = contexts[k - 1] if k else np.zeros(len(p), np.uint64)
                p = self.gains[j][k].find(hashes[k]) + p * self.weights[j][k].find(before)
            out[:, j] = np.log(p)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in each language, and letters, of each text."""
        symbols, owner, letters = letter_stream(texts, self.order - 1)
        hashes = gram_hashes(symbols, self.order)
        real = np.flatnonzero(symbols)
        which, grams = pd.factorize(hashes[-1][real])
        at = np.empty(len(grams), np.int64)
        at[which] = real  # any place of an n-gram will do
        logs = self.log_probabilities(
            [h[at] for h in hashes], [h[np.maximum(at - 1, 0)] for h in hashes[:-1]]
        )
        owner = owner[real]
        counts = np.bincount(owner, minlength=len(texts))
        total = np.stack(
            [
                np.bincount(owner, weights=logs[which, j], minlength=len(texts))
                for j in range(len(self.languages))
            ],
            axis=1,
        )
        return -total / np.maximum(counts, 1)[:, None], letters

    def predict(self, texts: list[str], sharpness: float = 8.0) -> list[tuple]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, None, True)] * len(texts)
        entropy, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy.min(axis=1)
        score = 1.0 / np.exp(-sharpness * (entropy - low[:, None])).sum(axis=1)
        return [
            (self.languages[b], float(s), float(e), bool(e > self.limits[b]))
            if n
            else (UNKNOWN, 0.0, None, True)
            for b, s, e, n in zip(best, score, low, letters, strict=True)
        ]


def _gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """Counts of the ``order``-grams, as UTF-32 code points, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                by.setdefault(lang.as_py(), []).append(text.as_py())
            for lang, texts in by.items():
                symbols, _, _ = letter_stream(texts, order - 1)
                ends = np.flatnonzero(symbols)
                _, first, n = np.unique(
                    gram_hashes(symbols, order)[-1][ends], return_index=True, return_counts=True
                )
                grams = symbols[ends[first][:, None] + np.arange(1 - order, 1)]
                flat = pa.py_buffer(np.ascontiguousarray(grams, "<u4"))
                fixed = pa.Array.from_buffers(pa.binary(4 * order), len(n), [None, flat])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(n)),
                        fixed.cast(pa.binary()),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    parts = map_arrow(rows, run, "lang string, gram binary, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame, order: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """All counts of ``_gram_counts`` on the driver: code points and counts by language."""
    table = counts.toArrow()
    langs = table["lang"].combine_chunks().dictionary_encode()
    codes = langs.indices.to_numpy()
    flat = table["gram"].cast(pa.binary(4 * order)).combine_chunks()
    start = flat.offset * order
    grams = np.frombuffer(flat.buffers()[1], "<u4")[start : start + len(flat) * order]
    grams, n = grams.reshape(-1, order), table["n"].to_numpy()
    names = langs.dictionary.to_pylist()
    return {lang: (grams[codes == i], n[codes == i]) for i, lang in enumerate(names)}


def _row_hashes(grams: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols, as ``gram_hashes`` has it; 0 for no symbol."""
    hashes = np.zeros(len(grams), np.uint64)
    for i in range(grams.shape[1]):
        hashes = hashes * MIX + spread(grams[:, i].astype(np.uint64) + np.uint64(1))
    return hashes


def kneser_ney(counts: dict[str, dict[str, int]], order: int) -> Model:
    """The model of n-gram counts by language; every gram has ``order`` characters."""
    return _kneser_ney(
        {
            lang: (
                code_points(list(grams))[0].reshape(-1, order),
                np.array(list(grams.values()), np.int64),
            )
            for lang, grams in counts.items()
        },
        order,
    )


def _kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Model:
    """``kneser_ney`` from code points and counts."""
    model = Model(sorted(counts), order)
    vocabulary = np.unique(np.concatenate([np.unique(g[:, -1]) for g, _ in counts.values()]))
    model.floor = 1.0 / (len(vocabulary) + 1)
    for lang in model.languages:
        grams, n = counts[lang]
        gains, weights = [], []
        for _ in range(order):
            ones, twos = int((n == 1).sum()), int((n == 2).sum())
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
            contexts, context = np.unique(_row_hashes(grams[:, :-1]), return_inverse=True)
            totals = np.bincount(context, weights=n, minlength=len(contexts))
            kinds = np.bincount(context, minlength=len(contexts))
            gains.insert(0, Grams.of(_row_hashes(grams), (n - discount) / totals[context], 0.0))
            weights.insert(0, Grams.of(contexts, discount * kinds / totals, 1.0))
            # In how many ways each shorter gram is continued to the left.
            _, first, n = np.unique(
                _row_hashes(grams[:, 1:]), return_index=True, return_counts=True
            )
            grams = grams[first, 1:]
        model.gains.append(gains)
        model.weights.append(weights)
    return model


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    order: int = 4,
    per_language: int = 2_500,
    quantile: float = 0.99,
    margin: float = 1.25,
) -> Model:
    """Fit on a bounded sample of rows with a language and a text.

    All n-grams of the sample reach the driver, so the model grows with its languages and the
    length of its texts.  The limit of rejection lies ``margin`` nats above the ``quantile`` of the cross-entropies that
    the calibrating fifth of the sample has in its own language.  A language without a row in
    that fifth takes the quantile of the rows of all languages.
    """
    rows = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"),
        F.col(label).cast("string").alias("lang"),
        F.col(key).alias("key"),
    )
    sample = bounded_sample(
        rows, "lang", "key", per_language,
        ["text", "lang", F.pmod(F.xxhash64(F.lit(23), "key"), F.lit(5)).alias("fold")],
    )
    fitted = _gram_counts(sample.where("fold <> 0").select("text", "lang"), order)
    counts = _collected(fitted, order)
    if not counts:
        return Model([], order)
    model = _kneser_ney(counts, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(0)]
            langs = [v.as_py() for v in batch.column(1)]
            entropy, letters = model.entropies(texts)
            own = [
                (lang, float(entropy[i, model.languages.index(lang)]))
                for i, lang in enumerate(langs)
                if letters[i] and lang in model.languages
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.float64())],
                names=["lang", "entropy"],
            )

    held = map_arrow(
        sample.where("fold = 0").select("text", "lang"), run, "lang string, entropy double"
    )
    usual = F.percentile("entropy", F.lit(quantile)).alias("usual")
    found = {r.lang: r.usual for r in held.rollup("lang").agg(usual).collect()}
    pooled = found.get(None)  # no row calibrates: nothing tells what is unlike a language
    pooled = np.inf if pooled is None else pooled
    model.limits = np.array([found.get(lang, pooled) + margin for lang in model.languages])
    return model


def predict(
    docs: DataFrame, model: Model, text: str = "text", prediction: str = "lang_pred"
) -> DataFrame:
    """``docs`` with the predicted language, ``score``, ``cross_entropy`` and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def column(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        fitted = shared.value
        for batch in batches:
            found: list[tuple] = []
            for _, texts in text_chunks(batch, at, ARRAY_CHARS):
                found.extend(fitted.predict(texts))
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]

    added = [
        (prediction, "string"), ("score", "double"), ("cross_entropy", "double"),
        ("rejected", "boolean"),
    ]
    return keep_rows_with(docs, text, added, column)
