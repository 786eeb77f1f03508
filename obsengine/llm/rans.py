"""Token ids in files of independent, interleaved rANS blocks with one shared frequency table.

Method: a static range asymmetric numeral system.  The counts of all ids are scaled to one
table whose slots sum to a power of two.  Ids are written in ascending order of the document
key; a block holds whole documents and is coded by ``lanes`` interleaved 64-bit states that
share one stream of 32-bit words.  Every ``interval`` rows of lanes a checkpoint keeps the
states and the place in the stream, so parts of a block decode in parallel; each part has the
crc32 of its ids.

Files: a folder with ``table`` (symbol, freq) and ``blocks`` (part, seq, before: ids
before it in its file, n_docs, n_tokens, first_id, last_id, block).  Block bytes, little-endian: magic ``RNS1``, scale bits u8, lanes
u16, n_docs u32, n_tokens u64, interval u32, n_words u64, then n_docs key flags u8 (1: the key
is null), n_docs keys i64, n_docs lengths u32, one crc32 u32 a segment, one (word u64, states
u64 x lanes) a segment, the words u32, and the crc32 u32 of all bytes before it.

Defined results: a null text is the empty text; a null key comes first; rows of equal keys are
ordered by their ids and stay separate documents; no documents give an empty folder that reads
back as no rows.
"""

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsengine.llm.bpe import PRE_TOKEN, byte_letters
from obsengine.llm.pieces import PieceCache, text_chunks
from obsengine.llm.workers import map_arrow

MAGIC = b"RNS1"
_HEADER = struct.Struct("<4sBHIQIQ")
_LOW = np.uint64(1 << 31)
#: Files whose starts (16 bytes each) are broadcast; beyond it they are joined by a shuffle.
MAX_BROADCAST_FILES = 1_000_000
_MASK32 = np.uint64(0xFFFFFFFF)


class FrequencyTable:
    """Slots of each symbol; ``freq`` sums to ``1 << bits`` and is 0 for unseen symbols."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.bits = int(self.freq.sum()).bit_length() - 1
        self.start = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.symbols = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))


def scaled_frequencies(counts: np.ndarray, bits: int = 0) -> np.ndarray:
    """Slots for ``counts``: proportional, at least 1 for each counted symbol."""
    used = counts > 0
    n_used = int(used.sum())
    bits = max(bits, 16, (4 * max(n_used, 1) - 1).bit_length())
    total = 1 << bits
    freq = np.zeros(len(counts), np.int64)
    if not n_used:
        freq[0] = total
        return freq
    share = counts[used] / counts[used].sum() * (total - n_used)
    slots = np.floor(share).astype(np.int64)
    rest = total - n_used - int(slots.sum())
    slots[np.argsort(slots - share, kind="stable")[:rest]] += 1
    freq[used] = slots + 1
    return freq


def encode_block(
    keys: list[int | None],
    lengths: list[int],
    ids: np.ndarray,
    table: FrequencyTable,
    lanes: int = 2048,
    interval: int = 256,
) -> bytes:
    """The bytes of one block; ``ids`` are those of all its documents in order."""
    n = len(ids)
    rows = -(-n // lanes)
    states = np.full(lanes, _LOW, np.uint64)
    freq, start, bits = table.freq, table.start, np.uint64(table.bits)
    total = np.uint64(1) << bits
    bound = (_LOW >> bits) << np.uint64(32)
    words: list[np.ndarray] = []
    n_words = 0
    marks: list[tuple[int, np.ndarray]] = []
    checks: list[int] = []
    for row in range(rows - 1, -1, -1):
        symbols = ids[row * lanes : (row + 1) * lanes]
        x = states[: len(symbols)]
        f = freq[symbols]
        over = x >= bound * f
        out = x[over]
        if len(out):
            words.append((out & _MASK32).astype("<u4"))
            n_words += len(out)
            x[over] = out >> np.uint64(32)
        quotient = x // f
        x += quotient * (total - f) + start[symbols]
        states[: len(symbols)] = x
        if row % interval == 0:
            part = ids[row * lanes : (row + interval) * lanes].astype("<u4")
            checks.append(zlib.crc32(part.tobytes()))
            marks.append((n_words, states.copy()))
    segments = [
        struct.pack("<Q", n_words - at) + state.astype("<u8").tobytes()
        for at, state in reversed(marks)
    ]
    body = b"".join(
        [
            _HEADER.pack(MAGIC, table.bits, lanes, len(keys), n, interval, n_words),
            np.array([k is None for k in keys], np.uint8).tobytes(),
            np.array([k or 0 for k in keys], "<i8").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            np.array(checks[::-1], "<u4").tobytes(),
            *segments,
            *(w.tobytes() for w in reversed(words)),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A parsed block: its documents, and any of its segments on request."""

    def __init__(self, data: bytes):
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged block: its checksum differs")
        magic, self.bits, self.lanes, n_docs, self.n_tokens, self.interval, n_words = (
            _HEADER.unpack_from(data)
        )
        if magic != MAGIC:
            raise ValueError("not a block of this format")
        at = _HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values

        null = take("u1", n_docs)
        keys = take("<i8", n_docs).tolist()
        self.keys = [None if gone else k for k, gone in zip(keys, null, strict=True)]
        self.lengths = take("<u4", n_docs)
        self.segments = -(-self.n_tokens // (self.lanes * self.interval))
        self.checks = take("<u4", self.segments)
        marks = take("<u8", self.segments * (self.lanes + 1))
        self.marks = marks.reshape(self.segments, self.lanes + 1)
        self.words = take("<u4", n_words)

    def segment(self, number: int, table: FrequencyTable) -> np.ndarray:
        """The ids of one segment, from its own checkpoint."""
        first = number * self.lanes * self.interval
        n = min(self.n_tokens - first, self.lanes * self.interval)
        at = int(self.marks[number, 0])
        states = self.marks[number, 1:].astype(np.uint64)
        bits = np.uint64(table.bits)
        mask = np.uint64((1 << table.bits) - 1)
        out = np.empty(n, np.uint32)
        for begin in range(0, n, self.lanes):
            x = states[: min(self.lanes, n - begin)]
            slot = x & mask
            symbols = table.symbols[slot]
            out[begin : begin + len(x)] = symbols
            x = table.freq[symbols] * (x >> bits) + slot - table.start[symbols]
            under = x < _LOW
            k = int(under.sum())
            if k:
                x[under] = x[under] << np.uint64(32) | self.words[at : at + k]
                at += k
            states[: len(x)] = x
        if zlib.crc32(out.astype("<u4").tobytes()) != self.checks[number]:
            raise ValueError("damaged segment: its checksum differs")
        return out

    def documents(self, table: FrequencyTable) -> Iterator[tuple[int | None, np.ndarray]]:
        """Key and ids of every document."""
        parts = [self.segment(i, table) for i in range(self.segments)]
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        ends = np.cumsum(self.lengths.astype(np.int64))
        for key, length, end in zip(self.keys, self.lengths, ends, strict=True):
            yield key, ids[end - int(length) : end]


def id_kind(tokenizer: str) -> str:
    """The narrowest little-endian integers that hold every id of a tokenizer file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def _library(path: str, kind: str, max_pieces: int) -> "PieceCache | WholeTexts":
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    pack = "H" if kind == "<u2" else "I"
    letters = {byte: letter for letter, byte in byte_letters().items()}  # by Latin-1 code point

    def encode(text: str) -> bytes:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{pack}", *ids)

    split_words = tokenizer.model.tokenize

    def encode_word(word: str) -> bytes:
        # A word is one pre-token, so the model alone gives its ids.
        if word[0] == " " and word.isascii() and word[1:].isalpha():
            mapped = letters[32] + word[1:]
        else:
            mapped = word.encode().decode("latin-1").translate(letters)
        ids = [t.id for t in split_words(mapped)]
        return struct.pack(f"<{len(ids)}{pack}", *ids)

    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    if not _is_byte_level(path):
        return WholeTexts(encode)
    return PieceCache(
        regex.compile(PRE_TOKEN).findall, encode_word, encode, special, max_pieces
    )


class WholeTexts:
    """Encodes whole texts one by one, for tokenizers whose texts cannot be cut at spaces."""

    def __init__(self, encode_text: Callable[[str], bytes]):
        self._encode_text = encode_text

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._encode_text(text) for text in texts]


def _is_byte_level(path: str) -> bool:
    """Whether a tokenizer file only splits byte-level pre-tokens, so that words stand alone."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
    )


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None,
    key: str = "doc_id",
    text: str = "text",
    max_pieces: int = 1_000_000,
) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (integers of ``id_kind``) of each text.

    ``end_id`` is appended to every text.  One row in each chunk of texts also has ``symbols``
    and ``counts`` of all ids of the chunk, so frequencies need no second look at the ids.
    """
    kind = id_kind(tokenizer)
    end = b"" if end_id is None else np.array([end_id], kind).tobytes()
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _library(tokenizer, kind, max_pieces)
        for batch in batches:
            for start, texts in text_chunks(batch, 1):
                ids = [found + end for found in encoder.encode(texts)]
                counts = np.bincount(np.frombuffer(b"".join(ids), kind))
                used = np.flatnonzero(counts)
                rest = [None] * (len(ids) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array([len(i) // width for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([used, *rest], pa.list_(pa.int64())),
                        pa.array([counts[used], *rest], pa.list_(pa.int64())),
                    ],
                    names=["key", "n_tokens", "ids", "symbols", "counts"],
                )

    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return map_arrow(
        rows, run, "key long, n_tokens long, ids binary, symbols array<long>, counts array<long>"
    )


def symbol_counts(tokens: DataFrame) -> DataFrame:
    """Occurrences of each id in ``tokens``, from the counts of its chunks."""
    pairs = tokens.where("symbols is not null").select(
        F.inline(F.arrays_zip("symbols", "counts"))
    )
    return pairs.groupBy("symbols").agg(F.sum("counts").alias("n")).toDF("symbol", "n")


def write_folder(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    block_tokens: int = 1 << 20,
    file_tokens: int = 1 << 23,
    lanes: int = 2048,
    interval: int = 256,
    max_files: int = 100_000,
) -> str:
    """Encode the texts of ``docs`` into a new folder of this format and return it.

    Texts are tokenised once into ``folder``/tokens; that table gives the frequencies and is
    then sorted into files of about ``file_tokens`` ids, larger ones beyond ``max_files``.  The frequency table has at most one
    row a vocabulary entry, so the driver can hold it.
    """
    spark = docs.sparkSession
    tokenize(docs, tokenizer, end_id, key, text).write.option("compression", "zstd").parquet(
        f"{folder}/tokens"
    )
    tokens = spark.read.parquet(f"{folder}/tokens")
    rows = symbol_counts(tokens).collect()
    counts = np.zeros(max((r.symbol for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.symbol] = r.n
    freq = scaled_frequencies(counts)
    used = [(int(s), int(freq[s])) for s in np.flatnonzero(freq)]
    spark.createDataFrame(used, "symbol long, freq long").coalesce(1).write.parquet(
        f"{folder}/table"
    )
    shared = spark.sparkContext.broadcast(freq)
    kind = id_kind(tokenizer)
    files = min(max_files, int(counts.sum() // file_tokens) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = FrequencyTable(shared.value)
        seq = before = 0
        keys: list[int | None] = []
        pending: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            lengths = [len(p) for p in pending]
            data = encode_block(keys, lengths, np.concatenate(pending), table, lanes, interval)
            known = [k for k in keys if k is not None]
            row = {
                "part": part, "seq": seq, "before": before, "n_docs": len(keys), "n_tokens": sum(lengths),
                "first_id": known[0] if known else None,
                "last_id": known[-1] if known else None, "block": data,
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        size = 0
        for batch in batches:
            for k, value in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(k.as_py())
                pending.append(np.frombuffer(value.as_py(), kind))
                size += len(pending[-1])
                if size >= block_tokens:
                    yield block()
                    seq, before, size = seq + 1, before + size, 0
                    keys.clear()
                    pending.clear()
        if keys:
            yield block()

    ordered = (
        tokens.repartitionByRange(files, "key", "n_tokens")
        .sortWithinPartitions("key", "n_tokens", "ids")
        .select("key", "ids")
    )
    blocks = map_arrow(ordered, run, _BLOCK_DDL)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


_BLOCK_DDL = (
    "part int, seq int, before long, n_docs long, n_tokens long, first_id long, last_id long, block binary"
)
_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("before", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("block", pa.binary()),
    ]
)


def file_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` and ``file_start``, the number of ids in all files before it: a row a file."""
    heads = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = heads.select("part", F.coalesce(before, F.lit(0)).alias("file_start"))
    return F.broadcast(starts) if heads.count() <= MAX_BROADCAST_FILES else starts


def read_folder(
    spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """``key``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids`` of every document.

    ``start`` counts the ids of all documents before it.  Every block is decoded from its
    bytes; without ``with_ids`` only the digests leave the tasks.
    """
    rows = spark.read.parquet(f"{folder}/table").collect()
    freq = np.zeros(max(r.symbol for r in rows) + 1, np.int64)
    for r in rows:
        freq[r.symbol] = r.freq
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(shared.value)
        for batch in batches:
            for part, before, data in zip(*batch.columns, strict=True):
                inside = before.as_py()
                out: list[tuple] = []
                for k, ids in Block(data.as_py()).documents(table):
                    raw = ids.astype("<u4").tobytes()
                    out.append((k, inside, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    inside += len(ids)
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(out), pa.int32()),
                        *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)),
                    ],
                    names=["part", "key", "inside", "n_tokens", "ids_crc32", "ids"],
                )

    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "before", "block")
    found = map_arrow(
        blocks, run, "part int, key long, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    return found.join(file_starts(spark, folder), "part").select(
        F.col("key").alias(key),
        (F.col("file_start") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
