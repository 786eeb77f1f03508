"""Byte-pair encoding and decoding with the merges of a public tokenizer file.

Encoding keeps a heap of (merge rank, position) over the symbols of a pre-token, which form a
doubly linked list; heap entries whose symbols have since changed are skipped.  Decoding joins
the vocabulary's byte strings.  The tokenizer file is read, never trained or copied.

Defined results: a null text is encoded as the empty text; the empty text has no tokens and
decodes to itself; equal texts have equal ids; ids of special tokens come from their literal
strings in the text, as in the tokenizers library.  Rows keep their order and columns; a
result column replaces an input column of the same name.
"""

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from obsengine.llm.columns import keep_rows_with
from obsengine.llm.pieces import PieceCache, text_chunks

#: Fixed value: how byte-level tokenizers split a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairCodec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str, max_words: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self._byte_ids = [0] * 256
        for letter, byte in letters.items():
            self._byte_ids[byte] = vocab[letter]
        # A pair of ids as one integer -> its rank and the id it merges to, as one integer.
        self._merges: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left] << 32 | vocab[right]
            self._merges.setdefault(pair, rank << 32 | vocab[left + right])
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {**{i: s for s, i in vocab.items()}, **{i: s for s, i in self._special.items()}}
        self._strings = [b""] * (max(strings) + 1)
        for i, s in strings.items():
            known = i not in self._special.values() and all(c in letters for c in s)
            self._strings[i] = bytes(letters[c] for c in s) if known else s.encode()
        self._split = regex.compile(PRE_TOKEN)
        self._specials = regex.compile(
            "(" + "|".join(regex.escape(s) for s in self._special) + ")"
        ) if self._special else None
        self._pieces = PieceCache(
            self._split.findall, self._word, self._encode_one, tuple(self._special), max_words
        )

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self._byte_ids[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        merges = self._merges.get
        heap = []
        for i in range(n - 1):
            found = merges(ids[i] << 32 | ids[i + 1])
            if found is not None:
                heap.append((found >> 32, i, found & 0xFFFFFFFF, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        while heap:
            _, i, merged, left, right = heapq.heappop(heap)
            j = following[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: a neighbour was merged meanwhile
            ids[i], ids[j] = merged, -1
            k = following[i] = following[j]
            if k < n:
                previous[k] = i
                found = merges(merged << 32 | ids[k])
                if found is not None:
                    heapq.heappush(heap, (found >> 32, i, found & 0xFFFFFFFF, merged, ids[k]))
            h = previous[i]
            if h >= 0:
                found = merges(ids[h] << 32 | merged)
                if found is not None:
                    heapq.heappush(heap, (found >> 32, h, found & 0xFFFFFFFF, ids[h], merged))
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> bytes:
        ids = self.merge(word.encode("utf-8", "replace"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_one(self, text: str) -> bytes:
        if self._specials is None:
            return b"".join(map(self._word, self._split.findall(text)))
        out = []
        for part in self._specials.split(text):
            if part in self._special:
                out.append(struct.pack("<I", self._special[part]))
            else:
                out.extend(map(self._word, self._split.findall(part)))
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self._pieces.encode(texts)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        strings = map(self._strings.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(strings).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """One codec per worker and file, with its cache."""
    return BytePairCodec(path)


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """``docs`` with the ids of its texts as bytes (little-endian unsigned 32-bit integers)."""

    def column(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        encoder = codec(path)
        for batch in batches:
            out: list[bytes] = []
            for _, texts in text_chunks(batch, at):
                out.extend(encoder.encode(texts))
            yield [pa.array(out, pa.binary())]

    return keep_rows_with(docs, text, [(ids, "binary")], column)


def decode(
    docs: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded"
) -> DataFrame:
    """``docs`` with the texts of its ids; null ids give the empty text."""

    def column(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        decoder = codec(path)
        for batch in batches:
            texts = [decoder.decode(v.as_py() or b"") for v in batch.column(at)]
            yield [pa.array(texts, pa.string())]

    return keep_rows_with(docs, ids, [(text, "string")], column)


def round_trip_digests(
    docs: DataFrame, path: str, text: str = "text", with_ids: bool = False
) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each row, texts left out.

    Ids and decoded texts are made as by ``encode`` and ``decode`` but stay inside the task,
    unless ``with_ids`` asks for ``token_ids`` as bytes.
    """

    def column(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.Array]]:
        coder = codec(path)
        for batch in batches:
            counts: list[int] = []
            id_digests: list[str] = []
            text_digests: list[str] = []
            kept: list[bytes] = []
            for _, texts in text_chunks(batch, at):
                for ids in coder.encode(texts):
                    counts.append(len(ids) // 4)
                    id_digests.append(hashlib.sha256(ids).hexdigest())
                    decoded = coder.decode(ids).encode()
                    text_digests.append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        kept.append(ids)
            yield [
                pa.array(counts, pa.int64()),
                pa.array(id_digests, pa.string()),
                pa.array(text_digests, pa.string()),
                *([pa.array(kept, pa.binary())] if with_ids else []),
            ]

    added = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    added += [("token_ids", "binary")] if with_ids else []
    return keep_rows_with(docs, text, added, column).drop(text)
