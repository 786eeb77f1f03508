"""Byte-level pre-tokenisation by spaces, with a bounded cache of encoded pieces.

A byte-level tokenizer never joins characters across the start of a space that follows a
non-space character, so a text can be cut there and equal pieces need encoding only once.
"""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa

#: A space between white space, or between white space and the end: the cut would change tokens.
_UNSAFE_SPACE = re.compile(r" (?<=\s )(?:\s|\Z)")

#: Characters of text handled at a time inside one Arrow batch; fewer where a character takes
#: many bytes of arrays.
CHUNK_CHARS = 1_000_000
ARRAY_CHARS = 300_000


#: Marks that are tokens of their own after a word.
_MARKS = frozenset(",.;:!?")


class PieceCache(dict):
    """Ids of texts as bytes, through cached pieces.

    ``split`` cuts a piece into pre-tokens, ``encode_word`` gets one of them and ``encode_text``
    any text; both return the bytes of its ids.  A key is a piece without
    the space before it; the first piece of a text is kept with a space in front.  The cache is
    emptied when it holds ``max_entries`` pieces, so a worker's memory is bounded.
    """

    def __init__(
        self,
        split: Callable[[str], list[str]],
        encode_word: Callable[[str], bytes],
        encode_text: Callable[[str], bytes],
        special: tuple[str, ...] = (),
        max_entries: int = 1_000_000,
    ):
        super().__init__()
        self._split = split
        self._encode_word = encode_word
        self._encode_text = encode_text
        self._special = special
        self._max_entries = max_entries
        self._marks = {mark: encode_text(mark) for mark in _MARKS}

    def __missing__(self, piece: str) -> bytes:
        plain = piece.removeprefix(" ")
        text = plain if plain is not piece else " " + piece
        if plain.isalpha():
            found = self._encode_word(text)
        elif piece[-1:] in _MARKS and plain[:-1].isalpha():
            found = self[piece[:-1]] + self._marks[piece[-1]]
        else:
            tokens = self._split(text)
            if len(tokens) == 1:
                found = self._encode_word(text)
            else:
                found = b"".join([self[t[1:] if t[0] == " " else " " + t] for t in tokens])
        self[piece] = found
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        get = self.__getitem__
        for text in texts:
            if _UNSAFE_SPACE.search(text) or any(s in text for s in self._special):
                out.append(self._encode_text(text))
                continue
            if len(self) > self._max_entries:
                self.clear()
            pieces = text.split(" ")
            pieces[0] = " " + pieces[0]
            out.append(b"".join(map(get, pieces)))
        return out


def text_chunks(
    batch: pa.RecordBatch, column: int, chars: int = CHUNK_CHARS
) -> Iterator[tuple[int, list[str]]]:
    """Row offset and texts (null: empty) of a batch, about ``chars`` characters at a time."""
    texts: list[str] = []
    size = start = 0
    for row, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= chars:
            yield start, texts
            start, texts, size = row + 1, [], 0
    if texts:
        yield start, texts
