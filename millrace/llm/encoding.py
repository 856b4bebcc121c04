"""Token ids of whole texts by a public tokenizer, as little-endian unsigned integers.

White space separates tokens in a word-end vocabulary, and so does the border between a run
of letters and the ASCII punctuation after it.  So the ids of a text are those of its chunks,
one after the other; chunks recur, and each worker keeps the ids of those it has met.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Capital letters whose lower case depends on their place or is not one letter.
ODD_CAPITALS = "\u03a3\u0130"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for the letters from
    256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids of texts.  ``kept`` bounds the words that a worker remembers, ``slice_bytes`` the texts it encodes at once."""

    def __init__(self, path: str, kept: int = 100_000, longest: int = 64, slice_bytes: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.kept, self.longest, self.slice_bytes = kept, longest, slice_bytes
        self.words: dict[str, bytes] = {}

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def whole(self, text: str) -> bytes:
        """The library's ids of ``text`` in one call."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def documents(self, texts: pa.Array):
        """The ids of each text, one array after the other; about a megabyte at a time."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(texts):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + self.slice_bytes, "right")))
            ids, offsets = self.encode(texts.slice(a, b - a))
            for x, y in zip(offsets, offsets[1:]):
                yield ids[x:y]
            a = b

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, list[int]]:
        """The ids of all texts and where each text's begin; each distinct chunk is seen once."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.values.dictionary_encode()
        of_chunk = [self.chunk(c) for c in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, of_chunk), np.int64, len(of_chunk)) // 4
        ids, first = np.frombuffer(b"".join(of_chunk), "<u4"), np.cumsum(size) - size
        code = coded.indices.to_numpy()
        length = size[code]
        ends = np.concatenate(([0], np.cumsum(length)))
        place = np.repeat(first[code] - ends[:-1], length)
        place += np.arange(len(place))
        return ids[place], ends[lists.offsets.to_numpy()].tolist()

    def chunk(self, chunk: str) -> bytes:
        word = chunk.rstrip(string.punctuation)
        ids = self.words.get(word) or self.word(word)
        if not ids:
            return self.whole(chunk)
        if len(word) < len(chunk):
            tail = chunk[len(word) :]
            ids += self.words.get(tail) or self.keep(tail, self.whole(tail))
        return ids

    def word(self, word: str) -> bytes:
        """Ids of a run of letters, normalised as the vocabulary asks, then merged by the library.

        Nothing for what isn't such a run, or is one that only the library's own rules lower.
        """
        if len(word) > self.longest or not word.isalpha() or any(c in word for c in ODD_CAPITALS):
            return b""
        letters = word.lower()
        if not letters.isascii():
            letters = unicodedata.normalize("NFC", word).lower()
            if not letters.isalpha():
                return b""
            letters = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self.keep(word, _packed([t.id for t in self.merge(letters)]))

    def keep(self, key: str, ids: bytes) -> bytes:
        if len(key) <= self.longest:
            if len(self.words) >= self.kept:
                self.words.clear()
            self.words[key] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)


def with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, np.uint32(end_id))
