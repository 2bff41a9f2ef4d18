"""Word shingles as sets of 64-bit numbers."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from altigrid.llm.common import mix64

WIDTH = 5


class WordHashes(dict):
    """Cache of word hashes; emptied when full, so it stays small in any corpus."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def forget_words() -> None:
    _HASHES.clear()


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words (lower case, by white space).

    A text of fewer words is one shingle; a text without words has none.
    """
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    n = len(words) - span + 1
    mixed = np.full(n, span, np.uint64)
    for k in range(span):
        mixed = mix64(mixed ^ hashes[k:k + n])
    return np.unique(mixed)


def set_digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
