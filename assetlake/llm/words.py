"""Words of a text and their hashes, for operators that compare sets of word shingles.

A word is a longest run of characters other than space and the controls 0x09-0x0D; A-Z are
lower-cased.  All functions work on batches of texts inside a task and keep no more than the
batch in memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MEMO_WORDS = 1 << 19
BATCH_BYTES = 4 << 20
_MIX1, _MIX2, _STEP = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


class WordHashes(dict):
    """64-bit hashes of words; up to MEMO_WORDS of them are remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


def split_words(text: str | None) -> list[bytes]:
    """The words of a text as bytes; bytes.split() cuts at the six ASCII blanks alone."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str | None, memo: WordHashes) -> np.ndarray:
    return np.array([memo[w] for w in split_words(text)], dtype=np.uint64)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle as a whole."""
    n = min(width, len(hashes))
    if not n:
        return hashes
    rows = len(hashes) - n + 1
    value = np.full(rows, n, dtype=np.uint64)
    for k in range(n):
        value = value * _STEP + hashes[k : k + rows]
    return np.unique(mixed(value))


def set_key(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a whole set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def blocks(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that the texts of each piece hold about BATCH_BYTES; one text at least."""
    for batch in batches:
        texts = batch.column(column)
        start, held = 0, 0
        for i in range(len(texts)):
            held += len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
            if held >= BATCH_BYTES:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < len(texts):
            yield batch.slice(start)
