"""Words of whole texts inside Arrow tasks.

A word is a run of characters other than ASCII white space, ``[^\\x20\\x09-\\x0D]+``. In UTF-8 these
are exactly the pieces that ``bytes.split`` yields.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
GROUP_BYTES = 2 << 20  # texts that a task takes apart at once; a longer text is a group alone
CACHE = 300_000  # entries of a task's word cache


def groups(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of some ``GROUP_BYTES`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        part = np.cumsum(sizes, dtype=np.int64) // GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hash of each word, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_all(documents: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words in order, and the number of words of each document."""
    words: list[bytes] = []
    counts = np.empty(len(documents), np.int64)
    for i, text in enumerate(documents):
        found = text.split()
        counts[i] = len(found)
        words += found
    return words, counts


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its beginning and that of its last item."""
    return mixed(left * np.uint64(0xD6E8FEB86659FD93) + right)


def packed(values: np.ndarray) -> bytes:
    """Integers in little room: byte planes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data) if data else b"", np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()
