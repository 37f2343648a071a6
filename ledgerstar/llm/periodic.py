"""Runs of periodic words in whole texts, by enumerating maximal pairs.

A run is a stretch of words with smallest period ``q`` and a length of at least ``LEAST_WORDS`` and
``LEAST_TIMES * q`` that no neighbouring word extends. Its start and the place one period on begin
equal sequences that differ in the word before and in the word after: a maximal pair at distance ``q``,
whose common length ``l`` is the run's length less ``q``. So the maximal pairs with
``l >= (LEAST_TIMES - 1) * q`` and ``l + q >= LEAST_WORDS`` are the runs as they stand, and nothing is
extended; of pairs over one stretch the smallest distance is its period.

Suffixes are sorted by doubling, for all documents of a group at once. The tree of LCP intervals is
walked bottom up; an interval holds its positions in order, classed by the word to the left, and children
are joined smaller into larger. A position meets the nearest position on either side in the other child:
positions of one class make no maximal pair, and among those within half the common length all but the
first are of one class, so a farther partner only gives a multiple of a period already found.

An interval below ``DEPTH`` words cannot hold a pair that satisfies both constraints. Only documents in
which a window of that many words occurs twice are sorted; windows are compared by hash there, so a
collision costs time and changes nothing.

Defined results: a null text has no words; a null id changes no words; rows are judged one by one, so
repeated rows give equal ones; an empty table gives an empty result. A document is worked on as a whole:
it takes some four bytes a word for each doubling of its longest repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm import words as W

LEAST_WORDS = 24
LEAST_TIMES = 3
FEW = 32  # positions inserted one by one rather than by a merge

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)

Run = tuple[int, int, int]  # start, length, period


def depth(least: int, times: int) -> int:
    """The smallest common length of a pair that satisfies both constraints."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


# Suffixes ------------------------------------------------------------------------------


def _repeating(codes: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """For each document, whether a window of that many words occurs in it twice."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keys = W.mixed(codes.astype(np.uint64) + np.uint64(1))
    for i in range(1, window):
        keys = W.chained(keys[:-1], W.mixed(codes[i:].astype(np.uint64) + np.uint64(1))) if len(keys) > 1 else keys[:0]
    left = np.cumsum(sizes)[owner[: len(keys)]] - np.arange(len(keys))
    whole = np.flatnonzero(left >= window)
    keys = W.chained(keys[whole], owner[whole].astype(np.uint64))
    order = np.argsort(keys)
    again = order[1:][keys[order[1:]] == keys[order[:-1]]]
    found = np.zeros(len(sizes), bool)
    found[owner[whole[again]]] = True
    return found


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int32)


def _levels(codes: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of each suffix within its document, until all differ."""
    n = len(codes)
    levels = [_ranked(owner.astype(np.int64) * (int(codes.max()) + 1) + codes)]
    ends = np.searchsorted(owner, owner, side="right")
    at = np.arange(n)
    while int(levels[-1].max()) < n - 1:
        step = 1 << (len(levels) - 1)
        last = levels[-1].astype(np.int64)
        inside = at + step < ends
        follow = np.zeros(n, np.int64)
        follow[inside] = last[at[inside] + step] + 1
        levels.append(_ranked(last * (n + 1) + follow))
    return levels


def _common(levels: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of equal words from each place of ``one`` and of ``other`` on; the places differ."""
    a, b = one.copy(), other.copy()
    for level in range(len(levels) - 1, -1, -1):
        ranks = np.append(levels[level], np.int32(-1))
        same = ranks[a] == ranks[b]
        a[same] += 1 << level
        b[same] += 1 << level
    return a - one


# Intervals -----------------------------------------------------------------------------


def _pairs(places: list[int], common: list[int], left: list[int], floor: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """``(first, second, common length)`` of the pairs of one subtree, whose suffixes come in order.

    ``common[i]`` belongs to ``places[i]`` and ``places[i + 1]``; the last one lies below ``floor``.
    """

    def joined(shared: int, one: list[int], other: list[int]):
        big, small = (one, other) if len(one) >= len(other) else (other, one)
        farthest = shared // (times - 1)
        for x in small:
            at = bisect_left(big, x)
            for y in big[max(at - 1, 0) : at + 1]:
                gap = abs(y - x)
                if gap <= farthest and shared + gap >= least and left[x] != left[y]:
                    found.append((min(x, y), max(x, y), shared))
        if len(small) <= FEW:
            for x in small:
                insort(big, x)
        else:
            big.extend(small)
            big.sort()
        return big

    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    for place, shared in zip(places, common):
        child = [place]
        while stack and stack[-1][0] > shared:
            child = joined(*stack.pop(), child)
        if shared < floor:
            break
        if stack and stack[-1][0] == shared:
            stack[-1] = (shared, joined(*stack[-1], child))
        else:
            stack.append((shared, child))
    return iter(found)


def runs(documents: list[np.ndarray], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[list[Run]]:
    """All runs of each document, by start, then period. A document is an array of word numbers."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in documents]
    floor = depth(least, times)
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    if sizes.sum() == 0:
        return [[] for _ in documents]
    which = np.flatnonzero(_repeating(np.concatenate(documents), sizes, floor))
    if len(which):
        codes = np.concatenate([documents[i] for i in which]).astype(np.int64)
        owner = np.repeat(np.arange(len(which)), sizes[which])
        starts = np.cumsum(sizes[which]) - sizes[which]
        levels = _levels(codes, owner)
        order = np.argsort(levels[-1])
        common = np.zeros(len(order), np.int64)
        enough = floor.bit_length() - 1  # the level of at most that many words
        near = np.flatnonzero(levels[enough][order[1:]] == levels[enough][order[:-1]])
        common[near] = _common(levels, order[near], order[near + 1])
        left = np.append(-1, codes[:-1])
        left[starts] = -1
        lefts = left.tolist()
        deep = common >= floor
        firsts = np.flatnonzero(deep & ~np.append(False, deep[:-1]))
        lasts = np.flatnonzero(deep & ~np.append(deep[1:], False)) + 1
        for first, last in zip(firsts.tolist(), lasts.tolist()):
            part = slice(first, last + 1)
            here = int(owner[order[first]])
            begin, runs_here = int(starts[here]), found[int(which[here])]
            for x, y, shared in _pairs(order[part].tolist(), common[part].tolist(), lefts, floor, least, times):
                stretch = x - begin, shared + y - x
                runs_here[stretch] = min(runs_here.get(stretch, y - x), y - x)
    return [sorted((start, n, q) for (start, n), q in x.items()) for x in found]


# Documents -------------------------------------------------------------------------------


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """The original word that stands at each of ``n`` places: a third part of some documents repeats.

    With ``h`` the CRC of the id and ``g`` its tenth, where 10 divides ``h`` the words from ``g % n`` on
    repeat the first ``1 + (n - a) // (3 + g % 8)`` of them.
    """
    at = np.arange(n)
    if doc_id is None or n == 0:
        return at
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest == 0:
        a = g % n
        at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


class _Numbers(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def row(found: list[Run], words: list[bytes]) -> tuple:
    """The result's columns behind ``doc_id``."""
    listed = _hex("".join(f"{s},{n},{q}\n" for s, n, q in found).encode())
    if not found:
        return 0, None, None, None, None, listed, _hex(b" ".join(words))
    edges = np.zeros(len(words) + 1, np.int64)
    for start, n, q in found:
        edges[start + q] += 1
        edges[start + n] -= 1
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
    start, n, q = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]))
    return len(found), start, n, q, 1000 * n // q, listed, _hex(b" ".join([words[i] for i in kept]))


def _detect(batches: Iterable[pa.RecordBatch], change: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.string() if x.endswith("sha256") else pa.int64() for x in names]
    for part in W.groups(batches):
        numbers, texts, codes = _Numbers(), [], []
        ids = part.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, W.texts(part.column("text"))):
            found = text.split()
            numbered = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
            if change:
                places = planted(doc_id, len(found))
                numbered, found = numbered[places], [found[i] for i in places.tolist()]
            texts.append(found)
            codes.append(numbered)
        rows = [(i, *row(x, text)) for i, x, text in zip(ids, runs(codes), texts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=names
        )


def detected(documents: DataFrame, change: bool = False) -> DataFrame:
    """One row per document: its runs, the one repeated most often, and the text without repetitions.

    ``runs_sha256`` digests ``start,length,period`` lines of all runs, ``collapsed_sha256`` the words that
    stay when every run keeps its first period alone. With ``change``, some documents get
    repeated words first, see :func:`planted`.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(lambda batches: _detect(batches, change), SCHEMA)
