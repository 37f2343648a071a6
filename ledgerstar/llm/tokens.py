"""Token ids of whole texts, by encoding each distinct piece of them once per worker.

Both tokenizers work within runs between white space, so the ids of a text are those of its pieces
in turn. A worker keeps the ids of the pieces it has met, up to a bound. The tokenizer's file is
read from its path on each node; special strings inside a text count as ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

ENTRIES = 700_000  # pieces that a worker keeps; beyond that, those met once go
LEARNT = 10_000  # new pieces encoded at once
SPACE = "\t-\r \x85\xa0  -     　"  # Unicode's White_Space

# A word takes one space before it; of other white space, all but what the word takes is a piece
SPACED = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def spaced(text: bytes) -> list[str]:
    """Pieces for tokenizers that keep white space."""
    return SPACED.findall(text.decode())


class _Numbers(dict):
    """A number for each piece, in order of appearance; ``new`` has those not yet encoded."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, piece) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts to 16-bit ids."""

    def __init__(self, path: str, split):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.split = split
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.empty(0, np.uint16)
        self.sizes = np.empty(0, np.int64)
        self.again = np.empty(0, bool)  # met more than once

    def _forget(self) -> None:
        """Keep the pieces met more than once, or none where these are most."""
        if 2 * self.again.sum() > ENTRIES:
            self._clear()
            return
        kept = [x for x, again in zip(self.numbers, self.again.tolist()) if again]
        self.numbers = _Numbers()
        self.numbers.update(zip(kept, range(len(kept))))
        self.ids = self.ids[np.repeat(self.again, self.sizes)]
        self.sizes = self.sizes[self.again]
        self.again = np.zeros(len(kept), bool)

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        ids, sizes = [self.ids], [self.sizes]
        for at in range(0, len(new), LEARNT):
            texts = [x.decode() if isinstance(x, bytes) else x for x in new[at : at + LEARNT]]
            found = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint16))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(texts)))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of ids of each."""
        if len(self.numbers) > ENTRIES:
            self._forget()
        pieces: list = []
        counts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.split(text)
            counts[i] = len(found)
            pieces += found
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        times = np.bincount(numbers, minlength=len(self.numbers))
        times[: len(self.again)] *= 2  # known before
        self.again = np.append(self.again, np.zeros(len(times) - len(self.again), bool)) | (times > 1)
        # every piece's stretch of the kept ids, with a place for the end after each text
        starts = np.cumsum(self.sizes) - self.sizes
        bounds = np.cumsum(counts)
        sizes = np.insert(self.sizes[numbers], bounds, 1)
        sources = np.insert(starts[numbers], bounds, len(self.ids))
        places = np.cumsum(sizes) - sizes
        at = np.repeat(sources - places, sizes) + np.arange(int(sizes.sum()))
        ids = np.append(self.ids, np.uint16(end))[at]
        ends = (places + sizes)[bounds + np.arange(len(texts))]
        return ids, np.diff(ends, prepend=0)


@lru_cache(maxsize=4)
def encoder(path: str, pieces: str) -> Encoder:
    """The encoder of this worker process; ``pieces`` is ``words`` or ``spaced``.

    Words are for tokenizers that drop white space. They are cut at ASCII white space only; the
    tokenizer itself cuts at any other.
    """
    return Encoder(path, {"words": bytes.split, "spaced": spaced}[pieces])
