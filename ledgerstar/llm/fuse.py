"""Static 3-wise binary fuse filters (Graf and Lemire, 2022) over 64-bit keys.

A key has one slot in each of three neighbouring segments, and the filter holds it where the three
slots XOR to its fingerprint. No key that was built in is ever missed; another key passes with
probability 1/256. Slots are assigned by peeling, a whole round of lonely slots at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerstar.llm.words import mixed


@dataclass(frozen=True)
class FuseFilter:
    seed: int
    segment: int  # slots per segment, a power of two
    segments: int  # first segments that a key may start in
    slots: np.ndarray  # one byte each

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not self.slots.size:
            return np.zeros(len(keys), bool)
        places, prints = _spread(keys, self.seed, self.segment, self.segments)
        return np.bitwise_xor.reduce(self.slots[places], axis=0) == prints


def _spread(keys, seed, segment, segments):
    """The three slots and the fingerprint of each key."""
    hashes = mixed(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    first = (hashes >> np.uint64(32)) * np.uint64(segment * segments) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ (hashes >> np.uint64(18) & mask)
    third = (first + np.uint64(2 * segment)) ^ (hashes & mask)
    prints = (hashes ^ (hashes >> np.uint64(40))).astype(np.uint8)
    return np.stack([first, second, third]).astype(np.int64), prints


def build(keys: np.ndarray) -> FuseFilter:
    keys = np.unique(keys)
    n = len(keys)
    if not n:
        return FuseFilter(0, 0, 0, np.empty(0, np.uint8))
    # sizes from the paper: segments grow slowly with the number of keys
    segment = 1 << min(18, max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-int(round(max(n, 2) * factor)) // segment) - 2)
    for seed in range(1, 1000):
        places, prints = _spread(keys, seed, segment, segments)
        rounds = _peel(places, segment * (segments + 2))
        if rounds is not None:
            slots = np.zeros(segment * (segments + 2), np.uint8)
            for who, slot in reversed(rounds):
                slots[slot] = prints[who] ^ np.bitwise_xor.reduce(slots[places[:, who]], axis=0)
            return FuseFilter(seed, segment, segments, slots)
    raise RuntimeError("no seed lets the filter be peeled")


def _peel(places, size):
    """Rounds of (keys, the slot that each has alone), or None if some keys stay entangled."""
    n = places.shape[1]
    count = np.bincount(places.ravel(), minlength=size)
    keys = np.zeros(size, np.int64)  # XOR of the keys in a slot
    np.bitwise_xor.at(keys, places.ravel(), np.tile(np.arange(n), 3))
    rounds, done = [], 0
    alone = np.flatnonzero(count == 1)
    while alone.size:
        who, first = np.unique(keys[alone], return_index=True)
        rounds.append((who, alone[first]))
        done += len(who)
        touched = places[:, who].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(keys, touched, np.tile(who, 3))
        touched = np.unique(touched)
        alone = touched[count[touched] == 1]
    return rounds if done == n else None
