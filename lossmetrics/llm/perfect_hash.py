"""Minimal perfect hash of a set of byte strings, with the strings stored for verification.

Keys are hashed to bit arrays, level by level: a key that is alone at its place of a level stays there, the others go on to
the next level, which is sized for them. The number of set bits before a key's bit is its index, so n keys get the numbers 0
to n - 1. About three bits a key, beside the keys themselves. A string that is no key may also reach a number; comparing it
with the stored key tells.

Defined cases: no keys give a hash that finds nothing; keys whose 64-bit hashes are equal are kept in a dictionary, so every
set of distinct keys can be built; repeated keys are an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import xxhash

from lossmetrics.llm.words import mix

#: Places of a level per key that is left.
ROOM = 1.5
#: Levels before the rest goes to the dictionary.
LEVELS = 40


def hashes(keys: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _places(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(hashed ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct byte strings."""

    def __init__(self, keys: Sequence[bytes]):
        if len(set(keys)) != len(keys):
            raise ValueError("repeated keys")
        hashed = hashes(keys)
        left = np.arange(len(keys))
        # Equal hashes never part, so such keys go to the dictionary at once.
        _, first, count = np.unique(hashed, return_index=True, return_counts=True)
        alone = np.zeros(len(keys), bool)
        alone[first[count == 1]] = True
        rest, left = left[~alone], left[alone]
        bits, sizes, order = [], [], []
        while len(left) and len(sizes) < LEVELS:
            size = -(-max(64, int(ROOM * len(left))) // 64) * 64
            place = _places(hashed[left], len(sizes), size).astype(np.int64)
            single = np.bincount(place, minlength=size)[place] == 1
            level = np.zeros(size, bool)
            level[place[single]] = True
            order.append(left[single][np.argsort(place[single])])
            bits.append(level)
            sizes.append(size)
            left = left[~single]
        rest = np.concatenate([rest, left])
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.words = np.packbits(flat, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)
        self.sizes = sizes
        ranked = np.concatenate([*order, rest]).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
        self.keys = [keys[k] for k in ranked]
        self.other = {keys[k]: len(keys) - len(rest) + n for n, k in enumerate(rest)}

    def __len__(self) -> int:
        return len(self.keys)

    def candidates(self, hashed: np.ndarray) -> np.ndarray:
        """The number that each hash leads to, -1 for none; unverified."""
        found = np.full(len(hashed), -1, np.int64)
        left, start = np.arange(len(hashed)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = _places(hashed[left], level, size).astype(np.int64) + start
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = self.before[word[hit]] + below[hit]
            left, start = left[~hit], start + size
        return found

    def lookup(self, keys: Sequence[bytes]) -> np.ndarray:
        """The number of every string, -1 for a string that is no key: exact, as the stored key is compared."""
        stored, other = self.keys, self.other
        found = self.candidates(hashes(keys)).tolist()
        return np.fromiter((k if k >= 0 and stored[k] == key else other.get(key, -1) if other else -1 for k, key in zip(found, keys)), np.int64, len(keys))

    def dump(self) -> bytes:
        return pickle.dumps((self.words, self.before, self.sizes, b"\0".join(self.keys) if all(b"\0" not in k for k in self.keys) else self.keys, self.other), 5)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        made = cls.__new__(cls)
        made.words, made.before, made.sizes, keys, made.other = pickle.loads(data)
        made.keys = (keys.split(b"\0") if len(made.before) > 1 or made.other else []) if isinstance(keys, bytes) else keys
        return made
