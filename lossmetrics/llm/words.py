"""Words and rolling hashes of a block of texts as numpy arrays, without a loop over characters.

A word is a run of symbols other than space and tab to carriage return. The hash of a run of symbols is a difference of
prefix sums of a polynomial modulo 2**64, so that every word and every character n-gram of a block costs a few vector
operations. Hashes are finished with a bit mixer and depend on the symbols alone.
"""

from __future__ import annotations

import numpy as np

#: Text handled at once; small enough that the arrays of a block stay near the processor.
BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if len(_powers[0]) < size:
        room = max(size, BLOCK_BYTES + 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(room, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:size], _powers[1][:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


class Block:
    """The symbols of some texts, one after another with a line feed before each and behind the last, and where their words are."""

    def __init__(self, texts: list[str | None], code_points: bool = False, lower_ascii: bool = False):
        joined = "\n".join(["", *(t or "" for t in texts), ""])
        if code_points:
            self.symbols = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            lengths = [len(t or "") + 1 for t in texts]
        else:
            encoded = joined.encode("utf-8")
            self.symbols = np.frombuffer(encoded, np.uint8)
            lengths = [len((t or "").encode("utf-8")) + 1 for t in texts] if len(encoded) != len(joined) else [len(t or "") + 1 for t in texts]
        self.texts = len(texts)
        self.bounds = np.cumsum([0, *lengths])
        s = self.symbols
        self.space = (s == 32) | ((s >= 9) & (s <= 13))
        if lower_ascii:
            self.symbols = np.where((s >= 65) & (s <= 90), s + s.dtype.type(32), s)
        edges = np.diff(np.concatenate(([True], self.space)).astype(np.int8))
        self.starts = np.flatnonzero(edges == -1)
        self.ends = np.flatnonzero(edges == 1)
        self.owner = np.searchsorted(self.bounds, self.starts, side="right") - 1
        power, self._back = _tables(len(s) + 1)
        self._sums = np.zeros(len(s) + 1, np.uint64)
        np.cumsum((self.symbols.astype(np.uint64) + np.uint64(1)) * power[:-1], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        """A 64-bit hash of each run of symbols."""
        raw = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)
