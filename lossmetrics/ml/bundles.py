"""Columns that hold the bins of several features at once.

One-hot features of a category are never set together, so one group of codes says all of them. Which two-valued features are
never set together is counted over all rows, whatever they mean; a feature that meets every other one is a group of its own.
Groups share a column while the product of their codes allows it.
"""

from __future__ import annotations

import dataclasses

import numpy as np

#: Codes of a column at most.
CODES = 64


@dataclasses.dataclass
class Bundles:
    """``column`` of every feature, its bin for every code of that column (``bins``), the codes of every column, and its factor in the code."""

    column: np.ndarray
    bins: np.ndarray
    widths: np.ndarray
    factors: np.ndarray

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """One code per column from one bin per feature."""
        out = np.zeros((len(codes), len(self.widths)), np.uint8)
        for feature, (k, factor) in enumerate(zip(self.column, self.factors)):
            out[:, k] += codes[:, feature] * np.uint8(factor)
        return out

    def by_feature(self, sums: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Whole sums by bin of every feature, from those by code of every column (last axis)."""
        out, first, ends = np.zeros((*sums.shape[:-1], int(bins.sum())), np.int64), np.cumsum(bins) - bins, np.cumsum(self.widths)
        for k, width in enumerate(self.widths):
            features = np.flatnonzero(self.column == k)
            at = np.concatenate([first[f] + np.arange(bins[f]) for f in features])
            holds = np.concatenate([self.bins[f, :width] == np.arange(bins[f])[:, None] for f in features]).T.astype(np.int64)
            out[..., at] = sums[..., ends[k] - width : ends[k]] @ holds
        return out


def together(codes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Rows that have both features of a pair in their upper bin, for two-valued features."""
    upper = (codes > 0) & (bins == 2)
    return np.rint(upper.T.astype(np.float32) @ upper.astype(np.float32)).astype(np.int64)


def found(both: np.ndarray, bins: np.ndarray) -> Bundles:
    """Every two-valued feature in the first group whose features it never meets, every group in the first column with room."""
    groups: list[list[int]] = []
    for feature in range(len(bins)):
        free = [m for m in groups if bins[feature] == 2 and bins[m[0]] == 2 and len(m) < CODES - 1 and not both[feature, m].any()]
        if free:
            free[0].append(feature)
        else:
            groups.append([feature])
    codes = [len(own) + 1 if len(own) > 1 else int(bins[own[0]]) for own in groups]
    column, factors, at, widths = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int64), np.zeros((len(bins), CODES), np.uint8), []
    for g in sorted(range(len(groups)), key=lambda g: -codes[g]):
        room = [k for k, width in enumerate(widths) if width * codes[g] <= CODES]
        k = room[0] if room else len(widths)
        if not room:
            widths.append(1)
        digit = np.arange(CODES) // widths[k] % codes[g]
        for n, feature in enumerate(groups[g], 1):
            several = len(groups[g]) > 1
            column[feature], factors[feature] = k, widths[k] * (n if several else 1)
            at[feature] = digit == n if several else digit
        widths[k] *= codes[g]
    return Bundles(column, at, np.array(widths, np.int64), factors)
