"""Signature trees over sets of hashes, joined with themselves by dual traversal.

A leaf holds one set as a bitmap; an inner node holds the OR of its children's
bitmaps and the range of their sizes. Two nodes are followed only while the
largest overlap that sets below them can have still reaches the threshold.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
# Bits per element of the largest set, within limits; more bits prune more.
_BITS_PER_ITEM, _LEAST_BITS, _MOST_BITS = 2, 512, 1 << 15


class _Level:
    """Nodes of one level as columns."""

    def __init__(self, bits, least, most, spare, comp_lo, comp_hi, side_lo, side_hi):
        self.bits, self.least, self.most, self.spare = bits, least, most, spare
        self.comp_lo, self.comp_hi, self.side_lo, self.side_hi = comp_lo, comp_hi, side_lo, side_hi

    def __len__(self):
        return len(self.least)

    def parents(self) -> _Level:
        at = np.arange(0, len(self), FANOUT)
        lo, hi = np.minimum.reduceat, np.maximum.reduceat
        return _Level(
            np.bitwise_or.reduceat(self.bits, at, axis=0), lo(self.least, at), hi(self.most, at), hi(self.spare, at),
            lo(self.comp_lo, at), hi(self.comp_hi, at), lo(self.side_lo, at), hi(self.side_hi, at),
        )

    def may_link(self, i, j, percent: int, across: bool):
        """Node pairs below which a pair of sets could still reach the threshold."""
        keep = ~((self.comp_lo[i] == self.comp_hi[i]) & (self.comp_lo[i] == self.comp_lo[j]) & (self.comp_lo[j] == self.comp_hi[j]))
        keep &= (100 * self.most[i] >= percent * self.least[j]) & (100 * self.most[j] >= percent * self.least[i])
        if across:
            keep &= ~((self.side_lo[i] == self.side_hi[i]) & (self.side_lo[i] == self.side_lo[j]) & (self.side_lo[j] == self.side_hi[j]))
        i, j = i[keep], j[keep]
        common = np.empty(len(i), dtype=np.int64)
        step = max(1, (1 << 22) // self.bits.shape[1])
        for at in range(0, len(i), step):
            s = slice(at, at + step)
            common[s] = np.bitwise_count(self.bits[i[s]] & self.bits[j[s]]).sum(axis=1)
        overlap = common + np.minimum(self.spare[i], self.spare[j])
        keep = (100 + percent) * overlap >= percent * (self.least[i] + self.least[j])
        return i[keep], j[keep]


def width_for(n: int) -> int:
    """Bits of the bitmap of a set of n elements."""
    width = _LEAST_BITS
    while width < min(_MOST_BITS, _BITS_PER_ITEM * n):
        width *= 2
    return width


def bitmap(s: np.ndarray, width: int) -> np.ndarray:
    """A set of hashes as a bitmap of 64-bit words."""
    row = np.zeros(width // 64, dtype=np.uint64)
    at = (s >> np.uint64(7)) & np.uint64(width - 1)
    np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return row


def folded(row: np.ndarray, width: int) -> np.ndarray:
    """A bitmap as it would be with fewer bits."""
    return np.bitwise_or.reduce(row.reshape(-1, width // 64), axis=0)


def _pairs(bits: np.ndarray, size: np.ndarray, comp: np.ndarray, side: np.ndarray, percent: int, across: bool):
    """Index pairs that dual traversal of the tree over these leaves cannot rule out."""
    spare = size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    levels = [_Level(bits, size, size, spare, comp, comp, side, side)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].parents())
    i = j = np.zeros(1, dtype=np.int64)
    for level in reversed(levels[:-1]):
        # Children of the pairs kept above; within one node each pair once.
        grid = np.arange(FANOUT)
        ci = (i[:, None, None] * FANOUT + grid[None, :, None] + np.zeros((1, 1, FANOUT), dtype=np.int64)).ravel()
        cj = (j[:, None, None] * FANOUT + grid[None, None, :] + np.zeros((1, FANOUT, 1), dtype=np.int64)).ravel()
        ok = (ci < len(level)) & (cj < len(level)) & ((ci <= cj) if level is not levels[0] else (ci < cj))
        i, j = level.may_link(ci[ok], cj[ok], percent, across)
    if across:
        differ = side[i] != side[j]
        i, j = i[differ], j[differ]
    return i, j


def survivors(bits: list[np.ndarray], size: np.ndarray, comp: np.ndarray, percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Which leaves have a partner that bitmaps cannot rule out.

    Sets that can link differ little in size, so their bitmaps differ by a factor
    of two at most; each width is joined with itself and the next, folded.
    """
    alive = np.zeros(len(size), dtype=bool)
    width = np.array([len(b) * 64 for b in bits])
    for w in np.unique(width):
        at = np.flatnonzero((width == w) | (width == 2 * w))
        if len(at) < 2:
            continue
        at = at[np.lexsort((size[at], comp[at]))]
        rows = np.stack([folded(bits[k], int(w)) for k in at])
        sides = side[at] if side is not None else np.zeros(len(at), dtype=np.int64)
        i, j = _pairs(rows, size[at], comp[at], sides, percent, side is not None)
        own = (width[at][i] == w) | (width[at][j] == w)
        alive[at[i[own]]] = alive[at[j[own]]] = True
    return alive


def overlap_size(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(sets: list[np.ndarray], comp: np.ndarray, percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of the given sets as all pairs with
    ``100 * intersection >= percent * union`` would; pairs of one component are skipped.

    ``sets`` are sorted distinct uint64 arrays, ``comp`` their components so far.
    With ``side``, only pairs of different sides count. Returns index pairs.
    """
    n = len(sets)
    if n < 2:
        return []
    across = side is not None
    # Like lies by like: components, then least hashes, then sizes.
    order = sorted(range(n), key=lambda k: (int(comp[k]), int(sets[k][0]) if len(sets[k]) else 0, len(sets[k])))
    sets = [sets[k] for k in order]
    comp = np.asarray(comp, dtype=np.int64)[order]
    side = np.asarray(side, dtype=np.int64)[order] if across else np.zeros(n, dtype=np.int64)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    width = width_for(int(size.max()))
    i, j = _pairs(np.stack([bitmap(s, width) for s in sets]), size, comp, side, percent, across)
    names, label = np.unique(comp, return_inverse=True)
    found = []
    at, step = 0, 64
    while at < len(i):
        if at:
            differ = label[i[at:]] != label[j[at:]]
            i, j, at = i[at:][differ], j[at:][differ], 0
        for x, y in zip(i[at : at + step].tolist(), j[at : at + step].tolist(), strict=True):
            if label[x] == label[y]:
                continue
            a, b = sets[x], sets[y]
            both = overlap_size(a, b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                label[label == label[y]] = label[x]
                found.append((order[x], order[y]))
        at += step
    return found
