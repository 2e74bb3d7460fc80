"""K2-treap: a compressed quadtree over a sparse grid whose cells hold numbers,
with the maximum of every quadrant.

The grid has terms as rows and documents as columns. A quadrant without values
is not stored; a stored one has a mask of its four children, and its children
follow one another on the next level, so the place of a child is the place of
the first plus the number of earlier bits in the mask. ``search`` descends from
the root along the row paths of several terms at once: the sum of the weighted
maxima over a range of documents bounds the score of each of them, and the
ranges with the largest bounds are halved first.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np

WIDTH = 64  # ranges halved together
FINE = 5  # ranges of 2^5 documents are resolved at once


def _spread(x: np.ndarray) -> np.ndarray:
    """Bit i of a number below 2^32 to bit 2 i."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _sorted_cells(keys: np.ndarray, values: np.ndarray, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells in order of key; where both fit in 64 bits, sorted as one number."""
    bits = int(values.max()).bit_length() if len(values) else 0
    if key_bits + bits > 64:
        order = np.argsort(keys)
        return keys[order], values[order]
    packed = np.sort(keys << np.uint64(bits) | values.astype(np.uint64))
    return packed >> np.uint64(bits), (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


class K2Treap:
    """Over the cells (rows[i], cols[i]) with positive ``values[i]``; no cell twice."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, n_cols: int):
        self.height = max(1, (max(n_rows, n_cols, 1) - 1).bit_length())
        keys, most = _sorted_cells(_spread(rows) << np.uint64(1) | _spread(cols), np.asarray(values, np.int64), 2 * self.height)
        maxima, masks, firsts = [most], [], []
        for _ in range(self.height):
            above = keys >> np.uint64(2)
            start = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(keys) else np.zeros(0, np.int64)
            child = np.left_shift(np.uint8(1), (keys & np.uint64(3)).astype(np.uint8))
            masks.append(np.bitwise_or.reduceat(child, start) if len(start) else child)
            most = np.maximum.reduceat(most, start) if len(start) else most
            firsts.append(start)
            maxima.append(most)
            keys = above[start]
        base, places = 0, []
        for level in reversed(maxima):
            places.append(base)
            base += len(level)
        # levels one after another from the root; children of level l lie in level l + 1
        self.maxima = np.concatenate(maxima[::-1]).astype(np.uint32)
        self.masks = np.concatenate(masks[::-1]) if masks else np.zeros(0, np.uint8)
        self.firsts = np.concatenate([f + places[i + 1] for i, f in enumerate(firsts[::-1])]).astype(np.int32)

    def nbytes(self) -> int:
        return self.maxima.nbytes + self.masks.nbytes + self.firsts.nbytes


class Best:
    """The k best (score, id) seen: larger scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def offer(self, score: int, ident: int) -> None:
        heappush(self.heap, (score, -ident))
        if len(self.heap) > self.k:
            heappop(self.heap)

    def floor(self) -> tuple[int, int]:
        """Score and negated id that the next one must exceed."""
        return self.heap[0] if len(self.heap) == self.k else (0, 0)

    def ranked(self) -> list[tuple[int, int]]:
        return [(s, -i) for s, i in sorted(self.heap, reverse=True)]


def _children(treap: K2Treap, nodes: np.ndarray, row: np.ndarray, shift: np.ndarray | int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node the child on its row's side in one half of its columns:
    whether there is one, and its place (0 if not)."""
    mask = treap.masks[nodes].astype(np.int64)
    q = (row >> shift & 1) << 1 | half
    has = (mask >> q & 1).astype(bool)
    child = treap.firsts[nodes] + np.bitwise_count(mask & (1 << q) - 1)
    return has, np.where(has, child, 0)


def _resolve(treap: K2Treap, nodes: np.ndarray, place: np.ndarray, term: np.ndarray, row: np.ndarray, weight: np.ndarray, level: int, ranges: int) -> np.ndarray:
    """Scores of the documents under nodes of one level, the i-th row those of
    the i-th range; ``place`` is the number of a node's range."""
    for below in range(level + 1, treap.height + 1):
        found = []
        for half in (0, 1):
            has, child = _children(treap, nodes, row[term], treap.height - below, half)
            found.append((child[has], place[has] << 1 | half, term[has]))
        nodes, place, term = (np.concatenate(x) for x in zip(*found))
    # sums of integers, exact in doubles below 2^53
    return np.bincount(place, weight[term] * treap.maxima[nodes], ranges << treap.height - level).astype(np.int64)


def search(treap: K2Treap, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, least: list[np.ndarray], best: Best) -> int:
    """Offers to ``best`` every document that may be among the best for the
    sum of weight x value over ``rows``. ``ids`` holds the documents' ids by
    column, ``least`` the smallest ids of column ranges (``range_minima``).
    Returns the number of ranges taken from the queue.

    A range of up to 2^``FINE`` documents at the head of the queue is not
    halved further: the scores of its documents are read from the leaves."""
    if not len(rows) or not len(treap.masks):
        return 0
    height, n_ids = treap.height, len(ids)
    fine = max(0, height - FINE)
    rows, weights = np.asarray(rows, np.int64), np.asarray(weights, np.int64)
    heap = [(-int(weights.sum()) * int(treap.maxima[0]), 0, 0, np.zeros(len(rows), np.int64), np.arange(len(rows)))]
    taken = 0
    while heap:
        batch, last = [], []
        floor, floor_id = best.floor()
        while heap and len(batch) + len(last) < WIDTH:
            bound, column, level, *_ = top = heappop(heap)
            if -bound < floor:
                heap.clear()  # all others are bounded by less
            elif -bound > floor or -int(least[height - level][column >> height - level]) > floor_id:
                (batch if level < fine else last).append(top)
        taken += len(batch) + len(last)
        for group, finish in ((last, True), (batch, False)):
            if not group:
                continue
            sizes = np.array([len(b[3]) for b in group])
            ends = np.cumsum(sizes)
            starts = ends - sizes
            nodes, term = np.concatenate([b[3] for b in group]), np.concatenate([b[4] for b in group])
            column, number = np.array([b[1] for b in group]), np.repeat(np.arange(len(group)), sizes)
            if finish:
                scores = _resolve(treap, nodes, number, term, rows, weights, fine, len(group))
                at = np.flatnonzero(scores >= max(1, best.floor()[0]))
                found = ids[column[at >> height - fine] + (at & (1 << height - fine) - 1)]
                for i in np.lexsort((found, -scores[at]))[: best.k].tolist():
                    best.offer(int(scores[at[i]]), int(found[i]))
                continue
            level = np.array([b[2] for b in group])
            for half in (0, 1):
                has, child = _children(treap, nodes, rows[term], np.repeat(height - 1 - level, sizes), half)
                sums = np.bincount(number, np.where(has, weights[term] * treap.maxima[child], 0), len(group)).astype(np.int64)
                columns = column | half << height - 1 - level
                for i in np.flatnonzero((sums > 0) & (sums >= best.floor()[0]) & (columns < n_ids)).tolist():
                    own = slice(starts[i], ends[i])
                    kept = has[own]
                    heappush(heap, (-int(sums[i]), int(columns[i]), int(level[i]) + 1, child[own][kept], term[own][kept]))
    return taken


def range_minima(ids: np.ndarray, height: int) -> list[np.ndarray]:
    """Smallest id of each aligned range of 1, 2, 4, ... 2^height columns."""
    out = [np.asarray(ids, np.int64)]
    for _ in range(height):
        below = out[-1]
        if len(below) % 2:
            below = np.append(below, below[-1])
        out.append(below.reshape(-1, 2).min(axis=1))
    return out
