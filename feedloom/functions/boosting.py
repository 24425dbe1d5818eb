"""Gradient boosted trees on binned rows: the passes over chunks of rows, and the choice of splits.

This module needs nothing else of the package, so that it can be sent to Python workers that lack it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Rows that are worked on at once; temporary arrays of so many fit a core's cache.
CHUNK = 1 << 16
#: Combinations of bins that are summed up together at most.
CELLS = 1 << 10
#: Below it an impurity counts as 0.
EPSILON = 2.0 ** -52
MASK = (1 << 64) - 1

# A chunk of rows is a tuple of arrays: bins (a row per feature with more than one), label as 1 or -1,
# the weights that occur and which of them a row has (both None if all are 1), and the score so far.
# A path is what a tree has been split by: per level {node: (row of the bins, last bin to the left)}.


@dataclass(frozen=True)
class Slot:
    """Features that are summed up together, by combinations of their bins."""

    features: list[int]
    bins: list[int]
    cells: int

    def per_feature(self, sums: np.ndarray) -> list[np.ndarray]:
        """Sums per node and bin of each feature, from sums per node and cell."""
        cube = sums.reshape(-1, *self.bins)
        axes = range(1, len(self.bins) + 1)
        return [cube.sum(axis=tuple(a for a in axes if a != mine)) for mine in axes]


def share_cells(bins: list[int], most: int = CELLS) -> list[Slot]:
    """Features put together, largest first, as long as a slot has at most ``most`` cells: one pass
    over its cells then serves them all."""
    groups: list[tuple[list[int], int]] = []
    for feature in sorted(range(len(bins)), key=lambda f: (-bins[f], f)):
        place = next((i for i, (_, cells) in enumerate(groups) if cells * bins[feature] <= most), None)
        if place is None:
            groups.append(([feature], bins[feature]))
        else:
            groups[place] = ([*groups[place][0], feature], groups[place][1] * bins[feature])
    return [Slot(features, [bins[f] for f in features], cells) for features, cells in groups]


def to_chunks(batches: Iterator[pa.RecordBatch], thresholds: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Columns features (a list each), label and, if there, weight as pickled chunks. ``thresholds``
    has the ordered split points of the features with any."""
    waiting, count = [], 0

    def chunk() -> pa.RecordBatch:
        bins, label, weight = (None if parts[0] is None else np.concatenate(parts, -1) for parts in zip(*waiting))
        values = index = None
        if weight is not None:
            values, index = np.unique(weight, return_inverse=True)
            index = index.astype(np.uint8 if values.size <= 256 else np.uint32)
        rows = bins, label, values, index, np.zeros(label.size)
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(rows, 5)], pa.binary())], ["chunk"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        bins = np.empty((len(thresholds), batch.num_rows), np.uint8)
        for out, (feature, points) in zip(bins, thresholds.items()):
            out[:] = np.searchsorted(points, rows[:, feature], "left")
        label = np.where(batch.column(1).to_numpy(zero_copy_only=False) > 0, 1, -1).astype(np.int8)
        weight = batch.column(2).to_numpy(zero_copy_only=False) if batch.num_columns > 2 else None
        waiting.append((bins, label, weight))
        count += batch.num_rows
        if count >= CHUNK:
            yield chunk()
            waiting, count = [], 0
    if count:
        yield chunk()


def routed(bins: np.ndarray, path: list[dict]) -> np.ndarray:
    """The node of each row on the level below the path. Rows of a node that is not split go left."""
    node = np.zeros(bins.shape[1], np.uint8)
    for splits in path:
        right = np.zeros(node.size, bool)
        for k, (feature, place) in splits.items():
            right |= (node == k) & (bins[feature] > place)
        node = 2 * node + right
    return node


def residuals(label: np.ndarray, score: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree is fitted to: the labels, then the logistic loss's negative gradient."""
    if first:
        return label.astype(np.float64)
    with np.errstate(over="ignore"):
        return 4.0 * label / (1.0 + np.exp(2.0 * label * score))


def level_sums(chunks: Iterator[tuple], slots: list[Slot], path: list[dict], first: bool, full: bool) -> Iterator[np.ndarray]:
    """One array of sums over all chunks: by node and bin of each feature, then by node alone. Summed up
    are weights and weighted residuals, and (by node always, by bin if ``full``) weighted squares and rows."""
    nodes, kinds = 1 << len(path), 4 if full else 2
    sums = [np.zeros((kinds, nodes * slot.cells)) for slot in slots]
    alone, plain = np.zeros((4, nodes)), False
    for bins, label, values, index, score in chunks:
        residual = residuals(label, score, first)
        weight = None if index is None else values[index]
        summed = residual if weight is None else residual * weight
        every = [weight, summed, summed * residual, None]
        node = routed(bins, path).astype(np.intp)
        # What is summed up by bin need not be by node, and rows without weights are their weights.
        for kind in range(kinds if slots else 0, 4 if weight is not None or not slots else 3):
            alone[kind] += np.bincount(node, every[kind], nodes)
        plain = weight is None
        for slot, into in zip(slots, sums):
            cell = np.zeros(node.size, np.uint16)
            for feature, n in zip(slot.features, slot.bins):
                cell *= np.uint16(n)
                cell += bins[feature]
            cell = node * slot.cells + cell
            for kind in range(kinds):
                into[kind] += np.bincount(cell, every[kind], into.shape[1])
    if slots:
        alone[:kinds] = sums[0].reshape(kinds, nodes, -1).sum(2)
        alone[3] = alone[0] if plain else alone[3]
    thin = [side for slot, of in zip(slots, sums) for kind in of for side in slot.per_feature(kind)]
    yield np.concatenate([a.ravel() for a in [*thin, alone]])


def taken_apart(flat: np.ndarray, slots: list[Slot], level: int, full: bool) -> tuple[dict, np.ndarray]:
    """Of what ``level_sums`` gives: by feature the kinds of sums by node and bin, and those by node."""
    nodes, kinds, at = 1 << level, 4 if full else 2, 0
    found: dict[int, list] = {feature: [] for slot in slots for feature in slot.features}
    for slot in slots:
        for _ in range(kinds):
            for feature, n in zip(slot.features, slot.bins):
                found[feature].append(flat[at:at + nodes * n].reshape(nodes, n))
                at += nodes * n
    return {feature: np.stack(of) for feature, of in found.items()}, flat[at:].reshape(4, nodes)


def add_tree(chunks: Iterator[tuple], path: list[dict], leaves: np.ndarray) -> Iterator[tuple]:
    """The chunks with a tree's values added to their scores."""
    for bins, label, values, index, score in chunks:
        yield bins, label, values, index, score + leaves[routed(bins, path)]


def best_split(sums: dict[int, np.ndarray], total: np.ndarray, order: list[int]) -> tuple | None:
    """(gain, feature, last bin to the left, the sums to the left and to the right) of the largest fall
    of the variance, the first in ``order`` among equals; None if nothing falls. ``sums`` holds a node's
    kinds of sums by bin of each feature, ``total`` those of the node."""
    best = None
    for feature in order:
        if feature not in sums:
            continue
        of = sums[feature]
        left, right = np.cumsum(of, 1)[:, :-1], np.cumsum(of[:, :0:-1], 1)[:, ::-1]
        able = (left[0] > 0) & (right[0] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total[1] ** 2 / total[0]) / total[0]
        gains = np.where(able, gains, -np.inf)
        place = int(np.argmax(gains))
        if gains[place] > (best[0] if best else 0):
            best = float(gains[place]), feature, place, left[:, place], right[:, place]
    return best


def impurity(weight: float, total: float, squares: float) -> float:
    """The variance, from sums of weights, weighted values and weighted squares."""
    return (squares - total * total / weight) / weight if weight else 0.0


class Xorshift:
    """The generator by which MLlib draws a node's features."""

    def __init__(self, seed: int) -> None:
        data = (seed & MASK).to_bytes(8, "big")
        low = murmur3(data, 0x3C074A61)
        self.seed = murmur3(data, low) << 32 | low

    def bits(self, n: int) -> int:
        x = self.seed
        x ^= x << 21 & MASK
        x ^= x >> 35
        x ^= x << 4 & MASK
        self.seed = x
        return x & (1 << n) - 1

    def uniform(self) -> float:
        high = self.bits(26)
        return ((high << 27) + self.bits(27)) * 2.0 ** -53


def murmur3(data: bytes, seed: int) -> int:
    """32-bit murmur hash of whole words."""
    def turned(x: int, n: int) -> int:
        return (x << n | x >> 32 - n) & 0xFFFFFFFF

    h = seed
    for i in range(0, len(data), 4):
        k = turned(int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15)
        h = turned(h ^ k * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def drawn_features(features: int, per_node: int, seed: int) -> Iterator[list[int]]:
    """Which features the nodes of a tree may split on, in the order in which MLlib draws them for a
    tree of this seed."""
    state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1
    while True:
        halves = []
        for _ in range(2):
            state = state * 0x5DEECE66D + 0xB & (1 << 48) - 1
            halves.append(state >> 16)
        # A long of Java's generator: the low half counts as signed.
        draw = (halves[0] << 32) + halves[1] - (halves[1] >> 31 << 32)
        kept = list(range(per_node))
        if per_node < features:
            numbers = Xorshift(draw)
            for item in range(per_node, features):
                place = int(numbers.uniform() * (item + 1))
                if place < per_node:
                    kept[place] = item
        yield kept


class Tree:
    """A tree that grows by levels. ``nodes`` holds by (level, number) the split or None, and the sums."""

    def __init__(self, depth: int, draws: Iterator[list[int]]) -> None:
        self.depth, self.draws, self.active = depth, draws, [0]
        self.nodes: dict[tuple[int, int], tuple[tuple | None, np.ndarray]] = {}
        self.path: list[dict] = []

    def split(self, sums: dict[int, np.ndarray], totals: np.ndarray) -> bool:
        """Split a level, by its sums over all rows. Whether another level is to be split."""
        level, chosen = len(self.path), {}
        for k in self.active:
            total, split = totals[:, k], None
            # A node without variance is a leaf, for which MLlib draws no features.
            if not level or impurity(*total[:3]) >= EPSILON:
                split = best_split({f: of[:, k] for f, of in sums.items()}, total, next(self.draws))
            self.nodes[level, k] = split, total
            if split:
                chosen[k] = split
        if not chosen:
            return False
        # As MLlib's stack gives nodes out: the child that was made last draws first.
        self.active = [child for k in chosen for child in (2 * k, 2 * k + 1)][::-1]
        self.path.append({k: split[1:3] for k, split in chosen.items()})
        if level + 1 < self.depth:
            return True
        for k, split in chosen.items():
            self.nodes[level + 1, 2 * k], self.nodes[level + 1, 2 * k + 1] = (None, split[3]), (None, split[4])
        return False

    def leaves(self) -> np.ndarray:
        """What the tree predicts, by the nodes to which its path leads."""
        out = np.zeros(1 << len(self.path))
        for (level, k), (split, total) in self.nodes.items():
            if split is None:
                out[k << len(self.path) - level] = total[1] / total[0] if total[0] else 0.0
        return out
