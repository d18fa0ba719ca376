"""Induced sorting of suffixes around anchors, with common-prefix values.

The suffixes that start at anchors are sorted by their text. All others are induced from them: the
suffix one byte further left sorts by that byte and then by the rank of the suffix it is induced from. So
each round takes the suffix tuples of the last one in order and deals them to one queue for each byte; the
queues, one after the other, are the order of the next round. The common prefix of two neighbours in a queue
is one more than the least value between them in the order they were taken from.

Texts and the sorted tuples lie in ``Store`` arrays, on disk beyond a limit.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

import numpy as np

LEAST = 200


class Store:
    """Arrays in memory up to ``most_bytes`` each, else in unnamed files in Spark's local folder.

    Like Spark's own spill files they are scratch of one task and vanish with it, however it ends.
    """

    def __init__(self, most_bytes: int = 64 << 20):
        self.most_bytes = most_bytes
        self.folder = next(iter(os.environ.get("SPARK_LOCAL_DIRS", "").split(",")), "") or None

    def array(self, shape: tuple[int, ...] | int, kind) -> np.ndarray:
        kind = np.dtype(kind)
        size = int(np.prod(shape)) * kind.itemsize
        if size <= self.most_bytes:
            return np.zeros(shape, kind)
        with tempfile.TemporaryFile(dir=self.folder) as file:
            file.truncate(size)
            return np.memmap(file, kind, "r+", shape=shape)

    def keep(self, values: np.ndarray) -> np.ndarray:
        out = self.array(values.shape, values.dtype)
        out[...] = values
        return out


def _common(rows: np.ndarray, order: np.ndarray, store: Store, block: int = 1 << 15) -> np.ndarray:
    """Bytes that each row of ``order`` has in common with the one before it."""
    out = store.array(len(order), np.int16)
    for at in range(1, len(order), block):
        now = rows[order[at : at + block]]
        differ = now != rows[order[at - 1 : at - 1 + len(now)]]
        out[at : at + block] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _between(common: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbours among the ``chosen`` places only; zero for the first."""
    out = np.zeros(len(chosen), common.dtype)
    if len(chosen) > 1:
        out[1:] = np.minimum.reduceat(common[: chosen[-1] + 1], chosen[:-1] + 1)
    return out


def repeated_windows(
    segments: Sequence[bytes], offsets: Sequence[int], runs: Sequence[int], *, least: int = LEAST, store: Store | None = None
) -> list[list[tuple[int, int]]]:
    """For each segment the windows that occur more than once, as intervals of their starts.

    A segment owns the windows of ``least`` bytes at its first ``runs`` starts, and has its anchor at
    ``offsets``, inside or at the end of those starts. Equal windows must have their anchor at the same place; windows
    are compared with those of other segments.
    """
    store = store or Store()
    n = len(segments)
    if n < 2:
        return [[] for _ in range(n)]
    off = np.array(offsets, dtype=np.int32)
    nearest = off - np.array(runs, dtype=np.int32) + 1  # the least distance of an owned window from the anchor
    widest = int(off.max())
    right = store.array((n, least), np.uint8)
    left = store.array((n, max(1, widest)), np.uint8)
    for i, segment in enumerate(segments):
        data = np.frombuffer(segment, np.uint8)
        after = data[off[i] : off[i] + least]
        right[i, : len(after)] = after
        left[i, : off[i]] = data[: off[i]][::-1]

    ids = store.keep(np.argsort(right.view(f"S{least}").ravel(), kind="stable").astype(np.int32))
    common = _common(right, ids, store)
    found: list[tuple[np.ndarray, int]] = []
    for distance in range(widest + 1):
        own = np.flatnonzero(nearest[ids] <= distance)
        if len(own) > 1:
            link = _between(common, own)
            hit = link >= least
            hit[:-1] |= hit[1:]
            if hit.any():
                found.append((np.array(ids[own[hit]]), distance))
        # A suffix goes on while it may still reach the length in common with another.
        reach = np.array(common)
        reach[:-1] = np.maximum(reach[:-1], common[1:])
        further = off[ids] - distance
        alive = np.flatnonzero((further > 0) & (reach + further >= least))
        if len(alive) < 2:
            break
        bytes_ = left[ids[alive], distance]
        places, commons = [], []
        for byte in np.unique(bytes_):
            queue = alive[bytes_ == byte]
            values = _between(common, queue)
            values[1:] = np.minimum(values[1:] + 1, np.iinfo(np.int16).max)
            places.append(queue)
            commons.append(values)
        ids, common = store.keep(ids[np.concatenate(places)]), store.keep(np.concatenate(commons))

    starts: list[list[int]] = [[] for _ in range(n)]
    for which, distance in found:
        for i in which.tolist():
            starts[i].append(int(off[i]) - distance)
    return [_intervals(sorted(s)) for s in starts]


def _intervals(places: list[int]) -> list[tuple[int, int]]:
    """Sorted places as intervals, end exclusive."""
    out: list[tuple[int, int]] = []
    for place in places:
        if out and out[-1][1] == place:
            out[-1] = (out[-1][0], place + 1)
        else:
            out.append((place, place + 1))
    return out
