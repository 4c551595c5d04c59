"""Pairs of 64-bit fingerprints within a Hamming radius, by vantage-point trees.

A node holds a vantage point and a distance; fingerprints within the distance live
on the inner side, the others on the outer.  A fingerprint near the boundary also
visits the other side, as far as the triangle inequality lets a partner live there:
a partner's distance to the vantage point differs by ``radius`` at most.  The upper
tree deals fingerprints to shards; each shard goes on in the same way by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BRUTE = 1024  # fingerprints compared directly
PAIRS = 4 << 20  # comparisons held at once


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def grow(sample: np.ndarray, depth: int) -> list[tuple[int, int] | None]:
    """A tree in heap order over a sample: (vantage point, distance) per inner node, None where it ends early."""
    nodes: list[tuple[int, int] | None] = [None] * (2**depth - 1)
    parts = {0: np.unique(sample)}
    for node in range(len(nodes)):
        part = parts.pop(node, None)
        if part is None or len(part) < 4:
            continue
        # of a few candidates, the one with the most even split
        best = None
        for v in part[np.linspace(0, len(part) - 1, 8).astype(int)]:
            d = distance(part, v)
            m = int(np.sort(d)[(len(d) - 1) // 2])
            inner = int((d <= m).sum())
            if 0 < inner < len(part) and (best is None or abs(2 * inner - len(part)) < best[0]):
                best = abs(2 * inner - len(part)), int(v), m
        if best is None:
            continue
        nodes[node] = best[1:]
        d = distance(part, np.uint64(best[1]))
        parts[2 * node + 1], parts[2 * node + 2] = part[d <= best[2]], part[d > best[2]]
    return nodes


def split(d: np.ndarray, home: np.ndarray, m: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows for the inner and the outer side, and which of them are at home there.

    Of a pair across the boundary only the inner one travels, so each pair meets once.
    """
    lives_in, lives_out = home & (d <= m), home & (d > m)
    visits_in = ~home & (d <= m + radius)
    visits_out = (home & (d <= m) & (d > m - radius)) | (~home & (d > m - radius))
    to_in, to_out = np.flatnonzero(lives_in | visits_in), np.flatnonzero(lives_out | visits_out)
    return to_in, to_out, lives_in[to_in], lives_out[to_out]


def route(fp: np.ndarray, nodes: list[tuple[int, int] | None], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, row, at home) for every shard a fingerprint lives in or visits."""
    out, todo = [], [(0, np.arange(len(fp)), np.ones(len(fp), bool))]
    while todo:
        node, rows, home = todo.pop()
        if not len(rows):
            continue
        if node >= len(nodes) or nodes[node] is None:
            out.append((np.full(len(rows), node), rows, home))
            continue
        v, m = nodes[node]
        to_in, to_out, home_in, home_out = split(distance(fp[rows], np.uint64(v)).astype(np.int64), home, m, radius)
        todo += [(2 * node + 1, rows[to_in], home_in), (2 * node + 2, rows[to_out], home_out)]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out))


def near(fp: np.ndarray, home: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) within the radius, j at home: all pairs at home, and visitors with those at home."""
    todo = [(np.arange(len(fp)), home)]
    while todo:
        rows, at_home = todo.pop()
        living = rows[at_home]
        if not len(living) or len(rows) < 2:
            continue
        if len(living) > BRUTE:
            part = fp[living]
            v = part[len(part) // 2]
            d = distance(part, v).astype(np.int64)
            m = int(np.sort(d)[(len(d) - 1) // 2])
            if 0.05 < (d <= m).mean() < 0.95:
                to_in, to_out, home_in, home_out = split(distance(fp[rows], v).astype(np.int64), at_home, m, radius)
                todo += [(rows[to_in], home_in), (rows[to_out], home_out)]
                continue
        step = max(1, PAIRS // len(living))
        for first in range(0, len(rows), step):
            some = rows[first : first + step]
            a, b = np.nonzero(distance(fp[some][:, None], fp[living][None, :]) <= radius)
            i, j = some[a], living[b]
            keep = ~at_home[first + a] | (i < j)
            yield i[keep], j[keep]


def roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index each of n items is linked with, over any number of links."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            differ = a != b
            if not differ.any():
                break
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]
    return root


def shard_links(radius: int):
    """For applyInArrow: each fingerprint of a shard that is linked with others, and the first of them."""

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
        doc = table.column("doc").combine_chunks().to_numpy()
        home = table.column("home").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(doc, kind="stable")
        fp, doc, home = fp[order], doc[order], home[order]
        root = roots(len(fp), near(fp, home, radius))
        linked = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"u": doc[linked], "v": doc[root[linked]]})

    return run


def shard_neighbours(radius: int):
    """For applyInArrow: each fingerprint of a shard that has others within the radius, with the first it is linked with and with its nearest."""

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
        doc = table.column("doc").combine_chunks().to_numpy()
        home = table.column("home").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(doc, kind="stable")
        fp, doc, home = fp[order], doc[order], home[order]
        best = np.full(len(fp), np.iinfo(np.int64).max)  # distance, then index of the nearest

        def seen() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j in near(fp, home, radius):
                far = distance(fp[i], fp[j]).astype(np.int64) << 48
                np.minimum.at(best, i, far | j)
                np.minimum.at(best, j, far | i)
                yield i, j

        root = roots(len(fp), seen())
        linked, met = np.flatnonzero(root != np.arange(len(fp))), np.flatnonzero(best < np.iinfo(np.int64).max)
        nearest = best[met] & ((1 << 48) - 1)
        return pa.table({"u": np.concatenate([doc[linked], doc[met]]), "v": np.concatenate([doc[root[linked]], doc[nearest]])})

    return run
