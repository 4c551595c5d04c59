"""Sign votes of hashed features, and the XXH64 shingles they may come from."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42


def vote(h: np.ndarray, counts: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """A fingerprint for each run of ``counts`` features: a bit is 1 where it is set in over half of the weight.

    Weights are whole numbers.  No feature gives fingerprint zero.
    """
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    before = (np.cumsum(counts) - counts)[some]
    bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if weights is None:
        total, half = np.add.reduceat(bits, before, axis=0, dtype=np.int32), counts[some, None]
    else:
        weights = weights.astype(np.int32)
        kind = np.int32 if weights.sum(dtype=np.int64) < 1 << 30 else np.int64
        total = np.add.reduceat(bits * weights[:, None], before, axis=0, dtype=kind)
        half = np.add.reduceat(weights, before, dtype=np.int64)[:, None]
    packed = np.packbits(total * 2 > half, axis=1, bitorder="little")
    out[some] = np.ascontiguousarray(packed).view(np.uint64)[:, 0]
    return out


def shingle_hashes(text: bytes, size: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, lower-cased A-Z, joined by spaces; all words if there are fewer."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < size:
        return np.array([digest(joined, SEED)], np.uint64)
    length = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(length + 1) - 1
    start = end - length
    return np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(start[: len(start) - size + 1].tolist(), end[size - 1 :].tolist())),
        np.uint64,
        len(found) - size + 1,
    )
