"""Byte-level BPE over a contiguous rank array.

A word is an array of parts and, beside it, the rank of each part with its right
neighbour.  Scan for the smallest rank, drop that boundary, refresh the two ranks
beside it, until no pair has a rank.  Here the arrays of many words stand in the
rows of a matrix and every scan serves them all.  A word longer than ``LONG`` bytes
would make the scans quadratic; its pairs wait in a heap instead, with the same result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import words as w

LONG = 64
KNOWN = 1 << 16  # encoded words a worker remembers
SLICE = 1 << 19  # bytes of text per step
NONE = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache
def _splitter(below: int) -> re.Pattern:
    """The word pattern for texts of code points under ``below``, with Unicode classes spelled out for
    the standard matcher, which is fastest with the smallest classes."""
    every = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)

    def spelled(kind: str) -> str:
        runs = ((m[0][0], m[0][-1]) for m in regex.finditer(rf"{kind}+", every))
        # two runs may touch only across the surrogates
        return "".join(re.escape(a) + ("-" + re.escape(b) if a != b else "") for a, b in runs)

    letter, number, space = spelled(r"\p{L}"), spelled(r"\p{N}"), spelled(r"\p{White_Space}")
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class Vocabulary:
    """Ranks and bytes of a tokenizer file (JSON with vocabulary and merges); small, and sent to every worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letter = _byte_letters()
        vocab = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        top = max([*vocab.values(), *self.special.values()])
        self.bytes = [b""] * (top + 1)
        for text, i in vocab.items():
            self.bytes[i] = bytes(letter[c] for c in text) if all(c in letter for c in text) else text.encode()
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in letter.items():
            self.byte_id[b] = vocab[c]
        self.left, self.right, self.made = [], [], []
        for merge in file["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.left.append(vocab[a])
            self.right.append(vocab[b])
            self.made.append(vocab[a + b])


class Encoder:
    """Encodes batches of texts; remembers words it has met, ``KNOWN`` at most."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        key = (np.array(vocabulary.left, np.int64) << 20) | np.array(vocabulary.right, np.int64)
        self.order = np.argsort(key)
        self.key = np.append(key[self.order], np.iinfo(np.int64).max)
        self.made = np.array(vocabulary.made, np.int64)
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str | int, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 20) | right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.order[np.minimum(at, len(self.order) - 1)], NONE)

    def _short(self, words: list[bytes]) -> list[bytes]:
        """All of one byte length: a row of parts and a row of ranks for each word."""
        width = len(words[0])
        parts = self.v.byte_id[np.frombuffer(b"".join(words), np.uint8).reshape(-1, width)]
        out: list[bytes] = [b""] * len(words)
        row = np.arange(len(words))
        rank = self.ranks(parts[:, :-1], parts[:, 1:]) if width > 1 else np.empty((len(words), 0), np.int64)
        while len(row):
            if rank.shape[1]:
                at = rank.argmin(axis=1)
                least = rank[np.arange(len(row)), at]
                done = least == NONE
            else:
                done = np.ones(len(row), bool)
            if done.any():
                flat, size = parts[done].astype(np.int32).tobytes(), 4 * parts.shape[1]
                for k, i in enumerate(row[done].tolist()):
                    out[i] = flat[k * size : (k + 1) * size]
                go = ~done
                row, parts, rank = row[go], parts[go], rank[go]
                if not len(row):
                    break
                at, least = at[go], least[go]
            n = np.arange(len(row))
            parts[n, at] = self.made[least]
            # drop the boundary: what stands to the right moves up by one
            cols = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, cols + (cols > at[:, None]), axis=1)
            cols = np.arange(rank.shape[1] - 1)
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), axis=1)
            if parts.shape[1] > 1:
                for side in (at - 1, at):
                    ok = (side >= 0) & (side < rank.shape[1])
                    rank[n[ok], side[ok]] = self.ranks(parts[n[ok], side[ok]], parts[n[ok], side[ok] + 1])
        return out

    def _long(self, word: bytes) -> bytes:
        ids = self.v.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        first = self.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        pair = {(a, b): r for r, (a, b) in enumerate(zip(self.v.left, self.v.right))} if n > 1 else {}
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.v.made[r], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    x, y = ids[left], ids[after[left]]
                    if (x, y) in pair:
                        heapq.heappush(heap, (pair[x, y], left, x, y))
        return np.array([i for i in ids if i >= 0], np.int32).tobytes()

    def learn(self, words: list[str]) -> None:
        by_length: dict[int, tuple[list[str], list[bytes]]] = defaultdict(lambda: ([], []))
        for word, raw in zip(words, map(str.encode, words)):
            names, group = by_length[len(raw)]
            names.append(word)
            group.append(raw)
        for length, (names, group) in by_length.items():
            self.known.update(zip(names, map(self._long, group) if length > LONG else self._short(group)))

    def _pieces(self, raw: bytes) -> list:
        """The words of a text, and the ids of special tokens among them."""
        top = int(np.frombuffer(raw, np.uint8).max()) if raw else 0
        # by the largest lead byte: U+0000 to U+00FF, to U+FFFF, all
        find = _splitter(0x100 if top < 0xC4 else 0x10000 if top < 0xF0 else 0x110000).findall
        text = raw.decode("utf-8", "replace")
        if self.special is None or not self.special.search(text):
            return find(text)
        own, at = [], 0
        for m in self.special.finditer(text):
            own += [*find(text[at : m.start()]), self.v.special[m[0]]]
            at = m.end()
        return own + find(text[at:])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian 32-bit numbers."""
        pieces = list(map(self._pieces, texts))
        met = set().union(*pieces)
        fresh = [x for x in met if type(x) is str and x not in self.known]
        if len(self.known) + len(fresh) > KNOWN:
            self.known = {}
            fresh = [x for x in met if type(x) is str]
        self.learn(fresh)
        look = self.known
        for special in self.v.special.values():
            look[special] = np.int32(special).tobytes()
        return [b"".join(map(look.__getitem__, own)) for own in pieces]


def _whole(df: DataFrame, read: str, made: str) -> tuple[DataFrame, int]:
    """All columns but ``made`` as one struct, so that each travels once, and the place of ``read`` in it."""
    columns = [c for c in df.columns if c != made]
    return df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")), columns.index(read)


_ENCODERS: dict[str, Encoder] = {}  # one per worker process and file, so that words are remembered between tasks


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns and ``ids_col``, the token ids of the text; a null text is empty.

    Strings of special tokens in a text become those tokens.  The vocabulary file is
    read on the driver and broadcast: its size is fixed by the tokenizer.
    """
    sent = df.sparkSession.sparkContext.broadcast(Vocabulary(path))
    row, place = _whole(df, text_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(sent.value)
        encoder = _ENCODERS[path]
        for batch in batches:
            for first, end, buf, offsets in w.text_slices(batch.column(0).field(place), SLICE):
                raw = buf.tobytes()
                ids = encoder.encode([raw[s:e] for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
                counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                values = w.list_array(np.frombuffer(b"".join(ids), np.int32), counts, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), values], names=["row", "ids"])

    out = row.mapInArrow(w.trimmed(run), f"row {row.schema['row'].dataType.simpleString()}, ids array<int>")
    return out.select("row.*", F.col("ids").alias(ids_col))


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns and ``text_col``, the text of the ids; bytes that are no UTF-8 become U+FFFD.

    Null ids give an empty text; special tokens are kept.
    """
    sent = df.sparkSession.sparkContext.broadcast(Vocabulary(path).bytes)
    row, place = _whole(df, ids_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        width = np.fromiter(map(len, table), np.int64, len(table))
        flat = np.frombuffer(b"".join(table), np.uint8)
        start = np.cumsum(width) - width
        for batch in batches:
            lists = batch.column(0).field(place).fill_null([])
            n = len(lists)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            first = 0
            while first < n:
                # about 262,000 ids at a time
                end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 18), "right")))
                part = lists.slice(first, end - first)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                length = width[ids]
                inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                raw = flat[inside + np.repeat(start[ids], length)].tobytes()
                edge = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(sizes[first:end]))].tolist()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(texts, pa.string())], names=["row", "text"])
                first = end

    out = row.mapInArrow(w.trimmed(run), f"row {row.schema['row'].dataType.simpleString()}, text string")
    return out.select("row.*", F.col("text").alias(text_col))
