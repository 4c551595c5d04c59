"""Substring dedup by seed and extend.

Seeds: of all k-grams of words, winnowing keeps the smallest hash (the last one on
ties) of each run of ``length - k + 1``; two equal passages of ``length`` words keep
the same seed.  Documents meet on seeds; a passage is extended both ways from a
shared seed, window by window, and each window's own hash decides.  Overlapping
windows that remain form the maximal repeats, which are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import words as w
from panelwright.llm.tables import LAST_ID, put_back, rest

LENGTH, GRAM = 13, 5
SECOND = 0xA0761D6478BD642F


def _seeds(h: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes; the starts of all windows inside one text; the position of each one's seed."""
    grams = w.ngrams(h, k)
    n = len(h) - length + 1
    if n <= 0:
        return grams, np.empty(0, np.int64), np.empty(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, length - k + 1):
        other = grams[j : j + n]
        lower = other <= least
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + j
    owner = w.owners(bounds)
    inside = np.flatnonzero(owner[:n] == owner[length - 1 :])
    return grams, inside, at[inside]


def _hashed(column: pa.Array) -> Iterator[tuple]:
    for first, end, buf, offsets in w.text_slices(column):
        starts, ends, bounds = w.split_words(buf, offsets)
        yield first, end, buf, offsets, starts, ends, bounds, w.hash_spans(buf, starts, ends)


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """True where sorted rows differ from the one before."""
    new = np.ones(len(keys[0]), bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _seed_rows(length: int, k: int):
    """(route, t, kind, seed): kind 0 a seed of one text of the slice, 1 a text with a seed that
    the slice holds in several texts, 2 says so once to the others.  A slice sends each seed once.
    The seed is the route but for kind 1, where the route spreads the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_id = w.longs(batch.column(0))
            for first, _, _, _, _, _, bounds, h in _hashed(batch.column(1)):
                grams, _, at = _seeds(h, bounds, length, k)
                if not len(at):
                    continue
                at = np.unique(at)
                seed, t = grams[at].view(np.int64), text_id[first:][w.owners(bounds)[at]]
                order = np.lexsort((t, seed))
                seed, t = seed[order], t[order]
                keep = _first_of(seed, t)
                seed, t = seed[keep], t[keep]
                new = _first_of(seed)
                several = np.diff(np.append(np.flatnonzero(new), len(seed))) > 1
                kind = np.where(several[np.cumsum(new) - 1], 1, 0)
                told = seed[new][several]
                route = np.where(kind == 1, w.mix(seed.view(np.uint64) ^ w.mix(t.view(np.uint64))).view(np.int64), seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(route, told)),
                        pa.array(np.append(t, t[new][several])),
                        pa.array(np.append(kind, np.full(len(told), 2)).astype(np.int8)),
                        pa.array(np.append(np.where(kind == 1, seed, 0), np.zeros(len(told), np.int64))),
                    ],
                    names=["route", "t", "kind", "seed"],
                )

    return run


def _window_rows(length: int, k: int):
    """(a, b, doc, t, settled) of the windows that hold a shared seed; a slice sends a window to the others
    for its smallest document only, the larger ones are settled where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, source, shared, text = w.longs(batch.column(0)), w.longs(batch.column(1)), batch.column(2), w.longs(batch.column(4))
            mine = np.flatnonzero((doc == source) & shared.is_valid().to_numpy(zero_copy_only=False))
            if not len(mine):
                continue
            shared, doc, text = shared.take(pa.array(mine)), doc[mine], text[mine]
            for first, end, _, _, _, _, bounds, h in _hashed(batch.column(3).take(pa.array(mine))):
                grams, inside, at = _seeds(h, bounds, length, k)
                if not len(at):
                    continue
                owner = w.owners(bounds)[inside]
                part = shared.slice(first, end - first)
                hit_seed = w.longs(part.flatten()).view(np.uint64)
                hit_owner = np.repeat(np.arange(end - first), part.value_lengths().to_numpy(zero_copy_only=False))
                # a (text, seed) pair as one number, mixed so that texts differ
                tag = lambda o, s: s ^ w.mix(o.astype(np.uint64) + w.U(1))
                wanted = np.isin(tag(owner, grams[at]), tag(hit_owner, hit_seed))
                inside, owner = inside[wanted], owner[wanted]
                if not len(inside):
                    continue
                a = w.ngrams(h, length)[inside].view(np.int64)
                b = (w.ngrams(h, length, SECOND)[inside] >> w.U(32)).astype(np.int64)
                d, t = doc[first:][owner], text[first:][owner]
                order = np.lexsort((t, d, b, a))
                a, b, d, t = a[order], b[order], d[order], t[order]
                keep = _first_of(a, b, d, t)
                a, b, d, t = a[keep], b[keep], d[keep], t[keep]
                new = _first_of(a, b)
                settled = d > d[new][np.cumsum(new) - 1]
                b = np.where(settled, w.mix(d.view(np.uint64)).view(np.int64), b)  # these need not meet the others
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(d), pa.array(t), pa.array(settled)], names=["a", "b", "doc", "t", "settled"]
                )

    return run


def _closed(raw: bytes, first: int, end: int, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """The text at first .. end of ``raw`` without the words that are gone; of the white space before and
    after them, that with more line breaks stays."""
    kept = np.flatnonzero(~gone)
    if not len(kept):
        return b""
    parts, last = [], -1
    for i in kept.tolist():
        gap = raw[ends[i - 1] : starts[i]] if i else raw[first : starts[0]]
        if i - last > 1:
            before = raw[ends[last] : starts[last + 1]] if last >= 0 else raw[first : starts[0]]
            gap = before if last < 0 or before.count(b"\n") >= gap.count(b"\n") else gap
        parts += [gap, raw[starts[i] : ends[i]]]
        last = i
    return b"".join(parts) + raw[ends[-1] : end]


def _cut(length: int, layout: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, source, gone = w.longs(batch.column(1)), w.longs(batch.column(2)), batch.column(3).fill_null([])
            for first, end, buf, offsets, starts, ends, bounds, h in _hashed(batch.column(4)):
                owner, n = w.owners(bounds), len(h)
                drop = np.zeros(n + 1, np.int64)
                if n >= length:
                    inside = np.flatnonzero(owner[: n - length + 1] == owner[length - 1 :])
                    part = gone.slice(first, end - first)
                    gone_owner = np.repeat(np.arange(end - first), part.value_lengths().to_numpy(zero_copy_only=False))
                    tag = lambda o, s: s ^ w.mix(o.astype(np.uint64) + w.U(1))
                    hit = np.isin(
                        tag(owner[inside], w.ngrams(h, length)[inside]), tag(gone_owner, w.longs(part.flatten()).view(np.uint64))
                    )
                    hit |= (doc > source)[first:][owner[inside]]  # an equal text has a smaller id
                    np.add.at(drop, inside[hit], 1)
                    np.add.at(drop, inside[hit] + length, -1)
                removed = np.cumsum(drop)[:n] > 0
                raw, texts = buf.tobytes(), []
                some = batch.column(4).slice(first, end - first)
                missing = some.is_null().to_pylist() if layout else []
                for i in range(end - first):
                    lo, hi = bounds[i], bounds[i + 1]
                    if layout:
                        at, to = int(offsets[i]), int(offsets[i + 1])
                        cut = removed[lo:hi].any()
                        texts.append(_closed(raw, at, to, starts[lo:hi], ends[lo:hi], removed[lo:hi]) if cut else None if missing[i] else raw[at:to])
                        continue
                    kept = np.flatnonzero(~removed[lo:hi]) + lo
                    texts.append(b" ".join([raw[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist())]))
                n_removed = np.add.reduceat(np.append(removed, 0).astype(np.int64), bounds[:-1]) * (np.diff(bounds) > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                        pa.array(np.diff(bounds)),
                        pa.array(n_removed),
                    ],
                    names=["rest", "kept", "n_words", "n_removed"],
                )

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, layout: bool = False) -> DataFrame:
    """Cut every passage of ``length`` words or more that also starts in a document with a smaller id.

    Returns ``rest`` (all other columns as a struct), ``kept`` (the words left,
    joined by one space), ``n_words`` and ``n_removed``, a row for each row.  With
    ``layout``, ``kept`` has the white space of the text, and is the text as it is, null
    too, where nothing is removed.
    Passages are judged on the input.  A null text is empty.  A null id counts as
    the largest; rows of one id never cut each other, whatever their texts.
    Equal texts are recognised by their 64-bit hash, passages by 96 bits.
    """
    base = docs.select(
        rest(docs, text_col).alias("rest"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.col(f"`{text_col}`").alias("text"),
    ).withColumn("t", F.xxhash64(F.coalesce("text", F.lit(""))))
    first = base.groupBy("t").agg(F.min("doc").alias("source"))

    seeds = base.select("t", "text").mapInArrow(w.trimmed(_seed_rows(length, gram)), "route long, t long, kind byte, seed long")
    group = Window.partitionBy("route")
    shared = (
        seeds.withColumn("lo", F.min("t").over(group))
        .withColumn("hi", F.max("t").over(group))
        .withColumn("told", F.max("kind").over(group))
        .where("kind = 1 OR (kind = 0 AND (lo < hi OR told = 2))")
        .groupBy("t")
        .agg(F.collect_set(F.when(F.col("kind") == 1, F.col("seed")).otherwise(F.col("route"))).alias("shared"))
    )
    facts = first.join(shared, "t", "left")
    windows = (
        base.join(facts, "t")
        .select("doc", "source", "shared", "text", "t", "rest")  # all columns, so that both joins read one exchange of the texts
        .mapInArrow(w.trimmed(_window_rows(length, gram)), "a long, b long, doc long, t long, settled boolean")
    )
    least = F.min("doc").over(Window.partitionBy("a", "b"))
    gone = windows.withColumn("least", least).where("settled OR least < doc").groupBy("t").agg(F.collect_set("a").alias("gone"))
    facts = first.join(gone, "t", "left")
    return (
        base.join(facts, "t")
        .select("rest", "doc", "source", "gone", "text")
        .mapInArrow(w.trimmed(_cut(length, layout)), f"rest {docs.select(rest(docs, text_col).alias('rest')).schema['rest'].dataType.simpleString()}, kept string, n_words long, n_removed long")
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents with their repeated passages cut out and their length brought up to date; no row is dropped.

    A document without such passages stays as it is, one that is cut keeps the white space of what is left.
    """
    cut = dedup_substrings(docs, id_col, text_col, length, gram, layout=True)
    new = {text_col: F.col("kept")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col(f"rest.`{chars_col}`"))
    return cut.select(*put_back(cut, docs.columns, "rest", new))
