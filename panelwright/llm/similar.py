"""Near-duplicate documents: SimHash of word shingles, candidates by vantage-point trees, the exact likeness of the shingle sets.

Each text has a 64-bit SimHash of its shingles.  Vantage-point shards find the
fingerprints within ``RADIUS`` bits, and so the balls that these pairs connect.  A pair of
likeness 0.8 differs in about 10 bits of 64, and shards of that radius would copy nearly
every fingerprint to every shard.  So pairs further apart are also looked for by MinHash:
``BANDS`` keys of ``ROWS`` minima each, of which a pair of likeness 0.8 shares one with
probability 1 - (1 - 0.8^ROWS)^BANDS, 0.9998.

All texts of a ball, and all of a key, are candidates of each other; a pair stays if the
shingle sets, compared as a whole, are alike enough.  Copies need not meet in all their
pairs: first each text meets a few others (the first and nearest of its ball, the first
and a neighbour of its keys, in four orders).  Then, in balls and keys that this leaves in
several groups, all pairs of different groups meet, with prefixes of the sets, rarest
shingles first, to pass over pairs that cannot be alike enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import vptree
from panelwright.llm import words as w
from panelwright.llm.components import components
from panelwright.llm.near_docs import link_fingerprints, one_row
from panelwright.llm.simhash import vote
from panelwright.llm.tables import LAST_ID, written

SHINGLE, LIKENESS = 5, 0.8
RADIUS = 3
BANDS, ROWS, ORDERS = 16, 4, 4
PART = 4 << 20  # bytes of text in a part of a ball or key; parts meet two by two
GATHER = 1 << 20  # shingles compared at once
SEEDS = w.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * w.U(0x9E3779B97F4A7C15))


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, lower-cased A-Z, and how many each text has; one of all words if it has fewer."""
    buf = w.LOWER[buf]
    starts, ends, bounds = w.split_words(buf, offsets)
    h, n, owner = w.hash_spans(buf, starts, ends), np.diff(bounds), w.owners(bounds)
    grams = w.ngrams(h, size)
    inside = np.flatnonzero(owner[: len(grams)] == owner[size - 1 :]) if len(grams) else np.empty(0, np.int64)
    found, whose = [grams[inside]], [owner[inside]]
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            found.append(w.ngrams(h, k)[bounds[short]])
            whose.append(short)
    found, whose = np.concatenate(found), np.concatenate(whose)
    return found[np.argsort(whose, kind="stable")], np.bincount(whose, minlength=len(n))


def band_keys(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A key for each text and band; texts without words share theirs."""
    out = np.zeros((len(counts), BANDS), np.uint64)
    some = np.flatnonzero(counts)
    before = (np.cumsum(counts) - counts)[some]
    for band in range(BANDS):
        key = np.full(len(some), SEEDS[band])
        for seed in SEEDS[band * ROWS : (band + 1) * ROWS]:
            if len(some):
                key = w.mix(key ^ np.minimum.reduceat(w.mix(found ^ seed), before))
        out[some, band] = key
        out[counts == 0, band] = SEEDS[band]
    return out


def _key_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.arange(BANDS) % ORDERS
        for batch in batches:
            t = w.longs(batch.column(0))
            for first, end, buf, offsets in w.text_slices(batch.column(1)):
                keys = band_keys(*shingles(buf, offsets, size))
                part = np.repeat(t[first:end], BANDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(part), pa.array(np.tile(order, end - first).astype(np.int8))], names=["key", "t", "turn"]
                )

    return run


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in w.text_slices(batch.column(1)):
                fp = vote(*shingles(buf, offsets, size))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(fp.view(np.int64))], names=["t", "fp"])

    return run


def near_fingerprints(texts: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) between the ``t`` of texts (t, text) that connect what all pairs of SimHashes within ``radius`` bits connect.

    Each text is linked with the first of its shard's group and with its nearest, texts of one
    fingerprint with the first of them; :func:`links` compares the others that this connects.
    """
    known = written(texts.mapInArrow(w.trimmed(_fingerprints(size)), "t long, fp long").distinct())
    firsts = written(known.groupBy("fp").agg(F.min("t").alias("doc")))
    copies = known.join(firsts, "fp").where("t <> doc").select(F.col("t").alias("u"), F.col("doc").alias("v"))
    return copies.union(link_fingerprints(firsts, radius, links=vptree.shard_neighbours)).where("u <> v")


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, in order."""
    out = []
    for _, _, buf, offsets in w.text_slices(column):
        found, counts = shingles(buf, offsets, size)
        out += [np.unique(x) for x in np.split(found, np.cumsum(counts)[:-1])]
    return out


def _alike(size: int, likeness: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                stay = []
                for a, b in zip(shingle_sets(part.column(2), size), shingle_sets(part.column(3), size)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    stay.append(both >= likeness * (len(a) + len(b) - both))
                stay = pa.array(stay, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(stay), part.column(1).filter(stay)], names=["u", "v"])

    return run


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def alike_groups(sets: list[np.ndarray], group: np.ndarray, side: np.ndarray, likeness: float) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of sets of the likeness that connect groups as all such pairs would.

    Pairs of one group are not compared; if there are several sides, only pairs of different sides are.
    Of two sets alike enough, the first ``reach`` shingles of each have one in common, in any
    order of all shingles; with the rarest first, few other sets have it.
    """
    _, root, members = np.unique(group, return_inverse=True, return_counts=True)
    asks = root != members.argmax()  # of two groups, one is not the largest
    n, apart = np.array([len(x) for x in sets], np.int64), len(np.unique(side)) > 1
    owner, starts = np.repeat(np.arange(len(sets)), n), np.cumsum(n) - n
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    place = rank[place]
    place = place[np.lexsort((place, owner))]
    reach = np.minimum(n, n - np.ceil(likeness * n - 1e-6).astype(np.int64) + 1)
    lead = _spans(starts, reach)
    by = np.argsort(place[lead], kind="stable")
    posted, whose = place[lead][by], owner[lead][by]
    mark = np.zeros(len(times), bool)
    for i in np.flatnonzero(asks):
        mine = place[starts[i] : starts[i] + reach[i]]
        first = np.searchsorted(posted, mine)
        met = np.unique(whose[_spans(first, np.searchsorted(posted, mine, "right") - first)])
        if not n[i]:  # sets without shingles are alike
            met = np.flatnonzero(n == 0)
        met = met[(root[met] != root[i]) & (~asks[met] | (met < i)) & (np.minimum(n[met], n[i]) >= likeness * np.maximum(n[met], n[i]) - 1e-6)]
        if apart:
            met = met[side[met] != side[i]]
        mark[place[starts[i] : starts[i] + n[i]]] = True
        for some in np.split(met, np.flatnonzero(np.diff(np.cumsum(n[met]) // GATHER)) + 1):
            shared = np.concatenate([[0], np.cumsum(mark[place[_spans(starts[some], n[some])]])])
            ends = np.cumsum(n[some])
            both = shared[ends] - shared[ends - n[some]]
            for j in some[both >= likeness * (n[i] + n[some] - both)]:
                if root[j] != root[i]:
                    yield int(i), int(j)
                    root[root == root[j]] = root[i]
        mark[place[starts[i] : starts[i] + n[i]]] = False


def _meet(size: int, likeness: float):
    def run(table: pa.Table) -> pa.Table:
        t, label, side = (table.column(c).combine_chunks().to_numpy() for c in ("t", "label", "side"))
        pairs = np.array(list(alike_groups(shingle_sets(table.column("text"), size), label, side, likeness)), np.int64).reshape(-1, 2)
        return pa.table({"u": t[pairs[:, 0]], "v": t[pairs[:, 1]]})

    return run


def _between_groups(texts: DataFrame, blocks: DataFrame, groups: DataFrame, size: int, likeness: float) -> DataFrame:
    """Links (u, v) between groups (node, component) of texts (t, text), each once, that meet in blocks (block, t): as all pairs of likeness there would link them.

    A block in one group has nothing left to link, one of two texts neither; blocks of the same texts are compared once.
    A block's texts are dealt to parts of about ``PART`` bytes, and each two parts meet in a task.
    """
    named = blocks.join(groups.toDF("t", "label"), "t", "left").select("block", "t", F.coalesce("label", "t").alias("label"))
    facts = [F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.sum(F.xxhash64("t").cast("decimal(38,0)")).alias("sign")]
    several = named.groupBy("block").agg(*facts).where("n > 2 AND low < high").groupBy("n", "sign").agg(F.min("block").alias("block"))
    inside = written(named.join(several.select("block"), "block"))
    held = written(texts.join(inside.select("t").distinct(), "t", "left_semi").withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0))))
    parts = inside.join(held.select("t", "bytes"), "t").groupBy("block").agg(F.ceil((F.sum("bytes") + 1) / PART).alias("parts"))
    dealt = inside.join(parts, "block").withColumn("side", F.pmod(F.xxhash64("t", "block"), "parts"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pairs = pairs.select("block", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "t", "label", "side")
    return pairs.join(held.select("t", "text"), "t").groupBy("block", "low", "high").applyInArrow(_meet(size, likeness), "u long, v long")


def links(texts: DataFrame, size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """Links (u, v) between the ``t`` of texts (t, text) that connect what all candidates whose shingle sets have the likeness (intersection by union) connect."""
    keys = written(texts.mapInArrow(w.trimmed(_key_rows(size)), "key long, t long, turn byte").distinct())
    order = Window.partitionBy("key").orderBy(F.xxhash64("t", "turn"), "t")
    beside = keys.select("t", F.array(F.first("t").over(order), F.lag("t").over(order)).alias("others"))
    linked = beside.select("t", F.explode("others").alias("other")).where("t <> other")
    near = written(near_fingerprints(texts, size))
    linked = linked.union(near)
    pairs = written(linked.select(F.greatest("t", "other").alias("u"), F.least("t", "other").alias("v")).distinct())
    wanted = pairs.select(F.col("u").alias("t")).union(pairs.select(F.col("v").alias("t"))).distinct()
    some = written(texts.join(wanted, "t", "left_semi").dropDuplicates(["t"]))
    met = pairs.join(some.toDF("u", "a"), "u").join(some.toDF("v", "b"), "v")
    groups = written(components(met.select("u", "v", "a", "b").mapInArrow(w.trimmed(_alike(size, likeness)), "u long, v long")))
    balls = components(near).select(F.col("component").alias("block"), F.col("node").alias("t"))
    blocks = balls.union(keys.select(F.col("key").alias("block"), "t"))
    return groups.toDF("u", "v").union(_between_groups(some, blocks, groups, size, likeness))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, likeness: float = LIKENESS) -> DataFrame:
    """One document of each group linked by the likeness of texts, that of the smallest id and then text hash.

    Texts are known by their 64-bit hash; a null text is empty, a null id the largest.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("t"), text.alias("text"))
    found = components(links(rows.select("t", "text"), size, likeness))
    known = rows.groupBy("t").agg(F.min("doc").alias("doc"))
    group = F.coalesce("component", "t").alias("group")
    first = known.join(found, known.t == found.node, "left").select("doc", "t", group).groupBy("group").agg(F.min(F.struct("doc", "t")).alias("first"))
    return one_row(docs, first.select("first.doc", "first.t"), id_col, text_col)
