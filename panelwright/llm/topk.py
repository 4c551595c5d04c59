"""Exact top-k by inner product: no-random-access aggregation (NRA) over sorted lists.

Candidates that are alike (by signs of random projections) share a block; a block stores,
for each dimension, its candidates sorted by that component.  Queries come in batches.  A
batch scores some blocks whole, which gives every query a lower bound on its k-th score;
then each task takes its blocks one after another and lifts the bounds as it finds better
candidates.

A query skips a block whose lists can't reach the bound even at their extremes.  In other
blocks it reads its lists in the order of falling contribution, each from the end that
contributes most, down to a share of its length; lists that can hardly matter stay unread.
Products are formed for entries read only.  A candidate's upper bound is the sum over its
entries read and, for each other list, over the most that an unread entry gives.  Reading
stops when the candidates that may still reach the bound are few; their scores are
resolved from all their entries.  The blocks' best meet in a final ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.tables import written
from panelwright.llm.words import U, mix

BLOCK = 4096  # candidates of a block
COMPONENTS = 1 << 19  # components of the queries of a batch
DEPTHS = (0.6, 0.8)  # shares of a list read, one after another
FEW = 1 / 8  # share of a block's candidates that are resolved without reading on
IDLE = 1 / 16  # share of the bound that lists left unread may give together
SIGNS = 16
SEEDS = 2  # blocks that give the first bounds


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v): components times ``scale`` rounded down; vectors null, empty, or with null or non-finite components go, as do null ids."""
    value = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("x") > 0)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), value.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & whole)
    return rows.select("id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _matrix(lists: pa.Array, dims: int | None = None) -> np.ndarray:
    """Rows of equal length, filled up with zeros."""
    counts, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    out = np.zeros((len(counts), max([*counts.tolist(), dims or 0])), np.int64)
    out[np.repeat(np.arange(len(counts)), counts), np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("v")).astype(float)
        sides = np.unpackbits(mix(np.arange(1, vectors.shape[1] + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)).view(np.uint8).reshape(-1, 8), axis=1)[:, :SIGNS]
        yield batch.append_column("sig", pa.array(((vectors @ (sides * 2.0 - 1) > 0) @ (1 << np.arange(SIGNS))).astype(np.int64)))


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, size) for b in batches for i in range(0, b.num_rows, size)):
            vectors = _matrix(batch.column("v"))
            order = np.argsort(vectors, axis=0, kind="stable")
            listed = np.take_along_axis(vectors, order, axis=0)
            yield pa.RecordBatch.from_pydict({"ids": pa.array([batch.column("id").to_numpy()]), "listed": pa.array([listed.T.ravel()]), "places": pa.array([order.T.ravel().astype(np.int32)])})

    return run


def blocks(candidates: DataFrame, size: int = BLOCK) -> DataFrame:
    """A row for each block of like candidates (id, v): ids, sorted values of every dimension, and whose they are; a written table."""
    signed = candidates.select("id", "v").mapInArrow(_signed, "id long, v array<long>, sig long")
    alike = signed.repartitionByRange("sig", F.xxhash64("id", "v")).sortWithinPartitions("sig", F.xxhash64("id", "v"))
    rows = alike.mapInArrow(_blocks(size), "ids array<long>, listed array<long>, places array<int>")
    return written(rows.withColumn("block", F.monotonically_increasing_id()))


class Search:
    """The k best candidates of every query over the blocks seen so far; ``read`` of ``entries`` were read."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
        self.ids, self.queries, self.bounds, self.k = ids, queries, bounds.astype(np.float64), k
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        self.read = self.entries = 0

    def block(self, ids: np.ndarray, listed: np.ndarray, places: np.ndarray) -> None:
        n = len(ids)
        listed, places = listed.reshape(-1, n), places.reshape(-1, n).astype(np.intp)
        vectors = np.empty((n, len(listed)), np.int64)
        np.put_along_axis(vectors, places.T, listed.T, axis=0)
        asked = np.zeros((len(self.ids), len(listed)), np.int64)
        shared = min(len(listed), self.queries.shape[1])
        asked[:, :shared] = self.queries[:, :shared]
        values, low, high = listed.astype(np.float64), listed[:, 0].astype(np.float64), listed[:, -1].astype(np.float64)
        for i, q in enumerate(asked):
            self.entries += vectors.size
            most = np.where(q >= 0, high, low) * q  # of each list
            slack = 1e-9 * float(np.abs(q) @ np.maximum(np.abs(low), np.abs(high)))  # sums of bounds are rounded
            if most.sum() + slack < self.bounds[i]:
                continue
            alive = self._alive(q.astype(np.float64), self.bounds[i] - slack, values, places, most, np.abs(q) * (high - low))
            alive = alive[ids[alive] != self.ids[i]]
            self._resolve(i, ids[alive], vectors[alive] @ q)
            self.read += vectors.shape[1] * len(alive)

    def _alive(self, q, bound, values, places, most, span) -> np.ndarray:
        """Candidates that can reach the bound."""
        n = values.shape[1]
        if bound == -np.inf:
            return np.arange(n)
        order = np.argsort(-span, kind="stable")
        left = np.cumsum(span[order][::-1])[::-1]  # what the lists from here on can give together
        lists = order[: max(1, int((left > max(bound, 0.0) * IDLE).sum()))]
        up, down = lists[q[lists] > 0], lists[q[lists] < 0]
        for depth in DEPTHS:
            m = min(n - 1, int(n * depth))
            # the most that an unread entry of a list gives
            edges = most.copy()
            edges[up], edges[down] = values[up, n - 1 - m] * q[up], values[down, m] * q[down]
            gained = [(values[up, n - m :] - values[up, n - 1 - m][:, None]) * q[up][:, None], (values[down, :m] - values[down, m][:, None]) * q[down][:, None]]
            seen = [places[up, n - m :], places[down, :m]]
            high = edges.sum() + np.bincount(np.concatenate([s.ravel() for s in seen]), np.concatenate([g.ravel() for g in gained]), n)
            alive = np.flatnonzero(high >= bound)
            if len(alive) <= n * FEW:
                break
        self.read += m * (len(up) + len(down))
        return alive

    def _resolve(self, i: int, ids: np.ndarray, score: np.ndarray) -> None:
        ids, score = np.concatenate([self.best[i][0], ids]), np.concatenate([self.best[i][1], score])
        first = np.lexsort((ids, -score))[: self.k]
        self.best[i] = ids[first], score[first]
        if len(first) == self.k:
            self.bounds[i] = max(self.bounds[i], float(score[first[-1]]))


def _searched(ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(ids, queries, bounds, k)
        for batch in batches:
            for i in range(batch.num_rows):
                search.block(*(batch.column(c)[i].values.to_numpy() for c in ("ids", "listed", "places")))
        counts = [len(found) for found, _ in search.best]
        flat = [np.concatenate([b[j] for b in search.best]) if counts else np.empty(0, np.int64) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), *map(pa.array, flat)], ["query_id", "vec_id", "score"])

    return run


def _query_batches(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors, filled up with zeros, of queries with at most COMPONENTS components together (or of one query)."""
    held, dims = [], 0
    for row in queries.groupBy("id").agg(F.min("v").alias("v")).toLocalIterator():
        if held and max(dims, len(row.v)) * (len(held) + 1) > COMPONENTS:
            yield _batch(held, dims)
            held, dims = [], 0
        held.append(row)
        dims = max(dims, len(row.v))
    if held:
        yield _batch(held, dims)


def _batch(rows: list, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r.id for r in rows], np.int64), np.array([r.v + [0] * (dims - len(r.v)) for r in rows], np.int64)


FOUND = "query_id long, vec_id long, score long"


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates (id, v) of each query (id, v) by integer inner product.

    A candidate with the query's id is its own and left out.  Ties go to the smaller
    id.  A shorter vector counts as filled up with zeros.  Of several queries with one
    id, one is asked, the smallest; of candidates each counts.  Every query meets every
    block, as asked, a bounded batch of queries at a time.
    """
    index, out = blocks(candidates, block), None
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    seeds = [r.block for r in index.select("block").orderBy(F.xxhash64("block")).limit(SEEDS).collect()]
    for ids, asked in _query_batches(queries):
        bounds = np.full(len(ids), -np.inf)
        first = best(index.where(F.col("block").isin(seeds)).mapInArrow(_searched(ids, asked, bounds, k), FOUND))
        known = {r.query_id: r.score for r in first.where(F.col("rank") == k).collect()}  # one row a query of the batch
        bounds = np.array([known.get(i, -np.inf) for i in ids.tolist()])
        found = best(index.mapInArrow(_searched(ids, asked, bounds, k), FOUND)).select("query_id", "rank", "vec_id", "score")
        out = found if out is None else out.unionByName(found)
    return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long") if out is None else out
