"""Ranked lexical search over posting lists in geometric blocks.

Documents become sparse vectors of whole-number impacts of the terms that a batch of
items asks for.  They are sorted by a signature (signs of random projections), so that
neighbours are alike, and cut into segments.  Inside a segment each term's posting list
is cut, in that order, into blocks of ``BLOCK`` documents, and each block stores the
coordinatewise maximum of its documents.

A document counts in the list of the rarest item term it holds; so a block in the list
of term t needs the maxima of terms as common as t or commoner only, and the bound of an
item on a block is their sum over the item's terms.  A block is skipped if that sum is
below the item's k-th best score so far (and a whole list if the segment's maxima say
so); the documents of all other blocks are scored in full.  Bounds are sums of true
maxima, so no document of the k best is lost.  Lists of fewer than ``SHORT`` documents in
a segment store no maxima and are read.

The index (:func:`index`) is a written table with a row for each segment; :func:`search`
reads it twice, some segments for a first k-th score of every item, then all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwright.llm.tables import LAST_ID, written
from panelwright.llm.words import LOWER, U, hash_spans, list_array, longs, mix, owners, split_words, text_slices, trimmed

BLOCK = 64
SHORT = 8
SEGMENT = 2048  # documents of a segment, fewer if they hold over
POSTINGS = 1 << 18  # postings
SIGNS = 24
SEEDS = 16  # segments that give the first bounds
LONG = 4096  # items of more different terms have no bounds: every document that holds one of their terms is scored
TERMS = 1 << 20  # terms, and
PAIRS = 1 << 24  # pairs of terms of one item, that a batch of items holds at most
_TERM = np.zeros(256, bool)
for _first, _end in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM[_first:_end] = True


def _hashed(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms (ASCII letters and digits and all else above ASCII, A-Z lower-cased), and each text's first."""
    plain = np.where(_TERM[buf], LOWER[buf], np.uint8(32))
    starts, ends, bounds = split_words(plain, offsets)
    return hash_spans(plain, starts, ends), bounds


# ---- items


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, buf, offsets in text_slices(batch.column("text")):
            h, bounds = _hashed(buf, offsets)
            each = [np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:])]
            flat = np.concatenate(each) if each else np.empty(0, np.uint64)
            lists = list_array(flat.view(np.int64), np.array([len(x) for x in each]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item").slice(first, end - first), lists], ["item", "terms"])


def item_batches(items: DataFrame) -> Iterator[list[Row]]:
    """Items (item, text) with the hashes of their terms, in batches of bounded size."""
    batch, terms, pairs = [], 0, 0
    for row in items.mapInArrow(_item_terms, "item long, terms array<long>").toLocalIterator():
        n = len(row.terms)
        if batch and (terms + n > TERMS or pairs + min(n, LONG) ** 2 > PAIRS):
            yield batch
            batch, terms, pairs = [], 0, 0
        batch.append(row)
        terms, pairs = terms + n, pairs + min(n, LONG) ** 2
    if batch:
        yield batch


# ---- documents


def _counted(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = longs(batch.column("doc"), LAST_ID)
            for first, end, buf, offsets in text_slices(batch.column("text")):
                h, bounds = _hashed(buf, offsets)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                asked = vocabulary[at] == h
                key, tf = np.unique(owners(bounds)[asked] * len(vocabulary) + at[asked], return_counts=True)
                n = np.diff(bounds)
                counts = np.bincount(key // len(vocabulary), minlength=end - first)
                some = n > 0  # a document without any term doesn't count
                lists = [list_array(x.astype(np.int32), counts[some], pa.int32()) for x in (key % len(vocabulary), tf)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:end][some]), pa.array(n[some]), *lists], ["doc", "n", "terms", "tfs"])

    return trimmed(run)


@dataclass
class Batch:
    """A batch of items over terms that are numbered from the commonest; what tasks need of it."""

    items: list  # the items' ids
    asked: list[np.ndarray]  # their terms, rising
    number: np.ndarray  # of each place in the vocabulary; -1 for terms no document holds
    weight: np.ndarray
    docs: int  # N
    length: int  # L
    free: np.ndarray  # items without bounds
    near: list[np.ndarray] = field(default_factory=list)  # of each term: commoner terms, and itself, that an item asks beside it

    def impacts(self, n: np.ndarray, places: np.ndarray, tf: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = 50 + 50 * n * self.docs // self.length
        terms = self.number[places]
        return terms, self.weight[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, counts)))


def weight(docs: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * held + 1)))


def _batch(rows: list[Row], vocabulary: np.ndarray, held: np.ndarray, docs: int, length: int) -> Batch:
    order = np.lexsort((vocabulary, -held))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    number[held == 0] = -1
    asked = []
    for row in rows:
        mine = number[np.searchsorted(vocabulary, np.array(row.terms, np.int64).view(np.uint64))]
        asked.append(np.sort(mine[mine >= 0]))
    beside: list[list[np.ndarray]] = [[] for _ in range(int((held > 0).sum()))]
    free = np.array([len(terms) > LONG for terms in asked], bool)
    for terms, none in zip(asked, free):
        if not none:
            for i, t in enumerate(terms.tolist()):
                beside[t].append(terms[: i + 1])
    near = [np.unique(np.concatenate(x)) if x else np.empty(0, np.int64) for x in beside]
    return Batch([r.item for r in rows], asked, number, np.array([weight(docs, int(h)) for h in held[order]], np.int64), docs, length, free, near)


def _vectors(batch: pa.RecordBatch, of: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, starts of their terms, terms and impacts."""
    counts = batch.column("terms").value_lengths().to_numpy()
    flat = lambda name: batch.column(name).flatten().to_numpy().astype(np.int64)
    terms, impact = of.impacts(batch.column("n").to_numpy(), flat("terms"), flat("tfs"), counts)
    return batch.column("doc").to_numpy(), np.concatenate([[0], np.cumsum(counts)]), terms, impact


def _signed(of: Batch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = np.unpackbits(mix(np.arange(1, len(of.weight) + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)).view(np.uint8).reshape(-1, 8), axis=1)[:, :SIGNS].astype(np.float64) * 2 - 1
        for batch in batches:
            _, starts, terms, impact = _vectors(batch, of)
            sig = np.zeros(len(starts) - 1, np.int64)
            for bit in range(SIGNS if len(terms) else 0):
                side = np.add.reduceat(impact * sides[terms, bit], starts[:-1])
                sig = sig * 2 + (side > 0)
            yield batch.append_column("sig", pa.array(sig))

    return run


def _cut(batches: Iterator[pa.RecordBatch], rows: int, postings: int) -> Iterator[pa.RecordBatch]:
    """Runs of at most so many rows and, but for a longer document, postings."""
    for batch in batches:
        ends, start = np.cumsum(batch.column("terms").value_lengths().to_numpy()), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = min(start + rows, batch.num_rows, max(start + 1, int(np.searchsorted(ends, before + postings, "right"))))
            yield batch.slice(start, end - start)
            start = end


def block_ends(size: int) -> np.ndarray:
    return np.append(np.arange(BLOCK, size, BLOCK), size)


def maxima(starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, lists: list[tuple[int, np.ndarray]], near: list[np.ndarray]) -> list[np.ndarray]:
    """For each list (term, members) its blocks' maxima (block, near term); dense columns of some terms at a time."""
    docs = len(starts) - 1
    out = [np.zeros((len(block_ends(len(members))), len(near[t])), np.int64) for t, members in lists]
    present, column = np.unique(terms, return_inverse=True)
    row, width = np.repeat(np.arange(docs), np.diff(starts)), max(1, (1 << 22) // docs)
    for low in range(0, len(present), width):
        some = (column >= low) & (column < low + width)
        dense = np.zeros((docs, width), np.int64)
        dense[row[some], column[some] - low] = impact[some]
        for (t, members), table in zip(lists, out):
            at = np.searchsorted(present, near[t])
            here = np.flatnonzero((at >= low) & (at < min(low + width, len(present))))
            here = here[present[at[here]] == near[t][here]]
            if len(here):
                begins = np.arange(0, len(members), BLOCK)
                table[:, here] = np.maximum.reduceat(dense[np.ix_(members, at[here] - low)], begins, axis=0)
    return out


SEGMENT_ROW = "docs array<long>, counts array<int>, terms array<int>, impacts array<long>, lists array<int>, sizes array<int>, members array<int>, maxima array<long>"


def _built(of: Batch, rows: int, postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches, rows, postings):
            docs, starts, terms, impact = _vectors(batch, of)
            order = np.argsort(terms, kind="stable")
            members = np.repeat(np.arange(len(docs)), np.diff(starts))[order]
            names, sizes = np.unique(terms, return_counts=True)
            ends = np.cumsum(sizes)
            lists = [(t, members[e - s : e]) for t, s, e in zip(names.tolist(), sizes.tolist(), ends.tolist()) if s >= SHORT]
            tables = maxima(starts, terms, impact, lists, of.near)
            flat = np.concatenate([t.ravel() for t in tables]) if tables else np.empty(0, np.int64)
            one = {"docs": [docs], "counts": [np.diff(starts).astype(np.int32)], "terms": [terms.astype(np.int32)], "impacts": [impact]}
            one |= {"lists": [names.astype(np.int32)], "sizes": [sizes.astype(np.int32)], "members": [members.astype(np.int32)], "maxima": [flat]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in one.items()})

    return trimmed(run)


def index(counted: DataFrame, of: Batch, segment: int = SEGMENT, postings: int = POSTINGS) -> DataFrame:
    """A row for each segment: documents with their vectors, posting lists, the blocks' maxima."""
    signed = counted.where(F.size("terms") > 0).mapInArrow(_signed(of), "doc long, n long, terms array<int>, tfs array<int>, sig long")
    alike = signed.repartitionByRange("sig", F.xxhash64("doc")).sortWithinPartitions("sig", F.xxhash64("doc"))
    return written(alike.mapInArrow(_built(of, segment, postings), SEGMENT_ROW).withColumn("segment", F.monotonically_increasing_id()))


# ---- search


class Search:
    """The k best documents of every item of a batch over the segments seen so far."""

    def __init__(self, of: Batch, k: int, least: np.ndarray):
        self.of, self.k, self.least = of, k, least.copy()  # no document below ``least`` can be among an item's k best
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in of.asked]
        self.scored = 0
        self.flat = np.concatenate(of.asked) if of.asked else np.empty(0, np.int64)
        self.ends = np.cumsum([len(a) for a in of.asked])
        self.item = np.repeat(np.arange(len(of.asked)), [len(a) for a in of.asked])
        self.inside = np.zeros(len(of.near), bool)

    def segment(self, docs: np.ndarray, starts: np.ndarray, terms: np.ndarray, impact: np.ndarray, names: np.ndarray, sizes: np.ndarray, members: np.ndarray, tables: np.ndarray) -> None:
        ends, place = np.cumsum(sizes), np.full(len(self.of.near), -1)
        place[names] = np.arange(len(names))
        offsets, at = np.full(len(names), -1), 0
        for i, (t, s) in enumerate(zip(names.tolist(), sizes.tolist())):
            if s >= SHORT:
                offsets[i] = at
                at += -(-s // BLOCK) * len(self.of.near[t])
        most = np.zeros(len(self.of.near), np.int64)
        np.maximum.at(most, terms, impact)
        # of each item and term: the sum of the segment's maxima over its terms as common or commoner
        upto = np.cumsum(most[self.flat])
        before = np.concatenate([[0], upto])[np.concatenate([[0], self.ends[:-1]])] if len(self.ends) else upto
        upto = upto - before[self.item]
        held = place[self.flat] >= 0
        for q in np.unique(self.item[held & ((upto >= self.least[self.item]) | self.of.free[self.item])]).tolist():
            self._item(q, upto, place, offsets, docs, starts, terms, impact, sizes, ends, members, tables)

    def _item(self, q, upto, place, offsets, docs, starts, terms, impact, sizes, ends, members, tables) -> None:
        mine = self.of.asked[q]
        bound = upto[self.ends[q] - len(mine) : self.ends[q]]
        taken, value = [], []  # runs of members, and their bounds
        for j in np.flatnonzero((place[mine] >= 0) & ((bound >= self.least[q]) | self.of.free[q])).tolist():
            i = place[mine[j]]
            size, end, near = sizes[i], ends[i], self.of.near[mine[j]]
            if offsets[i] < 0 or self.of.free[q]:
                taken.append((end - size, end))
                value.append(bound[j])
                continue
            blocks = -(-size // BLOCK)
            table = tables[offsets[i] : offsets[i] + blocks * len(near)].reshape(blocks, len(near))
            sums = table[:, np.searchsorted(near, mine[: j + 1])].sum(axis=1)
            for b in np.flatnonzero(sums >= self.least[q]).tolist():
                taken.append((end - size + b * BLOCK, min(end, end - size + (b + 1) * BLOCK)))
                value.append(sums[b])
        # the most promising blocks first: they may lift the k-th score above the bounds of the others
        order = np.argsort(-np.array(value), kind="stable")
        seen = np.zeros(len(docs), bool)
        self.inside[mine] = True
        for part in np.array_split(order, [i for i in (2, 8, 32, 128, 512) if i < len(order)]):
            runs = [members[taken[i][0] : taken[i][1]] for i in part.tolist() if value[i] >= self.least[q] or self.of.free[q]]
            if not runs:
                break
            new = np.unique(np.concatenate(runs))
            new = new[~seen[new]]
            seen[new] = True
            if len(new):
                self._score(q, new, docs, starts, terms, impact)
        self.inside[mine] = False

    def _score(self, q, rows, docs, starts, terms, impact) -> None:
        self.scored += len(rows)
        counts = starts[rows + 1] - starts[rows]
        begins = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) - np.repeat(begins - starts[rows], counts)
        score = np.add.reduceat(np.where(self.inside[terms[at]], impact[at], 0), begins)
        good = (score >= self.least[q]) & (score > 0)
        ids, score = np.concatenate([self.best[q][0], docs[rows[good]]]), np.concatenate([self.best[q][1], score[good]])
        first = np.lexsort((ids, -score))[: self.k]
        self.best[q] = (ids[first], score[first])
        if len(first) == self.k:
            self.least[q] = max(self.least[q], score[first[-1]])


def _searched(of: Batch, k: int, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(of, k, least)
        for batch in batches:
            for i in range(batch.num_rows):
                value = lambda name: batch.column(name)[i].values.to_numpy()  # noqa: B023, E731
                starts = np.concatenate([[0], np.cumsum(value("counts"))])
                search.segment(value("docs"), starts, value("terms"), value("impacts"), value("lists"), value("sizes"), value("members"), value("maxima"))
        counts = [len(ids) for ids, _ in search.best]
        flat = [np.concatenate([b[j] for b in search.best]) if search.best else np.empty(0, np.int64) for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(counts)), counts)), *map(pa.array, flat)], ["query", "doc", "score"])

    return trimmed(run)


FOUND = "query long, doc long, score long"


def search(segments: DataFrame, of: Batch, k: int) -> DataFrame:
    """(query, doc, score, rank): the k best documents of every item of the batch."""
    least = np.ones(len(of.items), np.int64)
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    best = lambda found: found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    # any segments give a valid bound; their numbers are picked first, as rows are large
    first = segments.where(F.col("segment").isin([r.segment for r in segments.select("segment").orderBy(F.xxhash64("segment")).limit(SEEDS).collect()]))
    for row in best(first.mapInArrow(_searched(of, k, least), FOUND)).where(F.col("rank") == k).collect():  # one row an item
        least[row.query] = row.score
    return best(segments.mapInArrow(_searched(of, k, least), FOUND))


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", segment: int = SEGMENT, postings: int = POSTINGS
) -> DataFrame:
    """(item, rank, doc, score): the k highest-scoring documents of each item, scores above 0, ties to smaller ids.

    Terms are runs of ASCII letters and digits and of all code points above ASCII, with
    A-Z lower-cased, known by 64-bit hashes.  A null text has none.  Each row of ``items``
    is asked for itself; an item without a term that a document holds gives no rows.  Each
    row of ``docs`` is a document; a null id comes last among ties.  Without documents or
    items there are no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text"))
    spark, out = docs.sparkSession, None
    for batch in item_batches(asked):
        terms = [np.array(r.terms, np.int64).view(np.uint64) for r in batch]
        vocabulary = np.unique(np.concatenate(terms))
        if not len(vocabulary):
            continue
        counted = written(rows.mapInArrow(_counted(vocabulary), "doc long, n long, terms array<int>, tfs array<int>"))
        docs_n, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = np.zeros(len(vocabulary), np.int64)
        for row in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most TERMS rows
            held[row.t] = row["count"]
        of = _batch(batch, vocabulary, held, docs_n, length)
        found = search(index(counted, of, segment, postings), of, k)
        names = spark.createDataFrame(list(enumerate(of.items)), "query long, item long")
        found = found.join(F.broadcast(names), "query").select("item", "rank", F.when(F.col("doc") != LAST_ID, F.col("doc")).alias("doc"), "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item long, rank int, doc long, score long") if out is None else out
