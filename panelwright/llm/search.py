"""Document fingerprints: SimHash of weighted terms, and all fingerprints within a Hamming radius.

Terms are pairs of neighbouring words, with one mark before the first word and after
the last; a term weighs 1 + ln(count in the text), in sixteenths.  Each bit of a
term's hash votes with its weight.

Near fingerprints come from permuted block tables: 64 bits are cut into ``radius +
EXTRA`` blocks, and two fingerprints within the radius agree on some ``EXTRA`` of
them.  There is a table for each choice of blocks, keyed by those blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import words as w
from panelwright.llm.simhash import vote
from panelwright.llm.tables import LAST_ID

RADIUS, EXTRA = 3, 3
CUTS, PIECES = 128, 64  # cut points of the ids, and ranges between two of them
HOT = 4096  # fingerprints of one key compared in one step
SCALE = 16
EDGE = np.uint64(0x2545F4914F6CDD1D)


def text_fingerprints(column: pa.Array) -> np.ndarray:
    """A fingerprint of each text; a text without words has zero."""
    out = np.zeros(len(column), np.uint64)
    for first, end, buf, offsets in w.text_slices(column, 1 << 20):
        starts, ends, bounds = w.split_words(buf, offsets)
        owner = w.owners(bounds)
        some = np.flatnonzero(np.diff(bounds))
        # the marks between texts: one before each text that has words, one after the last
        h = np.full(len(owner) + len(some) + 1, EDGE, np.uint64)
        place = np.cumsum(np.diff(bounds) > 0)
        h[np.arange(len(owner)) + place[owner]] = w.hash_spans(buf, starts, ends)
        term = w.ngrams(h, 2) if len(some) else np.empty(0, np.uint64)
        whose = np.repeat(some, np.diff(bounds)[some] + 1)
        order = np.lexsort((term, whose))
        term, whose = term[order], whose[order]
        new = np.ones(len(term), bool)
        if len(term) > 1:
            new[1:] = (term[1:] != term[:-1]) | (whose[1:] != whose[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(term)))
        out[first:end] = vote(term[at], np.bincount(whose[at], minlength=end - first), np.rint(SCALE * (1 + np.log(times))))
    return out


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for such as differ in half of their bits or more: the cosine the angle estimates."""
    angle = F.bit_count(a.bitwiseXOR(b)) / 64.0
    return F.greatest(F.lit(0.0), F.cos(angle * np.pi))


def fingerprinted(df: DataFrame, keep: dict[str, Column], **columns: str) -> DataFrame:
    """The columns ``keep``, and for each ``name=text column`` the fingerprint of that text as a long; a null text is empty."""
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [pa.array(text_fingerprints(part.column(i + 1)).view(np.int64)) for i in range(n)]
                yield pa.RecordBatch.from_arrays([part.column(0), *found], names=["row", *(f"f{i}" for i in range(n))])

    row = F.struct(*[c.alias(name) for name, c in keep.items()])
    named = df.select(row.alias("row"), *[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(columns.values())])
    out = named.mapInArrow(run, f"row {named.schema['row'].dataType.simpleString()}, " + ", ".join(f"f{i} long" for i in range(n)))
    return out.select("row.*", *[F.col(f"f{i}").alias(name) for i, name in enumerate(columns)])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cuts: int = CUTS) -> DataFrame:
    """(doc, text, next_text): each text with that of the next row by falling id; the last row's next is the first.

    Null ids come first, rows of one id follow by text hash; a single row is its own
    next.  Rows are sorted in ranges of ids; a range also gets a copy of the first row
    of the range after it.  The cut points and the ranges' first ids (``cuts`` times
    ``PIECES`` at most) pass through the driver.
    """
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))
    base = docs.select(doc.alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    points = sorted({min(int(x), LAST_ID) for x in base.approxQuantile("doc", [i / cuts for i in range(cuts + 1)], 0.2 / cuts)})
    if not points:
        return base.withColumn("next_text", F.col("text"))

    def within(low: int, high: int) -> Column:
        """The last of the cut points low .. high that x doesn't lie before, by halving."""
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(F.col("doc") >= points[middle], within(middle, high)).otherwise(within(low, middle - 1))

    # between two cut points, pieces of equal width
    start = F.element_at(F.array(*map(F.lit, points)), F.col("cut") + 1)
    width = F.element_at(F.array(*[F.lit(float(b - a)) for a, b in zip(points, [*points[1:], points[-1] + 1])]), F.col("cut") + 1)
    piece = F.least(F.lit(PIECES - 1), F.greatest(F.lit(0), F.floor((F.col("doc").cast("double") - start) * PIECES / width)))
    base = base.withColumn("cut", within(0, len(points) - 1)).withColumn("range", (F.col("cut") * PIECES + piece).cast("int")).drop("cut")
    heads = sorted((r[0], r[1]) for r in base.groupBy("range").agg(F.max("doc")).collect())
    copies = [(doc_id, heads[(i + 1) % len(heads)][0]) for i, (_, doc_id) in enumerate(heads)]
    goes = docs.sparkSession.createDataFrame(copies, "doc long, there int")
    home = F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))
    there = F.struct(F.col("there").alias("range"), F.lit(True).alias("copy"))
    at = F.when(F.col("there").isNull(), F.array(home)).otherwise(F.array(home, there))
    dealt = base.join(F.broadcast(goes), "doc", "left").select("doc", "text", F.explode(at).alias("at"))  # a row for each range
    order = Window.partitionBy("at.range").orderBy("at.copy", F.desc("doc"), F.xxhash64("text"))
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("NOT at.copy").select("doc", "text", "next_text")


def block_keys(fp: Column, radius: int = RADIUS) -> Column:
    """Keys of a fingerprint in all tables: structs (table, key)."""
    n = radius + EXTRA
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [F.shiftrightunsigned(fp, edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1) for i in range(n)]
    tables = []
    for t, chosen in enumerate(combinations(range(n), EXTRA)):
        key = F.lit(0).cast("long")
        for i in chosen:
            key = F.shiftleft(key, edges[i + 1] - edges[i]).bitwiseOR(blocks[i])
        tables.append(F.struct(F.lit(t).alias("table"), key.alias("key")))
    return F.array(*tables)


def near_counts(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, near): for each of the distinct fingerprints (fp, rows), the rows of all others within the radius.

    Keys held by one fingerprint drop out by an aggregate.  The rest is compared key by
    key; a pair that meets in several tables counts in the first.  No pair is written
    out: a key gives one row for each of its fingerprints.
    """
    keyed = distinct.select("fp", "rows", F.explode(block_keys(F.col("fp"), radius)).alias("k")).select("fp", "rows", "k.table", "k.key")
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / HOT).cast("int"))
    met = keyed.join(shared, ["table", "key"])
    # a hot key is compared in pieces: its rows of one part are asked, all are answers
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = met.withColumn("own", part).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = met.repartition("table", "key", "part").sortWithinPartitions("table", "key", "part").select("table", "key", "part", F.expr("own = part").alias("asks"), "fp", "rows")
    n = radius + EXTRA
    edges = [64 * i // n for i in range(n + 1)]
    masks = []
    for chosen in combinations(range(n), EXTRA):
        masks.append(sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen))
    masks = np.array(masks, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def answer(whole: pa.Table) -> pa.RecordBatch:
            table, key, piece = (whole.column(i).to_numpy() for i in range(3))
            asks, fp, rows = whole.column(3).to_numpy(), whole.column(4).to_numpy().view(np.uint64), whole.column(5).to_numpy()
            new = np.ones(len(fp), bool)
            new[1:] = (table[1:] != table[:-1]) | (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])
            at = np.flatnonzero(new)
            total = np.zeros(len(fp), np.int64)
            for lo, hi in zip(at.tolist(), np.append(at[1:], len(fp)).tolist()):
                who = np.flatnonzero(asks[lo:hi]) + lo
                step = max(1, (1 << 20) // (hi - lo))
                for a in range(0, len(who), step):
                    some = who[a : a + step]
                    x = fp[some][:, None] ^ fp[None, lo:hi]
                    ok = (np.bitwise_count(x) <= radius) & (x != 0)
                    i, j = np.nonzero(ok)
                    first = np.ones(len(i), bool)
                    for m in masks[: table[lo]]:
                        first &= (x[i, j] & m) != 0
                    total[some] += np.bincount(i[first], rows[lo:hi][j[first]], len(some)).astype(np.int64)
            some = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(fp[some].view(np.int64)), pa.array(total[some])], names=["fp", "n"])

        # a key may go on in the next batch: hold its rows until another begins
        for batch in batches:
            if not batch.num_rows:
                continue
            table, key, piece = (batch.column(i).to_numpy() for i in range(3))
            same = (table == table[-1]) & (key == key[-1]) & (piece == piece[-1])
            cut = int(np.argmax(same))
            if held and cut == 0 and all(held[-1].column(i)[-1].as_py() == batch.column(i)[0].as_py() for i in range(3)):
                held.append(batch)
                continue
            done = [*held, batch.slice(0, cut)]
            yield answer(pa.Table.from_batches(done))
            held = [batch.slice(cut)]
        if held:
            yield answer(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("near"))
