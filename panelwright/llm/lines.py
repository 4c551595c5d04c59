"""Line dedup: sharded minimal perfect hashes over distinct line hashes, probed by the documents.

A line's key is the line stripped of ASCII white space and with A-Z lower-cased, known
by two 64-bit hashes.  Each document names a key once; keys are counted with partial
sums, and those of several documents are dealt into shards by their first hash.  A shard
is one row: the bits of a minimal perfect hash and, at the places it gives, an array of
fingerprints (the second hash, whole, so that a line outside the set can't pass), of
document counts and of first documents.

Documents do not join lines: a probe goes to its shard, where one pass over sorted rows
looks it up in the arrays that precede it.  A task holds the arrays of one shard at a
time.  A shard that takes many probes, as one line may be in a third of all documents,
is copied to several pieces and its probes are spread over them; by the bound on what
counts as many there are at most ``HEAVY`` such shards, and only their list is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelwright.llm.tables import LAST_ID, rest, written
from panelwright.llm.words import U, mix

SHARD = 1 << 16  # entries, and expected probes, of a shard
HEAVY = 1 << 16  # shards that can hold more than a 1 / HEAVY share of all probes
GAMMA = 2.0  # bits a key on each level of the perfect hash
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---- minimal perfect hash of one shard


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix(a ^ mix(b + U((level + 1) * 0x9E3779B97F4A7C15 % 2**64))) % U(bits)).astype(np.int64)


def perfect(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits of each level, and all bits: a key whose place on a level is its own sets it, the others go on to the next."""
    sizes, levels = [], []
    while len(a):
        bits = max(64, int(len(a) * GAMMA))
        at = _places(a, b, len(sizes), bits)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        levels.append(alone)
        left = ~alone[at]
        a, b = a[left], b[left]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def place(a: np.ndarray, b: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The index of each key of the set, a permutation of 0..n-1; -1, or any index, for others."""
    before = np.cumsum(bits) - bits
    out, todo, start = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, size in enumerate(sizes):
        at = _places(a[todo], b[todo], level, size) + start
        hit = bits[at]
        out[todo[hit]] = before[at[hit]]
        todo, start = todo[~hit], start + size
    return out


ARRAYS = "shard long, held long, table struct<sizes:array<long>,bits:binary,fingerprints:binary,counts:binary,firsts:binary>"


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    column = lambda name: rows.column(name).combine_chunks().to_numpy()
    a, b = column("a").view(np.uint64), column("b").view(np.uint64)
    sizes, bits = perfect(a, b)
    order = np.empty(len(a), np.int64)
    order[place(a, b, sizes, bits)] = np.arange(len(a))
    held = {"sizes": sizes, "bits": np.packbits(bits).tobytes(), "fingerprints": b[order].tobytes(), "counts": column("n")[order].tobytes(), "firsts": column("first")[order].tobytes()}
    kind = pa.struct([("sizes", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("bits", "fingerprints", "counts", "firsts"))])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "held": pa.array(column("n").sum()[None]), "table": pa.array([held], kind)})


def _probe(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table = None, None
        for batch in batches:
            whose = batch.column("shard").to_numpy()
            tables = np.flatnonzero(batch.column("table").is_valid().to_numpy(zero_copy_only=False))
            a, b, doc = (batch.column(n).fill_null(0).to_numpy() for n in ("a", "b", "doc"))
            gone, start = [], 0
            for cut in (*tables.tolist(), len(whose)):
                asked = start + np.flatnonzero(whose[start:cut] == shard)
                if len(asked):
                    sizes, bits, prints, counts, firsts = table
                    at = place(a[asked].view(np.uint64), b[asked].view(np.uint64), sizes, bits)
                    known = (at >= 0) & (prints[at] == b[asked])
                    gone.append(asked[known & (counts[at] >= least) & (firsts[at] < doc[asked])])
                if cut < len(whose):
                    t = batch.column("table")[cut].as_py()
                    shard, bits = whose[cut], np.unpackbits(np.frombuffer(t["bits"], np.uint8))[: sum(t["sizes"])].astype(bool)
                    table = (t["sizes"], bits, *(np.frombuffer(t[n], np.int64) for n in ("fingerprints", "counts", "firsts")))
                start = cut + 1
            taken = pa.array(np.concatenate(gone) if gone else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(n).take(taken) for n in ("doc", "of", "line")], ["doc", "of", "line"])

    return run


# ---- the operator


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """ASCII white space stripped, A-Z lower-cased; other letters stay."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def shards(docs: DataFrame, least_chars: int, least_docs: int) -> tuple[DataFrame, int]:
    """(shard, held, table): a row for each shard, of the keys in ``least_docs`` documents or more; and the number of shards."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), key_of), lambda k: F.length(k) >= least_chars))
    named = docs.select("doc", F.explode(keys).alias("key")).select("doc", *_hashes("key"))
    seen = Observation()
    counts = named.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
    entries = written(counts.observe(seen, F.sum("n").alias("probes")).where(F.col("n") >= least_docs))
    probes = seen.get["probes"] or 0
    n = max(1, -(-max(probes, entries.count()) // SHARD))
    built = entries.withColumn("shard", F.pmod("a", F.lit(n))).groupBy("shard").applyInArrow(_build, ARRAYS)
    many = max(2 * SHARD, probes // HEAVY)
    pieces = F.when(F.col("held") > many, F.ceil(F.col("held") / SHARD)).otherwise(1)
    return written(built.withColumn("pieces", pieces.cast("int"))), n


def repeated_lines(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """(doc, of, lines): numbers of the lines that go, for each document that loses any."""
    tables, n = shards(docs, least_chars, least_docs)
    # at most HEAVY rows: each holds more than a 1 / HEAVY share of all probes
    heavy = F.broadcast(tables.where("pieces > 1").select("shard", "pieces"))
    asked = docs.select("doc", "of", F.posexplode(F.transform(lines_of(F.col("text")), key_of)).alias("line", "key")).where(F.length("key") >= least_chars)
    asked = asked.select("doc", "of", "line", *_hashes("key")).withColumn("shard", F.pmod("a", F.lit(n))).join(heavy, "shard", "left")
    piece = F.coalesce(F.pmod(F.xxhash64("doc", "of", "line"), F.col("pieces")), F.lit(0)).cast("int")
    asked = asked.select("shard", piece.alias("piece"), "doc", "of", "line", "a", "b")
    held = tables.select("shard", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "table")
    both = held.unionByName(asked, allowMissingColumns=True).repartition("shard", "piece").sortWithinPartitions("shard", "piece", F.col("table").isNull())
    gone = both.mapInArrow(_probe(least_docs), "doc long, of long, line int")
    return gone.groupBy("doc", "of").agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 10, least_docs: int = 2) -> DataFrame:
    """(rest, n_lines, n_dropped, kept) for each row of ``docs``; ``rest`` holds its other columns.

    Lines end at a line feed.  Keys of ``least_chars`` code points or more that
    ``least_docs`` documents or more hold lose all their lines but those of the smallest
    id; a line that a document repeats stays or goes as often as it is there.  Other lines
    stay, joined by line feeds.  A null or empty text is one empty line.  Rows of one id
    are one document, which takes nothing from itself; so are all rows with a null id,
    and they come last.  Keys are known by 128 bits.
    """
    others = rest(docs, text_col)
    rows = docs.select(
        others.alias("rest"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc"), F.col(f"`{text_col}`").alias("text")
    ).withColumn("of", F.xxhash64("text"))
    gone = repeated_lines(rows.select("doc", "of", "text"), least_chars, least_docs)
    lines = lines_of(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("lines"))
    kept = F.when(F.col("lines").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform(left, lambda i: F.get("all", i)), "\n"))
    return rows.join(gone, ["doc", "of"], "left").withColumn("all", lines).select(
        "rest", F.size("all").cast("long").alias("n_lines"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept")
    )
