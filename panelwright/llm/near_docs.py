"""Near-duplicate documents: SimHash of word shingles, links by vantage-point trees, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import vptree
from panelwright.llm import words as w
from panelwright.llm.components import components
from panelwright.llm.simhash import shingle_hashes, vote
from panelwright.llm.tables import LAST_ID, written

RADIUS, SHINGLE = 2, 3
SHARD = 8192  # fingerprints a shard should hold
SAMPLE = 65536  # fingerprints the upper tree is grown from, at most


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in w.text_slices(batch.column(1)):
                raw = buf.tobytes()
                each = [shingle_hashes(raw[s:e], size) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                counts = np.fromiter(map(len, each), np.int64, len(each))
                fp = vote(np.concatenate(each), counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the 64-bit SimHash of each row's word shingles; a text without words, or null, has zero."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "id long, fp long")


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE, links=vptree.shard_links) -> DataFrame:
    """Star links (u, v) between the ``doc`` values of fingerprints (fp, doc) within the radius.

    The links connect exactly what all pairs within the radius connect.  The upper
    tree is grown from one fingerprint in 128 (``sample`` at most), its shards from
    all of them.  ``links=vptree.shard_neighbours`` adds the nearest of each one.
    """
    n = distinct.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / shard)))
    share = min(1 / 128, sample / max(1, n))
    chosen = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))
    picked = [r[0] for r in distinct.where(chosen).select("fp").limit(2 * sample).collect()] if depth else []
    nodes = vptree.grow(np.array(picked, np.int64).view(np.uint64), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 8192):
                part = batch.slice(first, 8192)
                fp, doc = w.longs(part.column(0)), w.longs(part.column(1))
                at, rows, home = vptree.route(fp.view(np.uint64), nodes, radius)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(fp[rows]), pa.array(doc[rows]), pa.array(home)], names=["shard", "fp", "doc", "home"])

    dealt = distinct.select("fp", "doc").mapInArrow(deal, "shard long, fp long, doc long, home boolean")
    return dealt.groupBy("shard").applyInArrow(links(radius), "u long, v long")


def _groups(known: DataFrame, radius: int) -> DataFrame:
    """(fp, group, component): the smallest fingerprint linked with each one, and the smallest id of the group."""
    distinct = written(known.groupBy("fp").agg(F.min(F.coalesce("id", F.lit(LAST_ID))).alias("doc")))
    found = components(link_fingerprints(distinct.select("fp", F.col("fp").alias("doc")), radius))
    placed = distinct.join(found, distinct.fp == found.node, "left").select("fp", "doc", F.coalesce("component", "fp").alias("group"))
    return placed.join(placed.groupBy("group").agg(F.min("doc").alias("component")), "group").select("fp", "group", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, component): fingerprint of each row and the smallest id linked with it, itself included.

    Two rows are linked when their fingerprints differ in ``radius`` bits or fewer,
    whatever their ids.  A null id counts as the largest id where components are named.
    """
    known = written(fingerprints(docs, id_col, text_col, shingle))
    return known.join(_groups(known, radius).drop("group"), "fp").select("id", "fp", "component")


def one_row(docs: DataFrame, first: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each (doc, t) of ``first``: an id, null as the largest, and the hash of a text, null as empty."""
    key, t = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    some = docs.select(key.alias("_doc"), t.alias("_t"), F.struct("*").alias("_row")).join(first.toDF("_doc", "_t"), ["_doc", "_t"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("_doc", "_t").orderBy(F.lit(1)))
    return some.withColumn("_nth", nth).where("_nth = 1").select("_row.*")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id and then text hash.

    Rows that share an id, or have none, are documents of their own, grouped by their texts alone.
    """
    t = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    texts = docs.select(t.alias("t"), F.col(f"`{text_col}`").alias("text"))
    known = written(fingerprints(texts, "t", "text", shingle).toDF("t", "fp").distinct())
    ids = docs.select(t.alias("t"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("doc")).groupBy("t").agg(F.min("doc").alias("doc"))
    groups = _groups(known.select(F.col("t").alias("id"), "fp"), radius)
    first = known.join(groups, "fp").join(ids, "t").groupBy("group").agg(F.min(F.struct("doc", "t")).alias("first"))
    return one_row(docs, first.select("first.doc", "first.t"), id_col, text_col)
