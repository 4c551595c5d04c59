"""Language-model scoring by a probabilistic suffix tree over words.

Learning counts words, then the grams of two and more words, over all training rows.
A gram is a context and the symbol after it.  Contexts of up to ``DEPTH`` words seen
``CONTEXT`` times or more are candidates, whatever the size of the corpus, and state
the symbols seen ``EVENT`` times or more after them.  A context is kept if its
distribution diverges from the one its suffix's state gives: the gain in
log-likelihood must pass the cost of its parameters.  Stated symbols are discounted,
and the rest of the mass goes to the suffix's distribution; the root is the smoothed
word distribution.  A text is scored from the longest suffix state at each token.

A token's score is the root's plus one term for each kept context that ends before it:
the context's back-off, and where it states the token, what that adds.  So the tree is
a table of (key, value) that texts join by key, and it grows with the corpus.  What
tasks and the driver hold has a fixed bound: terms and words above ``HEAVY`` of all
tokens (1 / HEAVY an order at most; texts need no join for them, so no key of the join
is hot) and bitmaps of 2^``BITS`` bits, which only tell that a key is not in a table
and let all keys pass where a table is too large for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm import words as w
from panelwright.llm.tables import written

DEPTH = 4  # words of the longest context
CONTEXT, EVENT = 32, 4  # occurrences
HEAVY = 2.5e-7  # share of all training tokens
INDEX = 24  # bits of a heavy word's place: 1 / HEAVY is less
BITS = 27
ADD, DISCOUNT = 0.1, 0.5
END = np.uint64(0x5851F42D4C957F2D)
NODE = 0x3C6EF372FE94F82B  # tells the key of a context from that of the gram of the same words

# The primes of XXH64.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def is_training(id_col: str = "doc_id", folds: int = 10, held_out: int = 0) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(folds)) != held_out, F.lit(True))


def _hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    def turned(v: np.ndarray, r: int) -> np.ndarray:
        return (v << w.U(r)) | (v >> w.U(64 - r))

    h = (seed + w.U(P5 + 8)) ^ (turned(x * w.U(P2), 31) * w.U(P1))
    h = turned(h, 27) * w.U(P1) + w.U(P4)
    h = (h ^ (h >> w.U(33))) * w.U(P2)
    h = (h ^ (h >> w.U(29))) * w.U(P3)
    return h ^ (h >> w.U(32))


def gram_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The keys of grams, from those of all words but the last and all but the first: Spark's ``xxhash64(context, suffix)``."""
    return _hash_long(suffix, _hash_long(context, np.full(len(context), 42, np.uint64)))


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, token hashes, the row of each); words lower-cased A-Z, an end after each text."""
    for first, end, buf, offsets in w.text_slices(column, 2 << 20):
        buf = w.LOWER[buf]
        starts, ends, bounds = w.split_words(buf, offsets)
        h = w.hash_spans(buf, starts, ends)
        owner = w.owners(bounds)
        token = np.full(len(h) + end - first, END, np.uint64)
        token[np.arange(len(h)) + owner] = h
        yield first, end, token, np.repeat(np.arange(end - first), np.diff(bounds) + 1)


def _counted(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct key tuples, how often each comes, and where it first is, in order of the keys."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(np.append(at, len(order))), order[at]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, token, _ in _tokens(batch.column(0)):
            word, n = np.unique(token, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])


@dataclass
class Terms:
    """Some keys, in order, and a value of each."""

    key: np.ndarray
    value: np.ndarray

    def place(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its place among the keys, else any."""
        if not len(self.key):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return self.key[at] == wanted, at

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its value or 0."""
        ok, at = self.place(wanted)
        return ok, np.where(ok, self.value[at], 0.0) if len(self.key) else np.zeros(len(wanted))


def _terms(rows: DataFrame) -> Terms:
    """(key, value) rows, of a bounded number."""
    found = rows.select("key", F.col("value").cast("double")).toArrow()
    key, value = (found.column(i).combine_chunks().to_numpy() if found.num_rows else np.empty(0, t) for i, t in ((0, np.int64), (1, float)))
    key = key.view(np.uint64)
    order = np.argsort(key)
    return Terms(key[order], value[order])


class Bitmap:
    """A bit for each key of a table, by the key's low bits: a key whose bit is not set is not there."""

    def __init__(self, keys: DataFrame):
        place = F.col("key").bitwiseAND((1 << BITS) - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
        found = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
        self.mask, self.bits = w.U((1 << BITS) - 1), np.zeros(max((1 << BITS) >> 6, 1), np.uint64)
        if found.num_rows:
            self.bits[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)

    def has(self, key: np.ndarray) -> np.ndarray:
        place = key & self.mask
        return (self.bits[place >> w.U(6)] >> (place & w.U(63))) & w.U(1) > 0


@dataclass
class Words:
    """The corpus totals, and log10(count + ADD) of the heavy words."""

    tokens: int
    distinct: int
    heavy: Terms

    @property
    def whole(self) -> float:
        """The root's probabilities are (count + ADD) / 10 ** whole."""
        return float(np.log10(self.tokens + ADD * (self.distinct + 1)))


@dataclass
class Tree:
    """(key, value, n) of every kept context and every symbol it states, in a table; those that are heavy again as arrays."""

    words: Words
    depth: int
    table: DataFrame
    heavy: Terms
    nodes: Bitmap
    events: Bitmap


def count_words(training: DataFrame, text_col: str = "text") -> tuple[DataFrame, Words]:
    """(word, n) of all training rows in a table, and what tasks need of it."""
    rows = training.select(F.col(f"`{text_col}`").alias("text"))
    counts = written(rows.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    heavy = counts.where(F.col("n") >= HEAVY * tokens).select(F.col("word").alias("key"), F.log10(F.col("n") + ADD).alias("value"))
    return counts, Words(tokens, distinct, _terms(heavy))


def _counted_grams(rows: DataFrame, length: int, context: Bitmap, event: Bitmap, words: Terms) -> DataFrame:
    """(key, context, suffix, n) of the grams of ``length`` words seen ``EVENT`` times or more.

    The bitmaps hold grams with one word less, those that can be a context and those
    seen often enough to be the end of such a gram.  Pairs of heavy words travel as
    one number, without a suffix.
    """
    sent = rows.sparkSession.sparkContext.broadcast((context, event, words))
    low = (1 << INDEX) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, event, words = sent.value
        for batch in batches:
            for _, _, token, row in _tokens(batch.column(0)):
                part, last = token, length - 1
                for _ in range(length - 2):
                    part = gram_keys(part[:-1], part[1:])
                if len(token) < length:
                    continue
                ok = np.flatnonzero((row[last:] == row[:-last]) & context.has(part)[:-1] & event.has(part)[1:])
                _, first, n = np.unique(gram_keys(part[ok], part[ok + 1]), return_index=True, return_counts=True)
                before, after = part[ok[first]], part[ok[first] + 1]
                packed = np.zeros(len(n), bool)
                if length == 2:
                    (a, i), (b, j) = words.place(before), words.place(after)
                    packed = a & b
                    before = np.where(packed, (i << INDEX | j).view(np.uint64), before)
                    after = np.where(packed, w.U(0), after)
                yield pa.RecordBatch.from_arrays([pa.array(before.view(np.int64)), pa.array(after.view(np.int64), mask=packed), pa.array(n)], names=["context", "suffix", "n"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value[2]
        for batch in batches:
            whole = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            c, s = batch.column(0).to_numpy().view(np.uint64).copy(), w.longs(batch.column(1)).view(np.uint64).copy()
            both = c[whole].view(np.int64)
            c[whole], s[whole] = words.key[both >> INDEX], words.key[both & low]
            yield pa.RecordBatch.from_arrays([pa.array(gram_keys(c, s).view(np.int64)), pa.array(c.view(np.int64)), pa.array(s.view(np.int64)), batch.column(2)], names=["key", "context", "suffix", "n"])

    sums = rows.mapInArrow(w.trimmed(run), "context long, suffix long, n long").groupBy("context", "suffix").agg(F.sum("n").alias("n"))
    return written(sums.where(F.col("n") >= EVENT).mapInArrow(unpacked, "key long, context long, suffix long, n long"))


def learn(training: DataFrame, counts: DataFrame, words: Words, text_col: str = "text", depth: int = DEPTH) -> Tree:
    """Shorter contexts first: each is tested against the distribution that the state of its suffix gives by then."""
    rows = training.select(F.col(f"`{text_col}`").alias("text"))
    shorter = counts.select(F.col("word").alias("key"), "n", (F.log10(F.col("n") + ADD) - words.whole).alias("log"))
    grams, nodes, events = shorter, [], []
    for length in range(2, depth + 2):
        context, event = (Bitmap(grams.where(F.col("n") >= least)) for least in (CONTEXT, EVENT))
        grams = _counted_grams(rows, length, context, event, words.heavy)
        shorter, node, stated = _grown(grams, shorter)
        nodes.append(node)
        events.append(stated)
    nodes, events = (written(reduce(DataFrame.unionByName, parts)) for parts in (nodes, events))
    table = nodes.unionByName(events)
    return Tree(words, depth, table, _terms(table.where(F.col("n") >= HEAVY * words.tokens)), Bitmap(nodes), Bitmap(events))


def _grown(grams: DataFrame, shorter: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The grams with their probability under the longest state, and the terms (key, value, n) of the contexts kept and of what they state.

    ``shorter`` holds (key, n, log) of all grams with one word less: a context's own
    count, and a symbol's probability after the context's suffix.
    """
    seen = shorter.where(F.col("n") >= CONTEXT).select(F.col("key").alias("context"), F.col("n").alias("seen"))
    below = shorter.select(F.col("key").alias("suffix"), F.col("log").alias("below"))
    p = (F.col("n") - DISCOUNT) / F.col("seen")
    rows = written(grams.join(seen, "context").join(below, "suffix").select("key", "context", "n", "seen", "below", F.log10(p).alias("own")))
    sums = rows.groupBy("context", "seen").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum("n").alias("times"),
        F.sum((F.col("n") - DISCOUNT) / F.col("seen")).alias("mass"),
        F.sum(F.pow(F.lit(10.0), "below")).alias("mass_below"),
        F.sum(F.col("n") * (F.col("own") - F.col("below"))).alias("gain"),
    )
    left, left_below = 1 - F.col("mass"), 1 - F.col("mass_below")
    rated = sums.where((left > 1e-9) & (left_below > 1e-9)).withColumn("backoff", F.log10(left) - F.log10(left_below))
    gain = F.col("gain") + (F.col("seen") - F.col("times")) * F.col("backoff")
    kept = written(rated.where(gain * float(np.log(10)) > 0.5 * (F.col("size") + 1) * F.log(F.col("seen"))).select("context", "seen", "backoff"))
    states = rows.join(kept.select("context", "backoff"), "context", "left")
    stated = F.col("backoff").isNotNull()
    longest = states.select("key", "n", F.when(stated, F.col("own")).otherwise(F.col("below")).alias("log"))
    nodes = kept.select(F.col("context").bitwiseXOR(F.lit(NODE)).alias("key"), F.col("backoff").alias("value"), F.col("seen").alias("n"))
    events = states.where(stated).select("key", (F.col("own") - F.col("below") - F.col("backoff")).alias("value"), "n")
    return longest, nodes, events


def score(docs: DataFrame, counts: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for each row; a null text is empty, repeated rows score alike.

    Every text sends one row of sums and a row for each of its distinct words and terms
    that are not heavy; these meet their values, and sums are added up by text.
    """
    sent = docs.sparkSession.sparkContext.broadcast((tree.words, tree.depth, tree.heavy, tree.nodes, tree.events))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, depth, heavy, nodes, events = sent.value
        for batch in batches:
            ids, keys = batch.column(0), w.longs(batch.column(1))
            for first, end, token, row in _tokens(batch.column(2)):
                size, own = end - first, keys[first:end]
                total = np.bincount(row, minlength=size)
                common, value = words.heavy.find(token)
                base = np.bincount(row, value, size) - total * words.whole
                known = np.bincount(row[common], minlength=size)
                found, whose, more = [token[~common]], [row[~common]], np.zeros(size)
                gram = token
                for last in range(1, min(depth + 1, len(token))):  # the place of the first gram's last word
                    inside, context, gram = row[last:] == row[:-last], gram[:-1], gram_keys(gram[:-1], gram[1:])
                    at = np.arange(len(gram))[inside]
                    for key, there in ((context ^ w.U(NODE), nodes), (gram, events)):  # only a context states symbols
                        at = at[there.has(key[at])]
                        common, value = heavy.find(key[at])
                        owner = row[last:][at]
                        more += np.bincount(owner, value, size)
                        found.append(key[at[~common]])
                        whose.append(owner[~common])
                word = np.repeat([True, False], [len(found[0]), sum(map(len, found[1:]))])
                (owner, key), times, place = _counted(np.concatenate(whose), np.concatenate(found))
                facts = pa.StructArray.from_arrays([ids.slice(first, size), pa.array(total), pa.array(known), pa.array(base), pa.array(more)], names=["id", "n", "known", "base", "more"])
                spread = w.mix(own.view(np.uint64)).view(np.int64)
                columns = ([own, spread, np.zeros(size, np.int64), np.zeros(size, bool)], [own[owner], key.view(np.int64), times, word[place]])
                for arrays, fact in zip(columns, (facts, pa.nulls(len(owner), facts.type))):
                    yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), fact], names=["text", "key", "times", "word", "facts"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    parts = rows.select("id", F.xxhash64("id", "text").alias("own"), "text").mapInArrow(
        w.trimmed(run), "text long, key long, times long, word boolean, facts struct<id:long,n:long,known:long,base:double,more:double>"
    )
    light = F.col("n") < HEAVY * tree.words.tokens
    values = counts.where(light).select(F.col("word").alias("key"), F.log10(F.col("n") + ADD).alias("value"))
    values = values.unionByName(tree.table.where(light).select("key", "value"))
    met = parts.join(values, "key", "left")
    rare = F.col("times") * F.coalesce("value", F.lit(float(np.log10(ADD))))
    sums = met.groupBy("text").agg(
        F.first("facts", ignorenulls=True).alias("facts"),
        F.count("facts").alias("rows"),
        F.sum(F.when(F.col("word") & F.col("value").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("word"), rare).otherwise(0.0)).alias("base"),
        F.sum(F.when(~F.col("word"), F.col("times") * F.coalesce("value", F.lit(0.0))).otherwise(0.0)).alias("more"),
    )
    each = sums.select("facts", *[(F.col(c) / F.col("rows")).alias(c) for c in ("known", "base", "more")], F.explode(F.sequence(F.lit(1), F.col("rows"))))
    base = F.col("facts.base") + F.col("base")
    return each.select(
        "facts.id", F.col("facts.n").alias("n_tokens"), (F.col("facts.known") + F.col("known").cast("long")).alias("n_known"), base.alias("base_score"), (base + F.col("facts.more") + F.col("more")).alias("score")
    )
