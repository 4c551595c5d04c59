"""Mixing sources to target weights, with DataFrame functions only.

Each source's words are packed, document after document, into blocks of ``BLOCK``
words.  The mix is a list of slots dealt to output shards.  The shards' counts of
each source are a multinomial draw given the totals the targets demand: every slot
goes to a place of a pseudorandom permutation of all places, and a shard is a run of
places.  A source's slots walk its block indices through pseudorandom permutations,
one for each pass over the source, and blocks are joined by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.tables import LAST_ID, put_back, rest

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64  # words
SHARD = 4096  # slots of an output shard
BUCKETS, ROWS = 4096, 8192  # pieces a source is numbered in, at least, and rows that ask for one more
CHUNK = 1024  # slots made from one row
WEIGHTS = (1, 2, 3)
TIMES = 3  # a source gives its words so many times at most
SEED, ROUNDS = 20, 12


def permuted(i: Column, n: Column, *seed: Column) -> Column:
    """The place of i in a pseudorandom permutation of 0 .. n - 1, for any n.

    Swap-or-not rounds: i is paired with key - i (mod n), and a hash of the pair tells
    whether the two change places.
    """

    def round_(at: Column, turn: Column) -> Column:
        other = F.pmod(F.xxhash64(*seed, turn) % n - at, n)
        return F.when(F.xxhash64(*seed, turn, F.greatest(at, other)) % 2 == 0, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, round_)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row with its place among its source's words (``off``), its source's facts and a key (sid, bucket, nth).

    A source is numbered in pieces that are joined by the sums before them, so no task
    holds a source.  Rows go to pieces by id and text, so those of a null or repeated id
    spread; there is a piece for each ``ROWS`` rows of the input, ``BUCKETS`` at least.
    Sources are one row each in the tables of facts.
    """
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))
    source = F.col(f"`{source_col}`").cast("string")
    pieces = docs.agg(F.greatest(F.lit(BUCKETS).cast("long"), F.ceil(F.count(F.lit(1)) / ROWS))).scalar()
    base = docs.select(
        rest(docs, text_col).alias("rest"),
        F.col(f"`{text_col}`").alias("text"),
        doc.alias("doc"),
        source.isNull().alias("unnamed"),
        F.coalesce(source, F.lit("")).alias("src"),
        F.pmod(F.xxhash64(doc, F.col(f"`{text_col}`")), pieces).alias("bucket"),
        size.alias("size"),
    )
    keys = ["unnamed", "src", "bucket"]
    pieces = base.groupBy(*keys).agg(F.sum("size").alias("piece"))
    before = Window.partitionBy("unnamed", "src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("piece").over(before), F.lit(0))).drop("piece")
    facts = pieces.join(targets(base), ["unnamed", "src"])
    inside = Window.partitionBy(*keys).orderBy("doc", F.xxhash64("text"))
    placed = base.withColumn("nth", F.row_number().over(inside)).withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.join(facts, keys).withColumn("off", F.col("before") + F.col("upto") - F.col("size")).drop("before", "upto", "unnamed", "src")


def targets(base: DataFrame) -> DataFrame:
    """One row for each source: its words, its target, its blocks and slots.

    Weights repeat over the sources in code point order, null last.  A target stops at
    ``TIMES`` its source's words, and the excess is shared among the others by
    weight: in order of words per weight, a source is full if the level of those
    not yet full would pass its limit, and the level of the first that is not holds
    for all after it.
    """
    every, name = Window.partitionBy(), Window.orderBy("unnamed", "src")
    order = Window.orderBy((F.col("source_size") / F.col("weight")), "sid")
    earlier, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = base.groupBy("unnamed", "src").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("sid"), F.lit(len(WEIGHTS))) + 1)
    limit = F.col("source_size") * TIMES
    rated = (
        sums.withColumn("sid", F.row_number().over(name) - 1)
        .withColumn("weight", weight)
        .withColumn("words_left", F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(earlier), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("full", limit * F.col("weight_left") <= F.col("words_left") * F.col("weight"))
        .withColumn("level", F.first(F.when(~F.col("full"), F.col("words_left") / F.col("weight_left")), ignorenulls=True).over(whole))
        .withColumn("target", F.when(F.col("full"), limit.cast("double")).otherwise(F.col("level") * F.col("weight")))
        .withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
        # as many slots as give the target with this source's mean block
        .withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.col("blocks") * TIMES)).otherwise(F.lit(0)))
    )
    return rated.select("unnamed", "src", "sid", "source_size", "target", "blocks", "slots")


def deal_slots(places: DataFrame) -> DataFrame:
    """(sid, block, turn, shard, slot): every slot of the mix, from :func:`numbered` rows.

    ``turn`` counts the passes over a source; within one, no block comes twice.
    """
    sources = places.select("sid", "blocks", "slots").distinct()
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every, name = Window.partitionBy(), Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    rows = sources.withColumn("all", F.sum("slots").over(every)).withColumn("first", F.coalesce(F.sum("slots").over(name), F.lit(0))).where("slots > 0")
    for step in (CHUNK * CHUNK, CHUNK):
        end = F.least(F.col("slots"), F.col("at") + step * CHUNK) if "at" in rows.columns else F.col("slots")
        start = F.col("at") if "at" in rows.columns else F.lit(0).cast("long")
        rows = rows.withColumn("at", F.explode(F.sequence(start, end - 1, F.lit(step).cast("long")))).repartition(parts, "sid", "at")
    rows = rows.withColumn("r", F.explode(F.sequence(F.col("at"), F.least(F.col("slots"), F.col("at") + CHUNK) - 1)))
    place = permuted(F.col("first") + F.col("r"), F.col("all"), F.lit(SEED))
    turn = F.floor(F.col("r") / F.col("blocks"))
    block = permuted(F.pmod("r", "blocks"), F.col("blocks"), F.lit(SEED), F.col("sid"), turn)
    return rows.select("sid", block.alias("block"), turn.alias("turn"), place.alias("place")).select(
        "sid", "block", "turn", F.floor(F.col("place") / SHARD).alias("shard"), F.pmod("place", F.lit(SHARD)).alias("slot")
    )


def mixed_segments(places: DataFrame, *carried: str) -> DataFrame:
    """The mix as runs of words of a row: (sid, bucket, nth, carried.., block, words, turn, shard, slot).

    A row whose words are not in the mix comes once, with a null slot.
    """
    last = F.floor((F.col("off") + F.col("size") - 1) / BLOCK)
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("off") / BLOCK), last))
    cut = places.select("sid", "bucket", "nth", "off", "size", *carried, F.explode_outer(blocks).alias("block"))
    words = F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * BLOCK) - F.greatest(F.col("off"), F.col("block") * BLOCK)
    return cut.withColumn("words", words).join(deal_slots(places).hint("merge"), ["sid", "block"], "left")  # Spark sees the slots before they are spread out, and would broadcast them


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc, size, source_size, target, taken, first_shard) for each row; a null id is null again.

    A null text is empty, a null source is a source of its own, rows of one id are
    rows of their own.  Reruns agree: all choices are hashes of ids and indices.
    """
    places = numbered(docs, id_col, text_col, source_col)
    segments = mixed_segments(places, "doc", "source_size", "target")
    out = segments.groupBy("sid", "bucket", "nth", "doc", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).alias("taken"), F.min("shard").alias("first_shard")
    )
    return out.withColumn("doc", F.when(F.col("doc") != LAST_ID, F.col("doc"))).drop("sid", "bucket", "nth")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """The mixed corpus in the columns of the input: a row for each document and pass over its source.

    Its text is what the pass takes of the document: the text as it is if the pass
    takes all words, else those taken, joined by one space.  Texts without words
    are not in the mix.
    """
    places = numbered(docs, id_col, text_col, source_col)
    taken = (
        mixed_segments(places)
        .where("slot IS NOT NULL")
        .groupBy("sid", "bucket", "nth", "turn")
        .agg(F.collect_list("block").alias("taken"), F.sum("words").alias("taken_words"))
    )
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    whole = places.join(taken, ["sid", "bucket", "nth"])

    def run(block: Column) -> Column:
        low = F.greatest(F.col("off"), block * BLOCK)
        return F.slice(F.col("all"), (low - F.col("off") + 1).cast("int"), (F.least(F.col("off") + F.col("size"), (block + 1) * BLOCK) - low).cast("int"))

    some = F.array_join(F.flatten(F.transform(F.array_sort("taken"), run)), " ")
    cut = whole.withColumn("all", F.when(F.col("taken_words") < F.col("size"), words)).withColumn("part", F.when(F.col("all").isNull(), F.col("text")).otherwise(some))
    new = {text_col: F.col("part")} | ({chars_col: F.length("part").cast("long")} if chars_col in docs.columns else {})
    return cut.select(*put_back(cut, docs.columns, "rest", new))
