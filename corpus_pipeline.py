"""From documents to token ids: five stages, each written and read again by :func:`run`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import bpe, language, mixing, similar, substrings
from panelwright.llm.queries import TOKENIZER
from panelwright.llm.tables import read, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash of five-word shingles in vantage-point shards, then their likeness, 0.8 or more."""
    return similar.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that an earlier one has; other texts stay as they are, line breaks too."""
    return substrings.without_repeats(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and pass over its source, with the words taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, their number, and whether they decode to the text again."""
    said = F.sha2(F.coalesce("text", F.lit("")), 256)  # stands for the text, which need not go through decoding again
    rows = docs.select("doc_id", "lang", "source", "text", said.alias("said"))
    coded = written(bpe.encode(rows, TOKENIZER).drop("text"))  # read again, so that a task holds one Python worker at a time
    back = bpe.decode(coded, TOKENIZER)
    round_trip = F.sha2("decoded", 256) == F.col("said")
    return back.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), round_trip.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing_to_targets),
    ("bpe", tokens),
]

# SQL cannot express the language model; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
