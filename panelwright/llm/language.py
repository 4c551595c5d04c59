"""Language ID: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm import words as w

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
SMOOTH = 0.5
MAX_LANGUAGES = 1000  # proves the size of the broadcast matrix
UNKNOWN = "und"
SLICE = 1 << 19


def is_training(id_col: str = "doc_id", folds: int = 3, held_out: int = 1) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(folds)) != held_out, F.lit(True))


def _grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[str]]]:
    """(first row, end row, buckets of all n-grams, the row of each, texts); white space runs count as one space."""
    for first, end, buf, offsets in w.text_slices(column, SLICE):
        raw = buf.tobytes()
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        plain = [" " + " ".join(t.lower().split()) + " " for t in texts]
        code = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(end - first), np.fromiter(map(len, plain), np.int64, len(plain)))
        found, where = [], []
        for k in SIZES:
            n = len(code) - k + 1
            if n <= 0:
                continue
            h = np.full(n, k, np.uint64)
            for j in range(k):
                h = (h * w.U(0x100000001B3)) ^ code[j : j + n]
            h = (h * w.U(0x9E3779B97F4A7C15)) >> w.U(49)
            inside = row[:n] == row[k - 1 :]
            found.append(h[inside].astype(np.int64))
            where.append(row[:n][inside])
        yield first, end, np.concatenate(found), np.concatenate(where), texts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of a task's rows by language, sent once at its end."""
    total: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        lang = batch.column(1).to_pylist()
        for first, end, bucket, row, _ in _grams(batch.column(0)):
            names, which = np.unique(np.array(lang[first:end], object), return_inverse=True)
            both = np.bincount(which[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for i, name in enumerate(names):
                total[name] = total.get(name, 0) + both[i]
                docs[name] = docs.get(name, 0) + int((which == i).sum())
    for name, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(counts[at], docs[name]))],
            names=["lang", "bucket", "n"],
        )


class Model:
    """Class names, log priors, and log probabilities (bucket, class)."""

    def __init__(self, rows: list) -> None:
        self.names = sorted({r.lang for r in rows})
        if len(self.names) > MAX_LANGUAGES:
            raise ValueError(f"{len(self.names)} languages; the matrix is broadcast for {MAX_LANGUAGES} at most")
        at = {name: i for i, name in enumerate(self.names)}
        counts, docs = np.zeros((BUCKETS, len(self.names))), np.zeros(len(self.names))
        for r in rows:
            docs[at[r.lang]] = r.docs
            counts[np.array(r.buckets, np.int64), at[r.lang]] = r.counts
        counts += SMOOTH
        self.log = np.log(counts / counts.sum(axis=0)).astype(np.float32)
        self.prior = np.log(docs / max(1.0, docs.sum()))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all given rows with a language; a row per language with at most ``BUCKETS`` counts comes back."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang IS NOT NULL")
    sums = rows.mapInArrow(w.trimmed(_counts), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_lang = sums.groupBy("lang").agg(
        F.sum(F.when(F.col("bucket") < 0, F.col("n"))).alias("docs"),
        F.collect_list(F.when(F.col("bucket") >= 0, F.struct("bucket", "n"))).alias("all"),
    )
    return Model(by_lang.select("lang", "docs", F.col("all.bucket").alias("buckets"), F.col("all.n").alias("counts")).collect())


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns, the predicted language and its posterior probability.

    A text that is null or has no letter is ``und`` with score 0, as is every text of a model without classes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for first, end, bucket, row, texts in _grams(batch.column(1)):
                n, classes = end - first, len(m.names)
                known = np.array([any(map(str.isalpha, t)) for t in texts], bool)
                name, best = np.full(n, UNKNOWN, object), np.zeros(n)
                if classes:
                    total = np.stack([np.bincount(row, m.log[bucket, c], n) for c in range(classes)], axis=1) + m.prior
                    top = total.argmax(axis=1)
                    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    name[known] = np.array(m.names, object)[top[known]]
                    best[known] = share[known]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(name.tolist(), pa.string()), pa.array(best)], names=["row", "lang", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (out, score)])
    named = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    done = named.mapInArrow(w.trimmed(run), f"row {named.schema['row'].dataType.simpleString()}, lang string, score double")
    return done.select("row.*", F.col("lang").alias(out), F.col("score").alias(score))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.5) -> DataFrame:
    """The rows whose language is recognised: not ``und``, and more likely than not.  Columns stay as they are."""
    model = fit(docs.where(is_training(id_col)), text_col, lang_col)
    row = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    return predict(row, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
