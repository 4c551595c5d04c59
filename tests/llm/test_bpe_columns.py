"""Columns of byte-level BPE: each goes to the workers once, and the pipeline's texts do not go through decoding."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from panelwright.llm import bpe
from panelwright.llm.queries import TOKENIZER

TEXTS = [
    (1, "The cat sat.\n\tOn the mat", "en", "web"),
    (2, None, "de", "web"),
    (3, "", None, None),
    (None, "Größe 東京 <|endoftext|>", "de", "book"),
    (1, "again", "en", "web"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string").coalesce(1)


@pytest.fixture
def sent(spark, monkeypatch):
    """Names of the columns that steps in Python take, those of structs after a point."""
    kind, taken = type(spark.range(0)), []
    plain = kind.mapInArrow

    def noted(df, *args, **more):
        taken.append([f"{f.name}.{c}" for f in df.schema for c in getattr(f.dataType, "names", [""])])
        return plain(df, *args, **more)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    return taken


def test_each_column_goes_to_the_workers_once(docs, sent):
    coded = bpe.encode(docs, TOKENIZER)
    bpe.decode(coded, TOKENIZER)
    assert sent == [[f"row.{c}" for c in docs.columns], [f"row.{c}" for c in coded.columns]]


def test_pipeline_decodes_ids_without_their_texts(spark, docs, sent):
    got = {(r.doc_id, r.lang, r.source, tuple(r.ids), r.n_tokens, r.round_trip) for r in corpus_pipeline.tokens(spark, docs, "").collect()}
    assert "row.text" in sent[0] and "row.text" not in sent[1]
    lib = Tokenizer.from_file(TOKENIZER)
    want = set()
    for i, text, lang, source in TEXTS:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.add((i, lang, source, tuple(ids), len(ids), True))
    assert got == want
