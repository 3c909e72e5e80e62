"""Counts at every prefix against the sentencepiece library."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelscope.llm import token_counts
from parcelscope.llm.shipping import ship
from parcelscope.llm.suite import PIECES, QUERIES, tokenizer_path

sentencepiece = pytest.importorskip("sentencepiece")
ODD = [
    "", " ", "\n", "a", " a", "a ", "  a  b", "a\nb\n\nc", "▁x", "<s></s><unk><0x0A>", "éﬁ①　x\xa0y", "\x00a", "🎉🎉 👩‍👩‍👧",
    "a\r\nb\tc", "=" * 40, " " * 40, "-" * 17 + "x", "characteristics internationalization", "0123456789" * 3, "日本語の文章", "ab" * 40,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


def fuzz(n):
    rng = random.Random(7)
    parts = ["the ", "'s", "\n", "  ", "<s>", "Ünï", "漢", "🎈", " ", "12", "%%%", "a", "zq", "====", "internation", "alization ", "▁"]
    return ["".join(rng.choice([*parts, chr(rng.randrange(32, 0x2FFF))]) for _ in range(rng.randrange(12))) for _ in range(n)]


def counts(steps: bytes) -> list[int]:
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)]).tolist()


@pytest.mark.parametrize("remembered, pairs", [(3, 3), (500_000, 500_000)])
def test_every_prefix(library, monkeypatch, remembered, pairs):
    monkeypatch.setattr(token_counts, "REMEMBERED", remembered)
    monkeypatch.setattr(token_counts, "PAIRS", pairs)
    model = token_counts.Pieces(tokenizer_path(PIECES))
    texts = ODD + fuzz(150)
    for at in range(0, len(texts), 10):
        for text, steps in zip(texts[at : at + 10], model.steps(texts[at : at + 10])):
            assert counts(steps) == [len(library.encode(text[:n])) for n in range(len(text) + 1)], text


def test_long_texts(library):
    model = token_counts.Pieces(tokenizer_path(PIECES))
    texts = ["x" * 20_000, "ab c" * 20_000, "e漢" * 5000, "".join(fuzz(400))]
    assert [counts(s)[-1] for s in model.steps(texts)] == [len(library.encode(t)) for t in texts]
    assert not any(len(word) > token_counts.SHORT for word in model)


def test_questions(spark, library):
    ship(spark)
    rows = [(i, t) for i, t in enumerate([None, *ODD, *fuzz(20)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS n_tokens")
    found = token_counts.with_counts(docs, tokenizer_path(PIECES))
    assert found.columns == ["doc_id", "text", "token_steps", "n_tokens"]
    steps = F.col("token_steps")
    for budget in (0, 1, 3):
        asked = found.select(
            "text", "n_tokens", token_counts.tokens_at(steps, 2).alias("two"),
            token_counts.longest_within(steps, budget).alias("most"),
            token_counts.truncated(F.col("text"), steps, budget).alias("cut"),
        ).collect()
        for r in asked:
            text = r["text"] or ""
            assert r["n_tokens"] == len(library.encode(text))
            assert r["two"] == len(library.encode(text[:2]))
            most = max(n for n in range(len(text) + 1) if len(library.encode(text[:n])) <= budget)
            assert r["most"] == most
            assert r["cut"] == (None if r["text"] is None else text[:most])
    assert token_counts.with_counts(docs.limit(0), tokenizer_path(PIECES)).count() == 0


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        token_counts.Pieces(str(tmp_path / "none.model"))


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op12_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)
