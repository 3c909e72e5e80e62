"""Byte-pair encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest

from parcelscope.llm import byte_pairs
from parcelscope.llm.shipping import ship
from parcelscope.llm.suite import QUERIES, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    None, "", " ", "\n", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 50, "  \n\n  x 　 y \x1c\x1d z\x85q",
    "don't I'LL we'll 'S", " " * 50 + "x" + " " * 7, "a \nb", "a\n b", "a\n  b", "a\n \nb ", "日本語🎉👩‍👩‍👧 é é",
    "0123456789" * 30, "\r\n\t\x0b\x0c", "x" * 3000, "ab" * 3000, "tail\n",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def fuzz(n):
    rng = random.Random(5)
    parts = ["the ", "'s", "\n", "  ", "<|endoftext|>", "Ünï", "漢", "🎈", " ", "12", "%%%", "a", "zq"]
    return ["".join(rng.choice([*parts, chr(rng.randrange(32, 0x2FFF))]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [10, 250_000])
def test_ids_and_text(library, monkeypatch, remembered):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", remembered)
    table = byte_pairs.Merges(tokenizer_path())
    texts = [t or "" for t in ODD] + fuzz(300)
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, ends = table.encode(part)
        for n, text in enumerate(part):
            own = ids[ends[n] : ends[n + 1]].tolist()
            assert own == library.encode(text, add_special_tokens=False).ids
            assert table.decode(own) == library.decode(own, skip_special_tokens=False)


def test_broken_ids_decode(library):
    table = byte_pairs.Merges(tokenizer_path())
    ids = library.encode("é🎉", add_special_tokens=False).ids[:-1]
    assert table.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert table.decode([10**9]) == ""


def test_columns(spark, library):
    ship(spark)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, "again"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS decoded")
    back = byte_pairs.decoded(byte_pairs.encoded(docs, tokenizer_path()), tokenizer_path())
    assert back.columns == ["doc_id", "text", "token_ids", "decoded"]
    for r in back.collect():
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    both = byte_pairs.round_trip(docs, tokenizer_path())
    assert both.columns == back.columns
    assert sorted(map(str, both.collect())) == sorted(map(str, back.collect()))
    assert byte_pairs.encoded(docs.limit(0), tokenizer_path()).count() == 0
    assert byte_pairs.round_trip(docs.limit(0), tokenizer_path()).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op3_byte_pairs"](spark, folder).collect()
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
