"""The corpus pipeline, stage by stage, against plain versions of its stages."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from test_simhash import plain_components, plain_fingerprint

from parcelscope.llm.suite import QUERIES, tokenizer_path
from parcelscope.llm.text import table
from parcelscope.settings import staged

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    kept = {r["doc_id"] for r in QUERIES["op4_quality"](spark, FOLDER).where("kept").collect()}
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r["doc_id"]: r for r in docs.collect()}
        docs = staged(stage(spark, docs, FOLDER), f"test-{name}")
        if name != "tokens":
            assert docs.columns == columns
    assert set(inputs["near_duplicates"]) == kept
    prints = sorted((d, plain_fingerprint(r["text"])) for d, r in inputs["near_duplicates"].items())
    assert set(inputs["private_values"]) == set(plain_components(prints))
    assert set(inputs["mixing"]) == set(inputs["private_values"])
    changed = [d for d, r in inputs["mixing"].items() if r["text"] != inputs["private_values"][d]["text"]]
    assert changed and len(changed) < len(inputs["mixing"]) / 2
    import tokenizers

    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    rows = docs.collect()
    words = Counter()
    for r in rows:
        text = library.decode(r["token_ids"], skip_special_tokens=False)
        assert inputs["mixing"][r["doc_id"]]["text"].startswith(text)
        assert r["n_tokens"] == len(r["token_ids"]) and library.encode(text, add_special_tokens=False).ids == r["token_ids"]
        words[r["source"]] += len(text.split())
    total = sum(len(r["text"].split()) for r in inputs["mixing"].values())
    assert abs(sum(words.values()) - 1.5 * total) <= len(words)


def test_empty(spark, tmp_path):
    table(spark, FOLDER, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
