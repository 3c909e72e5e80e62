"""From raw documents to token ids: quality, near-duplicates, private values, mixing, tokens.

Each stage takes (session, docs, data folder) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm import byte_pairs, mixing, pseudonyms, quality, simhash
from parcelscope.llm.shipping import ship
from parcelscope.llm.suite import PSEUDONYM_KEY, tokenizer_path
from parcelscope.llm.text import table
from parcelscope.settings import remove, scratch_dir, scratch_run

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's fences."""
    return quality.of_good_quality(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints, the one with the smallest id."""
    ship(spark)
    return simhash.without_near_duplicates(docs)


def hide_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private numbers, addresses and secrets replaced by pseudonyms of the same format."""
    return pseudonyms.with_pseudonyms(docs, PSEUDONYM_KEY).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and cut to their sources' target weights."""
    return mixing.mixture(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text they decode to."""
    ship(spark)
    return byte_pairs.round_trip(docs, tokenizer_path(), keep=["doc_id", "lang", "source"]).select(
        "doc_id", "lang", "source", "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("private_values", hide_private_values),
    ("mixing", mix_sources),
    ("tokens", to_tokens),
]

# Token ids are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written before the next one starts. What a stage staged on its way, and the
    rows of the stage before it, are removed then, so disk holds two stages at most."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = scratch_dir(spark, f"pipeline-{name}")
        with scratch_run(spark, name):
            made = stage(spark, docs, sf_dir)
            made.write.mode("overwrite").parquet(out)
        docs = spark.read.schema(made.schema).parquet(out)
        if before is not None:
            remove(spark, before)
        before = out
    return docs
