"""Registered queries of the training-data operators: (session, data folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelscope.llm import (
    byte_pairs, chat, licenses, merkle, mixing, negatives, neighbours, pseudonyms, quality, simhash, token_counts,
    url_rules, wrappers,
)
from parcelscope.llm.shipping import ship
from parcelscope.llm.text import table

# A key for tests and demonstrations; production passes its own to the operator.
PSEUDONYM_KEY = "not a secret"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(ship(spark), folder)

    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The vocabulary file, installed with the public tokenizers package on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judged(pages).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query
def op3_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = byte_pairs.round_trip(table(spark, folder, "documents"), tokenizer_path(), keep=["doc_id"])
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.with_quality(table(spark, folder, "documents"), carry=["doc_id"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


@query
def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    return chat.digests(chat.conversations(rows.unionByName(extra)))


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op9_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    rows = pseudonyms.with_pseudonyms(table(spark, folder, "documents"), PSEUDONYM_KEY)
    return rows.select("doc_id", "text", "n_chars", "pii_kinds")


@query
def op10_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    rows = wrappers.with_main_text(table(spark, folder, "pages"), carry=["page_id", "url"])
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, held against a copy in which one document in five is lower-cased."""
    docs = table(spark, folder, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", upper, upper.lower())
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    claimed = merkle.leaf(*[F.when(touched, lowered).otherwise(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS])
    made = merkle.manifest(docs, carry={"claimed": claimed})
    root = F.lit(made.root)
    folded = merkle.folded(F.col("claimed"), F.col("path"))
    rows = merkle.proofs(made).select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    rows = token_counts.with_counts(docs, tokenizer_path(PIECES), keep=["doc_id", "n_bytes"])
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)
