"""The registered queries of this subpackage: operators with production parameters, whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scoped_conf
from . import fill_middle, html_text, mixing, packing, permutation_index, quality, secrets
from . import setsketch, spelling, suffix_dedup, tokens, warc, winnowing
from .common import pick, small_batches, table
from .oracles import ORACLES  # noqa: F401 - part of the contract of this module

#: Folder of public vocabularies; their files are only read.
TOKENIZERS = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a unigram vocabulary of 32,000 pieces."""
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


@_query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of every document and of its edited text."""
    return winnowing.compare_with_successor(table(spark, sf_dir, "documents"))


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses of every document in a mixture as even as repetition of at most 1.5 allows."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", source="source", text="text")
    words = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))
    mixed = mixing.mix_sources(docs, words, max_repeats=1.5)
    return mixed.select("doc_id", "source", "mix_epoch", "mix_order.place", "mix_order.block", "mix_order.row")


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 50 bytes share with an earlier one."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    found = suffix_dedup.remove_repeats(docs, min_bytes=50)
    n_bytes = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    # Whole pages: as few at a time to Python, and from Parquet while the archives are written.
    small_batches(spark, 256)
    with scoped_conf(spark, {"spark.sql.parquet.columnarReaderBatchSize": "512"}):
        return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@_query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by two-word shingles at a similarity of 0.8."""
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@_query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every vector whose id is divisible by 100."""
    rows = pick(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding")
    return permutation_index.nearest_neighbours(rows, rows.filter(F.col("vec_id") % 100 == 0))


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model)
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@_query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns, and context values that are hard to guess."""
    words = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
    paths = [public_tokenizers.path(name) for name in words]
    return secrets.digest_spans(secrets.scan_secrets(table(spark, sf_dir, "documents"), paths))


@_query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, assembled and restored."""
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))


@_query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
