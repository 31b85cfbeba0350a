"""From raw documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the last
returns the pieces of packed sequences.  ``run`` writes each stage to the shared folder and reads it
again, as a job that runs the stages one by one would.
"""

from __future__ import annotations

from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import mixing, packing, quality, setsketch, suffix_dedup
from wardflow.llm.common import partitions, pick, small_batches, strings, table
from wardflow.llm.queries import TOKENIZERS
from wardflow.session import materialise

#: Shortest repeated passage that is cut, in bytes: no passage of over 50 words is shorter.
REPEAT_BYTES = 100
MAX_REPEATS = 1.5


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, by exact name, whatever others there are."""
    return pick(docs, **{c: c for c in COLUMNS})


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of ``docs``, does not reject."""
    docs = _documents(docs)
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the document of the smallest id.

    Rows of equal ids count as one document and stay or go together.
    """
    docs = _documents(docs)
    kept = setsketch.near_duplicates(docs, words=5, percent=80).filter("kept")
    kept = kept.select(F.col("doc_id").alias("kept_doc_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_doc_id"]), "left_semi")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; a text that loses everything goes."""
    docs = _documents(docs)
    found = suffix_dedup.remove_repeats(docs, min_bytes=REPEAT_BYTES, whole_characters=True)
    text = F.when(F.size("spans") > 0, F.col("kept").cast("string")).otherwise(F.col("row.text"))
    out = found.withColumn("text", text)
    out = out.filter((F.size("spans") == 0) | (F.octet_length("text") > 0))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(
        *[
            F.when(F.size("spans") > 0, changed[c]).otherwise(F.col(f"row.{c}")).alias(c)
            if c in changed
            else F.col(f"row.{c}").alias(c)
            for c in docs.columns
        ]
    )


def _with_tokens(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_tokens``, the ids that packing gives the text and its end."""
    path, text_at = f"{TOKENIZERS}/byte_bpe_50k.json", docs.columns.index("text")

    def run(batches):
        encoder = packing.Encoder(path)
        for rows in batches:
            counts = [len(encoder.encode(t)) // 4 + 1 for t in strings(rows[text_at])]
            columns = [*rows.columns, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "n_tokens"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*fields, "n_tokens bigint"]))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources made more even by repeating the smaller ones; every document is used.

    Rows are written in the permuted order of the mixture, as packing takes them as they come.
    """
    counted = materialise(_with_tokens(_documents(docs)), "mix-tokens")
    mixed = mixing.mix_sources(counted, F.col("n_tokens"), max_repeats=MAX_REPEATS)
    # Rows of equal ids have one place in the order; their texts part them.
    order = ("mix_order", F.xxhash64("text"))
    mixed = mixed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return mixed.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


def _bounded(stage):
    """The stage with batches of texts that are small in memory."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality classifier", _bounded(keep_quality)),
    ("near duplicates", _bounded(drop_near_duplicates)),
    ("suffix-array dedup", _bounded(cut_repeats)),
    ("source mixing", _bounded(mix)),
    ("packing", _bounded(pack)),
]

#: SQL has no expression for these stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
