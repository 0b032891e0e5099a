"""The corpus pipeline: quality filter, exact and near deduplication, mixing, tokenization.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. A stage's result reads scratch tables of its own,
which stay as long as it is wanted; ``run`` deletes them once the result is written.

Defined cases: rows are decided on one by one, whatever their ids. Of rows with equal texts one stays, also where they
share an id or have none; rows with one id and different texts are different documents. Of equal ids the first row counts
as the smaller, and null ids come after all others. Null, empty and white texts are equal texts, resemble nothing, and
are never taken into the mix. The mix can take words of a row twice: it gives a row for each time round. Further columns
go along to the mix, whatever they are called; the last stage names its own. Empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radiospark.llm import bpe, exact_dedup, minhash, mixing, quality
from radiospark.llm.common import release, table, written
from radiospark.session import tracked

RANKS = "byte_bpe_multi_50k.tiktoken"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row, ``_row``, written so that it stays the same; ids can be null or repeated."""
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")


def _place() -> Column:
    """The order of rows that resemble each other: by id, null ids last, then by row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality classifier accepts; it is trained on the labelled rows of ``docs``."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where("predicted = 1").select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the smallest doc_id, one row whatever their ids."""
    rows = _keyed(docs)
    kept = exact_dedup.exact_duplicates(rows.select(_place().alias("doc_id"), "text")).where("kept")
    return rows.join(kept.select("doc_id._row"), "_row", "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates keep the row with the smallest doc_id, one row whatever their ids."""
    rows = _keyed(docs)
    found = minhash.classes(rows, "_row").select(F.col("doc_id").alias("_row"), "class_id")
    kept = found.join(rows.select("_row", "doc_id"), "_row").groupBy("class_id").agg(F.min(_place()).alias("first"))
    return rows.join(kept.select("first._row"), "_row", "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: one row for each time round, with the words taken."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every text: doc_id, source, n_tokens, ids_sha256, decoded_sha256."""
    done = bpe.round_trip(docs.select("doc_id", "source", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return done.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier, the mix and the encoder are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with tracked() as behind:
            made = stage(spark, docs, sf_dir)
        kept = written(made, "stage")
        release(docs, *behind)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
