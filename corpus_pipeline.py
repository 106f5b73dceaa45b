"""A corpus cleaned and packed: the stages, each over all that the one before kept.

Every stage takes and returns the columns of ``documents`` (others are dropped); the last one returns pieces of token sequences. Stages are
written in between, so a lost executor costs the stage it was in. Very long texts are gone through in time in proportion to them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import minhash, packing, pii, quality, substrings
from tessera.llm.common import importable, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, counting the characters anew."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the rules nor the estimates of their language and source reject.

    Each row is judged by its own text: repeated rows and ids share their verdict and stay as many, null languages and sources
    are groups of their own. Null texts and texts without words are rejected. An empty table gives an empty one.
    """
    importable(spark)
    return quality.good_documents(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: similarity of 0.8 or more on shingles of five words.

    The smallest doc_id stays. Rows without an id, and different texts under one id, are judged by their own text; an id goes before none,
    equal rows become one. Texts without words are linked with nothing and stay. An empty table gives an empty one.
    """
    importable(spark)
    return minhash.one_of_each(docs.select(*COLUMNS), length=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur more than once.

    All copies of a passage go, and so does all of a text that a repeated row or a copy repeats; texts that lose nothing keep their
    lines. Every row stays, with an empty text where nothing is left or there was none. An empty table gives an empty one.
    """
    importable(spark)
    return _documents(substrings.without_repeats(docs.select(*COLUMNS), words=35, layout=True))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the names of its kinds.

    Every row stays, repeated ones and those without an id too; null texts become empty; where spans overlap, the one that starts
    first names them. An empty table gives an empty one.
    """
    return _documents(pii.masked(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, a row per piece of a document.

    Null and empty texts are the end id alone; repeated rows and null ids are packed like others; equal lengths are told apart by a hash of
    their row, so a run packs alike again. A text longer than a sequence is cut. An empty table gives no rows.
    """
    importable(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("PII", mask_personal_data),
    ("best-fit packing", pack),
]

#: Components, estimates and tokenizers: SQL can't express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
