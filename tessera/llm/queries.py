"""The registered queries of this package, one per operator, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, kdtree, minhash, packing, pieces, pii, quality, runs, substrings, token_counts, token_files
from tessera.llm import toxicity, whitening
from tessera.llm.common import WORD, importable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_chat_formatting(spark, sf):
    spoken = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    words = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        words.alias("text"),
    )
    chats = chat.formatted(spoken.unionByName(extra), public_tokenizers.path(BYTE_BPE))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.read_back(chats).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op2_piece_encoding(spark, sf):
    rows = pieces.encoded_and_decoded(table(spark, sf, "documents"), public_tokenizers.path(PIECE_BPE))
    return rows.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op3_token_files(spark, sf):
    docs = table(spark, sf, "documents")
    folder = token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), end_id=1)
    rows = token_files.read_token_files(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_exact_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return kdtree.top_k(vectors, "embedding", F.col("vec_id") % 20 == 0, k=20, scale=64)


@query
def op5_personal_data(spark, sf):
    rows = pii.personal_data(table(spark, sf, "documents"))
    base = F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256")
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, "spans")


@query
def op6_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"), threshold=0.3)


@query
def op7_minhash_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), length=4, percent=80)


@query
def op8_best_fit_packing(spark, sf):
    docs = table(spark, sf, "documents")
    packed = packing.packed_documents(docs, public_tokenizers.path(WORD_BPE), end_id=0, capacity=2048)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query
def op9_substring_dedup(spark, sf):
    rows = substrings.without_repeats(table(spark, sf, "documents"), words=35)
    return rows.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


@query
def op10_quality_rules(spark, sf):
    rows = quality.quality(table(spark, sf, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *counts, "base_failed", "kept")


@query
def op11_token_counts(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path(BYTE_BPE), limit=512)


def _with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth, by a hash of their id, repeat a stretch of their words to their end.

    Their words are joined by one space. A null id changes nothing.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1)))
    n, g = F.size("words"), F.floor(h / 10)
    rows = docs.select("doc_id", "text", words.alias("words"), g.alias("g")).withColumn("n", n.cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("rest", F.col("n") - F.col("a"))
    rows = rows.withColumn("p", 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8)))
    a, rest, p = (F.col(c).cast("int") for c in ("a", "rest", "p"))
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(rest / p).cast("int")))
    changed = F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), rest))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, sf):
    rows = runs.document_runs(_with_periods(table(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), line.alias("lines"), "collapsed")
    period = -F.col("best")["q"]
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("best")["s"]).alias("start"),
        F.col("best")["l"].alias("length"),
        period.alias("period"),
        F.floor(1000 * F.col("best")["l"] / period).alias("exponent_milli"),
        F.sha2(F.encode(F.array_join("lines", ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


@query
def op13_embedding_whitening(spark, sf):
    return whitening.whitened(table(spark, sf, "embeddings"), "vec_id", "embedding", scale=256, components=4)
