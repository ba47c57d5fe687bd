"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.llm import (align, bpe, chat, exact_dedup, fingerprints, line_dedup, merkle, mixing, near_dedup,
                          ngram_join, pii, quality, suffix_dedup)
from laketide.llm.common import prepare, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    done = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def of(kind: str):
        return F.filter("pii", lambda s: s["kind"] == kind)
    base = [k.name for k in pii.KINDS[:pii.N_BASE]]
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.joined_spans(F.filter("pii", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.1f", s["score"])), ",").alias("scores"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)],
                                  "conv_id bigint, turn bigint, role string, text string")
    done = chat.format_chats(turns.unionByName(extra))
    read = done.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                       chat.read_back(F.col("formatted")).alias("turns"),
                       chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    done = mixing.copies(table(spark, sf_dir, "documents"))
    return done.withColumn("source_weight", F.round("source_weight", 9))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                          public_tokenizers.PATTERN)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    done = near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=3, similarity=(85, 100))
    return done.select("doc_id", "n_shingles", "component_id", "kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.drop_lines(docs, line_dedup.line_drops(docs, min_docs=10))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    done = ngram_join.ngram_join(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_shingles", "component_id")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    cut = F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(cut, F.translate(docs["text"], "\n", "")).otherwise(docs["text"])
    received = merkle.leaf_digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"], text)
    done = merkle.manifest(docs, also={"received": received})
    folded = done.withColumn("folded_root", merkle.fold(F.col("received"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return align.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_pii, op3_chat_format, op4_suffix_dedup, op5_fingerprints, op6_quality, op7_mixing,
    op8_bpe, op9_near_dedup, op10_line_dedup, op11_ngram_join, op12_merkle, op13_align)}
