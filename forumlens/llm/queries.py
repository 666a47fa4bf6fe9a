"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import alignment, bpe_automaton, byte_bpe, decontamination, hmm, quotations, repair, shuffling, simhash, suffix_dedup, topk, toxicity, warc
from forumlens.llm.common import read, utf8_bytes

TOKENIZER = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest, archive = warc.scratch_archive(read(spark, folder, "pages", "page_id", "url", "html"))
    return warc.read_warc(manifest, archive).drop("payload", "url", "file")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents", "doc_id", "text"))


def op4_hmm(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return hmm.score_texts(read(spark, folder, "documents", "doc_id", "text"), F.coalesce(fold != 1, F.lit(True))).drop("text")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, p_quality, p_toxic, is_quality and is_toxic of each document."""
    docs = read(spark, folder, "documents", "doc_id", "text")
    return toxicity.judge(docs, read(spark, folder, "labels", "doc_id", "quality", "toxic")).drop("text")


def op6_quotations(spark: SparkSession, folder: str) -> DataFrame:
    """conv_id, turn, role, text without quotes, reply_to, thread, n_quotes and n_linked of each message."""
    return quotations.link_quotations(read(spark, folder, "conversations", "conv_id", "turn", "role", "text"))


def op7_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    placed = shuffling.external_shuffle(read(spark, folder, "documents", "doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read(spark, folder, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    scanned = decontamination.scan_windows(docs, read(spark, folder, "benchmark", "item_id", "text"))
    return decontamination.judged(scanned).drop("text", "hits", "items")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return bpe_automaton.encode_documents(docs, public_tokenizers.path(TOKENIZER), digests=True).drop("text")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    paths = [public_tokenizers.path(name) for name in (BYTE_LEVEL, PIECES)]
    return alignment.align_documents(docs, *paths, public_tokenizers.PATTERN).drop("text")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults, by the hash of conversation and turn."""
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    harm = F.crc32(F.encode(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")), "utf-8")) % 20
    text = F.when(harm == 1, F.lit("")).when(harm == 2, F.regexp_replace(as_text("text"), "[.!?]", "")).otherwise(as_text("text"))
    role = F.when(harm == 4, F.lit("user")).otherwise(as_text("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(harm == 3, 2).otherwise(1)))
    return turns.filter(harm != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    found = repair.reports(repair.repair(damaged(turns)))
    every = turns.select(F.col("conv_id").alias("conv")).distinct()
    met = every.join(found, F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return met.select(F.col("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return byte_bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, digests=True).drop("text")


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_top_k, op3_simhash, op4_hmm, op5_toxicity, op6_quotations, op7_shuffle,
        op8_suffix_dedup, op9_decontamination, op10_bpe, op11_alignment, op12_repair, op13_byte_bpe,
    )
}
